"""Dates to period hubs: months without year (`January`), years, quarters and days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import LABEL, SAME_AS, TYPE, as_triples, union_frames
from ..storage import settle

#: Fixed values.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
#: Finest first.
GRAINS = ["day", "month", "quarter", "year"]


def month_name(number: Column) -> Column:
    """Of "01" to "12"; null for anything else."""
    n = number.try_cast("int")
    return F.when(n.between(1, 12), F.element_at(F.array(*map(F.lit, MONTHS)), F.when(n.between(1, 12), n).otherwise(1)))


def periods_of(dated: DataFrame, subject: str, date: str, prefix: str) -> DataFrame:
    """(subject, period, name, kind): the month, year and, if the text has one, day of each date, as URIs under prefix.

    Dates without a month make nothing. One scan: each date is exploded into its periods.
    """
    year = F.regexp_extract(date, r"(\d{4})", 1)
    month = month_name(F.regexp_extract(date, r"\d{4}-(\d{2})", 1))
    day = F.regexp_extract(date, r"(\d{4}-\d{2}-\d{2})", 1)
    rows = F.array(*[F.struct(n.alias("name"), F.lit(k).alias("kind")) for n, k in ((month, "month"), (year, "year"), (F.when(day != "", day), "day"))])
    parsed = dated.select(F.col(subject).alias("subject"), F.col(date)).where((year != "") & month.isNotNull()).distinct()
    out = parsed.select("subject", F.explode(rows).alias("p")).select("subject", "p.*").where("name IS NOT NULL")
    return out.select("subject", F.concat(F.lit(prefix), "name").alias("period"), "name", "kind").distinct()


def finest(periods: DataFrame) -> DataFrame:
    """Each subject's periods of the finest grain it has; all ties stay."""
    order = F.array_position(F.array(*map(F.lit, GRAINS)), F.col("kind"))
    best = periods.groupBy(F.col("subject").alias("_s")).agg(F.min(order).alias("_r"))
    return periods.join(best, (F.col("subject") == F.col("_s")) & (order == F.col("_r"))).drop("_s", "_r")


def hub(prefix: str) -> Column:
    """The URI of a period's hub, `<prefix><kind>/<name>`."""
    return F.concat(F.lit(prefix), F.col("kind"), F.lit("/"), F.col("name"))


def unify_periods(periods: DataFrame, prefix: str, ontology: str) -> DataFrame:
    """Triples: hubs with type and label, sameAs from each source period, coversMonth and coversDay between hubs, observedInPeriod of subjects.

    periods: (period, name, kind) and, for those with a subject, subject; day names are ISO dates.
    """
    if "subject" in periods.columns:
        periods = settle(periods, "periods")  # subjects have far more rows than there are periods, and two branches read them
    known = settle(periods.select("period", "name", "kind", hub(prefix).alias("hub")).distinct(), "known-periods")
    hubs = known.select("hub", "name", "kind").distinct()
    kinds = F.concat(F.lit(f"{ontology}Unified"), F.initcap("kind"))
    days = hubs.where("kind = 'day'")
    month = F.concat(F.lit(f"{prefix}month/"), month_name(F.substring("name", 6, 2)))
    year = F.concat(F.lit(f"{prefix}year/"), F.substring("name", 1, 4))
    out = [
        as_triples(hubs, "hub", TYPE, kinds),
        as_triples(hubs, "hub", LABEL, "name"),
        as_triples(known, "period", SAME_AS, "hub"),
        as_triples(days.select(month.alias("a"), F.col("hub").alias("b")), "a", f"{ontology}coversDay", "b"),
        as_triples(days.select(year.alias("a"), month.alias("b")), "a", f"{ontology}coversMonth", "b"),
    ]
    if "subject" in periods.columns:
        out.append(as_triples(finest(periods.where("subject IS NOT NULL")), "subject", f"{ontology}observedInPeriod", "period"))
    return union_frames(out).distinct()


def dates_of(triples: DataFrame, entities: DataFrame, predicate: str) -> DataFrame:
    """(subject, date): stated by the entity itself, or by a node it refers to; what it states itself comes first."""
    dates = triples.where(F.col("predicate") == predicate).select("subject", F.col("object").alias("date"))
    own = entities.join(dates, "subject").select("subject", "date", F.lit(0).alias("hops"))
    refs = triples.select("subject", F.col("object").alias("_via"))
    via = entities.join(refs, "subject").join(dates.select(F.col("subject").alias("_via"), "date"), "_via").select("subject", "date", F.lit(1).alias("hops"))
    both = own.unionByName(via).distinct()
    return both.withColumn("_r", F.rank().over(W.partitionBy("subject").orderBy("hops"))).where("_r = 1").select("subject", "date")
