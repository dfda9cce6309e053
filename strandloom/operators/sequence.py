"""What comes next: ordered chains within partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import as_triples


def sequence(df: DataFrame, entity: str, partition: list[str], order: list[str | Column], leads: list[str] = ()) -> DataFrame:
    """Each entity with the next one of its partition.

    An entity that occurs more than once in a partition counts at its first place; leads are taken after that.
    order must make the order total.  Columns: those of df, `next_<entity>` and `next_<c>` for each of leads; rows without
    a next entity, or whose next is the entity itself, are left out.
    """
    first = W.partitionBy(*partition, entity).orderBy(*order)
    chain = W.partitionBy(*partition).orderBy(*order)
    once = df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    out = once.withColumns({f"next_{c}": F.lead(c).over(chain) for c in [entity, *leads]})
    return out.where(F.col(f"next_{entity}").isNotNull() & (F.col(f"next_{entity}") != F.col(entity)))


def sequence_triples(df: DataFrame, entity: str, partition: list[str], order: list[str | Column], predicate: str) -> DataFrame:
    return as_triples(sequence(df, entity, partition, order), entity, predicate, f"next_{entity}").distinct()


def escalations(df: DataFrame, entity: str, partition: list[str], order: list[str | Column], severity: str, urgency: str) -> DataFrame:
    """(entity, next) where the next of the chain is more severe, or as severe and more urgent. Rows of unknown severity are not in the chain; unknown urgency is 0."""
    known = df.where(F.col(severity).isNotNull()).withColumn(urgency, F.coalesce(urgency, F.lit(0)))
    out = sequence(known, entity, partition, order, [severity, urgency])
    worse = (F.col(f"next_{severity}") > F.col(severity)) | ((F.col(f"next_{severity}") == F.col(severity)) & (F.col(f"next_{urgency}") > F.col(urgency)))
    return out.where(worse).select(entity, f"next_{entity}").distinct()


def latest(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key by the order: give it descending for the latest, and total. Only a key's first row of each task is dealt out."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def newest_day(df: DataFrame, key: list[str], day: str) -> DataFrame:
    """All rows of each key's newest day."""
    return df.withColumn("_r", F.rank().over(W.partitionBy(*key).orderBy(F.desc(day)))).where("_r = 1").drop("_r")


def increments(df: DataFrame, key: list[str], order: list[str | Column], total: str, name: str) -> DataFrame:
    """A running total's difference from the row before; the first row has null."""
    return df.withColumn(name, F.col(total) - F.lag(total).over(W.partitionBy(*key).orderBy(*order)))
