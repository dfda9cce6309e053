"""Questions over the tables, as plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import within


def split_adjusted(prices: DataFrame, splits: DataFrame, key: str = "ticker", day: str = "day", price: str = "price") -> DataFrame:
    """prices with `factor`, the product of the ratios of later splits, and `adjusted`.

    Instead of a join of every price with every later split, both are merged into one ordered stream per key
    and the running product is taken from the end.
    """
    a = prices.select("*", F.lit(1.0).alias("_ratio"), F.lit(True).alias("_price"), F.col(day).alias("_at"))
    b = splits.select(key, (F.col("shares_after") / F.col("shares_before")).alias("_ratio"), F.lit(False).alias("_price"), F.col("split_date").alias("_at"))
    later = W.partitionBy(key).orderBy(F.desc("_at"), F.desc("_price")).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = a.unionByName(b, allowMissingColumns=True).withColumn("factor", F.product("_ratio").over(later)).where("_price")
    return out.withColumn("adjusted", F.col(price) / F.col("factor")).drop("_ratio", "_price", "_at")


def around_split(quotes: DataFrame, splits: DataFrame, key: str = "ticker", day: str = "day", time: str = "time", price: str = "price") -> DataFrame:
    """(key, split_date, before, after): the last price of the trading day before each split and of the first from its date on."""
    last = quotes.groupBy(key, day).agg(F.max_by(price, time).alias("close"))
    chain = W.partitionBy(key).orderBy(day)
    days = last.withColumns({"next_day": F.lead(day).over(chain), "next_close": F.lead("close").over(chain)})
    hit = (F.col(day) < F.col("split_date")) & (F.col("next_day") >= F.col("split_date"))
    return days.join(splits.select(key, "split_date"), key).where(hit).select(key, "split_date", F.col("close").alias("before"), F.col("next_close").alias("after"))


def traded(quotes: DataFrame, key: str, time: str, volume: str) -> DataFrame:
    """Rows that traded since the row before: the running total's difference, filtered after it is taken."""
    gap = F.col(volume) - F.lag(volume).over(W.partitionBy(key).orderBy(time))
    return quotes.withColumn("traded", gap).where("traded > 0")


def widest_spreads(quotes: DataFrame, key: str, bid: str, ask: str, n: int = 5) -> DataFrame:
    """The n widest bid-ask spreads in basis points of the middle."""
    middle = (F.col(bid) + F.col(ask)) / 2
    out = quotes.where((F.col(bid) > 0) & (F.col(ask) >= F.col(bid))).withColumn("spread_bp", (F.col(ask) - F.col(bid)) / middle * 10_000)
    return out.orderBy(F.desc("spread_bp"), key).limit(n)


def movers(quotes: DataFrame, key: str, first: str, last: str, n: int = 10) -> DataFrame:
    """The n largest moves from first to last, either way."""
    out = quotes.where(F.col(first) > 0).withColumn("move", F.col(last) / F.col(first) - 1)
    return out.orderBy(F.desc(F.abs("move")), key).limit(n)


def before_after(rows: DataFrame, key: str, time: str, value: str, moment: str) -> DataFrame:
    """(key, before, after, change): the last value before a moment and the first from it on, as filtered aggregates."""
    t = F.col(time)
    early, late = F.when(t < moment, F.struct(t, F.col(value).alias("v"))), F.when(t >= moment, F.struct(t, F.col(value).alias("v")))
    out = rows.groupBy(key).agg(F.max(early)["v"].alias("before"), F.min(late)["v"].alias("after")).where("before IS NOT NULL AND after IS NOT NULL")
    return out.withColumn("change", F.col("after") - F.col("before"))


def filings_to_minutes(filings: DataFrame, minutes: DataFrame, key: str, filed: str, minute: str) -> DataFrame:
    """Minutes from one before to fifteen after each filing."""
    return within(filings, minutes, key, filed, minute, before=60, after=900)


def chain_summary(options: DataFrame, chain: list[str], right: str, strike: str) -> DataFrame:
    """Contracts, calls, puts and strikes of each chain."""
    return options.groupBy(*chain).agg(
        F.count("*").alias("contracts"), F.count_if(F.col(right) == "CALL").alias("calls"), F.count_if(F.col(right) == "PUT").alias("puts"), F.min(strike).alias("low"), F.max(strike).alias("high")
    )


def cross_section(quotes: DataFrame, key: str, time: str, value: str, at: str, tie: str) -> DataFrame:
    """(key, value, quotes): the newest value of each key up to a time, and how many there were; equal times are ordered by tie."""
    some = quotes.where(F.col(time) <= F.lit(at).cast("timestamp"))
    return some.groupBy(key).agg(F.max_by(value, F.struct(time, tie)).alias(value), F.count("*").alias("quotes"))


def number_series(rows: DataFrame, key: list[str], period: str, newest: list[str], value: str) -> DataFrame:
    """(*key, period, value): for each period the value stated last."""
    return rows.groupBy(*key, period).agg(F.max_by(value, F.struct(*newest)).alias(value))
