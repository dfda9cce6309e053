"""Direct feeds: constituents, splits, company facts, minute quotes. A missing or stale feed is None, an empty one an empty frame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import digits_of, padded
from ..model import is_finite
from ..storage import exists, modified

FEED_ZONE = "America/New_York"
#: The columns a constituents file must have, and the names they get.
CONSTITUENT_COLUMNS = {"Symbol": "ticker", "GICS Sector": "sector", "GICS Sub-Industry": "sub_industry", "CIK": "cik"}


def constituents(spark: SparkSession, folder: str, day: str) -> DataFrame | None:
    """(ticker, sector, sub_industry, cik, quote_symbol) of the day's file, else of `latest.csv`; a file without the columns is passed over."""
    for name in (f"{day}.csv", "latest.csv"):
        path = f"{folder.rstrip('/')}/{name}"
        if exists(spark, path):
            rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
            if set(CONSTITUENT_COLUMNS) <= set(rows.columns):
                alt = F.col("quote_symbol") if "quote_symbol" in rows.columns else F.lit(None).cast("string")
                cols = [F.trim(F.col(f"`{c}`")).alias(n) for c, n in CONSTITUENT_COLUMNS.items() if n != "cik"]
                return rows.select(*cols, padded(digits_of(F.trim("CIK")), 10).alias("cik"), F.coalesce(alt, F.trim("Symbol")).alias("quote_symbol"))
    return None


def stale(spark: SparkSession, path: str, day: str, zone: str = FEED_ZONE) -> bool:
    """Whether a file was last written before the day began."""
    began = dt.datetime.fromisoformat(day).replace(tzinfo=ZoneInfo(zone))
    return modified(spark, path) < began.timestamp()


def splits_of(rows: DataFrame, day: str) -> DataFrame:
    """(ticker, ratio, shares_after, shares_before, split_date) of one day, each (ticker, ratio) once.

    A ratio is two positive finite numbers around a colon; anything else has null shares. Dates are MM/DD/YYYY.
    """
    ratio = F.coalesce("split_ratio", F.lit(""))
    sides = F.split(ratio, ":", 2)
    after, before = sides.getItem(0).try_cast("double"), F.try_element_at(sides, F.lit(2)).try_cast("double")
    good = is_finite(after) & is_finite(before) & (after > 0) & (before > 0)
    when = F.try_to_timestamp(F.trim("split_date"), F.lit("MM/dd/yyyy")).cast("date")
    out = rows.select(
        F.upper(F.trim(F.coalesce("ticker", F.lit("")))).alias("ticker"),
        ratio.alias("ratio"),
        F.when(good, after).alias("shares_after"),
        F.when(good, before).alias("shares_before"),
        when.alias("split_date"),
    )
    return out.where(F.col("split_date") == F.lit(day).cast("date")).dropDuplicates(["ticker", "ratio"])


def splits(spark: SparkSession, folder: str, day: str) -> DataFrame | None:
    """The month's file, `year=YYYY/MM.snappy.parquet`, unless it is missing or stale."""
    path = f"{folder.rstrip('/')}/year={day[:4]}/{day[5:7]}.snappy.parquet"
    if not exists(spark, path) or stale(spark, path, day):
        return None
    return splits_of(spark.read.parquet(path), day)


def company_facts_of(rows: DataFrame, day: str) -> DataFrame:
    """Rows filed on a day, without those that only repeat an earlier filing; dates typed, fiscal year an int."""
    dates = {c: F.col(c).try_cast("date") for c in ("period_start", "period_end", "filed", "first_filed") if c in rows.columns}
    typed = rows.withColumns(dates).withColumn("fy", F.col("fy").try_cast("int"))
    return typed.where((F.col("filed") == F.lit(day).cast("date")) & (F.col("status").isNull() | (F.col("status") != "repeated")))


def company_facts(spark: SparkSession, folder: str, day: str) -> DataFrame | None:
    path = f"{folder.rstrip('/')}/year={day[:4]}.parquet"
    return company_facts_of(spark.read.parquet(path), day) if exists(spark, path) else None


def iso_utc(millis):
    """Milliseconds since 1970 as ISO text with a Z."""
    return F.concat(F.date_format(F.timestamp_millis(millis.cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


QUOTE_COLUMNS = {"symbol": "ticker", "bidPrice": "bid", "askPrice": "ask", "bidSize": "bid_size", "askSize": "ask_size", "lastPrice": "last", "mark": "mark", "openPrice": "open", "highPrice": "high", "lowPrice": "low", "closePrice": "prev_close", "totalVolume": "volume", "netChange": "net_change", "netPercentChange": "net_percent_change"}
_LONGS = {"bid_size", "ask_size", "volume"}


def minute_quotes_of(rows: DataFrame) -> DataFrame:
    """Typed quotes with `capture_time` from the file's name (`...HHMM.parquet` under a day's folder, or a `minute` column), each (ticker, minute) once, from the first file by name."""
    cols = [F.col(c).try_cast("string" if n == "ticker" else "bigint" if n in _LONGS else "double").alias(n) for c, n in QUOTE_COLUMNS.items() if c in rows.columns]
    times = [iso_utc(F.col(c).try_cast("bigint")).alias(n) for c, n in (("quoteTime", "quote_time"), ("tradeTime", "trade_time")) if c in rows.columns]
    minute = F.col("minute") if "minute" in rows.columns else F.regexp_extract(F.input_file_name(), r"(\d{4}-?\d{2}-?\d{2}[T_/-]?\d{2}:?-?\d{2})[^/]*\.parquet$", 1)
    source = F.col("_file") if "_file" in rows.columns else F.input_file_name()
    out = rows.select(*cols, *times, minute.alias("capture_time"), source.alias("_file"))
    first = W.partitionBy("ticker", "capture_time").orderBy("_file", *[c for c in ("quote_time", "last") if c in out.columns])
    return out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_file")


def minute_quotes(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Quotes of one file a minute; unreadable files are passed over."""
    there = [p for p in paths if exists(spark, p)]
    return minute_quotes_of(spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(*there)) if there else None
