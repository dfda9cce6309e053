"""Day-partitioned Parquet tables: nodes, edges, edge types, facts, entities, snapshots, feeds and the triples themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SPO

#: A predicate whose name has one of these is text worth searching.
TEXT_TERMS = ["name", "title", "label", "description", "headline", "summary", "comment", "text"]
SORTS = {
    "nodes": ["node_type", "node_id"],
    "edges": ["src_type", "relation", "dst_type", "src_id"],
    "facts": ["node_type", "uri", "predicate"],
    "entities": ["node_type", "uri"],
    "snapshots": ["underlying", "symbol", "uri"],
    "minute_quotes": ["ticker", "capture_time"],
    "triples": ["predicate", "subject"],
}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def publish(df: DataFrame, root: str, table: str, day: str, row_group: int | None = None) -> str:
    """Replace one day of a table. Rows are range-partitioned and sorted within partitions, which clusters row groups as a total order would, without one.

    An empty frame leaves an empty partition: the feed was read and had nothing. A missing feed is never published.
    """
    order = [c for c in SORTS.get(table, []) if c in df.columns]
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    path = f"{table_path(root, table)}/day={day}"
    write = df.write.mode("overwrite").option("compression", "zstd")
    (write.option("parquet.block.size", row_group) if row_group else write).parquet(path)
    return path


def publish_days(df: DataFrame, root: str, table: str) -> None:
    """Replace every day that occurs in df (column `day`) and no other."""
    df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table_path(root, table))


def save_triples(triples: DataFrame, path: str, files: int = 200) -> None:
    triples.select(*SPO).repartition(files).write.mode("overwrite").parquet(path)


def load_triples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*SPO)


def facts(literal_rows: DataFrame) -> DataFrame:
    return literal_rows.select("node_type", "uri", "predicate", "predicate_name", "value", "is_numeric")


def entities(literal_rows: DataFrame, terms: Sequence[str] = tuple(TEXT_TERMS)) -> DataFrame:
    """(node_type, uri, text): the sorted set of `name: value` of textual predicates, joined by "; "."""
    textual = F.lower("predicate_name").rlike("|".join(terms)) & ~F.col("is_numeric") & (F.col("value") != "")
    item = F.concat(F.col("predicate_name"), F.lit(": "), F.col("value"))
    return literal_rows.where(textual).groupBy("node_type", "uri").agg(F.concat_ws("; ", F.sort_array(F.collect_set(item))).alias("text"))


def numeric_columns(literal_rows: DataFrame) -> DataFrame:
    """(predicate_name, is_numeric): by the majority of its values."""
    share = F.avg(F.col("is_numeric").cast("int"))
    return literal_rows.groupBy("predicate_name").agg((share > 0.5).alias("is_numeric"))


def snapshots(literal_rows: DataFrame, columns: dict[str, bool] | None = None) -> DataFrame:
    """One row for each node with the largest value of each predicate as a column, numbers as doubles.

    columns: predicate name -> numeric; without it, the names are read from the data, of which there are as many as
    predicates.
    """
    if columns is None:
        columns = {r[0]: r[1] for r in numeric_columns(literal_rows).collect()}
    names = sorted(columns)
    wide = literal_rows.groupBy("node_type", "uri").pivot("predicate_name", names).agg(F.max("value"))
    typed = [F.col(f"`{n}`").try_cast("double").alias(n) if columns[n] else F.col(f"`{n}`") for n in names]
    return wide.select("node_type", "uri", *typed)


def market_coverage(quotes: DataFrame, constituents: DataFrame) -> DataFrame:
    """(capture_time, equities, options, underlyings, missing): how many there are at each time, and constituents without a quote.

    quotes: (symbol, underlying or null, capture_time); constituents: (ticker).
    """
    each = quotes.groupBy("capture_time").agg(
        F.count_if(F.col("underlying").isNull()).alias("equities"),
        F.count_if(F.col("underlying").isNotNull()).alias("options"),
        F.countDistinct("underlying").alias("underlyings"),
    )
    times = quotes.select("capture_time").distinct()
    seen = quotes.where("underlying IS NULL").select("capture_time", F.col("symbol").alias("ticker")).distinct()
    # Constituents are a bounded list; each time is checked against it once.
    lost = times.crossJoin(F.broadcast(constituents.select("ticker").distinct())).join(seen, ["capture_time", "ticker"], "left_anti")
    missing = lost.groupBy("capture_time").agg(F.sort_array(F.collect_list("ticker")).alias("missing"))
    return each.join(missing, "capture_time", "left").withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))
