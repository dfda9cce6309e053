"""Pairs of things that share something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sharing(df: DataFrame, entity: str, key: list[str]) -> DataFrame:
    """(a, b, *key) for a < b with an equal key: each unordered pair once.

    The result has a row for each pair, which is quadratic in a key's entities by definition; a hub
    (operators.hubs) says the same with one row for each entity.
    """
    once = df.select(entity, *key).distinct()
    a = once.select(F.col(entity).alias("a"), *key)
    b = once.select(F.col(entity).alias("b"), *key)
    return a.join(b, key).where("a < b").select("a", "b", *key)


def opposite(df: DataFrame, entity: str, key: list[str], side: Column, left: Column) -> DataFrame:
    """(a, b, *key): entities of one side with those of the other under an equal key. left says which side a is."""
    marked = df.withColumn("_left", left).where(side).select(entity, *key, "_left").distinct()
    a = marked.where("_left").select(F.col(entity).alias("a"), *key)
    b = marked.where("NOT _left").select(F.col(entity).alias("b"), *key)
    return a.join(b, key).select("a", "b", *key)


def ranked_about_middle(df: DataFrame, entity: str, chain: list[str], value: str, upper: Column, lower: Column, most: int = 10) -> DataFrame:
    """(a, b, *chain, rank): the i-th nearest `upper` entity above the middle of its chain's range with the i-th nearest `lower` one below.

    The middle is (min + max) / 2 over the whole chain; ranks of equal values follow the entity.
    """
    middle = (F.min(value).over(W.partitionBy(*chain)) + F.max(value).over(W.partitionBy(*chain))) / 2
    df = df.withColumn("_mid", middle).withColumns({"_up": upper & (F.col(value) > F.col("_mid")), "_low": lower & (F.col(value) < F.col("_mid"))})

    def side(flag: str, order: Column, name: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*chain).orderBy(order, entity))
        return df.where(flag).withColumn("rank", rank).where(F.col("rank") <= most).select(F.col(entity).alias(name), *chain, "rank")

    return side("_up", F.asc(value), "a").join(side("_low", F.desc(value), "b"), [*chain, "rank"]).select("a", "b", *chain, "rank")


def both_ways(edges: DataFrame, a: str, b: str, node: Column | str | None = None) -> DataFrame:
    """(node, peer) of edges that are stored once for each unordered pair."""
    out = edges.select(F.explode(F.array(F.struct(F.col(a).alias("node"), F.col(b).alias("peer")), F.struct(F.col(b).alias("node"), F.col(a).alias("peer")))).alias("e")).select("e.*")
    return out if node is None else out.where(F.col("node") == node)
