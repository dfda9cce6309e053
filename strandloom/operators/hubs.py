"""Hubs: one node for what several sources mean, with a link from each member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SAME_AS, TYPE, as_triples, union_frames
from .joins import best_of


def shared_keys(df: DataFrame, entity: str, key: str) -> DataFrame:
    """The keys of more than one entity."""
    return df.groupBy(key).agg(F.countDistinct(entity).alias("n")).where("n > 1").select(key)


def unify(df: DataFrame, entity: str, key: str, prefix: str, kind: str, key_predicate: str) -> DataFrame:
    """Triples of a hub for each key of more than one entity: its type, its key, and sameAs from each entity."""
    members = df.select(entity, key).distinct().join(shared_keys(df, entity, key), key)
    hub = F.concat(F.lit(prefix), F.col(key).cast("string"))
    hubs = members.select(hub.alias("hub"), F.col(key).cast("string").alias("key")).distinct()
    return union_frames([
        as_triples(hubs, "hub", TYPE, F.lit(kind)),
        as_triples(hubs, "hub", key_predicate, "key"),
        as_triples(members.select(F.col(entity).alias("member"), hub.alias("hub")), "member", SAME_AS, "hub"),
    ])


def by_routes(routes: list[DataFrame], entity: str, hub: str) -> DataFrame:
    """Distinct (entity, hub) over several routes, each a frame that has both columns."""
    return union_frames([r.select(entity, hub) for r in routes]).distinct()


def reached(hubs: DataFrame, links: DataFrame, hub: str) -> DataFrame:
    """Only hubs that some link reaches."""
    return hubs.join(links.select(hub).distinct(), hub, "left_semi")


def pairing(rows: DataFrame, key: str, value: str, priority: str) -> DataFrame:
    """One value for each key: lowest priority number, then lowest value."""
    return best_of(rows.select(key, value, priority).distinct(), [key], [priority, value])


def crosswalk(df: DataFrame, table: DataFrame, on: str, present: DataFrame | None = None, target: str | None = None) -> DataFrame:
    """df through a small table of a known size; with present, only targets that occur there."""
    out = df.join(table, on)
    return out if present is None else out.join(present.select(target).distinct(), target, "left_semi")


def through(left: DataFrame, right: DataFrame, middle: str, a: str, b: str) -> DataFrame:
    """(a, b) that share a middle."""
    return left.select(a, middle).distinct().join(right.select(b, middle).distinct(), middle).select(a, b).distinct()


def share_partition(mappings: DataFrame, source: str, target: str) -> DataFrame:
    """mappings with `relation`: subClassOf where a target has several sources, else equivalent."""
    many = mappings.groupBy(target).agg(F.countDistinct(source).alias("_n"))
    return mappings.join(many, target).withColumn("relation", F.when(F.col("_n") > 1, "subsumption").otherwise("equivalence")).drop("_n")


def label_prefix(c: Column, words: list[str]) -> Column:
    """The first of some words a text starts with, followed by its end or something other than a letter."""
    out = F.lit(None).cast("string")
    for w in reversed(words):
        out = F.when(c.rlike(f"^{w}([^a-z]|$)"), F.lit(w)).otherwise(out)
    return out
