"""Ordinary tables as triples, so that every operator runs on relational data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import TYPE, merged
from .naming import Namespaces

ONTOLOGY, IDS = "https://example.org/ontology/star/", "https://example.org/id/star/"
NAMESPACES = Namespaces(((ONTOLOGY, "star"),))


def uri(table: str, key: Column) -> Column:
    return F.concat(F.lit(f"{IDS}{table}/"), key.cast("string"))


@dataclass(frozen=True)
class TableMap:
    """key: columns whose values, joined by "-", name the row; links: column -> table it refers to; the other columns are literals."""

    table: str
    kind: str
    key: tuple[str, ...]
    links: dict[str, str] = field(default_factory=dict)
    literals: tuple[str, ...] | None = None

    def subject(self) -> Column:
        return uri(self.table, F.concat_ws("-", *[F.col(k).cast("string") for k in self.key]))

    def triples(self, df: DataFrame) -> DataFrame:
        """One pass: each row is exploded into its type, link and literal triples; null values make none."""
        plain = [c for c in df.columns if c not in self.key and c not in self.links] if self.literals is None else list(self.literals)
        pairs = [F.struct(F.lit(TYPE).alias("predicate"), F.lit(ONTOLOGY + self.kind).alias("object"))]
        pairs += [F.struct(F.lit(ONTOLOGY + c).alias("predicate"), uri(t, F.col(c)).alias("object")) for c, t in self.links.items()]
        pairs += [F.struct(F.lit(ONTOLOGY + c).alias("predicate"), F.col(c).cast("string").alias("object")) for c in plain]
        return df.select(self.subject().alias("subject"), F.explode(F.array(*pairs)).alias("po")).select("subject", "po.*").where("object IS NOT NULL")


MAPS = {
    m.table: m
    for m in (
        TableMap("region", "Region", ("r_regionkey",)),
        TableMap("nation", "Nation", ("n_nationkey",), {"n_regionkey": "region"}),
        TableMap("customer", "Customer", ("c_custkey",), {"c_nationkey": "nation"}),
        TableMap("supplier", "Supplier", ("s_suppkey",), {"s_nationkey": "nation"}),
        TableMap("part", "Part", ("p_partkey",)),
        TableMap("orders", "Order", ("o_orderkey",), {"o_custkey": "customer"}),
        TableMap("events", "Event", ("event_id",)),
    )
}


def lift(spark: SparkSession, folder: str, tables: list[str]) -> DataFrame:
    """The set of triples of several tables."""
    return merged([MAPS[t].triples(spark.read.parquet(f"{folder}/{t}.parquet")) for t in tables])
