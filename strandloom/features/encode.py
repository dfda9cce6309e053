"""Node features: one scan per kind of evidence, each row exploded into its (dim, value) entries, summed once.

A slot is `hash(value, seed)`, absolute, modulo the part's width.  The hash is Murmur3 over the value and then the
seed as a second column; `slot_md5` is a stand-in that other engines can compute.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SUBCLASS, SUBPROPERTY, TYPE, is_finite, number_of, union_frames
from ..operators.schema import closure, property_schema
from ..storage import settle
from .layout import Layout, Part

Slot = Callable[[Column, int, Part], Column]
SEEDS = [0, 7, 13, 31]


def slot(value: Column, seed: int, part: Part) -> Column:
    return (F.abs(F.hash(value, F.lit(seed)).cast("bigint")) % part.dim + part.start).cast("int")


def slot_md5(value: Column, seed: int, part: Part) -> Column:
    code = F.conv(F.substring(F.md5(F.concat(value, F.lit(f"#{seed}"))), 1, 8), 16, 10).cast("bigint")
    return (code % part.dim + part.start).cast("int")


def entries(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[Column, Column]]) -> DataFrame:
    """df's rows with each (dim, value) pair as a row."""
    rows = F.array(*[F.struct(d.cast("int").alias("dim"), v.cast("double").alias("value")) for d, v in pairs])
    return df.select(*keys, F.explode(rows).alias("e")).select(*keys, "e.*")


def summed(entry_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries that fall on the same column add up."""
    return entry_rows.groupBy(*keys, "dim").agg(F.sum("value").alias("value"))


def numeric_shares(literal_rows: DataFrame, codes: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """(predicate, total, numeric, is_numeric): numeric if more than the threshold of its values are finite numbers and it is no code."""
    number = number_of(F.col("value")).isNotNull()
    out = literal_rows.groupBy("predicate").agg(F.count("*").alias("total"), F.sum(number.cast("long")).alias("numeric"))
    return out.withColumn("is_numeric", (F.col("numeric") / F.col("total") > threshold) & ~F.col("predicate").isin(list(codes)))


def numeric_means(literal_rows: DataFrame, shares: DataFrame, identifiers: Sequence[str] = ()) -> DataFrame:
    """(node_type, node_id, predicate, value): mean of each node's values of a numeric predicate."""
    some = literal_rows.where(~F.col("predicate").isin(list(identifiers))).join(shares.where("is_numeric").select("predicate"), "predicate", "left_semi")
    some = some.withColumn("x", number_of(F.col("value"))).where("x IS NOT NULL")
    return some.groupBy("node_type", "node_id", "predicate").agg(F.avg("x").alias("value"))


def normalisation(means: DataFrame) -> DataFrame:
    """(predicate, mean, std): sample deviation; not finite or 0 becomes 1, a mean that is not finite 0."""
    out = means.groupBy("predicate").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    std = F.when(is_finite(F.col("s")) & (F.col("s") != 0), F.col("s")).otherwise(1.0)
    return out.select("predicate", F.when(is_finite(F.col("m")), F.col("m")).otherwise(0.0).alias("mean"), std.alias("std"))


def z_scores(means: DataFrame, stats: DataFrame) -> DataFrame:
    joined = means.join(stats, "predicate", "left")
    return joined.withColumn("z", (F.col("value") - F.coalesce("mean", F.lit(0.0))) / F.coalesce("std", F.lit(1.0)))


def class_identity(node_ids: DataFrame, kinds: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """Four slots of the node's class; kinds: (node_type, type_uri)."""
    rows = node_ids.select("node_type", "node_id").join(kinds, "node_type")
    return entries(rows, ["node_type", "node_id"], [(at(F.col("type_uri"), s, layout["class_identity"]), F.lit(1.0)) for s in SEEDS])


def class_hierarchy(node_ids: DataFrame, kinds: DataFrame, triples: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """Two slots for each ancestor of the class, weighing one over its depth."""
    edges = triples.where(F.col("predicate") == SUBCLASS).select(F.col("subject").alias("child"), F.col("object").alias("parent"))
    above = kinds.join(closure(edges).withColumnRenamed("class_uri", "type_uri"), "type_uri").select("node_type", "superclass_uri", "depth")
    rows = node_ids.select("node_type", "node_id").join(above, "node_type")
    return entries(rows, ["node_type", "node_id"], [(at(F.col("superclass_uri"), s + 100, layout["class_hierarchy"]), 1 / F.col("depth")) for s in SEEDS[:2]])


def ontology_source(node_ids: DataFrame, kinds: DataFrame, namespaces: Sequence[str], frozen: Sequence[str], layout: Layout, at: Slot = slot) -> DataFrame:
    """The place of the class's namespace (1.0) and, half a part on, of the node's own (0.5): a frozen index, else a hash."""
    part = layout["ontology_source"]

    def place(uri: Column) -> Column:
        out = F.lit(None).cast("int")
        for n in reversed(namespaces):
            where = F.lit(frozen.index(n) % part.dim) if n in frozen else at(F.lit(n), 700, Part(0, part.dim))
            out = F.when(uri.startswith(n), where.cast("int")).otherwise(out)
        return out

    rows = node_ids.join(kinds, "node_type")
    own = (place(F.col("uri")) + part.dim // 2) % part.dim + part.start
    return entries(rows, ["node_type", "node_id"], [(place(F.col("type_uri")) + part.start, F.lit(1.0)), (own, F.lit(0.5))]).where("dim IS NOT NULL")


def node_properties(triples: DataFrame, node_ids: DataFrame, without: Sequence[str] = (TYPE,)) -> DataFrame:
    """(node_type, node_id, predicate) each node states."""
    some = triples.where(~F.col("predicate").isin(list(without))).select(F.col("subject").alias("uri"), "predicate").distinct()
    return some.join(node_ids, "uri").select("node_type", "node_id", "predicate")


def property_presence(properties: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    return entries(properties, ["node_type", "node_id"], [(at(F.col("predicate"), s + 200, layout["property_presence"]), F.lit(1.0)) for s in SEEDS[:3]])


def domain_range(properties: DataFrame, triples: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """The first half of the part for domains, the second for ranges, of the properties a node states."""
    whole = layout["domain_range"]
    half = max(1, whole.dim // 2)
    first, second = Part(whole.start, half), Part(whole.start + half, max(1, whole.dim - half))
    rows = properties.join(property_schema(triples), properties["predicate"] == F.col("property_uri"))
    pairs = [(F.when(F.col("domain_uri").isNotNull(), at(F.col("domain_uri"), 300, first)), F.lit(1.0)), (F.when(F.col("range_uri").isNotNull(), at(F.col("range_uri"), 301, second)), F.lit(1.0))]
    return entries(rows, ["node_type", "node_id"], pairs).where("dim IS NOT NULL")


def property_hierarchy(properties: DataFrame, triples: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    edges = triples.where(F.col("predicate") == SUBPROPERTY).select(F.col("subject").alias("predicate"), F.col("object").alias("parent")).distinct()
    return entries(properties.join(edges, "predicate"), ["node_type", "node_id"], [(at(F.col("parent"), s + 400, layout["property_hierarchy"]), F.lit(1.0)) for s in SEEDS[:2]])


def numeric_entries(scored: DataFrame, layout: Layout, value: str = "z", at: Slot = slot) -> DataFrame:
    return entries(scored, ["node_type", "node_id"], [(at(F.col("predicate"), 500, layout["numeric"]), F.col(value))])


def categorical_entries(literal_rows: DataFrame, shares: DataFrame, layout: Layout, without: Sequence[str] = (), at: Slot = slot) -> DataFrame:
    """Four slots of `predicate::value` for each distinct value of a predicate that is not numeric."""
    labels = literal_rows.where(~F.col("predicate").isin(list(without))).join(shares.where("NOT is_numeric").select("predicate"), "predicate", "left_semi")
    labels = labels.select("node_type", "node_id", F.concat_ws("::", "predicate", "value").alias("key")).distinct()
    return entries(labels, ["node_type", "node_id"], [(at(F.col("key"), s + 600, layout["categorical"]), F.lit(1.0)) for s in SEEDS])


def node_features(triples: DataFrame, node_ids: DataFrame, kinds: DataFrame, literal_rows: DataFrame, layout: Layout, namespaces: Sequence[str] = (), frozen: Sequence[str] = (), identifiers: Sequence[str] = (), codes: Sequence[str] = (), normalise: bool = True, at: Slot = slot) -> DataFrame:
    """(node_type, node_id, dim, value) over all parts. What several parts read is written once."""
    literal_rows = settle(literal_rows, "literals")
    shares = settle(numeric_shares(literal_rows, codes), "shares")
    means = settle(numeric_means(literal_rows, shares, identifiers), "means")
    scored = z_scores(means, normalisation(means)) if normalise else means.withColumn("z", F.col("value"))
    stated = settle(node_properties(triples, node_ids), "stated")
    parts = [
        class_identity(node_ids, kinds, layout, at),
        class_hierarchy(node_ids, kinds, triples, layout, at),
        ontology_source(node_ids, kinds, namespaces, frozen, layout, at),
        property_presence(stated, layout, at),
        domain_range(stated, triples, layout, at),
        property_hierarchy(stated, triples, layout, at),
        numeric_entries(scored, layout, at=at),
        categorical_entries(literal_rows, shares, layout, identifiers, at),
    ]
    return summed(union_frames(parts), ["node_type", "node_id"])


def slot_mapping(predicates: DataFrame, layout: Layout) -> DataFrame:
    """(predicate, part, dim): where each predicate's presence and number go, by the encoder's own expression."""
    rows = [F.struct(F.lit("property_presence").alias("part"), slot(F.col("predicate"), s + 200, layout["property_presence"]).alias("dim")) for s in SEEDS[:3]]
    rows.append(F.struct(F.lit("numeric").alias("part"), slot(F.col("predicate"), 500, layout["numeric"]).alias("dim")))
    return predicates.select("predicate", F.explode(F.array(*rows)).alias("r")).select("predicate", "r.*").distinct()
