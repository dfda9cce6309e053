"""Nodes, edges and facts of a triple frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import META_NAMESPACES, NOT_EDGES, TYPE, looks_like_uri, number_of, starts_with_any
from ..naming import Namespaces, origin
from ..storage import settle


@dataclass(frozen=True)
class TypeFilter:
    """Applied before types are counted and ranked, so that it changes which type wins."""

    only: tuple[str, ...] = ()
    without: tuple[str, ...] = ()
    without_pattern: str | None = None
    pinned: tuple[str, ...] = ()


def type_rows(triples: DataFrame, names: Namespaces, filters: TypeFilter = TypeFilter()) -> DataFrame:
    """(uri, node_type, type_uri) after filters; classes of the schema's own vocabularies never type a node."""
    rows = triples.where(F.col("predicate") == TYPE).where(~starts_with_any(F.col("object"), META_NAMESPACES))
    rows = rows.select(F.col("subject").alias("uri"), names.name(F.col("object")).alias("node_type"), F.col("object").alias("type_uri")).distinct()
    if filters.only:
        rows = rows.where(F.col("node_type").isin(*filters.only))
    if filters.without:
        rows = rows.where(~F.col("node_type").isin(*filters.without))
    return rows.where(~F.col("node_type").rlike(filters.without_pattern)) if filters.without_pattern else rows


def subsumed_types(rows: DataFrame) -> DataFrame:
    """(node_type) of types all of whose nodes also have another, strictly more frequent type."""
    types = rows.select("uri", "node_type").distinct()
    counts = types.groupBy("node_type").agg(F.count("*").alias("n"))
    # Only pairs of types are counted, over the nodes that have several: equal for equal node sets of types, so the sets are counted first.
    sets = types.groupBy("uri").agg(F.sort_array(F.collect_set("node_type")).alias("s")).where(F.size("s") > 1).groupBy("s").agg(F.count("*").alias("c"))
    pairs = sets.select("c", F.explode("s").alias("sub"), "s").select("c", "sub", F.explode("s").alias("sup")).where("sub <> sup").groupBy("sub", "sup").agg(F.sum("c").alias("c"))
    sub = counts.select(F.col("node_type").alias("sub"), F.col("n").alias("n_sub"))
    sup = counts.select(F.col("node_type").alias("sup"), F.col("n").alias("n_sup"))
    return pairs.join(sub, "sub").join(sup, "sup").where("c = n_sub AND n_sup > n_sub").select(F.col("sub").alias("node_type")).distinct()


def nodes(triples: DataFrame, names: Namespaces, filters: TypeFilter = TypeFilter()) -> DataFrame:
    """(node_type, node_id, uri): one type for each URI, ids from 0 without gaps by URI within type.

    Of several types the first wins by: pinned order, not subsumed, fewer nodes, name.
    """
    rows = type_rows(triples, names, filters).select("uri", "node_type").distinct()
    counts = rows.groupBy("node_type").agg(F.count("*").alias("n"))
    narrow = subsumed_types(rows).withColumn("narrow", F.lit(1))
    ranks = counts.join(narrow, "node_type", "left")
    place = F.array_position(F.array(*map(F.lit, filters.pinned)).cast("array<string>"), F.col("node_type"))
    pin = F.when(place > 0, place).otherwise(len(filters.pinned) + 1)
    # The best type of a URI is a minimum, so it is found by a partial aggregate instead of a sort.
    order = F.struct(pin.alias("pin"), F.coalesce("narrow", F.lit(0)).alias("narrow"), "n", "node_type")
    best = rows.join(ranks, "node_type").groupBy("uri").agg(F.min(order).alias("b")).select("uri", "b.node_type")
    return dense_ids(best, "node_type", ["uri"], "node_id").select("node_type", "node_id", "uri")


def dense_ids(df: DataFrame, group: str | Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """0-based row numbers by `order` within `group`, of any size: ranges are sorted apart, and each adds the sizes of those before it.

    `row_number` over a group would sort it in one task. Here rows are range-partitioned and sorted by (group, order) once, and
    written with their place, as ranges are sampled anew each time a plan runs; only one count for each group and partition is
    carried over. Rows must be distinct in (group, order). group: a column or several.
    """
    groups = [group] if isinstance(group, str) else list(group)
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *groups, *order).sortWithinPartitions(*groups, *order)
    ranged = settle(ranged.withColumn("_row", F.monotonically_increasing_id()), "ranged").withColumn("_part", F.shiftright("_row", 33))
    counts = ranged.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    earlier = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(*groups, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return ranged.join(before, [*groups, "_part"]).withColumn(name, F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def edges(triples: DataFrame, node_ids: DataFrame, names: Namespaces, only: Sequence[str] = ()) -> DataFrame:
    """Distinct (src_type, src_id, relation, dst_type, dst_id, predicate) of triples both of whose ends are nodes."""
    some = triples.where(~F.col("predicate").isin(NOT_EDGES)).select("subject", "predicate", "object").distinct()
    src = node_ids.select(F.col("uri").alias("subject"), F.col("node_type").alias("src_type"), F.col("node_id").alias("src_id"))
    dst = node_ids.select(F.col("uri").alias("object"), F.col("node_type").alias("dst_type"), F.col("node_id").alias("dst_id"))
    out = some.join(src, "subject").join(dst, "object").withColumn("relation", names.name(F.col("predicate")))
    out = out.where(F.col("relation").isin(*only)) if only else out
    return out.select("src_type", "src_id", "relation", "dst_type", "dst_id", "predicate").dropDuplicates(["src_type", "src_id", "relation", "dst_type", "dst_id"])


def edge_types(edge_rows: DataFrame, derived: Sequence[str] = (), unified: Sequence[str] = (), groups: dict[str, str] | None = None) -> DataFrame:
    """(src_type, relation, dst_type, count, predicate_uri, origin, relation_group)."""
    out = edge_rows.groupBy("src_type", "relation", "dst_type").agg(F.count("*").alias("count"), F.min("predicate").alias("predicate_uri"))
    out = out.withColumn("origin", origin(F.col("predicate_uri"), F.col("src_type"), F.col("dst_type"), list(derived), list(unified)))
    group = F.regexp_extract("relation", "^([^_]+)_", 1)
    for relation, name in (groups or {}).items():
        group = F.when(F.col("relation") == relation, F.lit(name)).otherwise(group)
    return out.withColumn("relation_group", group)


def relation_groups(types: DataFrame) -> DataFrame:
    """(relation_group, relations, edges)."""
    return types.groupBy("relation_group").agg(F.sort_array(F.collect_set("relation")).alias("relations"), F.sum("count").alias("edges"))


def literals(triples: DataFrame, node_ids: DataFrame, names: Namespaces, never_numbers: Sequence[str] = ()) -> DataFrame:
    """(node_type, node_id, uri, predicate, predicate_name, value, is_numeric): literals of nodes; identifiers and codes are never numbers."""
    some = triples.where(F.col("predicate") != TYPE).where(~looks_like_uri(F.col("object")))
    some = some.join(node_ids.select(F.col("uri").alias("object")), "object", "left_anti")
    out = some.select(F.col("subject").alias("uri"), "predicate", F.col("object").alias("value")).distinct().join(node_ids, "uri")
    numeric = number_of(F.col("value")).isNotNull() & ~F.col("predicate").isin(list(never_numbers))
    return out.select("node_type", "node_id", "uri", "predicate", names.name(F.col("predicate")).alias("predicate_name"), "value", numeric.alias("is_numeric"))


def type_uris(triples: DataFrame, node_ids: DataFrame, names: Namespaces) -> DataFrame:
    """(node_type, type_uri): for each node type, the first class URI with that name among those of its nodes, else the first of them."""
    rows = type_rows(triples, names).join(node_ids.select("uri", F.col("node_type").alias("own")), "uri")
    best = F.min_by("type_uri", F.struct((F.col("node_type") != F.col("own")).cast("int"), "type_uri"))
    return rows.groupBy("own").agg(best.alias("type_uri")).withColumnRenamed("own", "node_type")


def days_only(edge_rows: DataFrame, periods: Sequence[str], left_out: Sequence[str]) -> DataFrame:
    """(dst_type, dst_id) of period nodes that only nodes of left-out types refer to."""
    dated = edge_rows.where(F.col("dst_type").isin(*periods)).groupBy("dst_type", "dst_id")
    return dated.agg(F.bool_and(F.col("src_type").isin(*left_out)).alias("only")).where("only").drop("only")


def kept_nodes(node_ids: DataFrame, left_out: Sequence[str], days: DataFrame) -> DataFrame:
    """Nodes without those of left-out types and without periods that only they were dated to."""
    gone = days.select(F.col("dst_type").alias("node_type"), F.col("dst_id").alias("node_id"))
    return node_ids.where(~F.col("node_type").isin(*left_out)).join(gone, ["node_type", "node_id"], "left_anti")
