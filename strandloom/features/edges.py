"""Edge features for all edge types at once: properties are joined by (node type, id), formulas chosen by category with CASE.

Properties found by pattern (month, year, strike, price, severity) are averaged per node first, so several matches do
not multiply an edge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..graph.build import dense_ids
from ..model import union_frames
from ..storage import settle
from .encode import SEEDS, Slot, entries, slot, summed
from .layout import Layout, Part

#: Categories in the order they are tested, with fragments of relation names.
CATEGORIES: dict[str, list[str]] = {
    "skip": ["belongsToSector", "sameAs", "hasParent", "hasChild", "equivalentClass", "equivalentProperty", "imports", "refersToCompany", "hasRegion", "affectsRegion"],
    "temporal": ["precedes", "follows", "hasNext", "hasPrevious", "temporallyRelated"],
    "option_stock": ["hasUnderlying", "hasMoneyness"],
    "escalation": ["escalatesTo"],
    "correlation": ["correlatesWith", "relatedTo", "Correlation"],
    "causal": ["leadsTo", "impacts", "causes", "affects"],
    "strategy": ["straddleWith", "strangleWith", "SpreadWith"],
}
DEFAULT_ENABLED = ["temporal", "option_stock", "escalation", "correlation", "causal"]
#: Which properties are what, by name.
PATTERNS = {"month": "(?i)month", "year": "(?i)year", "strike": "(?i)strike", "price": "(?i)price", "severity": "(?i)severity"}


def category(relation: Column, fragments: Mapping[str, Sequence[str]] = CATEGORIES) -> Column:
    """The first category one of whose fragments the name contains in any case, else `generic`."""
    out = F.lit("generic")
    for name, parts in reversed(fragments.items()):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(F.lower(relation), F.lit(p.lower()))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def enabled(configured: Sequence[str] | None = None) -> list[str]:
    out = DEFAULT_ENABLED if configured is None else list(configured)
    if bad := [c for c in out if c == "skip" or c not in {*CATEGORIES, "generic"}]:
        raise ValueError(f"no such category can be encoded: {bad}")
    return out


def indexed(edge_rows: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Edges of enabled categories with `category` and `edge_idx`, 0-based by (src_id, dst_id) within their type."""
    out = edge_rows.withColumn("category", category(F.col("relation"))).where(F.col("category").isin(enabled(categories)))
    return dense_ids(out, ["src_type", "relation", "dst_type"], ["src_id", "dst_id"], "edge_idx")


KEYS = ["src_type", "relation", "dst_type", "edge_idx"]


def _named(props: DataFrame, pattern: str, side: str, name: str) -> DataFrame:
    some = props.where(F.col("predicate").rlike(pattern)).groupBy("node_type", "node_id").agg(F.avg("value").alias(name))
    return some.withColumnsRenamed({"node_type": f"{side}_type", "node_id": f"{side}_id"})


def with_ends(edge_rows: DataFrame, props: DataFrame, names: Sequence[str]) -> DataFrame:
    """Edges with `src_<name>` and `dst_<name>` for each of some patterned properties: two joins, whatever their number."""
    wanted = [F.avg(F.when(F.col("predicate").rlike(PATTERNS[n]), F.col("value"))).alias(n) for n in names]
    each = props.groupBy("node_type", "node_id").agg(*wanted)
    for side in ("src", "dst"):
        own = each.withColumnsRenamed({"node_type": f"{side}_type", "node_id": f"{side}_id", **{n: f"{side}_{n}" for n in names}})
        edge_rows = edge_rows.join(own, [f"{side}_type", f"{side}_id"], "left")
    return edge_rows


def temporal_entries(edge_rows: DataFrame, props: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """Months between the ends over 12, its size, same year, consecutive months, same quarter, direction; other categories get an indicator."""
    rows = with_ends(edge_rows, props, ["month", "year"])
    known = F.col("src_month").isNotNull() & F.col("dst_month").isNotNull() & F.col("src_year").isNotNull() & F.col("dst_year").isNotNull()
    delta = F.when(known, (F.col("dst_year") - F.col("src_year")) * 12 + F.col("dst_month") - F.col("src_month")).otherwise(0.0)
    rows = rows.withColumn("delta", delta)
    td, pf, way = layout["time_delta"], layout["period_flags"], layout["direction"]
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    same_year = F.col("src_year") == F.col("dst_year")
    quarter = lambda s: F.floor((F.col(f"{s}_month") - 1) / 3)
    pairs = [(at(F.lit("time_delta"), 0, td), F.col("delta") / 12)]
    if td.dim >= 2:
        pairs.append((at(F.lit("abs_time_delta"), 7, td), F.abs(F.col("delta")) / 12))
    pairs.append((F.lit(pf.start), flag(same_year)))
    if pf.dim >= 2:
        pairs.append((F.lit(pf.start + 1), flag(F.abs("delta") == 1)))
    if pf.dim >= 3:
        pairs.append((F.lit(pf.start + 2), flag(same_year & (quarter("src") == quarter("dst")))))
    pairs.append((F.lit(way.start), F.signum("delta")))
    timed = entries(rows.where("category = 'temporal'"), KEYS, pairs)
    other = entries(rows.where("category <> 'temporal'"), KEYS, [(at(F.col("category"), 50, td), F.lit(1.0))])
    return timed.unionByName(other)


def contrast_entries(edge_rows: DataFrame, props: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """Difference, clamped ratio and mean magnitude of each number both ends state; where no edge of a type shares one, what its category compares."""
    d, r, m = layout["difference"], layout["ratio"], layout["magnitude"]
    one = props.withColumnsRenamed({"node_type": "src_type", "node_id": "src_id", "value": "x"})
    two = props.withColumnsRenamed({"node_type": "dst_type", "node_id": "dst_id", "value": "y"})
    both = edge_rows.join(one, ["src_type", "src_id"]).join(two, ["dst_type", "dst_id", "predicate"])
    ratio = F.when(F.abs("x") > 1e-8, F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.try_divide("y", "x")))).otherwise(0.0)
    p = F.col("predicate")
    shared = entries(both, KEYS, [(at(p, 500, d), F.col("y") - F.col("x")), (at(p, 501, r), ratio), (at(p, 502, m), (F.abs("x") + F.abs("y")) / 2)])
    types = both.select("src_type", "relation", "dst_type").distinct()
    rest = with_ends(edge_rows, props, ["strike", "price", "severity"]).join(types, ["src_type", "relation", "dst_type"], "left_anti")
    strike, price = F.col("src_strike"), F.col("dst_price")
    share = F.when(F.abs(price) > 1e-8, F.try_divide(strike, price)).otherwise(1.0)
    options = rest.where("category = 'option_stock' AND src_strike IS NOT NULL AND dst_price IS NOT NULL")
    fallback = entries(options, KEYS, [
        (at(F.lit("moneyness"), 510, d), share), (at(F.lit("log_moneyness"), 511, r), F.log(F.greatest(share, F.lit(1e-8)))), (at(F.lit("strike_stock_diff"), 512, m), strike - price)])
    alerts = rest.where("category = 'escalation' AND src_severity IS NOT NULL AND dst_severity IS NOT NULL")
    worse = entries(alerts, KEYS, [(at(F.lit("severity_delta"), 520, d), F.col("dst_severity") - F.col("src_severity"))])
    return union_frames([shared, fallback, worse])


def word_jaccard(a: Column, b: Column) -> Column:
    """Of the words of two labels; a missing label is one empty word, so two missing ones are alike."""
    words = lambda c: F.split(F.coalesce(c, F.lit("")), r"\s+")
    return F.size(F.array_intersect(words(a), words(b))) / F.size(F.array_union(words(a), words(b)))


def context_entries(edge_rows: DataFrame, labels: DataFrame, layout: Layout, at: Slot = slot) -> DataFrame:
    """Same or other source, sources, likeness of labels for correlation and cause, relation and category."""
    ns, ls, ri = layout["namespace"], layout["label_similarity"], layout["relation_identity"]
    prefix = lambda c: F.split(c, "_").getItem(0)
    rows = edge_rows.withColumns({"src_ns": prefix(F.col("src_type")), "dst_ns": prefix(F.col("dst_type"))})
    same = (F.col("src_ns") == F.col("dst_ns")).cast("double")
    pairs = [(F.lit(ns.start), same)]
    if ns.dim >= 2:
        pairs.append((F.lit(ns.start + 1), 1 - same))
    if ns.dim >= 3:
        rest = Part(ns.start + 2, max(1, ns.dim - 2))
        for s in SEEDS[:2]:
            pairs += [(at(F.col("src_ns"), s + 700, rest), F.lit(1.0)), (at(F.col("dst_ns"), s + 710, rest), F.lit(0.5))]
    pairs += [(at(F.col("relation"), s + 900, ri), F.lit(1.0)) for s in SEEDS[:2]] + [(at(F.col("category"), 950, ri), F.lit(0.5))]
    base = entries(rows, KEYS, pairs)
    one = labels.groupBy("node_type", "node_id").agg(F.min("label").alias("src_label")).withColumnsRenamed({"node_type": "src_type", "node_id": "src_id"})
    two = labels.groupBy("node_type", "node_id").agg(F.min("label").alias("dst_label")).withColumnsRenamed({"node_type": "dst_type", "node_id": "dst_id"})
    wordy = F.col("category").isin("correlation", "causal")
    named = rows.where(wordy).join(one, ["src_type", "src_id"], "left").join(two, ["dst_type", "dst_id"], "left").withColumn("sim", word_jaccard(F.col("src_label"), F.col("dst_label")))
    alike = [(F.lit(ls.start), F.col("sim"))]
    if ls.dim >= 2:
        key = F.concat(F.coalesce("src_label", F.lit("")), F.lit("::"), F.coalesce("dst_label", F.lit("")))
        alike.append((at(key, 800, Part(ls.start + 1, max(1, ls.dim - 1))), F.col("sim")))
    other = entries(rows.where(~wordy), KEYS, [(at(F.col("category"), 810, ls), F.lit(1.0))])
    return union_frames([base, entries(named, KEYS, alike), other])


def edge_features(edge_rows: DataFrame, props: DataFrame, labels: DataFrame, layout: Layout, categories: Sequence[str] | None = None, at: Slot = slot) -> DataFrame:
    """(src_type, relation, dst_type, edge_idx, dim, value) for all enabled edges in one plan. props: (node_type, node_id, predicate, value)."""
    rows = settle(indexed(edge_rows, categories), "edges-indexed")
    return summed(union_frames([temporal_entries(rows, props, layout, at), contrast_entries(rows, props, layout, at), context_entries(rows, labels, layout, at)]), KEYS)


def property_rows(props: DataFrame) -> DataFrame:
    """(node_type, total, month, year): how many endpoint property rows each type has."""
    count = lambda n: F.count_if(F.col("predicate").rlike(PATTERNS[n])).alias(n)
    return props.groupBy("node_type").agg(F.count("*").alias("total"), count("month"), count("year"))
