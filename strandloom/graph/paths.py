"""Patterns, neighbourhoods and distances over triples and edges."""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pattern = tuple[str, str, str]


def match(triples: DataFrame, patterns: Sequence[Pattern], where: Column | None = None, select: Sequence[str] | None = None) -> DataFrame:
    """A basic graph pattern: terms that start with `?` are variables, a predicate may be `p1/p2` (a path) or `p1|p2` (either).

    Each pattern is a scan filtered by its constants; patterns are joined on the variables they share, in the order given.
    Patterns that share none with those before are refused, since that is a product.
    """
    out, bound = None, set()
    for i, (s, p, o) in enumerate(patterns):
        steps = p.split("/") if not p.startswith("?") and "://" not in p else [p]
        names = [s, *[f"?_p{i}_{j}" for j in range(len(steps) - 1)], o]
        for step, a, b in zip(steps, names[:-1], names[1:], strict=True):
            part = _scan(triples, a, step, b)
            shared = sorted(bound & set(part.columns))
            if out is not None and not shared:
                raise ValueError(f"pattern {(a, step, b)} shares no variable with those before it")
            out = part if out is None else out.join(part, shared)
            bound |= set(part.columns)
    out = out if where is None else out.where(where)
    keep = [v.lstrip("?") for v in select] if select else [c for c in out.columns if not c.startswith("_p")]
    return out.select(*keep).distinct()


def _scan(triples: DataFrame, s: str, p: str, o: str) -> DataFrame:
    terms = [(s, "subject"), (p, "predicate"), (o, "object")]
    tests: list[Column] = []
    columns: dict[str, str] = {}
    for term, column in terms:
        if not term.startswith("?"):
            options = term.split("|") if column == "predicate" else [term]
            tests.append(F.col(column).isin(options) if len(options) > 1 else F.col(column) == term)
        elif term[1:] in columns:
            tests.append(F.col(columns[term[1:]]) == F.col(column))
        else:
            columns[term[1:]] = column
    rows = triples.where(functools.reduce(operator.and_, tests)) if tests else triples
    return rows.select(*[F.col(c).alias(v) for v, c in columns.items()]).distinct()


def named_edges(edge_rows: DataFrame, node_ids: DataFrame, day: str | None = None) -> DataFrame:
    """Edges with the URIs of both ends; joined within a day where both frames have that column."""
    on = [day] if day else []
    src = node_ids.select(*on, F.col("node_type").alias("src_type"), F.col("node_id").alias("src_id"), F.col("uri").alias("src_uri"))
    dst = node_ids.select(*on, F.col("node_type").alias("dst_type"), F.col("node_id").alias("dst_id"), F.col("uri").alias("dst_uri"))
    return edge_rows.join(src, [*on, "src_type", "src_id"]).join(dst, [*on, "dst_type", "dst_id"])


def neighbourhood(named: DataFrame, uri: str) -> DataFrame:
    """(direction, relation, neighbour) one hop around a node, both ways."""
    out = named.where(F.col("src_uri") == uri).select(F.lit("out").alias("direction"), "relation", F.col("dst_uri").alias("neighbour"))
    back = named.where(F.col("dst_uri") == uri).select(F.lit("in").alias("direction"), "relation", F.col("src_uri").alias("neighbour"))
    return out.unionByName(back)


def meeting_points(reaches: Sequence[DataFrame], column: str) -> DataFrame:
    """What every reach contains."""
    return functools.reduce(DataFrame.intersect, [r.select(column) for r in reaches])


def _reach(links: DataFrame, start: DataFrame, keys: list[str], directed: bool, most: int | None) -> DataFrame:
    """(*keys, node, distance), breadth first from the nodes of every key at once; start: (*keys, node).

    Each step joins only the last frontier and removes what is known; it ends when the frontier is empty,
    or after `most` steps if that is given. What is known is written anew now and then, so that no plan grows with the steps.
    """
    from ..storage import settle

    if not directed:
        links = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    found = settle(start.select(*keys, "node").distinct().withColumn("distance", F.lit(0)), "bfs")
    frontier = found
    for step in itertools.count(1) if most is None else range(1, most + 1):
        ahead = frontier.select(*keys, F.col("node").alias("src")).join(links, "src").select(*keys, F.col("dst").alias("node")).distinct()
        frontier = settle(ahead.join(found.select(*keys, "node"), [*keys, "node"], "left_anti").withColumn("distance", F.lit(step)), "bfs")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
        found = settle(found, "bfs") if step % 16 == 0 else found
    return found


def distances(links: DataFrame, start: DataFrame, directed: bool = False, most: int | None = None) -> DataFrame:
    """(node, distance) from a set of nodes, breadth first; links: (src, dst); start: (node)."""
    return _reach(links, start, [], directed, most)


def family_distances(links: DataFrame, families: DataFrame, directed: bool = False, most: int | None = None) -> DataFrame:
    """(a, b, distance) between families of nodes, all searched at once; families: (node, family)."""
    reach = _reach(links, families, ["family"], directed, most).withColumnRenamed("family", "a")
    near = reach.join(families.withColumnRenamed("family", "b"), "node").where("a <> b")
    return near.groupBy("a", "b").agg(F.min("distance").alias("distance"))
