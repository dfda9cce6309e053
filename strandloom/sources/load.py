"""Several sources as one triple frame, with accounting."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SPO, union_frames
from ..storage import settle
from .rdf import datatype_markers, read_ntriples, read_turtle


@dataclass(frozen=True)
class Source:
    """One source: namespaces, file format, fragments that its paths contain, what it may only be read from, and a canonical form."""

    name: str
    namespaces: tuple[tuple[str, str], ...] = ()
    format: str = "turtle"
    fragments: tuple[str, ...] = ()
    feeds: tuple[str, ...] = ()
    date_predicates: tuple[str, ...] = ()
    conform: Callable[[DataFrame], DataFrame] | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def match_path(path: str, sources: Sequence[Source]) -> Source:
    """The one source that has a fragment in the path, else the one whose name is a folder or the file's stem; none or several is an error."""
    found = [s for s in sources if any(f in path for f in s.fragments)]
    if not found:
        parts = {re.sub(r"\.[^.]*$", "", p) for p in path.strip("/").split("/")}
        found = [s for s in sources if s.name in parts]
    if len(found) != 1:
        raise ValueError(f"{path} matches {[s.name for s in found] or 'no source'}")
    return found[0]


def path_day(path: str) -> str | None:
    """The ISO date in `year=2026/month=09/day=10` or `year=2026/month=09/10`, else None."""
    m = re.search(r"year=(\d{4})/month=(\d{1,2})/(?:day=)?(\d{1,2})(?:[/.]|$)", path)
    return f"{m[1]}-{int(m[2]):02}-{int(m[3]):02}" if m else None


def mirrored(path: str, root: str | None) -> str:
    """The place of an object-store path in a local mirror: scheme://bucket/key as file://root/bucket/key."""
    m = re.match(r"^s3[an]?://(.+)$", path)
    return f"file://{root.rstrip('/')}/{m[1]}" if root and m else path


def require_feed(paths: Sequence[str], source: Source) -> None:
    """A source that handles certain feeds accepts no path of another."""
    if source.feeds and (bad := [p for p in paths if not any(f in p for f in source.feeds)]):
        raise ValueError(f"{source.name} reads {list(source.feeds)}, not {bad}")


READERS = {"turtle": read_turtle, "ntriples": read_ntriples}


def load_sources(spark: SparkSession, paths: Sequence[str], sources: Sequence[Source], mirror: str | None = None) -> DataFrame:
    """(subject, predicate, object, _source) of all paths, canonical, with datatype markers; raises if there is nothing.

    Each path is parsed once: the parsed rows are written to the shared folder, and triples and markers are read from there.
    """
    parts = []
    for path in paths:
        source = match_path(path, sources)
        require_feed([path], source)
        rows = READERS[source.format](spark, mirrored(path, mirror), **source.options)
        rows = source.conform(rows) if source.conform else rows
        parts.append(rows.withColumn("_source", F.lit(source.name)))
    if not parts:
        raise ValueError("no paths")
    parsed = settle(union_frames(parts), "parsed")
    if parsed.isEmpty():
        raise ValueError(f"no triples in {list(paths)}")
    marks = [datatype_markers(parsed.where(F.col("_source") == s)).withColumn("_source", F.lit(s)) for s in sorted({match_path(p, sources).name for p in paths})]
    return union_frames([parsed.drop("object_datatype"), *marks])


def source_statistics(stamped: DataFrame) -> DataFrame:
    """(_source, rows, distinct_rows, duplicates, shared): what each source states, how often it repeats itself, and how much others state too.

    Two aggregates: one per triple, one per source.
    """
    each = stamped.groupBy(*SPO, "_source").agg(F.count("*").alias("n"))
    spread = each.groupBy(*SPO).agg(F.collect_list(F.struct("_source", "n")).alias("s"))
    rows = spread.select(F.explode("s").alias("x"), (F.size("s") > 1).alias("shared")).select("x.*", "shared")
    return rows.groupBy("_source").agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct_rows"), (F.sum("n") - F.count("*")).alias("duplicates"), F.count_if(F.col("shared")).alias("shared")
    )
