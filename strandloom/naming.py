"""URIs to short names by an ordered table of namespaces: the first match wins.

A name is `prefix_local`, local being what follows the namespace without `/` and `#` at its ends.  A match with an empty
local part falls through.  Without a match a name is `unknown_<last segment>`, or `unknown_<hash>` without one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .model import SAME_AS


@dataclass(frozen=True)
class Namespaces:
    pairs: tuple[tuple[str, str], ...]

    def name(self, uri: Column) -> Column:
        strip = lambda c: F.regexp_replace(c, "^[/#]+|[/#]+$", "")
        last = F.regexp_extract(strip(uri), "([^/#]+)$", 1)
        out = F.when(last != "", F.concat(F.lit("unknown_"), last)).otherwise(F.concat(F.lit("unknown_"), F.abs(F.hash(uri).cast("bigint")).cast("string")))
        for namespace, prefix in reversed(self.pairs):
            local = strip(F.substring(uri, F.lit(len(namespace) + 1), F.length(uri)))
            out = F.when(uri.startswith(namespace) & (local != ""), F.concat(F.lit(f"{prefix}_"), local)).otherwise(out)
        return F.when(uri.isNotNull(), out)

    def name_of(self, uri: str) -> str | None:
        """The same rule without Spark; None where only the hash rule would apply."""
        for namespace, prefix in self.pairs:
            if uri.startswith(namespace) and (local := uri[len(namespace) :].strip("/#")):
                return f"{prefix}_{local}"
        last = uri.strip("/#").replace("#", "/").rpartition("/")[2]
        return f"unknown_{last}" if last else None

    def uri_of(self, name: str) -> str | None:
        """A URI with that name, by the longest prefix that fits."""
        fits = [(len(p), n + name[len(p) + 1 :]) for n, p in self.pairs if name.startswith(f"{p}_")]
        return max(fits)[1] if fits else None

    def source(self, uri: Column) -> Column:
        out = F.lit(None).cast("string")
        for namespace, prefix in reversed(self.pairs):
            out = F.when(uri.startswith(namespace), F.lit(prefix)).otherwise(out)
        return out

    def unregistered(self, uris: DataFrame, column: str, most: int = 50) -> list[str]:
        """Some of the URIs that no namespace covers, sorted: a diagnosis, hence the limit."""
        bad = uris.select(column).distinct().where(self.name(F.col(column)).startswith("unknown_"))
        return [r[0] for r in bad.orderBy(column).limit(most).collect()]

    def require(self, uris: DataFrame, column: str) -> None:
        if bad := self.unregistered(uris, column):
            raise ValueError(f"no namespace is registered for {bad}")


def origin(predicate: Column, src_type: Column, dst_type: Column, derived: list[str], unified: list[str]) -> Column:
    """`unification` for sameAs and edges that touch a unified type, `enrichment` for predicates of derived namespaces, else `raw`."""
    is_unified = F.lit(False)
    for prefix in unified:
        is_unified = is_unified | src_type.startswith(prefix) | dst_type.startswith(prefix)
    is_derived = F.lit(False)
    for namespace in derived:
        is_derived = is_derived | predicate.startswith(namespace)
    return F.when((predicate == SAME_AS) | is_unified, "unification").when(is_derived, "enrichment").otherwise("raw")
