"""JSON artifacts of a graph: schema, features, normalisation, encoding contract, slots, ontology, checksums, manifest."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .features.dense import class_codes, collision_report
from .features.encode import SEEDS, slot_mapping
from .features.layout import Layout
from .model import DOMAIN, RANGE, SUBCLASS, TYPE


def rounded(x: object, digits: int = 12) -> object:
    """Floats to significant digits, in any nesting, so that sums taken in another order give the same text."""
    if isinstance(x, float):
        return float(f"{x:.{digits}g}") if math.isfinite(x) else None
    if isinstance(x, Mapping):
        return {str(k): rounded(v, digits) for k, v in x.items()}
    return [rounded(v, digits) for v in x] if isinstance(x, (list, tuple)) else x


def serialised(content: object) -> bytes:
    return (json.dumps(rounded(content), sort_keys=True, indent=1, ensure_ascii=False) + "\n").encode()


def graph_schema(node_ids: DataFrame, edge_types: DataFrame, kinds: DataFrame) -> dict:
    """Node types with counts and classes, edge types with counts and origins: rows for each type come to the driver."""
    uris = {r["node_type"]: r["type_uri"] for r in kinds.collect()}
    counts = {r["node_type"]: r["count"] for r in node_ids.groupBy("node_type").count().collect()}
    rows = sorted((r.asDict() for r in edge_types.collect()), key=lambda r: (r["src_type"], r["relation"], r["dst_type"]))
    return {"node_types": {t: {"count": n, "type_uri": uris.get(t)} for t, n in sorted(counts.items())}, "edge_types": rows, "nodes": sum(counts.values()), "edges": sum(r["count"] for r in rows)}


def feature_spec(layout: Layout, edge: Layout) -> dict:
    parts = lambda x: {n: {"start": p.start, "dim": p.dim} for n, p in x.parts.items()}
    return {"node": {"width": layout.width, "parts": parts(layout)}, "edge": {"width": edge.width, "parts": parts(edge)}}


def normalisation(stats: DataFrame) -> dict:
    return {r["predicate"]: {"mean": r["mean"], "std": r["std"]} for r in stats.collect()}


def encoding_config(layout: Layout, edge: Layout, normalise: bool = True) -> dict:
    """All that decides where a value goes, with a digest of itself."""
    out = {"hash": "murmur3(value, seed), absolute, modulo", "seeds": SEEDS, "normalise": normalise, "ancestor_weight": "1/depth", "depth": 10, **feature_spec(layout, edge)}
    return out | {"digest": hashlib.sha256(serialised(out)).hexdigest()}


def slots(predicates: DataFrame, layout: Layout) -> dict:
    out: dict[str, dict[str, list[int]]] = {}
    for r in slot_mapping(predicates, layout).orderBy("predicate", "part", "dim").collect():
        out.setdefault(r["predicate"], {}).setdefault(r["part"], []).append(r["dim"])
    return out


def ontology_schema(triples: DataFrame, predicates: DataFrame) -> dict:
    """Subclass, domain and range axioms by predicate, and how many properties have each."""
    rows = triples.where(F.col("predicate").isin(SUBCLASS, DOMAIN, RANGE)).distinct().collect()
    by = {name: sorted((r["subject"], r["object"]) for r in rows if r["predicate"] == p) for name, p in (("subclasses", SUBCLASS), ("domains", DOMAIN), ("ranges", RANGE))}
    used = {r[0] for r in predicates.select("predicate").distinct().collect()} - {TYPE}
    cover = {n: len(used & {s for s, _ in by[n]}) for n in ("domains", "ranges")}
    return by | {"coverage": {"properties": len(used), **cover}}


def checksums(files: Mapping[str, bytes]) -> dict:
    return {n: {"sha256": hashlib.sha256(b).hexdigest(), "bytes": len(b)} for n, b in sorted(files.items())}


def write_metadata(spark: SparkSession, folder: str, contents: Mapping[str, object], latest: bool = True) -> dict:
    """Each content as `<name>.json`, again under `latest/`, and checksums.json; returns the checksums."""
    files = {f"{n}.json": serialised(c) for n, c in contents.items()}
    sums = checksums(files)
    files["checksums.json"] = serialised(sums)
    for name, body in files.items():
        storage.write_bytes(spark, f"{folder}/{name}", body)
        if latest:
            storage.write_bytes(spark, f"{folder}/latest/{name}", body)
    return sums


def manifest(settings: Mapping[str, object], results: Mapping[str, object], seconds: float) -> dict:
    return {"settings": dict(settings), "results": dict(results), "seconds": round(seconds, 1)}


def require_free(spark: SparkSession, path: str, overwrite: bool = False) -> None:
    """Raises if something is there already."""
    if not overwrite and storage.exists(spark, path):
        raise FileExistsError(f"{path} holds an earlier run")


def separability(kinds: DataFrame, layout: Layout, fail: bool = False) -> dict:
    return collision_report(class_codes(kinds, layout), layout, fail)


def save_graph(folder: str, node_ids: DataFrame, edge_rows: DataFrame, node_vectors: DataFrame, edge_vectors: DataFrame) -> None:
    """Tensor-ready Parquet: node index, edge index, feature vectors, by type; nothing passes the driver."""
    node_ids.write.mode("overwrite").partitionBy("node_type").parquet(f"{folder}/node_index")
    edge_rows.select("src_type", "relation", "dst_type", "src_id", "dst_id").write.mode("overwrite").partitionBy("src_type", "relation", "dst_type").parquet(f"{folder}/edge_index")
    node_vectors.write.mode("overwrite").partitionBy("node_type").parquet(f"{folder}/node_features")
    edge_vectors.write.mode("overwrite").partitionBy("src_type", "relation", "dst_type").parquet(f"{folder}/edge_features")
