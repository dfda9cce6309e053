"""Sparse entries to dense arrays and back, trimmed layouts, and a report on how well classes can be told apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encode import SEEDS, slot
from .layout import Layout


#: Floats that are laid out at once.
BLOCK_FLOATS = 1 << 20


def densify(entry_rows: DataFrame, keys: Sequence[str], width: int, rows: DataFrame | None = None) -> DataFrame:
    """(keys, vector): an array of `width` floats for each key; entries outside are ignored. rows: keys that get a vector even without entries.

    The vectors never leave the executors.
    """
    inside = entry_rows.where(F.col("dim").between(0, width - 1)).groupBy(*keys, "dim").agg(F.sum("value").alias("value"))
    maps = inside.groupBy(*keys).agg(F.collect_list(F.struct("dim", "value")).alias("m"))
    if rows is not None:
        maps = rows.select(*keys).join(maps, list(keys), "left")
    kinds = [maps.schema[k] for k in keys]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Values to their places in a block of zeros, all rows of a slice at once."""
        step = max(1, BLOCK_FLOATS // max(width, 1))
        for b in batches:
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                lists = part.column(len(keys))
                row = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                flat = lists.flatten()
                block = np.zeros((part.num_rows, width), np.float32)
                block[row, flat.field(0).to_numpy(zero_copy_only=False)] = flat.field(1).to_numpy(zero_copy_only=False)
                offsets = pa.array(np.arange(part.num_rows + 1) * width, pa.int32())
                yield pa.record_batch([*part.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(block.ravel()))], [*keys, "vector"])

    schema = T.StructType([*kinds, T.StructField("vector", T.ArrayType(T.FloatType()))])
    return maps.select(*keys, "m").mapInArrow(scatter, schema)


def sparsify(vectors: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, dim, value) of the elements that are not 0."""
    out = vectors.select(*keys, F.posexplode(column).alias("dim", "value"))
    return out.where("value <> 0").select(*keys, "dim", F.col("value").cast("double"))


def position_kinds(entry_rows: DataFrame, rows: int, width: int) -> DataFrame:
    """(dim, kind, value): each column as `varying`, `constant` with its value, or `zero`; rows is how many vectors there are."""
    used = entry_rows.groupBy("dim").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    every = entry_rows.sparkSession.range(width).select(F.col("id").cast("int").alias("dim")).join(used, "dim", "left")
    flat = (F.col("n") == rows) & (F.col("low") == F.col("high"))
    kind = F.when(F.col("n").isNull() | (F.col("low").eqNullSafe(0.0) & F.col("high").eqNullSafe(0.0)), "zero").when(flat, "constant").otherwise("varying")
    return every.select("dim", kind.alias("kind"), F.when(kind == "constant", F.col("low")).when(kind == "zero", F.lit(0.0)).alias("value"))


class Trim:
    """A published narrowing of a layout: columns kept, columns that hold a constant, columns that copy another."""

    def __init__(self, width: int, kept: Sequence[int], constant: dict[int, float] | None = None, copies: dict[int, int] | None = None):
        self.width, self.kept, self.constant, self.copies = width, list(kept), dict(constant or {}), dict(copies or {})
        claimed = [*self.kept, *self.constant, *self.copies]
        if len(set(claimed)) != len(claimed) or any(not 0 <= d < width for d in claimed) or not set(self.copies.values()) <= set(self.kept):
            raise ValueError("each column is kept, constant or a copy of a kept one, at most one of these")

    def apply(self, entry_rows: DataFrame) -> tuple[DataFrame, Observation]:
        """Entries of the kept columns, renumbered, and an observation that counts, while they are read, entries that break the promise."""
        to = F.create_map(*[F.lit(x) for i, d in enumerate(self.kept) for x in (d, i)])
        zero = sorted(set(range(self.width)) - {*self.kept, *self.constant, *self.copies})
        off = F.lit(False)
        for d, v in self.constant.items():
            off = off | ((F.col("dim") == d) & (F.col("value") != v))
        seen = Observation()
        watched = entry_rows.observe(seen, F.count_if(F.col("dim").isin(zero) & (F.col("value") != 0)).alias("not_zero"), F.count_if(off).alias("not_constant"))
        return watched.where(F.col("dim").isin(self.kept)).withColumn("dim", to[F.col("dim")]), seen

    def restore(self, vector: Sequence[float]) -> list[float]:
        out = [0.0] * self.width
        for d, v in zip(self.kept, vector, strict=True):
            out[d] = v
        return [self.constant.get(d, out[self.copies.get(d, d)]) for d in range(self.width)]


def class_codes(kinds: DataFrame, layout: Layout) -> dict[str, frozenset[int]]:
    """Slots of each class; one row for each node type comes to the driver, never one for each node."""
    rows = kinds.select("node_type", *[slot(F.col("type_uri"), s, layout["class_identity"]).alias(f"s{i}") for i, s in enumerate(SEEDS)]).collect()
    return {r["node_type"]: frozenset(r[1:]) for r in rows}


def collision_report(codes: dict[str, frozenset[int]], layout: Layout, fail: bool = False) -> dict:
    """Reuse of slots, classes with equal codes, the largest overlap of two, and the rank of the code matrix.

    With fail, raises if two classes have the same code or the rank is less than the number of classes.
    """
    part, names = layout["class_identity"], sorted(codes)
    matrix = np.zeros((len(names), part.dim))
    for i, n in enumerate(names):
        matrix[i, [d - part.start for d in codes[n]]] = 1
    used = matrix.sum(0)
    overlap = matrix @ matrix.T
    np.fill_diagonal(overlap, 0)
    same: dict[frozenset[int], list[str]] = {}
    for n in names:
        same.setdefault(codes[n], []).append(n)
    rank = int(np.linalg.matrix_rank(matrix)) if names else 0
    out = {"classes": len(names), "dims": part.dim, "used": int((used > 0).sum()), "reused": int((used > 1).sum()), "identical": sorted(g for g in same.values() if len(g) > 1), "max_overlap": int(overlap.max()) if names else 0, "rank": rank}
    if fail and (out["identical"] or rank < len(names)):
        raise ValueError(f"{len(names)} classes have codes of rank {rank} in {part.dim} columns; widen the vector")
    return out
