"""What the text operators share: the shared folder, checked broadcasts, words, shingles, components.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``; lower-casing touches A-Z only.  On UTF-8
bytes both are what ``bytes.split()`` and ``bytes.lower()`` do, so no pattern is needed.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import fresh_path, settle  # noqa: F401  the operators take them from here
from ..workers import ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = "[\\x20\\x09-\\x0D]"
#: A side of a join is broadcast up to this many rows of a few numbers each; beyond it, it is shuffled.
BROADCAST_ROWS = 400_000
#: Words whose codes a Python worker remembers between rows, for each kind of code; workers live through all stages of a job.
CACHE_WORDS = 100_000
#: Bytes of a slice of rows that is worked on at once.
SLICE_BYTES = 8 << 20


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of frames that are no longer referred to; it does so when the driver's JVM collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checked(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A settled frame with a broadcast hint if it has few rows, else as it is (Spark then shuffles it)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is written meanwhile goes to Python workers in batches of so many rows: whole texts of the usual 10,000 take tens of megabytes on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def strip_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def remainder(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(c.cast("string")) % n


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(b: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """b in slices of at most `rows` rows and, of more than one row, SLICE_BYTES."""
    if b.num_rows > rows or b.num_rows > 1 and b.nbytes > SLICE_BYTES:
        half = min(rows, b.num_rows // 2) if b.nbytes > SLICE_BYTES else rows
        yield from slices(b.slice(0, half), rows)
        yield from slices(b.slice(half), rows)
    elif b.num_rows:
        yield b


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, label, text) of the `rows` labelled ids with the smallest hashes, at most: one row for each id and label, of the id's first text.

    The first text is taken by a partial aggregate, so an id that a third of all rows have brings one row of each task.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").select(F.col("doc_id").alias("_id"), "label").distinct()
    sample = known.orderBy(F.xxhash64("_id"), "_id", "label").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample.select("_id").distinct()), F.col("doc_id") == F.col("_id"))
    first = found.groupBy("doc_id").agg(F.min(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    return first.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on between tasks, and what each keeps counts for its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType, rows: int = 512) -> DataFrame:
    """mapInArrow by slices, so that memory does not follow the batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, rows):
                if (out := f(part)) is not None and out.num_rows:
                    yield out
        b = part = out = None  # noqa: F841  else the last batch stays
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def add_column(df: DataFrame, f: Callable[[pa.RecordBatch], pa.Array], name: str, kind: T.DataType, rows: int = 512) -> DataFrame:
    """df with one more column, made by f from each slice; a column of that name is replaced, the others pass through."""
    df = df.drop(name)
    names = [*df.columns, name]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*b.columns, f(b)], names)

    return map_batches(df, run, T.StructType([*df.schema.fields, T.StructField(name, kind)]), rows)


class Codes(dict):
    """word -> code, remembered for a bounded number of words."""

    def __init__(self, code: Callable[[bytes], int], most: int = CACHE_WORDS):
        self.code, self.most = code, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = out = self.code(word)
        return out


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def segments(lengths: np.ndarray) -> np.ndarray:
    """Row numbers of concatenated rows of these lengths."""
    return np.repeat(np.arange(len(lengths)), lengths)


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_runs(rows: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the n-word shingles of lower-cased texts in order, concatenated, and how many each text has.

    A text of fewer than n words has its whole word sequence as its only shingle; one without words has none.
    """
    words = [t.lower().split() for t in rows]
    counts = np.array([len(w) for w in words], np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    if not len(h):
        return h, counts
    acc = np.zeros(len(h), np.uint64)
    used = np.zeros(len(h), np.uint64)
    doc = segments(counts)
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for i in range(n):  # words beyond the text's end add nothing, so that short texts have their whole sequence
            part = h[i:]
            same = doc[i:] == doc[: len(doc) - i]
            m = len(part)
            acc[:m] += np.where(same, mixed(part + odd * np.uint64(2 * i + 1)), np.uint64(0))
            used[:m] += same
        acc = mixed(acc ^ (used * odd))
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    kept = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.arange(int(kept.sum())) - np.repeat(np.cumsum(kept) - kept, kept) + np.repeat(starts, kept)
    return acc[at], kept


def shingle_sets(rows: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle codes of each text in ascending order, concatenated, and how many each has."""
    codes, counts = shingle_runs(rows, n)
    out, size, at = [], np.zeros(len(counts), np.int64), 0
    for i, c in enumerate(counts):
        s = np.unique(codes[at : at + c])
        out.append(s)
        size[i] = len(s)
        at += c
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), size


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def components(edges: DataFrame, tag: str = "cc", rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of undirected edges (a, b), two longs; root is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until the edges stand still: each
    round only aggregates and joins, so neither a component nor the links ever meet in one place.
    """
    e = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), tag)
    for _ in range(rounds):
        # Done when the edges are stars: every a has one b, and no b is an a.
        roots = e.select(F.col("b").alias("root")).distinct()
        counts = e.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d")).crossJoin(F.broadcast(e.join(roots, F.col("a") == F.col("root"), "left_semi").agg(F.count("*").alias("inner"))))
        now = counts.first()
        if now["n"] == now["d"] and not now["inner"]:
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("v").alias("a"), F.col("m").alias("b")))
        e = settle(small.where("a <> b").distinct(), tag)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
