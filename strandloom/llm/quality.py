"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its lower-cased words, the shapes of its words (`Aa.`, `A!`), pairs of neighbouring
shapes, and whether a word repeats the one before it, hashed to `DIMS` columns.  They are weighted by
(1 + log tf) * idf, where document frequencies are counted over all documents.  A randomised singular
value decomposition of a bounded sample of labelled documents (`TRAIN_ROWS`, those with the smallest id
hashes) gives `RANK` latent directions; the sample's unit vectors, at most TRAIN_ROWS x RANK floats,
are broadcast.  Every document's cosine with every one of them is computed exactly, as blocked matrix products,
and its `NEIGHBOURS` nearest vote with their similarity as weight.

Defined results: a text without terms (null, empty, blank) has the share of label 1 in the sample as
its score, 0.5 without labels.  A null doc_id is not held out and never trained on.  Repeated label rows count once.
Similarities are compared after rounding to six digits, ties go to the neighbour that comes first by doc_id.  Of rows that repeat a labelled
id, the first text is learnt from.  All other columns pass through `score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Codes, add_column, documents, labelled as sampled, map_batches, mixed, remainder, segments, texts

TRAIN_ROWS, DIMS, RANK, NEIGHBOURS = 4_000, 4096, 64, 15
THRESHOLD = 0.3
SHARPNESS = 4

_SHAPES = bytes(65 if 65 <= i <= 90 else 48 if 48 <= i <= 57 else 97 if i >= 128 or 97 <= i <= 122 else i for i in range(256))


def _shape(runs: bytes) -> int:
    """Code of a word's shape, from the word translated by _SHAPES."""
    return xxhash.xxh3_64_intdigest(bytes(c for i, c in enumerate(runs) if i == 0 or c != runs[i - 1])[:6])


_shapes = Codes(_shape)


#: Texts whose counts are kept in one table of a row for each text and a column for each of DIMS.
TABLE_ROWS = 16
_AGAIN = [int(mixed(np.array([x], np.uint64))[0] % np.uint64(DIMS)) for x in (13, 11)]


def _terms(rows: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For blocks of at most TABLE_ROWS texts: the number of texts before it, and the counts by text and column."""
    words = [t.lower().split() for t in rows]
    counts = np.array([len(w) for w in words], np.int64)
    edge = np.concatenate(([0], np.cumsum(counts)))
    # There are too many different words to remember their codes, but few shapes.
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(edge[-1]))
    shape = np.fromiter(map(_shapes.__getitem__, chain.from_iterable(t.translate(_SHAPES).split() for t in rows)), np.uint64, int(edge[-1]))
    one, low = np.uint64(1), np.uint64(DIMS - 1)  # DIMS is a power of two
    with np.errstate(over="ignore"):
        columns = (mixed(word + one) & low).astype(np.int64), (mixed(shape + np.uint64(2)) & low).astype(np.int64)
        pairs = (mixed(shape[1:] * np.uint64(3) + shape[:-1]) & low).astype(np.int64)
    same = word[1:] == word[:-1]
    for start in range(0, len(rows), TABLE_ROWS):
        n = counts[start : start + TABLE_ROWS]
        i, j = edge[start], edge[start + len(n)]
        doc = segments(n)
        base = doc * DIMS
        near = doc[1:] == doc[:-1]
        key = np.concatenate([base + columns[0][i:j], base + columns[1][i:j], (base[1:] + pairs[i : j - 1])[near] if j > i else base])
        table = np.bincount(key, minlength=len(n) * DIMS).reshape(len(n), DIMS)
        if j > i:
            again = np.bincount(doc[1:][near & same[i : j - 1]], minlength=len(n))
            table[:, _AGAIN[1]] += again
            table[:, _AGAIN[0]] += np.maximum(n - 1, 0) - again
        yield start, table


def term_counts(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, column, count), sorted by document and column."""
    docs, columns, counts = ([np.zeros(0, np.int64)] for _ in range(3))
    for start, table in _terms(rows):
        flat = table.ravel()
        key = np.flatnonzero(flat)
        docs.append(key // DIMS + start)
        columns.append(key % DIMS)
        counts.append(flat[key])
    return np.concatenate(docs), np.concatenate(columns), np.concatenate(counts)


@dataclass
class NeighbourVotes:
    """idf by column; directions (DIMS x RANK); unit vectors and labels of the labelled sample."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, doc: np.ndarray, column: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        weight = ((1 + np.log(count)) * self.idf[column]).astype(np.float32)
        out = np.zeros((n, self.directions.shape[1]), np.float32)
        cuts = np.searchsorted(doc, np.arange(0, n + TABLE_ROWS, TABLE_ROWS))
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j > i:
                starts = np.concatenate(([0], np.nonzero(np.diff(doc[i:j]))[0] + 1))
                part = self.directions[column[i:j]]
                part *= weight[i:j, None]
                out[doc[i:j][starts]] = np.add.reduceat(part, starts, axis=0)
        return _unit(out)

    def scores(self, rows: list[bytes]) -> np.ndarray:
        share = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(rows), share)
        x = self.embed(*term_counts(rows), len(rows))
        sim = np.round(x @ self.vectors.T, 6)
        k = min(NEIGHBOURS, len(self.labels))
        best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        # Of those that equal the k-th, argpartition takes any: rows that leave some out are settled by place.
        last = np.take_along_axis(sim, best, 1).min(1, keepdims=True)
        tied = np.flatnonzero((sim >= last).sum(1) > k)
        if len(tied):
            best[tied] = np.argsort(-sim[tied], axis=1, kind="stable")[:, :k]
        weight = np.maximum(np.take_along_axis(sim, best, 1).astype(float), 0) ** SHARPNESS
        total = weight.sum(1)
        return np.where(total > 0, (weight * self.labels[best]).sum(1) / np.where(total > 0, total, 1), share).clip(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def fit(counts: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, idf: np.ndarray, seed: int = 1) -> NeighbourVotes:
    """Randomised SVD (Halko et al., 2011) of the sample's unit tf-idf rows."""
    n = len(labels)
    doc, column, count = counts
    x = np.zeros((n, DIMS), np.float32)
    x[doc, column] = (1 + np.log(count)) * idf[column]
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.where(norm > 0, norm, 1).astype(np.float32)[:, None]
    q = np.random.default_rng(seed).normal(size=(DIMS, RANK + 16)).astype(np.float32)
    for _ in range(4):
        q, _r = np.linalg.qr(x.T @ (x @ q))
    _u, _s, vt = np.linalg.svd(x @ q, full_matrices=False)
    votes = NeighbourVotes(idf.astype(np.float32), np.ascontiguousarray((q @ vt.T)[:, :RANK]), np.zeros((0, RANK), np.float32), labels.astype(float))
    votes.vectors = votes.embed(doc, column, count, n)
    return votes


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents per column over all rows, then the number of documents: DIMS + 1 counts."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        df = np.zeros(DIMS + 1, np.int64)
        for _, table in _terms(texts(b.column(0))):
            df[:DIMS] += np.count_nonzero(table, axis=0)
        df[DIMS] = b.num_rows
        at = np.nonzero(df)[0]
        return pa.record_batch([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], ["column", "n"])

    out = np.zeros(DIMS + 1, np.int64)
    for column, n in map_batches(docs.select("text"), run, "column int, n long", rows=1024).groupBy("column").agg(F.sum("n")).collect():
        out[column] = n
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> NeighbourVotes:
    """labels: (doc_id, label). At most `rows` labelled ids, those with the smallest hashes, are learnt from."""
    df = document_frequencies(docs)
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS]))
    found = sampled(docs, labels, rows)

    def coded(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, column, count = term_counts(texts(b.column(2)))
        cut = np.searchsorted(doc, np.arange(1, b.num_rows))
        pack = lambda x: pa.array([p.astype(np.int32).tobytes() for p in np.split(x, cut)], pa.binary())
        return pa.record_batch([b.column(0), b.column(1), pack(column), pack(count)], ["doc_id", "label", "columns", "counts"])

    got = map_batches(found, coded, "doc_id long, label int, columns binary, counts binary").toArrow().sort_by([(c, "ascending") for c in ("doc_id", "label", "columns")])
    if not got.num_rows:
        return NeighbourVotes(idf.astype(np.float32), np.zeros((DIMS, RANK), np.float32), np.zeros((0, RANK), np.float32), np.zeros(0))
    columns, counts = ([np.frombuffer(x, np.int32) for x in got[c].to_pylist()] for c in ("columns", "counts"))
    doc = segments(np.array([len(c) for c in columns]))
    return fit((doc, np.concatenate(columns), np.concatenate(counts)), np.array(got["label"].to_pylist()), idf)


def score(docs: DataFrame, model: NeighbourVotes, column: str = "score") -> DataFrame:
    """docs with a double column of scores; a column of that name is replaced, all others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_column(docs, lambda b: pa.array(sent.value.scores(texts(b.column("text"))), pa.float64()), column, T.DoubleType())


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = score(docs, train(docs, training_labels(spark, sf_dir)))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
