"""Toxicity by a factorization machine over hashed terms.

A text's terms are the 64-bit codes of its distinct lower-cased words (runs of letters and digits)
and of the first four and six bytes of longer ones, which catches compounds of a known stem.  The machine
adds to the usual linear weight of each term a weight for each pair of terms, the product of two
short vectors, so that an insult together with a group mention can weigh more than either.
It is trained in numpy on a bounded sample (`TRAIN_ROWS` labelled documents with the smallest
id hashes) and sent to the executors, which score every whole text.

Defined results: a null or empty text has the bias term only.  A null doc_id is not held out and never
trained on.  Repeated label rows count once; contradicting ones count each.  Of rows that repeat a labelled id, the first text is learnt
from.  Without any label the score is 0.5.  All other columns pass through `score`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_column, documents, give_back, labelled as sampled, map_batches, remainder, texts

TRAIN_ROWS, MIN_DF, MAX_TERMS, FACTORS, EPOCHS = 12_000, 5, 512, 8, 12
THRESHOLD = 0.7
STEMS = (4, 6)

#: A-Z to lower case, other ASCII characters than letters and digits to blanks.
_TABLE = bytes((i + 32 if 65 <= i <= 90 else i) if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def terms(text: bytes) -> np.ndarray:
    """Sorted distinct term codes of a text; 0 is the bias, which every text has."""
    words = set(text.translate(_TABLE).split())
    words |= {b"^" + w[:k] for k in STEMS for w in words if len(w) > k}
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


@dataclass
class FactorizationMachine:
    """codes: the known terms in ascending order; row 0 of w and v is the bias, row i + 1 is term i."""

    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    w: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    v: np.ndarray = field(default_factory=lambda: np.zeros((1, FACTORS), np.float32))

    def rows(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the known terms of each document, bias first, concatenated; where each document starts."""
        out = []
        for d in docs:
            at = np.searchsorted(self.codes, d)
            known = (at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == d) if len(self.codes) else np.zeros(len(d), bool)
            out.append(np.concatenate(([0], at[known] + 1)))
        return np.concatenate(out).astype(np.int64), np.cumsum([0] + [len(x) for x in out])[:-1]

    def logits(self, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.v[rows]
        s = _sums(v, starts)
        return _sums(self.w[rows], starts) + 0.5 * (s * s - _sums(v * v, starts)).sum(1), s

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(*self.rows(docs))[0].astype(float), -30, 30)))


def _counted(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms in ascending order and in how many documents each is; sorted in place, as the sample has millions of terms."""
    flat = np.concatenate(docs)
    flat.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(len(flat), 1), bool), flat[1:] != flat[:-1])))
    return flat[first], np.diff(np.append(first, len(flat))).astype(float)


def fit(docs: list[np.ndarray], labels: np.ndarray, seed: int = 1, rate: float = 0.1, decay: float = 2e-4) -> FactorizationMachine:
    """Logistic loss, AdaGrad, mini-batches of 128, over the MAX_TERMS terms of at least MIN_DF documents
    that depend most on the label by chi-square: the rest, mostly rare words, would only be learnt by heart."""
    if not len(docs):
        return FactorizationMachine()
    codes, df = _counted(docs)
    hits = np.zeros(len(codes))
    bad = [d for d, y in zip(docs, labels, strict=True) if y]
    if bad:
        some, many = _counted(bad)
        hits[np.searchsorted(codes, some)] = many
    share, n = float(labels.mean()), len(docs)
    chance = np.maximum(df * share * (1 - share) * (1 - df / n), 1e-9)
    chi = np.where((df >= MIN_DF) & (df < n), (hits - df * share) ** 2 / chance, 0)
    best = np.lexsort((codes, -chi))[:MAX_TERMS]
    keep = np.zeros(len(codes), bool)
    keep[best[chi[best] > 0]] = True
    rng = np.random.default_rng(seed)
    n = int(keep.sum()) + 1
    fm = FactorizationMachine(codes[keep], np.zeros(n, np.float32), rng.normal(0, 0.01, (n, FACTORS)).astype(np.float32))
    fm.v[0] = 0
    gw, gv = np.full(n, 1e-2, np.float32), np.full((n, FACTORS), 1e-2, np.float32)
    at = [fm.rows([d])[0] for d in docs]
    for _ in range(EPOCHS):
        order = rng.permutation(len(at))
        for i in range(0, len(order), 128):
            some = order[i : i + 128]
            rows = np.concatenate([at[j] for j in some])
            lengths = np.array([len(at[j]) for j in some])
            starts = np.cumsum(lengths) - lengths
            z, s = fm.logits(rows, starts)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]).astype(np.float32) / len(some) * 8
            each = np.repeat(err, lengths)
            used, where = np.unique(rows, return_inverse=True)
            dw = np.bincount(where, each, len(used)).astype(np.float32) + decay * fm.w[used]
            pull = each[:, None] * (np.repeat(s, lengths, axis=0) - fm.v[rows])
            dv = np.stack([np.bincount(where, pull[:, k], len(used)) for k in range(FACTORS)], 1).astype(np.float32) + decay * fm.v[used]
            dv[used == 0] = 0
            gw[used] += dw * dw
            gv[used] += dv * dv
            fm.w[used] -= rate * dw / np.sqrt(gw[used])
            fm.v[used] -= rate * 0.2 * dv / np.sqrt(gv[used])
    return fm


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """labels: (doc_id, label). The sample is the `rows` labelled ids with the smallest hashes, at most."""
    found = sampled(docs, labels, rows)

    def coded(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([b.column(0), b.column(1), pa.array([terms(t).tobytes() for t in texts(b.column(2))], pa.binary())], ["doc_id", "label", "terms"])

    got = map_batches(found, coded, "doc_id long, label int, terms binary").toArrow()
    order = sorted(zip(got["doc_id"].to_pylist(), got["label"].to_pylist(), range(got.num_rows), strict=True))  # an id and label are one row
    rows = got["terms"].to_pylist()
    del got
    model = fit([np.frombuffer(rows[i], np.uint64) for _, _, i in order], np.array([y for _, y, _ in order], np.float32))
    del rows, order
    give_back()
    return model


def score(docs: DataFrame, model: FactorizationMachine, column: str = "score") -> DataFrame:
    """docs with a double column of scores; a column of that name is replaced, all others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return add_column(docs, lambda b: pa.array(sent.value.scores([terms(t) for t in texts(b.column("text"))]), pa.float64()), column, T.DoubleType())


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 3) != 1).select("doc_id", F.col("toxic").alias("label"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = score(docs, train(docs, training_labels(spark, sf_dir)))
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
