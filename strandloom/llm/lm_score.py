"""Text log-probabilities under a log-bilinear model trained with noise-contrastive estimation.

Tokens are the words of a text, A-Z lower-cased, then one end.  Counts of all training tokens are
aggregated over the whole corpus; the VOCABULARY most frequent make up the neural model's vocabulary,
all others are its class `rest`, inside which a word has its smoothed unigram probability.

The model predicts a token from the two before it: the context vector is the sum of their vectors scaled by one weight
vector per position, a token's score the inner product with its output vector plus a bias (Mnih and Hinton, 2007).
Training is noise-contrastive (Mnih and Teh, 2012), by AdaGrad from unigram biases, over all training tokens.  Texts are dealt by
the hash of id and text into shards of about SHARD_TOKENS tokens, as many as the corpus needs, and into ROUNDS rounds.
In each round every shard starts from the same broadcast parameters and learns from its texts of that round; the shards'
parameters and step sums are averaged by token count, FAN at a time in a tree on the executors, and broadcast for the next.
How Spark has partitioned the table has no part in the result.

Scores are normalised.  exp(score) factors into one term for each context word, so the normalisers of all
V x V contexts are one matrix product; a token's log-probability is then three table look-ups.

Words outside the broadcast head of the counts (at most HEAD words) get theirs by a join, so
the vocabulary may grow with the corpus without limit.

Defined results: a null or empty text is the end token alone.  A null doc_id is not held out and not learnt from.
Repeated rows are scored and counted each; the network learns once from rows of equal id and text, so that they meet in no shard by
the million.  Without training tokens N and V are 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import ship
from .common import documents, map_batches, remainder, segments, settle, texts

VOCABULARY, SIZE, NOISE, BATCH, RATE = 2048, 16, 48, 4096, 0.1
HEAD = 100_000
SHARD_TOKENS, ROUNDS, FAN = 2_000_000, 4, 16
FLUSH_WORDS = 300_000
#: Codes of the vocabulary's three fixed members; words follow.
START, END, REST, FIRST = 0, 1, 2, 3
_END_WORD = b""


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
            counts.clear()
            return out

        for b in batches:
            for t in texts(b.column(0)):
                counts.update(t.lower().split())
                counts[_END_WORD] += 1
                if len(counts) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    ship(docs.sparkSession)
    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Parameters:
    """Vectors in (V x SIZE) and out (V x SIZE), biases (V), position weights (2 x SIZE), as one flat array each."""

    inner: np.ndarray
    outer: np.ndarray
    bias: np.ndarray
    place: np.ndarray

    @classmethod
    def start(cls, probability: np.ndarray, seed: int = 3) -> Parameters:
        rng, v = np.random.default_rng(seed), len(probability)
        make = lambda: rng.normal(0, 0.1, (v, SIZE)).astype(np.float32)
        return cls(make(), make() * 0.1, np.log(np.maximum(probability, 1e-12)).astype(np.float32), np.ones((2, SIZE), np.float32))

    @classmethod
    def steps(cls, v: int) -> Parameters:
        """Where AdaGrad's sums of squares start."""
        return cls.from_flat(np.full(2 * v * SIZE + v + 2 * SIZE, 0.1))

    def parts(self) -> list[np.ndarray]:
        return [self.inner, self.outer, self.bias, self.place]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()]).astype(np.float64)

    @classmethod
    def from_flat(cls, x: np.ndarray) -> Parameters:
        v = (len(x) - 2 * SIZE) // (2 * SIZE + 1)
        x = x.astype(np.float32)
        return cls(x[: v * SIZE].reshape(v, SIZE), x[v * SIZE : 2 * v * SIZE].reshape(v, SIZE), x[2 * v * SIZE : 2 * v * SIZE + v], x[2 * v * SIZE + v :].reshape(2, SIZE))


def contexts(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before and the one before that, START beyond the text's beginning."""
    rank = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
    back = lambda k: np.where(rank >= k, np.concatenate((np.zeros(k, tokens.dtype), tokens[:-k]))[: len(tokens)], START)
    return back(1), back(2)


class Trainer:
    """One pass of noise-contrastive estimation with AdaGrad; the noise of a batch is shared by its tokens."""

    def __init__(self, p: Parameters, steps: Parameters, probability: np.ndarray, seed: int | list[int]):
        self.p, self.steps, self.rng = p, steps, np.random.default_rng(seed)
        self.logq = np.log(np.maximum(probability, 1e-12) * NOISE).astype(np.float32)
        self.cumulated = np.cumsum(probability) / probability.sum()
        self.sums = steps.parts()
        self.tokens = 0

    def _move(self, k: int, x: np.ndarray, g: np.ndarray) -> None:
        self.sums[k] += g * g
        x -= RATE * g / np.sqrt(self.sums[k])

    def learn(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> None:
        p, v = self.p, len(self.p.bias)
        order = self.rng.permutation(len(w))
        for i in range(0, len(w), BATCH):
            at = order[i : i + BATCH]
            t, a, b = w[at], w1[at], w2[at]
            noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), v - 1)
            ra, rb = p.inner[a], p.inner[b]
            r = ra * p.place[0] + rb * p.place[1]
            out, other = p.outer[t], p.outer[noise]
            good = (r * out).sum(1) + p.bias[t] - self.logq[t]
            bad = r @ other.T + (p.bias[noise] - self.logq[noise])
            g = 1 / (1 + np.exp(-np.clip(good, -30, 30))) - 1
            h = 1 / (1 + np.exp(-np.clip(bad, -30, 30)))
            scale = np.float32(1 / len(at) * 64)
            g, h = g * scale, h * scale
            d = g[:, None] * out + h @ other
            gout = _scattered(t, g[:, None] * r, v)
            np.add.at(gout, noise, h.T @ r)
            gbias = np.bincount(t, g, v).astype(np.float32)
            np.add.at(gbias, noise, h.sum(0))
            ginner = _scattered(np.concatenate((a, b)), np.concatenate((d * p.place[0], d * p.place[1])), v)
            self._move(0, p.inner, ginner)
            self._move(1, p.outer, gout)
            self._move(2, p.bias, gbias)
            self._move(3, p.place, np.stack(((d * ra).sum(0), (d * rb).sum(0))) / 64)
        self.tokens += len(w)


def _scattered(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    width = values.shape[1]
    flat = at[:, None] * width + np.arange(width)
    return np.bincount(flat.ravel(), values.ravel(), n * width).astype(np.float32).reshape(n, width)


@dataclass
class LanguageModel:
    """head: word -> (count, vocabulary code or REST). n, v: training tokens and distinct ones; p: the network."""

    head: dict[bytes, tuple[int, int]]
    probability: np.ndarray
    n: int
    v: int
    rest_n: int
    rest_v: int
    p: Parameters
    _tables: tuple | None = None

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (last word, token) with biases and by (word before, token), and log-normalisers by both context words."""
        if self._tables is None:
            p = self.p
            bias = p.bias.copy()
            bias[START] = -np.inf
            one = (p.inner * p.place[0]) @ p.outer.T + bias
            two = (p.inner * p.place[1]) @ p.outer.T
            high1, high2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
            total = np.exp(one - high1) @ np.exp(two - high2).T
            self._tables = one, two, np.log(np.maximum(total, 1e-30)) + high1 + high2.T
        return self._tables

    def encode(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Vocabulary codes and head counts (-1 outside the head) of all tokens, tokens per text, and the words outside the head."""
        tokens, counts, lengths, tails = [], [], [], []
        get, none = self.head.get, (-1, REST)
        for t in rows:
            words = t.lower().split()
            found = [get(w, none) for w in words]
            tails.append([w for w, x in zip(words, found, strict=True) if x is none])
            found.append((self.head[_END_WORD][0] if _END_WORD in self.head else 0, END))
            lengths.append(len(found))
            counts += [x[0] for x in found]
            tokens += [x[1] for x in found]
        return np.array(tokens, np.int64), np.array(counts, np.int64), np.array(lengths, np.int64), tails

    def token_logs(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Natural log-probability of each token, less log(c + 1) of words outside the head, and what encode() gives besides codes."""
        tokens, counts, lengths, tails = self.encode(rows)
        one, two, normal = self.tables()
        w1, w2 = contexts(tokens, lengths)
        logs = (one[w1, tokens] + two[w2, tokens] - normal[w1, w2]).astype(np.float64)
        rest = tokens == REST
        logs[rest] += np.log(np.maximum(counts[rest], 0) + 1.0) - math.log(self.rest_n + self.rest_v + 1)
        return logs, counts, lengths, tails


def fit(training: DataFrame, counts: DataFrame) -> LanguageModel:
    """training: (doc_id, text); counts: settled (word, c)."""
    spark = training.sparkSession
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    top = counts.where(F.length("word") > 0).orderBy(F.desc("c"), "word").limit(HEAD).collect()
    ends = sum(r["c"] for r in counts.where(F.length("word") == 0).collect())
    n, v = int(n or 0), int(v or 0) if n else 0
    head: dict[bytes, tuple[int, int]] = {}
    inside = [ends]
    for i, r in enumerate(top):
        code = FIRST + i if FIRST + i < VOCABULARY else REST
        head[bytes(r["word"])] = (r["c"], code)
        if code != REST:
            inside.append(r["c"])
    rest_n = n - sum(inside)
    rest_v = max(0, v - len(inside)) if n else 0
    share = np.array([0, ends + 1, rest_n + 1, *[c + 1 for c in inside[1:]]], float)
    share /= share.sum()
    if n:
        head[_END_WORD] = (ends, END)
    model = LanguageModel(head, share, n, v, rest_n, rest_v, Parameters.start(share))
    if n:
        learn(training, model)
    return model


def shards(training: DataFrame, model: LanguageModel) -> tuple[DataFrame, int]:
    """Settled (round, shard, h1, h2, tokens): packed vocabulary codes of each text, and the number of shards."""
    many = max(1, -(-model.n // SHARD_TOKENS))
    text = F.col("text").cast("string")
    keyed = training.select(F.xxhash64("doc_id", text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("text"))
    sent = training.sparkSession.sparkContext.broadcast(model.head)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        get, none = sent.value.get, (0, REST)
        rows = [np.array([get(w, none)[1] for w in t.lower().split()] + [END], np.uint16).tobytes() for t in texts(b.column(2))]
        return pa.record_batch([b.column(0), b.column(1), pa.array(rows, pa.binary())], ["h1", "h2", "tokens"])

    coded = map_batches(keyed, run, "h1 long, h2 long, tokens binary", rows=512).groupBy("h1", "h2").agg(F.first("tokens").alias("tokens"))
    place = F.pmod(F.col("h1"), F.lit(many * ROUNDS))
    return settle(coded.withColumns({"round": F.pmod(place, F.lit(ROUNDS)), "shard": F.floor(place / ROUNDS)}), "lm-shards"), many


def learn(training: DataFrame, model: LanguageModel) -> None:
    """Trains the model's network; training: (doc_id, text)."""
    spark = training.sparkSession
    rows, many = shards(training, model)
    p, steps, probability = model.p, Parameters.steps(len(model.probability)), model.probability
    width = 2 * len(p.flat())
    schema = "shard long, n long, sum binary"

    def packed(shard: int, n: int, total: np.ndarray) -> pa.Table:
        return pa.table([pa.array([shard]), pa.array([n]), pa.array([total.tobytes()], pa.binary())], ["shard", "n", "sum"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        order = np.argsort(table["shard"].to_numpy())
        for i in order.tolist():
            total += np.frombuffer(table["sum"][i].as_py(), np.float64)
        return packed(table["shard"][int(order[0])].as_py() // FAN, sum(table["n"].to_pylist()), total)

    def worker(sent: Broadcast, turn: int) -> Callable[[pa.Table], pa.Table]:
        def work(table: pa.Table) -> pa.Table:
            own, sums, share = sent.value
            shard = table["shard"][0].as_py()
            trainer = Trainer(Parameters.from_flat(own), Parameters.from_flat(sums), share, [turn, shard])
            order = np.lexsort((table["h2"].to_numpy(), table["h1"].to_numpy()))
            parts = [np.frombuffer(x, np.uint16) for x in table["tokens"].take(pa.array(order)).to_pylist()]
            for i in range(0, len(parts), 256):
                tokens = np.concatenate(parts[i : i + 256]).astype(np.int64)
                trainer.learn(tokens, *contexts(tokens, np.array([len(x) for x in parts[i : i + 256]])))
            return packed(shard, trainer.tokens, np.concatenate((trainer.p.flat(), trainer.steps.flat())) * trainer.tokens)

        return work

    for turn in range(ROUNDS):
        work = worker(spark.sparkContext.broadcast((p.flat(), steps.flat(), probability)), turn)
        ship(spark)
        found, left = rows.where(F.col("round") == turn).groupBy("shard").applyInArrow(work, schema), many
        while left > FAN:
            found, left = found.groupBy(F.floor(F.col("shard") / FAN).alias("s")).applyInArrow(add, schema), -(-left // FAN)
        got = sorted(found.collect(), key=lambda r: r["shard"])  # at most FAN rows
        if weight := sum(r["n"] for r in got):
            mean = sum(np.frombuffer(r["sum"], np.float64) for r in got) / weight
            p, steps = Parameters.from_flat(mean[: width // 2]), Parameters.from_flat(mean[width // 2 :])
    model.p = p


def lm_scores(docs: DataFrame, trains: DataFrame) -> DataFrame:
    """doc_id and the n_tokens, n_known, train_tokens, base_score and score of every row; trains: the texts to learn from."""
    spark = docs.sparkSession
    counts = settle(word_counts(trains), "lm-counts")
    model = fit(trains, counts)
    sent = spark.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        logs, c, lengths, tails = sent.value.token_logs(texts(b.column(1)))
        row, inside = segments(lengths), c >= 0
        many = len(lengths)
        base = np.bincount(row[inside], np.log10(c[inside] + 1.0), many)
        known = np.bincount(row[c > 0], minlength=many)
        total = np.bincount(row, logs, many) / math.log(10)
        return pa.record_batch(
            [b.column(0), pa.array(lengths, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(total), pa.array(tails, pa.list_(pa.binary()))],
            ["doc_id", "n_tokens", "known", "base", "total", "tail"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    each = map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens long, known long, base double, total double, tail array<binary>", rows=256)
    each = settle(each.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    words = each.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    # Words outside the head are at most as frequent as its last one, so no key of this join is hot.
    found = words.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("weight"))
    out = each.drop("tail").join(found, "row", "left")
    weight = F.coalesce("weight", F.lit(0.0))
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + weight - F.col("n_tokens") * math.log10(model.n + model.v + 1)).alias("base_score"),
        (F.col("total") + weight).alias("score"),
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = lm_scores(docs, docs.where(remainder(F.col("doc_id"), 7) != 2))
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
