"""Benchmark items found in documents by SimHash of item-sized windows.

An item of L words is compared with windows of L words at every word of a document, or with the whole document if it
is shorter.  Shingles of five words (of
the whole item, if it is shorter) weigh ln(1 + items / items with it), counted over the whole benchmark; the items are taken
CHUNK at a time, each chunk with the counts of all shingles that several items have (one that a single item has weighs as one
that none has).

Windows without a shingle of the item have similarity 0, so only windows around a shared shingle are fingerprinted:
64 signs of weighted sums, from one cumulative sum a document.  Fingerprints are looked up in a multi-index: BLOCKS
blocks of 16 bits, each listing the items within RADIUS // BLOCKS bits of the block's value, which by the pigeonhole principle
holds every item within RADIUS bits.  Similar windows may differ in more bits; so those in which the shingles of the item weigh
at least SIMILARITY of the item, without which no similarity reaches it, are candidates too.  Fingerprints alone thus lose no match.
Candidates are verified exactly: the weighted Jaccard similarity of the two
multisets of shingles must be at least SIMILARITY.

Defined results: one row for each document and item that match, with the best window (most similar, then first).
A null or empty text matches nothing; items without words match nothing; a null doc_id or item_id takes no part.  Rows that repeat
a doc_id are searched each.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked, documents, free_name, map_batches, mixed, settle, shingle_runs, texts, union_all

N, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 15, 4
CHUNK = 4_000
_SEED = np.uint64(0xA0761D6478BD642F)


def signs(codes: np.ndarray) -> np.ndarray:
    """64 signs of each shingle, as -1 and 1."""
    bits = np.unpackbits(mixed(codes ^ _SEED).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def _neighbours(bits: int, most: int) -> np.ndarray:
    out = [0]
    for k in range(1, most + 1):
        out += [sum(1 << i for i in some) for some in combinations(range(bits), k)]
    return np.array(out, np.int64)


@dataclass
class Items:
    """One chunk of the benchmark: shingles, weights, fingerprints and the multi-index."""

    ids: np.ndarray
    sizes: np.ndarray
    bags: list[dict[int, int]]
    codes: np.ndarray
    shared: np.ndarray
    weights: np.ndarray
    unknown: float
    holders: dict[int, list[int]]
    prints: np.ndarray
    totals: np.ndarray
    index: list[tuple[np.ndarray, np.ndarray]]
    filter: np.ndarray

    @classmethod
    def build(cls, ids: list[int], rows: list[bytes], n: int, total: int | None = None, counts: dict[int, int] | None = None) -> Items:
        """total, counts: items of the whole benchmark and those with each shingle that several have, if this is a part of it."""
        size = np.array([len(r.split()) for r in rows], np.int64)
        bags: list[dict[int, int]] = []
        for r, k in zip(rows, size, strict=True):
            code, count = np.unique(shingle_runs([r], min(n, int(k)))[0], return_counts=True)
            bags.append(dict(zip(code.tolist(), count.tolist(), strict=True)))
        holders: dict[int, list[int]] = defaultdict(list)
        for i, bag in enumerate(bags):
            for c in bag:
                holders[c].append(i)
        codes = np.array(sorted(holders), np.uint64)
        if counts is None:
            total, counts = len(ids), {c: len(h) for c, h in holders.items() if len(h) > 1}
        shared = np.array(sorted(counts), np.uint64)
        weights = np.log(1 + total / np.array([counts[c] for c in shared.tolist()], float))
        seen = np.zeros(1 << 20, bool)
        seen[(codes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        out = cls(np.array(ids, np.int64), size, bags, codes, shared, weights, float(np.log(1 + total)), dict(holders), np.zeros(len(ids), np.uint64), np.zeros(len(ids)), [], seen)
        for i, bag in enumerate(bags):
            own = np.array(list(bag), np.uint64)
            many = np.array(list(bag.values()), float)
            out.totals[i] = (out.weigh(own) * many).sum()
            out.prints[i] = fingerprint(np.round((signs(own) * (out.weigh(own) * many)[:, None]).sum(0, keepdims=True), 6))[0]
        near = _neighbours(64 // BLOCKS, RADIUS // BLOCKS)
        blocks = out.prints.view(np.uint16).reshape(-1, BLOCKS).astype(np.int64)
        for b in range(BLOCKS):
            value = (blocks[:, b][:, None] ^ near).ravel()
            order = np.argsort(value, kind="stable")
            item = np.repeat(np.arange(len(ids)), len(near))[order].astype(np.int32)
            out.index.append((np.searchsorted(value[order], np.arange((1 << 16) + 1)), item))
        return out

    def weigh(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.shared):
            return np.full(len(codes), self.unknown)
        at = np.minimum(np.searchsorted(self.shared, codes), len(self.shared) - 1)
        return np.where(self.shared[at] == codes, self.weights[at], self.unknown)

    def known(self, codes: np.ndarray) -> np.ndarray:
        some = np.nonzero(self.filter[(codes & np.uint64((1 << 20) - 1)).astype(np.int64)])[0]
        at = np.minimum(np.searchsorted(self.codes, codes[some]), len(self.codes) - 1)
        return some[self.codes[at] == codes[some]]

    def lookup(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS bits."""
        blocks = prints.view(np.uint16).reshape(-1, BLOCKS).astype(np.int64)
        pairs = []
        for b, (offset, item) in enumerate(self.index):
            many = offset[blocks[:, b] + 1] - offset[blocks[:, b]]
            who = np.repeat(np.arange(len(prints)), many)
            at = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(offset[blocks[:, b]], many)
            pairs.append(who * len(self.ids) + item[at])
        pair = np.unique(np.concatenate(pairs))
        who, what = pair // len(self.ids), pair % len(self.ids)
        near = np.bitwise_count(prints[who] ^ self.prints[what]) <= RADIUS
        return who[near], what[near]

    def similarity(self, codes: np.ndarray, item: int) -> float:
        code, count = np.unique(codes, return_counts=True)
        window, bag = dict(zip(code.tolist(), count.tolist(), strict=True)), self.bags[item]
        names = np.array(list({**window, **bag}), np.uint64)
        weight = self.weigh(names)
        a = np.array([window.get(c, 0) for c in names.tolist()])
        b = np.array([bag.get(c, 0) for c in names.tolist()])
        return float((weight * np.minimum(a, b)).sum() / (weight * np.maximum(a, b)).sum())

    def heavy(self, codes: np.ndarray, hits: np.ndarray, at: np.ndarray, size: int, span: int) -> set[tuple[int, int]]:
        """(window, item) pairs in which the item's shingles weigh enough for SIMILARITY; `at`: starts of the windows."""
        places: dict[int, list[int]] = defaultdict(list)
        for h in hits.tolist():
            for i in self.holders[int(codes[h])]:
                if self.sizes[i] == size:
                    places[i].append(h)
        out: set[tuple[int, int]] = set()
        for i, own in places.items():
            total = np.concatenate(([0], np.cumsum(self.weigh(codes[own]))))
            least = SIMILARITY * self.totals[i] - 1e-6
            if total[-1] >= least:
                inside = total[np.searchsorted(own, at + span)] - total[np.searchsorted(own, at)]
                out.update((w, i) for w in np.nonzero(inside >= least)[0].tolist())
        return out

    def search(self, codes: np.ndarray, hits: np.ndarray, n: int) -> list[tuple[int, int, int, float, int]]:
        """(item, first word, words, similarity, bits) of one document with n-word shingles `codes`, of which `hits` are known."""
        by_size: dict[int, set[int]] = defaultdict(set)
        for h in hits.tolist():
            for size in {int(self.sizes[i]) for i in self.holders[int(codes[h])] if min(N, int(self.sizes[i])) == n}:
                span = size - n + 1
                by_size[size].update(range(max(0, h - span + 1), max(0, min(h, len(codes) - span)) + 1))
        best: dict[int, tuple[int, int, int, float, int]] = {}
        if not any(by_size.values()):
            return []
        low = min(min(s) for s in by_size.values() if s)
        high = max(max(s) + k - n + 1 for k, s in by_size.items() if s)
        part = codes[low:high]
        sums = np.concatenate((np.zeros((1, 64)), np.cumsum(signs(part) * self.weigh(part)[:, None], axis=0, dtype=np.float64)))
        for size, starts in sorted(by_size.items()):
            if not starts:
                continue
            at = np.array(sorted(starts), np.int64)
            span = size - n + 1
            # Rounding of the running sums must not turn an exact copy's sign.
            prints = fingerprint(np.round(sums[np.minimum(at + span, len(codes)) - low] - sums[at - low], 6))
            who, what = self.lookup(prints)
            pairs = {(w, i) for w, i in zip(who.tolist(), what.tolist(), strict=True) if self.sizes[i] == size}
            for w, i in sorted(pairs | self.heavy(codes, hits, at, size, span)):
                s = self.similarity(codes[at[w] : at[w] + span], i)
                if s >= SIMILARITY and (i not in best or s > best[i][3]):
                    best[i] = (i, int(at[w]), min(size, len(codes) + n - 1), s, int(np.bitwise_count(prints[w] ^ self.prints[i])))
        return list(best.values())


def shared_counts(items: DataFrame, n: int) -> dict[int, int]:
    """Number of items with each shingle that several items have."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [t.lower() for t in texts(b.column(0))]
        codes = [np.unique(shingle_runs([t], min(n, len(t.split())))[0]) for t in rows if t.split()]
        return pa.record_batch([pa.array(np.concatenate([np.zeros(0, np.uint64), *codes]).view(np.int64))], ["code"])

    found = map_batches(items.select("text"), run, "code long").groupBy("code").count().where("count > 1")
    return {r["code"] % (1 << 64): r["count"] for r in found.collect()}


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity, hamming); benchmark: (item_id, text)."""
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    total = items.count()
    numbered = settle(items.withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.lit(-(-max(total, 1) // CHUNK)))), "benchmark")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, first_word long, n_words long, similarity double, hamming int"
    found = []
    counts = shared_counts(numbered, N) if total > CHUNK else None
    for chunk in range(-(-max(total, 1) // CHUNK)):
        rows = sorted((r["item_id"], r["text"].encode().lower()) for r in numbered.where(F.col("chunk") == chunk).collect())
        rows = [(i, t) for i, t in rows if t.split()]
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(Items.build([i for i, _ in rows], [t for _, t in rows], N, total, counts))
        widths = sorted({min(N, len(t.split())) for _, t in rows})

        def run(b: pa.RecordBatch, sent=sent, widths=widths) -> pa.RecordBatch:
            own, out = sent.value, []
            text = texts(b.column(1))
            for n in widths:
                codes, counts = shingle_runs(text, n)
                hits = own.known(codes)
                edge = np.concatenate(([0], np.cumsum(counts)))
                row = np.searchsorted(edge, hits, side="right") - 1
                for r in np.unique(row).tolist():
                    part = codes[edge[r] : edge[r + 1]]
                    out += [(r, int(own.ids[i]), *x) for i, *x in own.search(part, hits[row == r] - edge[r], n)]
            cols = list(zip(*out, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()]
            return pa.record_batch([b.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))], ["doc_id", "item_id", "first_word", "n_words", "similarity", "hamming"])

        found.append(map_batches(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), run, schema, rows=512))
    return union_all(found) if found else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows of documents in which a benchmark item was found; rows without doc_id stay."""
    name = free_name(docs, "gone")
    gone = settle(matches(docs, benchmark).select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(checked(gone), F.col("doc_id") == F.col(name), "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
