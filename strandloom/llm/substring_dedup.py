"""Repeated passages by sliding runs of sentences.

A sentence ends with a word that ends in `.`, `!` or `?`, at a line break, or, since sentences may be long, after a
word whose code is divisible by CUT.  Whether a sentence ends at a word depends on that word and the blanks behind it alone,
so two copies of a passage are cut alike whatever stands around them.  At every sentence one run starts and one ends:
the fewest consecutive sentences from it, or back from it, at least MIN_SENTENCES, with at least MIN_WORDS words.  Runs are
hashed to 128 bits over their lower-cased words; a run that is the fewest both ways is hashed once.  Globally, a run's first occurrence is that of the smallest (doc_id, sentence);
every sentence that any other occurrence covers is removed.  Counting and choosing the first are partial aggregates and
the way back is a join, so a passage that a third of all documents share meets in no single task.

Whatever any repeated run of MIN_SENTENCES and MIN_WORDS covers, those runs cover: of a passage of sentences a to b, the run from
sentence s lies within it, or else s to b is too short and the run back from b holds s.  So a repeated passage goes with all
its whole sentences; only the incomplete sentences at its two ends may stay.

Defined results: a null or empty text has no sentences and stays as it is (null becomes empty).  A null doc_id takes no part and
keeps its text.  An occurrence is (doc_id, code of the text, sentence): rows of equal id and text are one document, different texts
under one id are documents of their own.  Other columns pass through; `_n_sentences` and `_n_removed` replace columns of these names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, add_column, documents, free_name, map_batches, mixed, segments, settle, texts

MIN_SENTENCES, MIN_WORDS, CUT = 2, 20, 12

_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MARK = np.isin(np.arange(256), list(b".!?"))


def sentences(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Over all texts, one after the other: word codes, the first byte of each word, the first word of each sentence; and sentences per text.

    A word has the blanks behind it; blanks before a text's first word belong to that.  A text of blanks has no words, and its bytes don't count.
    """
    rows = [t if t.strip() else b"" for t in rows]
    raw = b"".join(rows).lower()
    edge = np.concatenate(([0], np.cumsum([len(t) for t in rows], dtype=np.int64)))
    bytes_ = np.frombuffer(raw, np.uint8)
    full = ~_BLANK[bytes_]
    some = edge[:-1][np.diff(edge) > 0]
    begins, ends = full.copy(), full.copy()
    begins[1:] &= ~full[:-1]
    begins[some] = full[some]
    ends[:-1] &= ~full[1:]
    ends[edge[1:][np.diff(edge) > 0] - 1] = full[edge[1:][np.diff(edge) > 0] - 1]
    at, last = np.flatnonzero(begins), np.flatnonzero(ends)
    counts = np.diff(np.searchsorted(at, edge))
    head = (np.cumsum(counts) - counts)[counts > 0]
    offsets = np.concatenate(([0], np.cumsum(last - at + 1)))
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(bytes_[full])]).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    code = known[words.indices.to_numpy()]
    stops = ((known >> np.uint64(1)) % np.uint64(CUT) == 0)[words.indices.to_numpy()] | _MARK[bytes_[last]]
    # A line break in the blanks behind a word; one before a text's first word counts for the text before, which ends there anyway.
    breaks = np.searchsorted(at, np.flatnonzero(bytes_ == 10), side="right") - 1
    stops[breaks[breaks >= 0]] = True
    at[head] = some
    starts = np.ones(len(code), bool)
    starts[1:] = stops[:-1]
    starts[head] = True
    first = np.flatnonzero(starts)
    per = np.bincount(segments(counts)[first], minlength=len(rows)) if len(rows) else np.zeros(0, np.int64)
    return code | np.uint64(1), at, first, per


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2 ... base ** n modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def runs(rows: list[bytes], min_sentences: int, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, first sentence, sentences, hash 1, hash 2) of every run."""
    code, _, first, per = sentences(rows)
    m = len(first)
    if not m:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    end = np.append(first[1:], len(code))
    row = segments(per)
    last_of = np.cumsum(per)[row] - 1
    first_of = (np.cumsum(per) - per)[row]
    every = np.arange(m)
    stop = np.maximum(np.searchsorted(end, first + min_words), every + min_sentences - 1)
    ok = np.nonzero(stop <= last_of)[0]
    # Back from each end; those that are also the fewest from their start are there already.
    start = np.minimum(np.searchsorted(first, end - min_words, side="right") - 1, every - min_sentences + 1)
    back_ok = np.nonzero(start >= first_of)[0]
    back_ok = back_ok[stop[start[back_ok]] != back_ok]
    begin, stop = np.concatenate((ok, start[back_ok])), np.concatenate((stop[ok], back_ok))
    hashes = []
    with np.errstate(over="ignore"):
        for k, base in enumerate(_BASES):
            word = mixed(code + np.uint64(k))
            power, back = (_powers(x, len(code)) for x in (base, _inverse(base)))
            total = np.zeros(len(code) + 1, np.uint64)
            np.cumsum(word * power[:-1], out=total[1:])
            span = (total[end[stop]] - total[first[begin]]) * back[first[begin]]
            hashes.append(mixed(span ^ (end[stop] - first[begin]).astype(np.uint64)))
    return row[begin], begin - first_of[begin], stop - begin + 1, *hashes


def repeated(docs: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    """(doc_id, code, spans): the sentences of each text that a non-first occurrence covers, as [first, number] pairs; docs: (doc_id, code, text)."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        row, at, many, h1, h2 = runs(texts(b.column(2)), min_sentences, min_words)
        row = pa.array(row)
        return pa.record_batch(
            [b.column(0).take(row), b.column(1).take(row), pa.array(at, pa.int32()), pa.array(many, pa.int32()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
            ["doc_id", "code", "at", "many", "h1", "h2"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = map_batches(docs.where("doc_id IS NOT NULL"), run, f"doc_id {kind}, code long, at int, many int, h1 long, h2 long", rows=1024)
    # Most runs occur once: whether one has a second place is told by 64-bit codes of the places, which are aggregated without a sort.
    coded = spans.select("h1", "h2", F.xxhash64("doc_id", "code", "at").alias("place"))
    found = coded.groupBy("h1", "h2").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    found = settle(found.where("low <> high").select("h1", "h2"), "span-repeats")
    again = settle(spans.join(found, ["h1", "h2"]), "span-places")
    place = F.struct("doc_id", "code", "at")
    first = again.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    rest = again.join(first, ["h1", "h2"]).where(place != F.col("first"))
    return rest.groupBy("doc_id", "code").agg(F.collect_set(F.array("at", "many")).alias("spans"))


def remove_repeats(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with `text` less its covered sentences, `_n_sentences` and `_n_removed`."""
    code, span_id, span_code, covers, cuts = (free_name(docs, x) for x in ("code", "span_id", "span_code", "spans", "cut"))
    text = F.col("text").cast("string")
    coded = docs.withColumns({"text": text, code: F.xxhash64(text)})
    spans = settle(repeated(coded.select("doc_id", F.col(code).alias("code"), "text"), min_sentences, min_words), "span-covers")
    spans = spans.select(F.col("doc_id").alias(span_id), F.col("code").alias(span_code), F.col("spans").alias(covers))
    small = (spans.agg(F.sum(F.size(covers))).first()[0] or 0) <= BROADCAST_ROWS
    both = coded.join(F.broadcast(spans) if small else spans, (F.col("doc_id") == F.col(span_id)) & (F.col(code) == F.col(span_code)), "left")

    def cut(b: pa.RecordBatch) -> pa.Array:
        rows = texts(b.column("text"))
        words, at, first, per = sentences(rows)
        byte = np.append(at[first], sum(len(t) for t in rows if t.strip()))  # where each sentence begins among the texts that have words
        kept, removed, base, offset = [], [], 0, 0
        for t, n, spans_ in zip(rows, per.tolist(), b.column(covers).to_pylist(), strict=True):
            gone = np.zeros(n + 1, bool)
            for start, many in spans_ or ():
                gone[start : start + many] = True
            if spans_:
                begin = np.append(byte[base : base + n], offset + len(t)) - offset
                kept.append(b"".join([t[i:j] for i, j, g in zip(begin[:-1].tolist(), begin[1:].tolist(), gone.tolist()[:n], strict=True) if not g]))
            else:
                kept.append(None)
            removed.append(int(gone.sum()))
            base, offset = base + n, offset + (len(t) if t.strip() else 0)
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(per, pa.int64()), pa.array(removed, pa.int64())], ["kept", "n", "removed"]
        )

    kind = T.StructType([T.StructField("kept", T.StringType()), T.StructField("n", T.LongType()), T.StructField("removed", T.LongType())])
    out = add_column(both, cut, cuts, kind)
    counted = {"_n_sentences": F.col(f"{cuts}.n"), "_n_removed": F.col(f"{cuts}.removed")}
    return out.withColumns({"text": F.coalesce(f"{cuts}.kept", "text", F.lit("")), **counted}).drop(cuts, covers, span_id, span_code, code)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_sentences").alias("n_sentences"), F.col("_n_removed").alias("n_removed"), "text")
