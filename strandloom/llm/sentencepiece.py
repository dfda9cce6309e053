"""Encoding and decoding with a SentencePiece vocabulary as relations.

The pieces and scores of a model file are a table.  A text is escaped as SentencePiece does (one blank more in front) and cut into
words wherever two neighbouring characters stand together in no piece of a best path: none crosses such a place, so the best path of a
text is that of its words, one after the other.  (Pieces that others in a row make up with a larger sum are in no best path.)  The corpus' distinct words are encoded once each: substrings of at most the longest
piece's length are exploded and equi-joined to the piece table, the matches are the edges of the word's lattice, grouped by
word, and a fold over end positions (the higher-order function `aggregate`) keeps the best score and the edge it came by, along which the
way back goes.  The best path has the largest sum of scores; of equal ones the edge that starts first wins.
A character that is no piece costs the lowest score less 10 and is written as its UTF-8 bytes' pieces.
Folds go by blocks of BLOCK positions, so that a long unbroken text, which is one word, takes time in proportion to its length.

Texts get their words' codes from a broadcast head of the most frequent words (at most HEAD), the others by a join.
The vocabulary is only read.  Its path is a parameter.

Defined results: a null or empty text has no codes and decodes to "".  Decoding gives the text back exactly, except that
U+2581 in a text becomes a blank.  Rows with equal or null ids are encoded each; all other columns pass through, and a column that
has the name of the result is replaced.  An empty table gives an empty one.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import remove
from ..workers import ship
from .common import add_column, documents, free_name, fresh_path, give_back, map_batches, release, settle, slices, small_batches, union_all

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
HEAD, FLUSH_WORDS, WAVES, ROWS = 300_000, 100_000, 6, 512
#: Positions of a word that one fold goes over.
BLOCK = 256
#: Substrings of at most so many characters are made at every place.
STEM = 2
#: A code is a piece's place in the lattice's pieces or UNKNOWN + a code point; an edge is its end, LONGEST less its length, and its code in one long.
UNKNOWN, CODE_BITS, LONGEST, STOP_SHIFT = 1 << 22, 23, 255, 31
#: Tasks of the lattice for each shuffle partition: edges are some forty times the bytes of their words.
TASKS = 4
#: Words whose edges a task of the lattice holds at once; an edge is a long.
HASH_KEYS = 32_768
SPACE = "▁"


@dataclass
class Vocabulary:
    """pieces: text -> (id, score) of ordinary pieces, blanks as blanks; byte_ids: the pieces of the 256 bytes; names: text of every id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    names: list[str]
    unknown: float

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=os.fspath(path))
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        special = lambda i: m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i)
        pieces = {p.replace(SPACE, " "): (i, m.get_score(i)) for i, p in enumerate(names) if not special(i)}
        at = {int(p[3:5], 16): i for i, p in enumerate(names) if m.is_byte(i)}
        if len(at) != 256:
            raise ValueError(f"{path} has no byte pieces, so unknown characters could not be given back")
        if len(names) >= UNKNOWN or max(map(len, pieces)) > LONGEST:
            raise ValueError(f"{path} has more or longer pieces than codes have room for")
        return cls(pieces, [at[i] for i in range(256)], names, min(s for _, s in pieces.values()) - 10)

    @functools.cached_property
    def lattice(self) -> dict[str, tuple[int, float]]:
        """The pieces that a best path can have: all but those that other pieces in a row make up with a larger sum, which any path could take instead."""

        def split(p: str) -> float:
            best = [0.0] + [-math.inf] * len(p)
            for stop in range(1, len(p) + 1):
                for start in range(stop):
                    if stop - start < len(p) and (q := self.pieces.get(p[start:stop])):
                        best[stop] = max(best[stop], best[start] + q[1])
            return best[-1]

        return {p: x for p, x in self.pieces.items() if len(p) == 1 or split(p) <= x[1] + 1e-9 * abs(x[1])}

    def cutter(self) -> Cutter:
        return Cutter("".join(sorted(set().union(*self.lattice))), sorted({p[i : i + 2] for p in self.lattice for i in range(len(p) - 1)}))

    @property
    def longest(self) -> int:
        return max(map(len, self.lattice))


@dataclass
class Cutter:
    """letters: the characters of pieces; pairs: those that stand together in some piece."""

    letters: str
    pairs: list[str]
    _tables: tuple | None = field(default=None, repr=False)

    def tables(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Class of each code point (0 for those of no piece), whether two classes stand together, and the number of classes."""
        if self._tables is None:
            classes = np.zeros(0x110000, np.uint16)
            classes[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
            n = len(self.letters) + 1
            if n > 0xFFFF:
                raise ValueError(f"{n} characters are more than classes have room for")
            together = np.zeros(n * n, bool)
            if self.pairs:
                a, b = (classes[[ord(p[i]) for p in self.pairs]].astype(np.int64) for i in (0, 1))
                together[a * n + b] = True
            self._tables = classes, together, n
        return self._tables

    def words(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts of a string column in UTF-8, concatenated, and how many each text has."""
        classes, together, n = self.tables()
        rows = [" " + t.replace(SPACE, " ") if t else "" for t in column.to_pylist()]
        whole = "".join(rows)
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        raw = whole.encode()
        edge = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
        starts = np.ones(len(code), bool)
        kind = classes[code]
        pair = kind[:-1].astype(np.uint32)
        pair *= np.uint32(n)
        pair += kind[1:]
        np.logical_not(together[pair], out=starts[1:])
        starts[edge[:-1][edge[:-1] < len(code)]] = True
        at = np.flatnonzero(starts)
        many = np.searchsorted(at, edge)
        if len(raw) != len(code):
            at = np.flatnonzero(np.frombuffer(raw, np.int8) >= -64)[at]  # bytes that begin a character
        offsets = pa.py_buffer(np.append(at, len(raw)))
        return pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(raw)]), np.diff(many)


def word_key(word: bytes) -> bytes:
    """What stands for a word: itself, or if it is longer than BLOCK bytes, a byte that begins no text and its 128-bit code."""
    return word if len(word) <= BLOCK else b"\xff" + xxhash.xxh3_128_digest(word)


def word_counts(docs: DataFrame, cutter: Broadcast, longest: int) -> DataFrame:
    """(key, base, part, c) of the words of all texts, several rows a word; of a word longer than BLOCK, a row for each BLOCK characters
    with `longest` - 1 more in `part`, which is null for others."""
    names = ["key", "base", "part", "c"]

    def plain(words: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        n = len(words)
        return pa.record_batch([words.cast(pa.binary()), pa.array(np.zeros(n), pa.int32()), pa.nulls(n, pa.string()), counts], names)

    def cut(words: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        rows = [(word_key(w), i, t[i : i + BLOCK + longest - 1], c) for w, c in zip(words.to_pylist(), counts.to_pylist(), strict=True) for t in [w.decode()] for i in range(0, len(t), BLOCK)]
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.binary(), pa.int32(), pa.string(), pa.int64()), strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("w", use_threads=False).aggregate([("c", "sum")]).rename_columns(["w", "c"])

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for part in table.to_batches(max_chunksize=100_000):
                long = pc.greater(pc.binary_length(part.column(0)), BLOCK)
                yield plain(*(part.filter(pc.invert(long)).columns))
                if pc.any(long).as_py():
                    yield cut(*(part.filter(long).columns))

        for b in batches:
            for some in slices(b, ROWS):
                found = pc.value_counts(cutter.value.words(some.column(0))[0])
                held.append(pa.table([found.field(0), found.field(1)], ["w", "c"]))
                if sum(t.num_rows for t in held) > 2 * FLUSH_WORDS:
                    held = [merged()]
                    if held[0].num_rows > FLUSH_WORDS:
                        yield from flush(held.pop())
        if held:
            held = [merged()]
            yield from flush(held.pop())
        b = some = found = None  # noqa: F841  else the last batch stays
        give_back()

    ship(docs.sparkSession)
    return docs.select(F.col("text").cast("string")).mapInArrow(run, "key binary, base int, part string, c long")


def edges_of(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(key, c, edge): the matches of the pieces in distinct words, packed in a long, which sorts them by end, then start.

    words: (key, base, part, c) as word_counts gives them.  Substrings of more than STEM characters are made only where the first STEM + 1 of them begin a piece, and
    only as long as such pieces are.
    """
    spark = words.sparkSession
    always = list(range(1, STEM + 1))
    stems: dict[str, set[int]] = {}
    for p in vocabulary.lattice:
        if len(p) > STEM:
            stems.setdefault(p[: STEM + 1], set()).add(len(p))
    reach = spark.createDataFrame([(s, always + sorted(n)) for s, n in stems.items()] or [("", always)], "stem string, sizes array<int>")
    pieces = spark.createDataFrame([(p, i) for i, p in enumerate(vocabulary.lattice)], "piece string, place long")
    rows = words.withColumn("part", F.coalesce("part", F.col("key").cast("string")))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.char_length("part")))))
    rows = rows.withColumn("stem", F.col("part").substr(F.col("i"), F.lit(STEM + 1))).join(F.broadcast(reach), "stem", "left")
    rows = rows.withColumn("left", F.char_length("part") - F.col("i") + 1)
    rows = rows.withColumn("size", F.explode(F.coalesce("sizes", F.lit(always)))).where("size <= left")
    rows = rows.select("key", "c", (F.col("base") + F.col("i") + F.col("size") - 1).alias("stop"), "size", F.col("part").substr(F.col("i"), F.col("size")).alias("piece"))
    found = rows.join(F.broadcast(pieces), "piece", "left").where("place IS NOT NULL OR size = 1")
    code = F.coalesce("place", (F.ascii("piece") + UNKNOWN).cast("long"))
    edge = F.shiftleft(F.col("stop").cast("long"), STOP_SHIFT) + F.shiftleft((LONGEST - F.col("size")).cast("long"), CODE_BITS) + code
    return found.select("key", "c", edge.alias("edge"))


def _let(value: Column, body) -> Column:
    """body of value, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ahead(edges: Column, seed: Column, offset: Column | None, vocabulary: Vocabulary) -> Column:
    """The best score of each position, behind those of `seed`, whose first is of position `offset`, or 0.

    Edges come by end, those of equal ends by start: a score is appended or, if the new one is better, replaced last.  A score is one
    value and comes by array_append, since this runs for every edge; by which edge it came is told from it afterwards.
    """
    scores = F.split(F.lit(",".join(repr(x) for _, x in vocabulary.lattice.values())), ",").cast("array<double>")

    def step(s: Column, e: Column) -> Column:
        stop, size = F.shiftright(e, STOP_SHIFT).cast("int"), LONGEST - F.shiftright(e, CODE_BITS).bitwiseAND(LONGEST).cast("int")
        stop = stop if offset is None else stop - offset
        score = F.coalesce(F.get(scores, e.bitwiseAND((1 << CODE_BITS) - 1).cast("int")), F.lit(vocabulary.unknown))
        total = F.element_at(s, stop - size + 1) + score
        better = F.array_append(F.slice(s, F.lit(1), F.size(s) - 1), total)
        return F.when(F.size(s) <= stop, F.array_append(s, total)).when(total > F.element_at(s, -1), better).otherwise(s)

    return F.aggregate(edges, seed, step)


def _seed() -> Column:
    return F.array(F.lit(0.0))


def short_scores(edges: Column, vocabulary: Vocabulary) -> Column:
    """Best scores of the positions of a word of at most BLOCK characters, from that before its first character on."""
    return _ahead(edges, _seed(), None, vocabulary)


def long_scores(blocks: Column, vocabulary: Vocabulary) -> Column:
    """The same of a word in blocks (block, edges that end there): each block's fold begins with the last positions of the one before.

    A fold copies its state at every step, so the state of the inner folds is that of one block.
    """
    start = F.struct(F.lit(0).alias("offset"), _seed().alias("seed"), F.array(_seed()).alias("done"))

    def over(s: Column, block: Column) -> Column:
        def close(t: Column) -> Column:
            keep = F.least(F.size(t), F.lit(vocabulary.longest))
            own = F.slice(t, F.size(s["seed"]) + 1, F.size(t))
            offset = s["offset"] + F.size(t) - keep
            return F.struct(offset.alias("offset"), F.slice(t, F.size(t) - keep + 1, keep).alias("seed"), F.concat(s["done"], F.array(own)).alias("done"))

        return _let(_ahead(block["edges"], s["seed"], s["offset"], vocabulary), close)

    return F.flatten(F.aggregate(blocks, start, over)["done"])


def best_edges(words: DataFrame, vocabulary: Vocabulary, tasks: int) -> DataFrame:
    """(key, c, scores, edges) of distinct words: the best score of each position and all edges in order; words: settled (key, base, part, c)."""
    # Dealt out by key before they are exploded, edges are grouped where they arise.
    inside = F.col("part").isNull()
    listed = lambda x: (F.first("c").alias("c"), F.sort_array(F.collect_list(x)))
    c, edges = listed("edge")
    short = edges_of(words.where(inside).repartition(tasks, "key"), vocabulary).groupBy("key").agg(c, edges.alias("edges"))
    long = edges_of(words.where(~inside).repartition(tasks, "key"), vocabulary)
    long = long.groupBy("key", F.floor((F.shiftright("edge", STOP_SHIFT) - 1) / BLOCK).alias("block")).agg(c, edges.alias("edges"))
    long = long.groupBy("key").agg(c, listed(F.struct("block", "edges"))[1].alias("blocks"))
    one = short.select("key", "c", short_scores(F.col("edges"), vocabulary).alias("scores"), "edges")
    all_edges = F.flatten(F.transform("blocks", lambda b: b["edges"]))
    return one.unionByName(long.select("key", "c", long_scores(F.col("blocks"), vocabulary).alias("scores"), all_edges.alias("edges")))


def walked(scores: pa.ListArray, edges: pa.ListArray, weights: np.ndarray, ids: np.ndarray, byte_ids: list[int]) -> pa.Array:
    """Packed 32-bit ids of words, from the first on: the way back along the best edges, and the bytes' pieces of unknown characters.

    A position's best edge is the first that gives its best score.  weights: the score of each place in the lattice's pieces and, last,
    of an unknown character; ids: id of each place.
    """
    many = scores.value_lengths().to_numpy().astype(np.int64)
    begin = np.cumsum(many) - many
    best = scores.flatten().to_numpy(zero_copy_only=False)
    edge = edges.flatten().to_numpy(zero_copy_only=False)
    stop = (edge >> STOP_SHIFT) + np.repeat(begin, edges.value_lengths().to_numpy())
    size, code = LONGEST - (edge >> CODE_BITS & LONGEST), edge & ((1 << CODE_BITS) - 1)
    came = np.flatnonzero(best[stop - size] + weights[np.minimum(code, len(weights) - 1)] == best[stop])
    came = came[np.diff(stop[came], prepend=-1) != 0]
    if len(came) != len(best) - len(many):
        raise ValueError("a position's score comes by no edge")
    length, piece = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
    length[stop[came]], piece[stop[came]] = size[came], code[came]
    row_of = np.repeat(np.arange(len(scores)), many)
    used, at = np.zeros(len(best), bool), many - 1
    while len(live := np.flatnonzero(at)):
        last = begin[live] + at[live]
        used[last] = True
        at[live] -= length[last]
        if len(live) < len(at):
            at, begin = at[live], begin[live]
    row, code = row_of[used], piece[used]
    plain = code < UNKNOWN
    out = [x if p else None for x, p in zip(ids[np.where(plain, code, 0)].tolist(), plain.tolist(), strict=True)] if not plain.all() else None
    if out is None:
        flat, wide = ids[code], np.ones(len(code), np.int64)
    else:
        parts = [[x] if x is not None else [byte_ids[b] for b in chr(c - UNKNOWN).encode()] for x, c in zip(out, code.tolist(), strict=True)]
        flat, wide = np.array([x for y in parts for x in y], np.int32), np.array([len(y) for y in parts], np.int64)
    many = np.bincount(row, wide, len(scores)).astype(np.int64) if len(row) else np.zeros(len(scores), np.int64)
    ends = pa.py_buffer((np.concatenate(([0], np.cumsum(many))) * 4).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(scores), [None, ends, pa.py_buffer(flat.astype(np.int32))])


@contextlib.contextmanager
def grouped_by_hash(spark: SparkSession) -> Iterator[None]:
    """Lists of what is written meanwhile are collected by hash for up to HASH_KEYS keys a task, where Spark would sort beyond 128: these
    lists are short.  Beyond it, Spark sorts."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(HASH_KEYS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Head:
    """Frequent words and their ids, packed: words is an Arrow array, that of word i are codes[at[i]:at[i + 1]]; the last code stands for a hole."""

    words: pa.Array
    codes: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, names: int) -> Head:
        ids = table["ids"].to_pylist()
        codes = np.append(np.frombuffer(b"".join(ids), np.int32), -1)
        at = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)))
        return cls(table["key"].combine_chunks().cast(pa.large_binary()), codes.astype(np.uint16 if names < 0xFFFF else np.int32), at)

    def places(self, distinct: pa.Array) -> np.ndarray:
        """The place of each of some distinct words in the head, -1 for those outside; the table of a look-up is made of these words, which are fewer."""
        found = pc.index_in(self.words, value_set=distinct)
        out = np.full(len(distinct), -1, np.int64)
        out[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        return out


@dataclass
class Dictionary:
    """The words of a corpus and their ids as packed 32-bit numbers. head: the most frequent ones, broadcast; rest: settled (key, ids) of all others."""

    rest: DataFrame
    cutter: Broadcast
    head: Broadcast

    @classmethod
    def build(cls, docs: DataFrame, vocabulary: Vocabulary) -> Dictionary:
        spark = docs.sparkSession
        cutter = spark.sparkContext.broadcast(vocabulary.cutter())
        tasks = TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
        with small_batches(spark):
            counts = settle(word_counts(docs, cutter, vocabulary.longest).groupBy("key", "base", "part").agg(F.sum("c").alias("c")), "piece-words")
        release(spark)
        ids, as_bytes = np.array([i for i, _ in vocabulary.lattice.values()], np.int32), vocabulary.byte_ids
        weights = np.array([*(x for _, x in vocabulary.lattice.values()), vocabulary.unknown])

        def pack(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch([b.column(0), b.column(1), walked(b.column(2), b.column(3), weights, ids, as_bytes)], ["key", "c", "ids"])

        with grouped_by_hash(spark):
            coded = settle(map_batches(best_edges(counts, vocabulary, tasks), pack, "key binary, c long, ids binary", rows=10_000), "piece-codes")
        if files := counts.inputFiles():
            remove(spark, files[0].rpartition("/")[0])  # the words' codes are written
        release(spark)
        # The head is a whole number of classes of frequency, so that it needs no sort; classes are a sixteenth of a doubling wide.
        level = F.floor(F.log2("c") * 16)
        sizes = sorted(coded.groupBy(level.alias("level")).count().collect(), reverse=True)
        total, least = 0, 1 << 30
        for r in sizes:
            total += r["count"]
            if total > HEAD:
                break
            least = r["level"]
        frequent = (level >= least) & (F.octet_length("key") <= BLOCK) & ~F.startswith("key", F.lit(b"\xff"))
        top = coded.where(frequent).select("key", "ids").toArrow()
        return cls(coded.where(~frequent).select("key", "ids"), cutter, spark.sparkContext.broadcast(Head.of(top, len(vocabulary.names))))


@dataclass
class Partly:
    """Settled rows with the codes of the words in the head, a hole for each of the others, and these others' keys, in columns of the names given."""

    rows: DataFrame
    codes: str
    holes: str
    row: str
    path: str = ""


def encode_head(docs: DataFrame, vocabulary: Vocabulary, words: Dictionary, keep: list[str]) -> Partly:
    """One pass over the texts; keep: the columns that go on."""
    sent, cutter = words.head, words.cutter
    codes, holes, row = (free_name(docs, x) for x in ("codes", "holes", "row"))
    rows = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField(codes, T.BinaryType()), T.StructField(holes, T.ArrayType(T.BinaryType()))])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        head = sent.value
        found, many = cutter.value.words(b.column("text"))
        found = found.dictionary_encode()
        distinct, which = found.dictionary, found.indices.to_numpy()
        place = head.places(distinct)
        hole = place < 0
        place[hole] = 0
        first = np.where(hole, len(head.codes) - 1, head.at[place]) if len(head.words) else np.zeros(len(place), np.int64)
        size = np.where(hole, 1, np.diff(head.at)[place]) if len(head.words) else np.ones(len(place), np.int64)
        each = size[which]
        end = np.cumsum(each)
        out = head.codes[np.arange(int(each.sum())) + np.repeat(first[which] - (end - each), each)]
        row_of = np.concatenate(([0], np.cumsum(many)))
        edges = np.concatenate(([0], end))[row_of] * out.itemsize
        packed = pa.Array.from_buffers(pa.large_binary(), len(many), [None, pa.py_buffer(edges), pa.py_buffer(out)]).cast(pa.binary())
        missed = hole[which]
        lists = np.concatenate(([0], np.cumsum(missed)))[row_of]
        keys = pa.array([word_key(w) for w in distinct.filter(pa.array(hole)).to_pylist()], pa.binary())
        gone = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), keys.take(pa.array((np.cumsum(hole) - 1)[which[missed]])))
        return pa.record_batch([*(b.column(c) for c in keep), packed, gone], [*keep, codes, holes])

    part = map_batches(rows.select(*dict.fromkeys([*keep, "text"])), run, schema, rows=ROWS)
    part = part.withColumn(row, F.monotonically_increasing_id())
    with small_batches(docs.sparkSession):
        part.write.option("compression", "zstd").parquet(path := fresh_path(docs.sparkSession, "piece-partly"))
    return Partly(docs.sparkSession.read.schema(part.schema).parquet(path), codes, holes, row, path)


def met(part: Partly, words: Dictionary) -> tuple[DataFrame, str]:
    """The rows with the codes of the words outside the head, which come by a join, in a column; rows without any do not take part in it."""
    keep = [c for c in part.rows.columns if c != part.row]
    more = free_name(part.rows, "found")
    # No word outside the head is frequent, so no key of this join is hot.
    tails = part.rows.select(part.row, F.explode(F.array_distinct(part.holes)).alias("key")).join(words.rest, "key")
    found = tails.groupBy(part.row).agg(F.collect_list(F.struct("key", "ids")).alias(more))
    some = part.rows.where(F.size(part.holes) > 0).join(found, part.row).select(*keep, more)
    none = F.array().cast("array<struct<key:binary,ids:binary>>")
    return part.rows.where(F.size(part.holes) == 0).select(*keep, none.alias(more)).unionByName(some), more


def filled(codes: pa.Array, holes: pa.Array, found: pa.Array, small: bool) -> pa.ListArray:
    """Piece ids of each row: packed codes, of which each hole is replaced by the ids of its word."""
    own = found.flatten()
    place = pc.index_in(holes.flatten(), value_set=own.field("key"))
    if place.null_count:
        raise KeyError("a word of the texts is not in the dictionary")
    parts = own.field("ids").take(place).cast(pa.large_binary())
    packed = [np.frombuffer(x, np.uint16 if small else np.int32) for x in codes.to_pylist()]
    flat = np.concatenate(packed).astype(np.int32)
    if small:
        flat[flat == 0xFFFF] = -1
    end = np.cumsum([len(x) for x in packed])
    at = np.flatnonzero(flat == -1)
    wide = np.ones(len(flat), np.int64)
    wide[at] = pc.binary_length(parts).to_numpy() // 4
    out = np.repeat(flat, wide)
    if len(at):
        first = (np.cumsum(wide) - wide)[at]
        out[np.repeat(first - (np.cumsum(wide[at]) - wide[at]), wide[at]) + np.arange(int(wide[at].sum()))] = np.frombuffer(b"".join(parts.to_pylist()), np.int32)
    edges = np.concatenate(([0], np.cumsum(wide)))[np.concatenate(([0], end))]
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(out, pa.int32()))


def joined(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """For each row the bytes of its ids, one after the other; table: the bytes of every id."""
    many = pc.fill_null(lists.value_lengths(), 0).to_numpy()
    parts = table.take(lists.flatten())
    at = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1][np.concatenate(([0], np.cumsum(many)))]
    return pa.Array.from_buffers(pa.large_binary(), len(many), [None, pa.py_buffer(at), parts.buffers()[2]])


def encode(docs: DataFrame, vocabulary: Vocabulary, column: str = "ids", dictionary: Dictionary | None = None) -> DataFrame:
    """docs with an array of piece ids for `text`; a dictionary, if given, must hold all of its words."""
    words = dictionary or Dictionary.build(docs, vocabulary)
    docs = docs.drop(column)
    part = encode_head(docs, vocabulary, words, docs.columns)
    both, more = met(part, words)
    codes, holes, keep, small = part.codes, part.holes, docs.columns, len(vocabulary.names) < 0xFFFF

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = filled(b.column(codes), b.column(holes), b.column(more), small)
        return pa.record_batch([*(b.column(c) for c in keep), ids], [*keep, column])

    schema = T.StructType([*(part.rows.schema[c] for c in keep), T.StructField(column, T.ArrayType(T.IntegerType()))])
    return map_batches(both, run, schema, rows=ROWS)


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """table: the bytes of every id."""
    return b"".join([table[i] for i in ids]).decode(errors="replace").replace(SPACE, " ")[1:] if ids else ""


def decode_lists(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """Texts of lists of ids; table: the bytes of every id, blanks as blanks."""
    try:
        text = joined(lists, table).cast(pa.large_string())
    except pa.ArrowInvalid:
        plain = table.to_pylist()
        return pa.array([decode_ids(x or [], plain) for x in lists.to_pylist()], pa.large_string())
    return pc.utf8_slice_codeunits(pc.replace_substring(text, SPACE, " "), 1)


def piece_bytes(vocabulary: Vocabulary) -> pa.Array:
    table = [n.replace(SPACE, " ").encode() for n in vocabulary.names]
    for b, i in enumerate(vocabulary.byte_ids):
        table[i] = bytes((b,))
    return pa.array(table, pa.large_binary())


def decode(coded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """coded with the text of an array of piece ids; bytes that are no UTF-8 become U+FFFD."""
    sent = coded.sparkSession.sparkContext.broadcast(piece_bytes(vocabulary))
    return add_column(coded, lambda b: decode_lists(b.column(ids), sent.value).cast(pa.string()), column, T.StringType(), rows=ROWS)


def dealt(docs: DataFrame, waves: int) -> Column:
    """The wave of each row, by its id and its text's bytes, so that copies of a text are dealt out: all rows are asked in every wave, so
    only a text without id is read for it."""
    text = F.col("text").cast("string")
    return F.pmod(F.xxhash64("doc_id", F.octet_length(text), F.when(F.col("doc_id").isNull(), text)), F.lit(waves))


def encoded_digests(docs: DataFrame, path: str = MODEL, waves: int = WAVES) -> DataFrame:
    """(doc_id, n_pieces, ids_sha256, round_trip): the codes' digest (decimal, comma-separated) and whether they decode to the text.

    The dictionary is made once over the whole corpus; texts are encoded in waves, so that a fraction of the corpus is on
    disk at a time.  Texts are compared by 64-bit codes, so they are not dealt out.
    """
    vocabulary = Vocabulary.load(path)
    spark = docs.sparkSession
    text = F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(SPACE), F.lit(" "))
    words = Dictionary.build(docs, vocabulary)
    share = dealt(docs, waves)
    sent = spark.sparkContext.broadcast((piece_bytes(vocabulary), pa.array([f"{i},".encode() for i in range(len(vocabulary.names))], pa.large_binary())))
    small = len(vocabulary.names) < 0xFFFF
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces long, ids_sha256 string, round_trip boolean"
    out = []
    for wave in range(waves):
        rows = docs.where(share == wave).select("doc_id", text.alias("text")).withColumn("code", F.xxhash64("text"))
        part = encode_head(rows, vocabulary, words, ["doc_id", "code"])
        both, more = met(part, words)

        def run(b: pa.RecordBatch, codes: str = part.codes, holes: str = part.holes, more: str = more) -> pa.RecordBatch:
            pieces, numbers = sent.value
            ids = filled(b.column(codes), b.column(holes), b.column(more), small)
            digest = [hashlib.sha256(x[:-1]).hexdigest() for x in joined(ids, numbers).to_pylist()]
            # The code is Spark's xxhash64 of one string, which is XXH64 with the seed 42.
            back = [xxhash.xxh64_intdigest(x, seed=42) for x in decode_lists(ids, pieces).cast(pa.large_binary()).to_pylist()]
            same = np.array(back, np.uint64).view(np.int64) == b.column("code").to_numpy()
            return pa.record_batch([b.column("doc_id"), ids.value_lengths().cast(pa.int64()), pa.array(digest, pa.string()), pa.array(same)], ["doc_id", "n_pieces", "ids_sha256", "round_trip"])

        with small_batches(spark):
            out.append(settle(map_batches(both, run, schema, rows=ROWS), "piece-digests"))
        remove(spark, part.path)  # the wave's digests are written
        release(spark)
    return union_all(out)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(documents(spark, sf_dir))
