"""Exact Jaccard self-join of word n-gram sets by groups and a token-group matrix.

1. Every whole text becomes its set of distinct n-word shingles (64-bit codes).  Equal sets are one class.
2. Classes are partitioned into groups of similar sets: minimum-hash bands propose a leader for each class,
   the proposals are checked on the whole sets, and links that hold are closed into groups.  A group is
   always connected, so nothing inside it has to be looked at again, however many near copies it has.
3. The token-group matrix stores each group's token union, dealt by token.  A set can only have a partner in another group
   if that group's union holds at least the threshold's share of its tokens, so a set's overlap with all other groups
   at once is bounded first: of its lowest PREFIX_PERCENT of tokens (in code order) enough must be in another group's, then, for the
   few sets that pass, the threshold's share of all its tokens must be in other groups.
4. For these, tokens are put in order of how many groups hold them; groups whose members share a token of the shortest
   sufficient prefixes are candidates for each other.  A large group's unions are kept by cell of some members.  The
   overlap of each set with the cells' unions is counted, and only cells that reach the bound are opened: their
   members are compared with the set, exactly.  Two groups are one as soon as one link between them is known, so the
   cell of the largest overlap is opened first, and the others only for groups that it did not join.

The bounds lose no link, so the components are exact for any grouping.  A link needs
100 * |A & B| >= percent * |A | B|.

Defined results: without words a document has no shingles and is its own component.  A null doc_id links
with nothing and has a null component.  Rows that repeat a doc_id are rows of their own; equal texts share a component,
different texts under one id do not link by it.  Empty input gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workers import ship
from .common import LOWER, UPPER, add_column, checked, components, documents, free_name, list_array, map_batches, mixed, segments, settle, shingle_sets, texts

N, PERCENT = 5, 80
BANDS, BAND_HASHES = 10, 3
#: Share of a set's tokens, lowest codes first, that the first pass looks at.
PREFIX_PERCENT = 40
#: Tokens that one task of the first pass holds.
TOKENS_PER_TASK = 2_000_000
#: Members of a group that share one row of unions.
CELL = 64
#: 64-bit words of a set's parity bits, and members up to which a group's sets meet others one by one, with these.
PARITY_WORDS, FEW = 16, 4

_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, BANDS * BAND_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _keys(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit code of each whole set; 0 for an empty one."""
    out = np.zeros(len(counts), np.uint64)
    full = np.nonzero(counts)[0]
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        with np.errstate(over="ignore"):
            out[full] = mixed(np.add.reduceat(mixed(codes), starts) ^ np.add.reduceat(mixed(codes ^ _MULTIPLIERS[0]), starts) * _MULTIPLIERS[1])
    return out


def _features(n: int):
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        codes, counts = shingle_sets(texts(b.column(1)), n)
        sketch = np.zeros((len(counts), len(_MULTIPLIERS)), np.uint64)
        full = np.nonzero(counts)[0]
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            with np.errstate(over="ignore"):
                for i, m in enumerate(_MULTIPLIERS):
                    x = codes * m
                    sketch[full, i] = np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts)
        with np.errstate(over="ignore"):
            parts = sketch.reshape(len(counts), BANDS, BAND_HASHES)
            bands = parts[:, :, 0].copy()
            for k in range(1, BAND_HASHES):
                bands = mixed(bands) + parts[:, :, k]
        rows = len(counts)
        return pa.record_batch(
            [
                b.column(0),
                pa.array(counts, pa.int64()),
                pa.array(_keys(codes, counts).view(np.int64)),
                list_array(sketch.astype(np.uint32).view(np.int32).ravel(), np.full(rows, len(_MULTIPLIERS)), pa.int32()),
                list_array(bands.view(np.int64).ravel(), np.full(rows, BANDS), pa.int64()),
            ],
            ["doc_id", "n", "key", "sketch", "bands"],
        )

    return run


def features(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, n, key, sketch, bands): set size, set code, minimum hashes and band codes of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), _features(n), f"doc_id {kind}, n long, key long, sketch array<int>, bands array<long>", rows=512)


def token_sets(docs: DataFrame, wanted: DataFrame, n: int = N) -> DataFrame:
    """(key, n, tokens) of the wanted classes; wanted: (key, first), settled, `first` being a document with that set."""
    some = docs.select("doc_id", "text").join(checked(wanted.select(F.col("first").alias("_id"), F.col("key").alias("_key"))), F.col("doc_id") == F.col("_id"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        codes, counts = shingle_sets(texts(b.column(0)), n)
        keys = _keys(codes, counts).view(np.int64)
        same = keys == b.column(1).to_numpy(zero_copy_only=False)  # another text may have the same id
        codes, counts, keys = codes[np.repeat(same, counts)], counts[same], keys[same]
        return pa.record_batch([pa.array(keys), pa.array(counts, pa.int64()), list_array(codes.view(np.int64), counts, pa.int64())], ["key", "n", "tokens"])

    return map_batches(some.select("text", "_key"), run, "key long, n long, tokens array<long>")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of classes, those whose whole sets link."""
    one = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.join(one, "a").join(two, "b").where(fits).where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b")


def proposals(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with the smallest class of each of its band buckets, if their sketches are near."""
    banded = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    leaders = banded.groupBy("band", "bucket").agg(F.min("key").alias("b"), F.count("*").alias("c")).where("c > 1").drop("c")
    pairs = banded.join(leaders, ["band", "bucket"]).where("key <> b").select(F.col("key").alias("a"), "b").distinct()
    one = classes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    near = same * 100 >= (percent - 20) * len(_MULTIPLIERS)
    return pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).where(near).select("a", "b")


def shared_tokens(docs: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, token, held): entries of the token-group matrix whose token several groups hold, and how many do.

    groups: settled (key, first, n, group). Of each set the lowest `percent` of its tokens take part. Entries travel as packed arrays, dealt
    by token, so that a block of some thousand entries is one row.
    """
    spark = docs.sparkSession
    tokens = (groups.agg(F.sum("n")).first()[0] or 0) * percent // 100
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TOKENS_PER_TASK), 1)
    keyed = groups.select(F.col("first").alias("_id"), F.col("key").alias("_key"), "group")
    some = docs.select("doc_id", "text").join(checked(keyed), F.col("doc_id") == F.col("_id")).select("text", "_key", "group")

    def deal(b: pa.RecordBatch) -> pa.RecordBatch | None:
        codes, counts = shingle_sets(texts(b.column(0)), n)
        wanted, group = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
        same = _keys(codes, counts).view(np.int64) == wanted
        row = segments(counts)
        rank = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
        keep = same[row] & (rank * 100 < counts[row] * percent)
        codes, row = codes[keep], row[keep]
        part = (mixed(codes) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        codes, row, part = codes[order], row[order], part[order]
        cuts = np.concatenate(([0], np.nonzero(np.diff(part))[0] + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
        out: list[list] = [[], [], [], []]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            used, at = np.unique(row[i:j], return_inverse=True)
            for o, x in zip(out, (int(part[i]), codes[i:j].tobytes(), at.astype(np.uint16).tobytes(), np.stack([wanted[used], group[used]]).tobytes()), strict=True):
                o.append(x)
        return pa.record_batch([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["part", "codes", "rows", "owners"])

    def held(table: pa.Table) -> pa.Table:
        codes, keys, groups_ = [], [], []
        for c, r, o in zip(*(table[x].to_pylist() for x in ("codes", "rows", "owners")), strict=True):
            owner, at = np.frombuffer(o, np.int64).reshape(2, -1), np.frombuffer(r, np.uint16)
            codes.append(np.frombuffer(c, np.uint64))
            keys.append(owner[0][at])
            groups_.append(owner[1][at])
        code, key, group = np.concatenate(codes), np.concatenate(keys), np.concatenate(groups_)
        del codes, keys, groups_
        order = np.argsort(code)
        code, group = code[order], group[order]
        starts = np.concatenate(([0], np.nonzero(code[1:] != code[:-1])[0] + 1))
        many = np.minimum.reduceat(group, starts) != np.maximum.reduceat(group, starts)
        hit = np.repeat(many, np.diff(np.append(starts, len(code))))
        code, group, key = code[hit], group[hit], key[order[hit]]
        again = np.lexsort((key, group, code))
        code, group, key = code[again], group[again], key[again]
        once = np.ones(len(code), bool)  # a set counts once, even if its document is there twice
        once[1:] = (code[1:] != code[:-1]) | (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        code, group, key = code[once], group[once], key[once]
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        which = np.cumsum(new) - 1
        first = new.copy()
        first[1:] |= group[1:] != group[:-1]
        return pa.table({"key": pa.array(key, pa.int64()), "token": pa.array(code.view(np.int64), pa.int64()), "held": pa.array(np.bincount(which, first)[which].astype(np.int32) if len(code) else np.zeros(0, np.int32), pa.int32())})

    ship(spark)
    blocks = map_batches(some, deal, "part int, codes binary, rows binary, owners binary", rows=1024)
    return blocks.repartition(parts, "part").groupBy("part").applyInArrow(held, "key long, token long, held int")


def _parities(b: pa.RecordBatch) -> pa.Array:
    """Of each set's shared tokens, how many fall to each of 64 * PARITY_WORDS bits, modulo 2."""
    shared = b.column(b.schema.get_field_index("shared"))
    token = shared.flatten().field("token").to_numpy(zero_copy_only=False).view(np.uint64)
    row = segments(np.diff(shared.offsets.to_numpy()))
    bits = 64 * PARITY_WORDS
    odd = np.bincount(row * bits + (mixed(token) % np.uint64(bits)).astype(np.int64), minlength=b.num_rows * bits) & 1
    return list_array(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64), np.full(b.num_rows, PARITY_WORDS), pa.int64())


def cross_links(docs: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): groups of which a member of one links with a member of the other. groups: settled (key, first, n, group)."""
    counts = shared_tokens(docs, groups, n, PREFIX_PERCENT).groupBy("key").agg(F.count("*").alias("c"))
    passed = groups.join(counts, "key").where(F.col("c") * 100 >= F.col("n") * (PREFIX_PERCENT - (100 - percent))).drop("c")
    passed = settle(passed, "ngram-passed")
    # Whole sets of those that passed: rare tokens first. Tokens of one group alone come before all others, and never meet another group.
    each = shared_tokens(docs, passed, n, 100).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("shared"))
    each = each.join(passed, "key").where(F.size("shared") * 100 >= F.col("n") * percent)
    each = settle(add_column(each, _parities, "parity", T.ArrayType(T.LongType())), "ngram-shared")
    many = each.groupBy("group").agg(F.count("*").alias("many"))
    sized = each.join(many.withColumnRenamed("group", "_group"), F.col("group") == F.col("_group"))
    # Of two sets that link, the larger shares a token of its probing prefix with the smaller's shorter indexing prefix.
    need = {"probe": F.ceil(F.col("n") * percent / 100), "index": F.ceil(F.col("n") * (2 * percent) / (100 + percent))}

    def prefixes(side: str) -> DataFrame:
        """(token, group, room, low): the group's union of its members' prefix tokens; low: its smallest member with the token there, room: the most
        that a member can have in common with others from the token on, as what it leaves for the other's size in the threshold."""
        most = F.greatest(F.size("shared") - need[side].cast("int") + 1, F.lit(0))
        alone = F.when(F.col("many") <= FEW, F.col("key")).alias("alone")
        rows = sized.select("n", "group", alone, "parity", F.size("shared").alias("size"), F.posexplode(F.slice("shared.token", F.lit(1), most)).alias("at", "token"))
        room = (F.col("size") - F.col("at")) * (100 + percent) - F.col("n") * percent
        rows = rows.groupBy("token", "group", "alone").agg(
            F.max(room).alias(f"{side}_room"), F.min("n").alias(f"{side}_low"), F.max("n").alias(f"{side}_high"),
            F.max("size").alias(f"{side}_size"), F.first("parity").alias(f"{side}_parity"),
        )
        return rows.withColumn(f"{side}_parity", F.when(F.col("alone").isNotNull(), F.col(f"{side}_parity"))).drop("alone")

    # The first token that two sets share in this order leaves each at most its remaining tokens in common, min(r, s), and
    # a link needs (100 + percent) * min(r, s) >= percent * (n + m): what shares a passage without being similar does not meet.
    index = prefixes("index").withColumnRenamed("group", "other")
    sizes = (F.col("probe_high") >= F.col("index_low")) & (F.col("index_high") * 100 >= F.col("probe_low") * percent)
    rooms = (F.col("probe_room") >= F.col("index_low") * percent) & (F.col("index_room") >= F.col("probe_low") * percent)
    # Two sets differ in as many shared tokens at least as their parities do in bits, which bounds what they have in common: of
    # near copies below the threshold, which share most tokens and would meet once for each, few pairs pass.
    differ = functools.reduce(Column.__add__, [F.bit_count(F.col("probe_parity")[i].bitwiseXOR(F.col("index_parity")[i])) for i in range(PARITY_WORDS)])
    common = F.col("probe_size") + F.col("index_size") - differ  # twice what they have in common, at most
    alike = F.coalesce(common * (100 + percent) >= (F.col("probe_low") + F.col("index_low")) * (2 * percent), F.lit(True))
    near = prefixes("probe").join(index, "token").where((F.col("group") != F.col("other")) & sizes & rooms & alike)
    met = near.select(F.least("group", "other").alias("g"), F.greatest("group", "other").alias("h")).distinct()
    # Of two groups the members of the smaller ask, whichever sets are larger: the bound below holds both ways.
    met = met.join(many.withColumnsRenamed({"group": "g", "many": "i"}), "g").join(many.withColumnsRenamed({"group": "h", "many": "j"}), "h")
    pairs = settle(met.select(F.when(F.col("i") <= F.col("j"), F.col("g")).otherwise(F.col("h")).alias("group"), F.when(F.col("i") <= F.col("j"), F.col("h")).otherwise(F.col("g")).alias("other")), "ngram-group-pairs")
    # A large group's matrix rows are kept by cell of about CELL members, so that a bound concerns few of them.
    cells = each.groupBy("group").agg(F.ceil(F.count("*") / CELL).alias("cells"))
    named = each.join(cells, "group").withColumn("cell", F.pmod("key", "cells")).select("key", "n", "group", "cell", F.col("shared.token").alias("mine"))
    sides = pairs.select("group").unionByName(pairs.select(F.col("other").alias("group"))).distinct()
    named = settle(named.join(sides, "group", "left_semi"), "ngram-cells")
    # The bound: a set and a member of a cell have at most c tokens in common, c being what the cell's union holds of the set,
    # and at least n + low - c together, low being the cell's smallest member. For a cell of one this is the similarity itself.
    entries = named.select(F.col("group").alias("other"), "cell", F.explode("mine").alias("token")).distinct()
    low = named.groupBy(F.col("group").alias("other"), "cell").agg(F.min("n").alias("low"))
    union = entries.groupBy("other", "cell").agg(F.collect_list("token").alias("union")).join(low, ["other", "cell"])
    asked = named.select(F.col("key").alias("a"), "n", "group", "mine").join(pairs, "group")
    bound = asked.join(union, "other").withColumn("c", F.size(F.array_intersect("mine", "union")))
    bound = settle(bound.where(F.col("c") * 100 >= (F.col("n") + F.col("low") - F.col("c")) * percent).select("a", "n", "group", "other", "cell", "c"), "ngram-bound")
    wanted = passed.join(named.select("key"), "key", "left_semi").select("key", "first")
    sets = settle(token_sets(docs, settle(wanted, "ngram-ends"), n).dropDuplicates(["key"]), "ngram-sets")
    members = named.select(F.col("key").alias("b"), F.col("group").alias("other"), "cell", F.col("n").alias("m"))
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent

    def opened(some: DataFrame) -> DataFrame:
        """(a, group, other) of links between sets and members of the cells opened for them."""
        rows = settle(some.join(members, ["other", "cell"]).where(fits).select("a", "b", "group", "other"), "ngram-opened")
        return settle(rows.join(linked(rows.select("a", "b"), sets, percent), ["a", "b"]).select("a", "group", "other").distinct(), "ngram-found")

    # One link joins two groups: the cell with the largest overlap is opened first, and the others only where it has none.
    best = settle(bound.groupBy("a", "other").agg(F.max_by("cell", F.struct("c", "cell")).alias("cell")), "ngram-best")
    first = opened(bound.join(best, ["a", "other", "cell"], "left_semi"))
    joined = first.select("group", "other").distinct()
    rest = bound.join(best, ["a", "other", "cell"], "left_anti").join(joined, ["group", "other"], "left_anti")
    found = first.select("group", "other").unionByName(opened(rest).select("group", "other"))
    return found.select(F.col("group").alias("a"), F.col("other").alias("b")).distinct()


def ngram_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text)."""
    feats = settle(features(docs, n), "ngram-features")
    sized = feats.where("n > 0 AND doc_id IS NOT NULL")
    classes = sized.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    classes = settle(classes, "ngram-classes")
    pairs = settle(proposals(classes, percent), "ngram-pairs")
    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    proposed = settle(classes.join(ends, "key").select("key", "first"), "ngram-proposed")
    links = linked(pairs, settle(token_sets(docs, proposed, n), "ngram-near"), percent)
    grown = components(links, "ngram-cc").withColumnsRenamed({"node": "key", "root": "group"})
    groups = settle(classes.select("key", "first", "n").join(grown, "key", "left").withColumn("group", F.coalesce("group", "key")), "ngram-groups")
    merged = components(cross_links(docs, groups, n, percent), "ngram-cc2").withColumnsRenamed({"node": "group", "root": "whole"})
    whole = groups.join(merged, "group", "left").select("key", "first", F.coalesce("whole", "group").alias("whole"))
    lowest = whole.groupBy("whole").agg(F.min("first").alias("component_id"))
    named = settle(whole.join(lowest, "whole").select("key", "component_id"), "ngram-components")
    out = feats.select("doc_id", "n", "key").join(checked(named), "key", "left")
    mine = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), mine.alias("component_id"))


def keep_representatives(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: the one of the smallest doc_id. Rows without words or without id stay."""
    name = free_name(docs, "gone")
    gone = ngram_components(docs, n, percent).where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(checked(settle(gone, "ngram-gone")), F.col("doc_id") == F.col(name), "left_anti")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir).select("doc_id", F.col("text").cast(T.StringType())))


OP1_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {N} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {N - 2}), lambda i: array_to_string(ws[i:i + {N - 1}], ' '))) END AS sh FROM w),
t AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (len(x.sh) + len(y.sh) - c)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = s.doc_id
"""
