"""Approximate nearest neighbours: inverted lists scanned by adaptive dimension sampling.

Largest inner product becomes smallest Euclidean distance by one added coordinate, sqrt(M^2 - |x|^2)
with M the largest norm (0 for queries).  k-means on a bounded sample (`SAMPLE` vectors of the smallest id
hashes) gives the lists; every vector is put in the list of its nearest centre.  A list is cut into blocks of about
BLOCK vectors and its queries into blocks of about as many, so a list that holds a third of all vectors
is as many small tasks.  How many lists a query probes is set on the sample, by brute force: the
fewest that find RECALL of its neighbours there.

A query's nearest lists are searched first; its k-th best score there is the bound that all its other lists start from.
Within a block (Gao and Long, 2023) vectors are rotated at random and scanned in blocks of COLUMNS columns.  After each,
the partial distance, scaled to all dimensions, is a test of the hypothesis that the vector is nearer
than the query's k-th best so far; a candidate that fails is abandoned.  Those left are scored in double precision
on the original vectors.  Equal vectors of a block are scanned once; of each, only its k + 1 smallest ids can be among k nearest.

Defined results: vectors that are null, zero, of a length other than the most frequent one, or hold null or
non-finite components take no part.  A null vec_id takes no part.  Equal scores are ranked by vec_id; rows
that repeat a vec_id are candidates each, but none is a candidate of its own id; as queries, equal rows are one, and different vectors
under one id share one list of the k nearest to any of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..workers import ship
from .common import map_batches, settle

K, EVERY = 20, 20
SAMPLE, MAX_LISTS, RECALL = 20_000, 1024, 0.985
BLOCK, ROWS, COLUMNS, EPSILON = 4096, 1024, 16, 2.1
#: The lists that set a query's bound hold at least so many times k vectors.
FIRST = 8


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part; vectors of doubles stay doubles."""
    kind = table.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(~bad & F.exists("embedding", lambda x: x != 0))
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (common["d"] if common else 0))


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Unit vectors: x by the largest norm, and the coordinate that fills it up."""
    x = x.astype(float) / math.sqrt(top)
    return np.column_stack((x, np.sqrt(np.maximum(1 - (x * x).sum(1), 0)))).astype(np.float32)


def as_query(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return np.column_stack((x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x)))).astype(np.float32)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def rotation(d: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(5).normal(size=(d, d)))
    return q.astype(np.float32)


def centres(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """k-means; a centre that loses all its vectors moves to the worst served one."""
    rng = np.random.default_rng(7)
    x = np.unique(x, axis=0)
    n = min(n, len(x))
    c = x[rng.choice(len(x), n, replace=False)].copy()
    for _ in range(rounds):
        far = distances(x, c)
        at = far.argmin(1)
        size = np.bincount(at, minlength=n)
        c = np.stack([np.bincount(at, x[:, j], n) for j in range(x.shape[1])], 1) / np.maximum(size, 1)[:, None]
        c = c.astype(np.float32)
        empty = np.nonzero(size == 0)[0]
        c[empty] = x[np.argsort(-far[np.arange(len(x)), at])[: len(empty)]]
    return c


def probes(x: np.ndarray, c: np.ndarray, top: float, k: int) -> int:
    """The fewest lists that find RECALL of the k nearest of up to 500 sample vectors in the sample."""
    some = np.random.default_rng(9).permutation(len(x))[:500]
    at = distances(lifted(x, top), c).argmin(1)
    near = x[some].astype(float) @ x.T.astype(float)
    near[np.arange(len(some)), some] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return len(c)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    order = np.argsort(distances(as_query(x[some]), c), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(c))[None, :], 1)
    need = np.take_along_axis(place, at[best], 1).ravel()
    return int(np.quantile(need, RECALL, method="higher")) + 1


def survivors(vr: np.ndarray, qr: np.ndarray, limit: np.ndarray, seen: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of qr, row of vr, squared distance) of the pairs that no test abandons; limit: the squared distance that a pair must reach, by row of qr.

    While many pairs are left, partial distances are blocked matrix products, then they are gathered.  seen, if given, gets how many
    column entries were read and how many a full scan reads.
    """
    d, read = vr.shape[1], 0
    slack = lambda done: (1 + EPSILON / math.sqrt(done)) ** 2 * done / d if done < d else 1.0001
    done, sums, qi = 0, np.zeros((len(qr), len(vr)), np.float32), None
    while done < d:
        cols = slice(done, min(done + COLUMNS, d))
        read += (cols.stop - done) * (len(qr) * len(vr) if qi is None else len(qi))
        done = cols.stop
        if qi is None:
            sums += distances(qr[:, cols], vr[:, cols])
            left = sums <= (limit * slack(done) + 1e-6)[:, None]
            if done == d or np.count_nonzero(left) < left.size / 8:
                qi, vi = np.nonzero(left)
                held = sums[qi, vi]
        else:
            held = held + ((qr[qi, cols] - vr[vi, cols]) ** 2).sum(1)
            ok = held <= limit[qi] * slack(done) + 1e-6
            qi, vi, held = qi[ok], vi[ok], held[ok]
    if seen is not None:
        seen += [read, d * len(qr) * len(vr)]
    return qi, vi, held


def best_of(q: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each q: highest score, then lowest tie, in this order."""
    order = np.lexsort((tie, -score, q))
    q = q[order]
    first = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
    begin = np.nonzero(first)[0]
    return order[np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q)))) < k]


def scan(v: np.ndarray, q: np.ndarray, turn: np.ndarray, top: float, k: int, limit: np.ndarray | None = None, seen: list | None = None) -> tuple[np.ndarray, ...]:
    """(row of q, row of v, score) of pairs that hold, for each row of q, its k nearest by inner product (as far as no test is wrong).

    limit: a score that each query need not fall below.
    """
    vr, qr = lifted(v, top) @ turn, as_query(q) @ turn
    norm = np.linalg.norm(q.astype(float), axis=1) * math.sqrt(top)
    far = np.full(len(q), np.inf) if limit is None else np.maximum(2 - 2 * limit / norm, 0)
    out: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for start in range(0, len(v), ROWS):
        qi, vi, held = survivors(vr[start : start + ROWS], qr, far, seen)
        keep = best_of(qi, -held, vi, k + 16)
        qi, vi = qi[keep], vi[keep] + start
        score = np.concatenate([(q[qi[i : i + 65536]].astype(float) * v[vi[i : i + 65536]].astype(float)).sum(1) for i in range(0, len(qi), 65536)] or [np.zeros(0)])
        both = [np.concatenate(x) for x in zip(out[0], (qi, vi, score), strict=True)]
        keep = best_of(both[0], both[2], both[1], k)
        out[0] = tuple(x[keep] for x in both)
        many = np.bincount(out[0][0], minlength=len(q))
        full = many >= k
        last = np.cumsum(many)[full] - 1
        far[full] = np.minimum(far[full], np.maximum(2 - 2 * out[0][2][last] / norm[full], 0))
    return out[0]


def search_cell(own: pa.Table, ask: pa.Table, d: int, top: float, k: int) -> pa.Table:
    """The k nearest of a block of a list to each of a block of queries, if they reach the query's bound."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not own.num_rows or not ask.num_rows:
        return schema.empty_table()
    ids, v = own["vec_id"].to_numpy(), matrix(own["embedding"], d)
    asker, q, bound = ask["vec_id"].to_numpy(), matrix(ask["embedding"], d), ask["bound"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    _, where, copy = np.unique(v + 0.0, axis=0, return_index=True, return_inverse=True)
    by = np.argsort(copy, kind="stable")  # rows of each distinct vector, by id
    begin = np.searchsorted(copy[by], np.arange(len(where) + 1))
    many = np.minimum(np.diff(begin), k + 1)
    u, turn = v[where], rotation(d + 1)
    out = []
    for i in range(0, len(q), 512):
        qi, ui, score = scan(u, q[i : i + 512], turn, top, k + 1, bound[i : i + 512])
        each = many[ui]
        who = ids[by[np.arange(int(each.sum())) + np.repeat(begin[ui] - (np.cumsum(each) - each), each)]]
        qi, score = np.repeat(qi, each) + i, np.repeat(score, each)
        ok = (who != asker[qi]) & (score >= bound[qi])
        qi, who, score = qi[ok], who[ok], score[ok]
        keep = best_of(qi, score, who, k)
        out.append((asker[qi[keep]], who[keep], score[keep]))
    return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], schema=schema)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of each query; both frames: (vec_id, embedding), usable."""
    spark = vectors.sparkSession
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"), F.max(square).alias("top")).first()
    n, d, top = stats["n"], stats["d"] or 1, stats["top"] or 1.0
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    x = matrix(sample["embedding"], d) if n else np.ones((1, d), np.float32)
    c = centres(lifted(x, top), max(1, min(MAX_LISTS, int(np.sqrt(n)) // 2)))
    sent = spark.sparkContext.broadcast((c, probes(x, c, top, k)))
    vector = vectors.schema["embedding"].dataType.simpleString()

    def put(b: pa.RecordBatch) -> pa.RecordBatch:
        at = distances(lifted(matrix(b.column(1), d), top), sent.value[0]).argmin(1)
        return pa.record_batch([pa.array(at, pa.int32()), b.column(0), b.column(1)], ["list", "vec_id", "embedding"])

    index = settle(map_batches(vectors, put, f"list int, vec_id long, embedding {vector}", rows=4096), "ann-index")
    sizes = dict(index.groupBy("list").count().collect())  # at most MAX_LISTS rows
    filled = np.array([sizes.get(i, 0) for i in range(len(c))])
    shapes = spark.sparkContext.broadcast(filled)

    def ask(b: pa.RecordBatch) -> pa.RecordBatch:
        """A row for each list that a query probes; `ahead` are the nearest lists, with FIRST * k vectors, that set its bound."""
        centre, probe = sent.value
        order = np.argsort(distances(as_query(matrix(b.column(1), d)), centre), axis=1, kind="stable")
        held = np.cumsum(shapes.value[order], axis=1)
        enough = (held < FIRST * k).sum(1) + 1
        many = np.maximum(probe, enough).clip(max=len(centre))
        who = np.repeat(np.arange(b.num_rows), many)
        place = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        columns = [pa.array(order[who, place], pa.int32()), *(b.column(i).take(pa.array(who)) for i in (0, 1)), pa.array(place < enough[who])]
        return pa.record_batch(columns, ["list", "vec_id", "embedding", "ahead"])

    once = queries.select("vec_id", "embedding").dropDuplicates()
    asked = settle(map_batches(once, ask, f"list int, vec_id long, embedding {vector}, ahead boolean", rows=1024), "ann-probes")

    def searched(some: DataFrame) -> DataFrame:
        """(query_id, vec_id, score) found in blocks of lists for blocks of their queries; some: (list, vec_id, embedding, bound)."""
        asking = dict(some.groupBy("list").count().collect())
        plan = [(i, max(1, -(-int(filled[i]) // BLOCK)), max(1, -(-asking[i] // BLOCK))) for i in range(len(c)) if filled[i] and i in asking]
        blocks = F.broadcast(spark.createDataFrame(plan or [(0, 1, 1)], "list int, parts int, askers int"))
        spread = lambda own, other: [F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))]
        mine, each = spread("parts", "askers")
        left = index.join(blocks, "list").select("list", mine.alias("part"), each.alias("asker"), "vec_id", "embedding")
        mine, each = spread("askers", "parts")
        right = some.join(blocks, "list").select("list", each.alias("part"), mine.alias("asker"), "vec_id", "embedding", "bound")
        cell = ["list", "part", "asker"]
        return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(lambda a, b: search_cell(a, b, d, top, k), "query_id long, vec_id long, score double")

    ship(spark)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ahead = searched(asked.where("ahead").withColumn("bound", F.lit(float("-inf"))))
    ahead = settle(ahead.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "ann-ahead")
    bounds = ahead.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    rest = asked.where("NOT ahead").join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    found = ahead.drop("rank").unionByName(searched(rest.select("list", "vec_id", "embedding", "bound")))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
