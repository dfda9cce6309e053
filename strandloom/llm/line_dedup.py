"""Line deduplication over levelled sorted runs of line keys.

Documents come in batches, highest ids first.  A batch's line keys are aggregated, anti-joined by
merge with every run so far (a key that no run holds is owned by its largest document in this batch),
and written as a run of their own: bucketed by key and sorted, so that joins and compactions of runs
need no shuffle.  When a level holds `fanout` runs they are merged into one run of the next level.
Whole keys are never collected; a key that a third of all documents hold is counted by partial aggregates.

Defined results: a null or empty text is one empty line.  A null doc_id is no document: its lines are
neither counted nor dropped.  Rows that repeat a doc_id are one document.  Extra columns are ignored by
`op7_line_dedup` and carried along by `dedup_lines`; `_n_lines` and `_n_dropped` replace columns of these names.
Runs are tables of the catalog until the result that reads them is written; `drop` then removes them.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import remove
from .common import BLANKS, BROADCAST_ROWS, LOWER, UPPER, ascii_lower, checked, documents, free_name, fresh_path, settle, strip_blanks

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 2


def line_key(line: Column) -> Column:
    return ascii_lower(strip_blanks(line))


def key_codes(key: Column) -> list[Column]:
    """128 bits of a key as two longs."""
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(7), key).alias("k2")]


@dataclass
class LineRuns:
    """Runs of (k1, k2, n, owner) by level; n documents, and the largest of the batch that first held the key."""

    spark: SparkSession
    buckets: int
    fanout: int = FANOUT
    levels: list[list[DataFrame]] = field(default_factory=list)
    names: list[str] = field(default_factory=list)

    def _write(self, run: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "k1", "k2")
            .write.bucketBy(self.buckets, "k1", "k2")
            .sortBy("k1", "k2")
            .option("path", fresh_path(self.spark, "line-run"))
            .saveAsTable(name)
        )
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Removes the runs' tables and files; nothing lazy may read them any more."""
        for name in self.names:
            path = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, path)
        self.names.clear()

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self, runs: list[DataFrame] | None = None) -> DataFrame:
        """One row per key: runs are merge-joined in pairs, which their buckets allow without a shuffle."""

        def pair(x: DataFrame, y: DataFrame) -> DataFrame:
            y = y.select("k1", "k2", F.col("n").alias("n2"), F.col("owner").alias("owner2"))
            both = x.hint("merge").join(y, ["k1", "k2"], "full")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            return both.select("k1", "k2", total.alias("n"), F.greatest("owner", "owner2").alias("owner"))

        return functools.reduce(pair, self.runs() if runs is None else runs)

    def add(self, batch: DataFrame) -> None:
        """batch: distinct (doc_id, k1, k2)."""
        own = batch.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        new = own.repartition(self.buckets, "k1", "k2")
        for run in self.runs():
            new = new.hint("merge").join(run.select("k1", "k2", F.lit(True).alias("known")), ["k1", "k2"], "left")
            new = new.select("k1", "k2", "n", F.when(F.col("known").isNull(), F.col("top")).alias("top"))
        run = self._write(new.select("k1", "k2", "n", F.col("top").alias("owner")))
        for depth in range(len(self.levels) + 1):
            if depth == len(self.levels):
                self.levels.append([])
            self.levels[depth].append(run)
            if len(self.levels[depth]) < self.fanout:
                break
            run = self._write(self.merged(self.levels[depth]))
            self.levels[depth] = []


def doc_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Distinct (doc_id, k1, k2) of the lines that are long enough."""
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.char_length(x) >= min_chars)
    keys = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(lines).alias("line")).select("doc_id", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select("doc_id", *key_codes(F.col("key"))).distinct()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k1, k2) of all long lines, and (k1, k2, owner) of keys in at least min_docs documents."""
    spark = docs.sparkSession
    keys = settle(doc_keys(docs, min_chars), "line-keys")
    low, high = keys.agg(F.min("doc_id"), F.max("doc_id")).first()
    runs = LineRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    step = max(1, -(-((high or 0) - (low or 0) + 1) // batches))
    for i in range(batches):
        top = (high or 0) - i * step
        runs.add(keys.where((F.col("doc_id") <= top) & (F.col("doc_id") > top - step)))
    repeats = settle(runs.merged().where(F.col("n") >= min_docs).select("k1", "k2", "owner"), "line-repeats")
    runs.drop()  # what is written reads them no more
    return keys, repeats


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """docs with `text` less its repeated lines (except in the key's largest doc_id), `_n_lines` and `_n_dropped`."""
    keys, repeats = repeated_lines(docs, min_chars, min_docs, batches)
    all_lines, rest, drop, drop_id = (free_name(docs, x) for x in ("lines", "kept", "drop", "drop_id"))
    drops = keys.join(checked(repeats), ["k1", "k2"]).where("doc_id <> owner").groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias(drop))
    drops = settle(drops, "line-drops")
    small = (drops.agg(F.sum(F.size(drop))).first()[0] or 0) <= BROADCAST_ROWS
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    named = drops.withColumnRenamed("doc_id", drop_id)
    both = docs.withColumn(all_lines, lines).join(F.broadcast(named) if small else named, F.col("doc_id") == F.col(drop_id), "left")

    def stays(x: Column) -> Column:
        code = F.struct(*key_codes(line_key(x)))
        return (F.char_length(x) < min_chars) | (F.char_length(line_key(x)) < min_chars) | ~F.array_contains(drop, code)

    kept = F.when(F.col(drop).isNull(), F.col(all_lines)).otherwise(F.filter(all_lines, stays))
    both = both.withColumn(rest, kept)
    return (
        both.withColumn("_n_lines", F.size(all_lines).cast("long"))
        .withColumn("_n_dropped", (F.size(all_lines) - F.size(rest)).cast("long"))
        .withColumn("text", F.array_join(rest, "\n"))
        .drop(all_lines, rest, drop, drop_id)
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


_CHARS = "||".join(f"chr({ord(c)})" for c in BLANKS)

OP7_SQL = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM s),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_CHARS}), '{UPPER}', '{LOWER}') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.*, h.key IS NOT NULL AND keep <> doc_id AS dropped FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
