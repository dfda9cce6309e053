"""N-Triples files as a stream into a day-partitioned table: each micro-batch adds only facts that are not there yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import SPO, added
from ..storage import exists
from ..tables.publish import table_path


def follow_ntriples(spark: SparkSession, folder: str, root: str, day: str, checkpoint: str) -> StreamingQuery:
    """Reads each new file once and appends its new facts to `triples/day=...`; ends when all files are read."""
    line = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:\^\^<[^>]*>|@[A-Za-z0-9-]+)?)\s*\.\s*$'
    part = lambda i: F.regexp_extract("value", line, i)
    rows = spark.readStream.text(folder).where(F.col("value").rlike(line))
    parsed = rows.select(F.concat(part(1), part(2)).alias("subject"), part(3).alias("predicate"), F.concat(part(4), part(5), part(6)).alias("object"))
    path = f"{table_path(root, 'triples')}/day={day}"

    def append(batch: DataFrame, epoch: int) -> None:
        there = batch.sparkSession.read.parquet(path) if exists(batch.sparkSession, path) else batch.limit(0)
        added(batch, there.select(*SPO)).write.mode("append").parquet(path)

    return parsed.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
