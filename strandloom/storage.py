"""The folder that driver and executors share, plan truncation through it, and file access through Spark's file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where none is set, a temporary folder if driver and executors are one process, else an error: they would not share it."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strandloom-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/strandloom/{tag}-{uuid.uuid4().hex}"


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: the plan is cut, and a lost executor loses nothing."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> bool:
    """Deletes what this package has written to the shared folder, when no frame that reads it is needed any more; false if there was nothing."""
    return remove(spark, f"{shared_dir(spark)}/strandloom")


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of a file's last change."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Replace a file on any file system that Spark reads."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
