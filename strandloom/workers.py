"""Makes this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_strandloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="strandloom-src-")) / "strandloom_src.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(path))
    sc._strandloom_shipped = True
