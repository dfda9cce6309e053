from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

REPO = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(REPO))
DATA = os.environ.get("STRANDLOOM_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def same_rows(left, right) -> bool:
    """Whether two pandas frames hold the same rows in any order, columns by name, floats to 6 digits."""
    assert sorted(left.columns) == sorted(right.columns)

    def rows(d):
        d = d[sorted(d.columns)].copy()
        for c in d.columns:
            if d[c].dtype.kind == "f":
                d[c] = d[c].round(6) + 0.0
        return sorted(str([None if pd.isna(x) else float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r]) for r in d.astype(object).values.tolist())

    a, b = rows(left), rows(right)
    assert a == b, (len(a), len(b), sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
    return True
