"""Every registered query against DuckDB, or, where SQL can't say it, for its shape."""

from __future__ import annotations

import pytest

from conftest import same_rows
from strandloom import domain_queries
from strandloom.queries import ORACLES as _ORACLES
from strandloom.queries import QUERIES as _QUERIES

QUERIES, ORACLES = _QUERIES | domain_queries.QUERIES, _ORACLES | domain_queries.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, data, duck, name):
    assert same_rows(QUERIES[name](spark, data).toPandas(), duck.sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_breadth_first_over_all_customers(spark, data, duck):
    near: dict[str, set] = {}
    for a, b in duck.sql("SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation").fetchall():
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want, edge, step = {"r0": 0}, {"r0"}, 0
    while edge:
        step += 1
        edge = {b for a in edge for b in near[a]} - set(want)
        want |= dict.fromkeys(edge, step)
    rows = QUERIES["breadth_first"](spark, data).collect()
    assert {r["node"]: r["distance"] for r in rows} == want and len(rows) == len(want)
    assert any(n[0] == "c" and int(n[1:]) >= 40 for n in want)
