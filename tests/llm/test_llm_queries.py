from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from strandloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, data, duck, name):
    assert same_rows(QUERIES[name](spark, data).toPandas(), duck.sql(ORACLES[name]).df())


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline(spark, data):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = docs.columns
    first = docs
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == names
    assert docs.count() > 0.5 * first.count()
    out = p.run(spark, data)
    assert out.where("NOT round_trip").count() == 0 and out.count() == docs.count()


def test_pipeline_on_odd_documents(spark, data, odd_docs, no_docs):
    import corpus_pipeline as p

    for docs in (odd_docs, no_docs):
        names = {"_toxicity": "t", "_gone": "g", "_lines": "l", "_kept": "k", "_drop": "d", "_drop_id": "i", "_h1": "h", "_found": "f", "_codes": "c", "_holes": "o", "_row": "r"}
        docs = docs.withColumns({n: F.lit(v) for n, v in names.items()})
        ids = [sorted(str(r["doc_id"]) for r in docs.collect())]
        for _, stage in p.STAGES[:-1]:
            out = stage(spark, docs, data)
            assert out.columns == docs.columns
            docs = out
            rows = docs.collect()
            assert all(r[n] == v for r in rows for n, v in names.items())
            ids.append(sorted(str(r["doc_id"]) for r in rows))
        # Nothing is toxic or of the benchmark; 2 repeats 1, twice; all else stays.
        assert ids[1] == ids[2] == ids[0] and ids[3] == ids[4] == [i for i in ids[0] if i != "2"]
        out = p.STAGES[-1][1](spark, docs, data)
        assert out.columns == ["doc_id", "n_pieces", "ids_sha256", "round_trip"] and out.where("NOT round_trip").count() == 0
        assert sorted(str(r["doc_id"]) for r in out.collect()) == ids[4]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]
