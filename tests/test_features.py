from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandloom import meta
from strandloom.features import dense, edges, encode
from strandloom.features.layout import edge_layout, node_layout
from strandloom.queries import _graph
from strandloom.lift import NAMESPACES
from strandloom.graph import build


@given(st.integers(32, 4096))
def test_node_layout_tiles(width):
    parts = sorted((p.start, p.dim) for p in node_layout(width).parts.values())
    assert parts[0][0] == 0 and all(d >= 1 for _, d in parts) and all(a + d == b for (a, d), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) == width


@given(st.integers(11, 512))
def test_edge_layout_tiles(width):
    parts = sorted((p.start, p.dim) for p in edge_layout(width).parts.values())
    assert parts[0][0] == 0 and all(d >= 1 for _, d in parts) and all(a + d == b for (a, d), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) == width


def test_known_widths():
    assert [p.dim for p in node_layout(1024).parts.values()] == [160, 48, 48, 192, 111, 81, 257, 127]
    assert [p.dim for p in edge_layout(32).parts.values()] == [5, 4, 3, 5, 4, 3, 3, 3, 2]
    assert node_layout(1024, 200)["class_identity"].dim == 200
    for bad in (lambda: node_layout(31), lambda: edge_layout(8), lambda: edge_layout(10), lambda: node_layout(64, 16)):
        with pytest.raises(ValueError):
            bad()


def test_hash_contract(spark):
    assert spark.range(1).select(F.hash(F.lit("abc"), F.lit(0))).first()[0] == 569280457


def test_trim_round_trip_and_observation(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 2, 5.0), ("b", 0, 2.0), ("b", 1, 9.0)], "k string, dim int, value double")
    trim = dense.Trim(5, [0], {2: 5.0}, {4: 0})
    out, seen = trim.apply(rows)
    assert {tuple(r) for r in out.collect()} == {("a", 0, 1.0), ("b", 0, 2.0)}
    assert seen.get == {"not_zero": 1, "not_constant": 0}
    assert trim.restore([7.0]) == [7.0, 0.0, 5.0, 0.0, 7.0]
    with pytest.raises(ValueError):
        dense.Trim(3, [0], {0: 1.0})


def test_collisions():
    layout = node_layout(64)
    codes = {"a": frozenset({0, 1, 2, 3}), "b": frozenset({0, 1, 2, 3}), "c": frozenset({4, 5})}
    out = dense.collision_report(codes, layout)
    assert out["identical"] == [["a", "b"]] and out["rank"] == 2 and out["max_overlap"] == 4
    with pytest.raises(ValueError):
        dense.collision_report(codes, layout, fail=True)


def test_numeric_share_is_strict_and_codes_are_labels(spark):
    rows = spark.createDataFrame([("p", "1"), ("p", "x"), ("q", "1"), ("q", "2"), ("q", "y"), ("code", "7")], "predicate string, value string")
    assert {r["predicate"]: r["is_numeric"] for r in encode.numeric_shares(rows, ["code"]).collect()} == {"p": False, "q": True, "code": False}


def test_normalisation_of_one_value(spark):
    rows = spark.createDataFrame([("p", 3.0)], "predicate string, value double")
    assert tuple(encode.normalisation(rows).first()) == ("p", 3.0, 1.0)


def _edges(spark, relation, src="t_A", dst="t_B"):
    return spark.createDataFrame([(src, 0, relation, dst, 0)], "src_type string, src_id long, relation string, dst_type string, dst_id long")


def test_contrast_falls_back_by_type(spark):
    props = spark.createDataFrame([("t_A", 0, "strikePrice", 12.0), ("t_B", 0, "lastPrice", 10.0)], "node_type string, node_id long, predicate string, value double")
    out = edges.contrast_entries(edges.indexed(_edges(spark, "x_hasUnderlyingEquity")), props, edge_layout(32))
    assert sorted(round(r["value"], 6) for r in out.collect()) == sorted([1.2, round(__import__("math").log(1.2), 6), 2.0])
    both = props.unionByName(spark.createDataFrame([("t_A", 0, "n", 0.0), ("t_B", 0, "n", 4.0)], props.schema))
    out = edges.contrast_entries(edges.indexed(_edges(spark, "x_hasUnderlyingEquity")), both, edge_layout(32))
    assert sorted(r["value"] for r in out.collect()) == [0.0, 2.0, 4.0]


def test_missing_labels_are_alike(spark):
    labels = spark.createDataFrame([], "node_type string, node_id long, label string")
    out = edges.context_entries(edges.indexed(_edges(spark, "x_leadsTo")), labels, edge_layout(32))
    at = edge_layout(32)["label_similarity"].start
    assert [r["value"] for r in out.where(F.col("dim") == at).collect()] == [1.0]


def test_enabled_categories():
    assert "skip" not in edges.enabled() and edges.enabled(["generic"]) == ["generic"]
    with pytest.raises(ValueError):
        edges.enabled(["skip"])


def test_one_scan_and_no_python_in_the_edge_plan(spark):
    props = spark.createDataFrame([("t_A", 0, "x", 1.0)], "node_type string, node_id long, predicate string, value double")
    labels = spark.createDataFrame([("t_A", 0, "l")], "node_type string, node_id long, label string")
    plan = edges.edge_features(_edges(spark, "x_leadsTo"), props, labels, edge_layout(32))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_metadata(spark, data, tmp_path):
    facts, nodes, edge_rows, literal_rows = _graph(spark, data)
    kinds = build.type_uris(facts, nodes, NAMESPACES)
    layout = node_layout(128)
    shares = encode.numeric_shares(literal_rows)
    contents = {
        "graph_schema": meta.graph_schema(nodes, build.edge_types(edge_rows), kinds),
        "feature_spec": meta.feature_spec(layout, edge_layout()),
        "normalization": meta.normalisation(encode.normalisation(encode.numeric_means(literal_rows, shares))),
        "encoding_config": meta.encoding_config(layout, edge_layout()),
        "slot_mapping": meta.slots(facts.select("predicate").distinct(), layout),
        "ontology_schema": meta.ontology_schema(facts, facts.select("predicate")),
    }
    sums = meta.write_metadata(spark, str(tmp_path / "meta"), contents)
    assert set(sums) == {f"{n}.json" for n in contents} and (tmp_path / "meta" / "latest" / "checksums.json").exists()
    assert contents["graph_schema"]["nodes"] == nodes.count()
    assert meta.serialised({"x": 0.1 + 0.2}) == meta.serialised({"x": 0.3})
    assert meta.separability(kinds, layout)["classes"] == 3
    with pytest.raises(FileExistsError):
        meta.require_free(spark, str(tmp_path / "meta"))
    vectors = dense.densify(encode.class_identity(nodes, kinds, layout), ["node_type", "node_id"], 128, nodes)
    meta.save_graph(str(tmp_path / "graph"), nodes, edge_rows, vectors, edge_rows.limit(0).select("src_type", "relation", "dst_type", F.lit(0).alias("edge_idx")))
    assert spark.read.parquet(str(tmp_path / "graph" / "node_features")).count() == nodes.count()
