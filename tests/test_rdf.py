from __future__ import annotations

import pytest

from strandloom.model import TYPE, XSD
from strandloom.sources import rdf
from strandloom.sources.load import Source, load_sources, match_path, mirrored, path_day, require_feed, source_statistics

DOC = """
@prefix ex: <http://ex.org/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
# a comment
ex:a a ex:Thing ; ex:name "A \\"quoted\\" \\u00e9", 'b'@en ; ex:n 5 ; ex:flag "true"^^xsd:boolean ;
  ex:when "2024-01-02T03:04:05"^^xsd:dateTime ; ex:bad "x"^^xsd:integer ; ex:part [ ex:v 1.50 ; ex:w 2e0 ] ;
  ex:list (1 2) .
_:x ex:sees ex:a . ex:a ex:long \"\"\"two
lines\"\"\" .
"""


def test_turtle_terms():
    rows = rdf.turtle_rows(DOC)
    by = {(p.rsplit("/", 1)[-1], o): d for s, p, o, d in rows if s == "http://ex.org/a"}
    assert ("http://ex.org/a", TYPE, "http://ex.org/Thing", "") in rows
    assert by[("name", 'A "quoted" é')] == XSD + "string" and by[("name", "b")] == ""
    assert by[("flag", "True")] == XSD + "boolean" and by[("when", "2024-01-02 03:04:05")] == XSD + "dateTime"
    assert by[("bad", "x")] == XSD + "integer" and by[("n", "5")] == XSD + "integer"
    assert by[("long", "two\nlines")] == XSD + "string"
    assert {o for _, p, o, _ in rows if p.endswith("/v") or p.endswith("/w")} == {"1.50", "2.0"}


def test_blank_labels_are_stable_and_distinct():
    a = rdf.turtle_rows("@prefix e: <http://e/> . e:s e:p [ e:v 1 ], [ e:v 2 ], [ e:v 2 ] .")
    b = rdf.turtle_rows("@prefix e: <http://e/> . e:s e:p [ e:v 2 ], [ e:v 2 ], [ e:v 1 ] .")
    assert sorted(a) == sorted(b)
    assert len({o for _, p, o, _ in a if p == "http://e/p"}) == 3


@pytest.mark.parametrize("text", ["e:a e:b e:c .", "<http://a> <http://b> ", "<http://a> <http://b> \"open .", "]"])
def test_malformed_documents_have_no_rows(text):
    assert rdf.rows_or_nothing(text) == []


def test_turtle_frame_and_markers(spark):
    docs = spark.createDataFrame([(DOC,), (None,), ("  ",), ("junk (",)], "rdf_turtle string")
    parsed = rdf.parse_turtle(docs, rdf.blob_column(docs.columns))
    assert parsed.count() == len(rdf.turtle_rows(DOC))
    marks = {(r["subject"], r["object"]) for r in rdf.datatype_markers(parsed).collect()}
    assert ("http://ex.org/flag", XSD + "boolean") in marks
    with pytest.raises(ValueError):
        rdf.blob_column(["x"])
    with pytest.raises(ValueError):
        rdf.blob_column(["triples"], "named")


def test_ntriples_lines(spark, tmp_path):
    lines = ["# c", "", "<http://a> <http://p> <http://b> .", '_:x <http://p> "l\\"q"@en .', '<http://a> <http://p> "5"^^<http://t> . # end', "_:x <http://p> _:y .", "<http://a> <http://p> broken ."]
    (tmp_path / "f.nt").write_text("\n".join(lines))
    rows = {tuple(r) for r in rdf.read_ntriples(spark, str(tmp_path / "f.nt")).collect()}
    assert rows == {("http://a", "http://p", "http://b", ""), ("_:x", "http://p", 'l\\"q', ""), ("http://a", "http://p", "5", "http://t"), ("_:x", "http://p", "_:y", "")}


def test_paths():
    sources = [Source("market", fragments=("quotes/",)), Source("weather")]
    assert match_path("s3a://b/quotes/x.parquet", sources).name == "market"
    assert match_path("/data/weather.nt", sources).name == "weather"
    for bad in ("/data/other.nt", "/quotes/weather/quotes/"):
        if bad.startswith("/data"):
            with pytest.raises(ValueError):
                match_path(bad, sources)
    assert path_day("a/year=2026/month=9/day=3/f") == "2026-09-03" and path_day("a/year=2026/month=09/12.parquet") == "2026-09-12" and path_day("a") is None
    assert mirrored("s3a://b/k", "/m") == "file:///m/b/k" and mirrored("/x", "/m") == "/x"
    with pytest.raises(ValueError):
        require_feed(["/a"], Source("s", feeds=("b",)))


def test_load_and_statistics(spark, tmp_path):
    (tmp_path / "one.nt").write_text('<http://a> <http://p> "1" .\n<http://a> <http://p> "1" .\n<http://a> <http://p> "2" .\n')
    (tmp_path / "two.nt").write_text('<http://a> <http://p> "1" .\n')
    sources = [Source("one", format="ntriples"), Source("two", format="ntriples")]
    loaded = load_sources(spark, [str(tmp_path / "one.nt"), str(tmp_path / "two.nt")], sources)
    stats = {r["_source"]: tuple(r)[1:] for r in source_statistics(loaded).collect()}
    assert stats == {"one": (3, 2, 1, 1), "two": (1, 1, 0, 1)}
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "one.nt").write_text("\n")
    with pytest.raises(ValueError):
        load_sources(spark, [str(tmp_path / "empty" / "one.nt")], sources)
