"""One query for each operator over the supplied tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .features import dense, edges as edge_features_of, encode
from .features.layout import Part, edge_layout, node_layout
from .functions import text as X
from .graph import build, paths
from .lift import IDS, NAMESPACES, ONTOLOGY, lift, uri
from .model import LABEL, PREF_LABEL, TYPE, added, as_triples, properties_of, union_frames
from .naming import Namespaces
from .operators import calendar, hubs, joins, pairs, schema
from .operators.sequence import escalations, increments, latest, newest_day, sequence
from .plans.pipeline import Phase, enrich
from .sources import rdf
from .sources.load import source_statistics
from .storage import fresh_path, settle
from .tables import publish, questions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEYWORDS = [("ring", "Jewellery"), ("widget", "Hardware"), ("gear", "Hardware"), ("red", "Colour")]
SEGMENTS = [("BUILDING", "HousingSector"), ("AUTOMOBILE", "TransportationSector"), ("MACHINERY", "ManufacturingSector"), ("FURNITURE", "RetailSector")]
SEVERITY = [("view", 1), ("click", 2), ("signup", 3), ("purchase", 4), ("error", 5)]


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _nodes(facts: DataFrame) -> DataFrame:
    """Nodes are read by several joins, so they are written once."""
    return settle(build.nodes(facts, NAMESPACES), "nodes")


def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


# Graph


@query("SELECT 'star_Region' AS region_type, r_name AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def two_hop_customers_per_region(spark, folder):
    facts = lift(spark, folder, ["region", "nation", "customer"])
    nodes = _nodes(facts)
    edges = build.edges(facts, nodes, NAMESPACES)
    hop1 = edges.where("relation = 'star_c_nationkey'").select("dst_type", F.col("dst_id").alias("nation"))
    hop2 = edges.where("relation = 'star_n_regionkey'").select(F.col("src_id").alias("nation"), F.col("dst_type").alias("region_type"), F.col("dst_id").alias("node_id"))
    names = build.literals(facts, nodes, NAMESPACES).where("predicate_name = 'star_r_name'").select("node_id", F.col("value").alias("region"))
    return hop1.join(hop2, "nation").join(names, "node_id").groupBy("region_type", "region").agg(F.count("*").alias("customers"))


@query(f"""SELECT predicate, count(*) AS n, count(DISTINCT object) AS objects FROM (
 SELECT '{TYPE}' AS predicate, 'c' AS object FROM customer UNION ALL SELECT '{ONTOLOGY}c_nationkey', c_nationkey::VARCHAR FROM customer
 UNION ALL SELECT '{ONTOLOGY}c_name', c_name FROM customer UNION ALL SELECT '{ONTOLOGY}c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT '{ONTOLOGY}c_acctbal', c_acctbal::VARCHAR FROM customer) GROUP BY 1""")
def lift_triples(spark, folder):
    return lift(spark, folder, ["customer"]).groupBy("predicate").agg(F.count("*").alias("n"), F.countDistinct("object").alias("objects"))


_NODE_SQL = " UNION ALL ".join(f"SELECT 'star_{k}' AS node_type, '{IDS}{t}/' || {c} AS uri FROM {t}" for t, k, c in (("region", "Region", "r_regionkey"), ("nation", "Nation", "n_nationkey"), ("customer", "Customer", "c_custkey"), ("supplier", "Supplier", "s_suppkey")))


@query(f"SELECT node_type, row_number() OVER (PARTITION BY node_type ORDER BY uri) - 1 AS node_id, uri FROM ({_NODE_SQL})")
def dense_node_ids(spark, folder):
    return build.nodes(lift(spark, folder, ["region", "nation", "customer", "supplier"]), NAMESPACES)


@query(f"""SELECT 'star_Customer' AS src_type, 'star_c_nationkey' AS relation, 'star_Nation' AS dst_type, count(*) AS count, '{ONTOLOGY}c_nationkey' AS predicate_uri, 'raw' AS origin, 'star' AS relation_group FROM customer
 UNION ALL SELECT 'star_Supplier', 'star_s_nationkey', 'star_Nation', count(*), '{ONTOLOGY}s_nationkey', 'raw', 'star' FROM supplier
 UNION ALL SELECT 'star_Nation', 'star_n_regionkey', 'star_Region', count(*), '{ONTOLOGY}n_regionkey', 'raw', 'star' FROM nation""")
def edge_type_counts(spark, folder):
    facts = lift(spark, folder, ["region", "nation", "customer", "supplier"])
    nodes = _nodes(facts)
    return build.edge_types(build.edges(facts, nodes, NAMESPACES))


@query(f"SELECT '{IDS}nation/' || n_nationkey AS src_uri, 'star_n_regionkey' AS relation, '{IDS}region/' || n_regionkey AS dst_uri FROM nation")
def edges_with_uris(spark, folder):
    facts = lift(spark, folder, ["region", "nation"])
    nodes = _nodes(facts)
    return paths.named_edges(build.edges(facts, nodes, NAMESPACES), nodes).select("src_uri", "relation", "dst_uri")


@query("SELECT 'star' AS relation_group, 'star_c_nationkey,star_n_regionkey' AS relations, (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) AS edges")
def relation_groups(spark, folder):
    facts = lift(spark, folder, ["region", "nation", "customer"])
    nodes = _nodes(facts)
    groups = build.relation_groups(build.edge_types(build.edges(facts, nodes, NAMESPACES)))
    return groups.withColumn("relations", F.array_join("relations", ","))


@query(f"""WITH k AS (SELECT '{IDS}part/' || p_partkey AS uri, 'star_Part' AS general, 'star_' || p_type AS narrow FROM part),
 t AS (SELECT uri, general AS node_type FROM k UNION ALL SELECT uri, narrow FROM k),
 n AS (SELECT node_type, count(*) AS n FROM t GROUP BY 1),
 s AS (SELECT n.node_type FROM n WHERE n.n < (SELECT max(n) FROM n))
 SELECT 'star_Part' AS node_type, (SELECT count(*) FROM k) AS nodes, (SELECT string_agg(node_type, ',' ORDER BY node_type) FROM s) AS subsumed""")
def type_subsumption(spark, folder):
    rows = table(spark, folder, "part")
    s = uri("part", F.col("p_partkey"))
    facts = as_triples(rows, s, TYPE, F.lit(ONTOLOGY + "Part")).unionByName(as_triples(rows, s, TYPE, F.concat(F.lit(ONTOLOGY), "p_type")))
    kinds = build.type_rows(facts, NAMESPACES)
    narrow = build.subsumed_types(kinds).agg(F.array_join(F.sort_array(F.collect_list("node_type")), ",").alias("subsumed"))
    return build.nodes(facts, NAMESPACES).groupBy("node_type").agg(F.count("*").alias("nodes")).crossJoin(F.broadcast(narrow))


@query(f"""SELECT 'star_Customer' AS node_type, '{IDS}customer/' || c_custkey AS uri, '{ONTOLOGY}' || p AS predicate, 'star_' || p AS predicate_name, v AS value, p = 'c_size' AS is_numeric
 FROM (SELECT c_custkey, 'c_name' AS p, c_name AS v FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer)""")
def facts_of_customers(spark, folder):
    facts = lift(spark, folder, ["customer"]).where(f"predicate <> '{ONTOLOGY}c_acctbal'")
    return publish.facts(build.literals(facts, build.nodes(facts, NAMESPACES), NAMESPACES)).where("predicate_name <> 'star_c_nationkey'")


@query(f"""SELECT '{ONTOLOGY}' || p AS predicate, count(*) AS total, count(*) FILTER (WHERE regexp_full_match(v, '[0-9]+')) AS numeric, count(*) FILTER (WHERE regexp_full_match(v, '[0-9]+')) / count(*) > 0.5 AS is_numeric
 FROM (SELECT 'event_type' AS p, event_type AS v FROM events UNION ALL SELECT 'user_id', user_id::VARCHAR FROM events UNION ALL SELECT 'props', props FROM events) GROUP BY 1""")
def numeric_shares(spark, folder):
    rows = table(spark, folder, "events").select("event_type", F.col("user_id").cast("string"), "props")
    pairs_ = F.array(*[F.struct(F.lit(ONTOLOGY + c).alias("predicate"), F.col(c).alias("value")) for c in rows.columns])
    return encode.numeric_shares(rows.select(F.explode(pairs_).alias("x")).select("x.*"))


@query(f"SELECT 'star_Customer' AS node_type, '{IDS}customer/' || c_custkey AS uri, c_mktsegment AS star_c_mktsegment, c_name AS star_c_name, round(c_acctbal, 4) AS star_c_acctbal FROM customer")
def snapshot_pivot(spark, folder):
    facts = lift(spark, folder, ["customer"])
    wide = publish.snapshots(build.literals(facts, build.nodes(facts, NAMESPACES), NAMESPACES).where("predicate_name <> 'star_c_nationkey'"))
    return wide.withColumn("star_c_acctbal", F.round("star_c_acctbal", 4))


@query(f"SELECT 'star_Part' AS node_type, '{IDS}part/' || p_partkey AS uri, 'star_p_name: ' || p_name AS text FROM part")
def entity_texts(spark, folder):
    facts = lift(spark, folder, ["part"])
    return publish.entities(build.literals(facts, build.nodes(facts, NAMESPACES), NAMESPACES))


@query("SELECT c_mktsegment AS dst_type, count(*) AS n FROM customer WHERE false GROUP BY 1 UNION ALL SELECT 'star_Nation', count(*) FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer) AND n_nationkey IN (SELECT s_nationkey FROM supplier) HAVING count(*) > 0")
def left_out_periods(spark, folder):
    facts = lift(spark, folder, ["nation", "customer", "supplier"])
    nodes = _nodes(facts)
    return build.days_only(build.edges(facts, nodes, NAMESPACES), ["star_Nation"], ["star_Supplier"]).groupBy("dst_type").agg(F.count("*").alias("n"))


# Sequences


@query("SELECT user_id, event_id, next_event_id FROM (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event_id FROM events) WHERE next_event_id IS NOT NULL")
def sequence_events(spark, folder):
    return sequence(table(spark, folder, "events"), "event_id", ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "next_event_id")


@query("""WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1)
 SELECT user_id, event_type, next_event_type, next_event_id FROM (SELECT user_id, event_type, lead(event_type) OVER w AS next_event_type, lead(event_id) OVER w AS next_event_id FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE next_event_type IS NOT NULL""")
def sequence_first_occurrences(spark, folder):
    return sequence(table(spark, folder, "events"), "event_type", ["user_id"], ["ts", "event_id"], ["event_id"]).select("user_id", "event_type", "next_event_type", "next_event_id")


@query("SELECT conv_id, turn, role, next_turn FROM (SELECT conv_id, turn, role, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn FROM conversations) WHERE next_turn IS NOT NULL")
def sequence_turns(spark, folder):
    return sequence(table(spark, folder, "conversations").select("conv_id", "turn", "role"), "turn", ["conv_id"], ["turn"])


@query(f"""WITH s AS (SELECT * FROM events JOIN (VALUES {_values(SEVERITY)}) AS v(event_type, sev) USING (event_type)),
 l AS (SELECT event_id, sev, value, lead(event_id) OVER w AS nx, lead(sev) OVER w AS ns, lead(value) OVER w AS nv FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
 SELECT event_id, nx AS next_event_id FROM l WHERE nx IS NOT NULL AND (ns > sev OR ns = sev AND nv > value)""")
def escalation_events(spark, folder):
    rows = table(spark, folder, "events")
    graded = joins.lookup(rows, joins.small_table(rows, SEVERITY, "event_type string, sev int"), ["event_type"])
    return escalations(graded, "event_id", ["user_id"], ["ts", "event_id"], "sev", "value")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1")
def newest_day_orders(spark, folder):
    return newest_day(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event(spark, folder):
    return latest(table(spark, folder, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")


@query("SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 4) AS gap FROM events")
def running_increments(spark, folder):
    return increments(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], "value", "gap").select("event_id", F.round("gap", 4).alias("gap"))


# Pairs


@query("SELECT a.o_orderkey AS a, b.o_orderkey AS b, a.o_custkey FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate AND a.o_orderstatus = 'F' AND b.o_orderstatus = 'O'")
def opposite_orders(spark, folder):
    rows = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    return pairs.opposite(rows, "o_orderkey", ["o_custkey", "o_orderdate"], status.isin("F", "O"), status == "F").select("a", "b", "o_custkey")


@query("SELECT o_custkey, o_orderkey, next_o_orderkey FROM (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS next_o_orderkey FROM orders) WHERE next_o_orderkey IS NOT NULL")
def adjacent_prices(spark, folder):
    return sequence(table(spark, folder, "orders"), "o_orderkey", ["o_custkey"], ["o_totalprice", "o_orderkey"]).select("o_custkey", "o_orderkey", "next_o_orderkey")


@query("""WITH m AS (SELECT *, (min(o_totalprice) OVER (PARTITION BY o_custkey) + max(o_totalprice) OVER (PARTITION BY o_custkey)) / 2 AS mid FROM orders),
 u AS (SELECT o_custkey, o_orderkey AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rank FROM m WHERE o_orderstatus = 'O' AND o_totalprice > mid),
 l AS (SELECT o_custkey, o_orderkey AS b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM m WHERE o_orderstatus = 'F' AND o_totalprice < mid)
 SELECT a, b, o_custkey, rank FROM u JOIN l USING (o_custkey, rank) WHERE rank <= 10""")
def rank_pairs_about_middle(spark, folder):
    status = F.col("o_orderstatus")
    return pairs.ranked_about_middle(table(spark, folder, "orders"), "o_orderkey", ["o_custkey"], "o_totalprice", status == "O", status == "F")


@query("SELECT x.s_suppkey AS a, y.s_suppkey AS b, x.s_nationkey FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey AND x.s_suppkey < y.s_suppkey")
def suppliers_sharing_nation(spark, folder):
    return pairs.sharing(table(spark, folder, "supplier"), "s_suppkey", ["s_nationkey"])


@query("""WITH p AS (SELECT x.s_suppkey AS a, y.s_suppkey AS b FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey AND x.s_suppkey < y.s_suppkey)
 SELECT node, count(*) AS peers FROM (SELECT a AS node, b FROM p UNION ALL SELECT b, a FROM p) GROUP BY node""")
def peers_both_ways(spark, folder):
    stored = pairs.sharing(table(spark, folder, "supplier"), "s_suppkey", ["s_nationkey"])
    return pairs.both_ways(stored, "a", "b").groupBy("node").agg(F.count("*").alias("peers"))


# Joins


_ASOF = """SELECT o_orderkey, {value} AS l_partkey FROM orders JOIN {right} r ON r.l_orderkey = o_orderkey {on}"""


def _as_of(spark, folder, shift: str):
    left = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderdate") + F.expr(shift)).alias("at"))
    right = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_shipdate").alias("at"), "l_partkey")
    return joins.exact_or_latest(left, right, "l_orderkey", "at", "l_partkey", "l_partkey").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")


@query("SELECT o_orderkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate = o_orderdate")
def as_of_exact(spark, folder):
    return _as_of(spark, folder, "INTERVAL 0 SECONDS")


@query("SELECT o_orderkey, l_partkey FROM orders JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) AS n FROM lineitem) ON l_orderkey = o_orderkey AND n = 1")
def as_of_fallback(spark, folder):
    return _as_of(spark, folder, "INTERVAL 1 SECONDS")


@query("""SELECT class, count(*) AS n FROM (SELECT CASE WHEN abs(p_retailprice - u) <= u * 0.02 THEN 'ATM' WHEN (s = 'F' AND p_retailprice <= u) OR (s <> 'F' AND p_retailprice > u) THEN 'ITM' ELSE 'OTM' END AS class
 FROM (SELECT p_retailprice, l_extendedprice / l_quantity AS u, l_linestatus AS s FROM lineitem JOIN part ON l_partkey = p_partkey)) GROUP BY class""")
def moneyness_classes(spark, folder):
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    right = F.when(F.col("l_linestatus") == "F", "CALL").otherwise("PUT")
    return rows.select(joins.moneyness(F.col("p_retailprice"), price, right).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


@query(f"SELECT p_partkey, keyword, sector FROM part JOIN (VALUES {_values(KEYWORDS)}) AS k(keyword, sector) ON contains(p_name, keyword)")
def keyword_sectors(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return joins.containing(rows, F.col("p_name"), joins.small_table(rows, KEYWORDS, "keyword string, sector string"), "keyword").select("p_partkey", "keyword", "sector")


@query(f"SELECT p_partkey, keyword, sector FROM part JOIN (VALUES {_values(KEYWORDS)}) AS k(keyword, sector) ON list_contains(string_split(p_name, ' '), keyword)")
def keyword_words(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    return joins.containing_words(rows, "p_partkey", F.col("p_name"), spark.createDataFrame(KEYWORDS, "keyword string, sector string"), "keyword").select("p_partkey", "keyword", "sector")


@query("""SELECT a.p_partkey AS a, 'ringWidget' AS relation, b.p_partkey AS b FROM part a JOIN part b ON contains(a.p_name, 'small ring') AND contains(b.p_name, 'red widget') AND a.p_partkey <> b.p_partkey
 UNION SELECT a.p_partkey, 'gearRing', b.p_partkey FROM part a JOIN part b ON contains(a.p_name, 'blue gear') AND contains(b.p_name, 'small ring') AND a.p_partkey <> b.p_partkey""")
def pattern_pairs(spark, folder):
    return joins.pattern_pairs(table(spark, folder, "part"), "p_partkey", F.col("p_name"), [("small ring", "ringWidget", "red widget"), ("blue gear", "gearRing", "small ring")])


@query("SELECT e.event_id, o.o_orderkey FROM orders o JOIN (SELECT event_id, user_id, ts - INTERVAL 9000 DAY AS at FROM events) e ON e.user_id = o.o_custkey AND e.at >= o.o_orderdate - INTERVAL 1 DAY AND e.at <= o.o_orderdate + INTERVAL 15 DAY")
def interval_join(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_orderdate")
    events = table(spark, folder, "events").select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 9000 DAYS")).alias("at"))
    return joins.within(orders, events, "user_id", "o_orderdate", "at", 86_400, 15 * 86_400).select("event_id", "o_orderkey")


@query("""WITH s AS (SELECT o_orderkey AS k, o_orderpriority AS v FROM orders WHERE o_orderstatus = 'F'), d AS (SELECT o_orderkey AS k, 'derived' AS v FROM orders WHERE o_orderstatus IN ('F', 'O'))
 SELECT o_orderkey AS k, coalesce(s.v, d.v) AS v FROM orders LEFT JOIN s ON s.k = o_orderkey LEFT JOIN d ON d.k = o_orderkey""")
def stated_or_derived(spark, folder):
    rows = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "k")
    stated = rows.where("o_orderstatus = 'F'").select("k", F.col("o_orderpriority").alias("v"))
    derived = rows.where("o_orderstatus IN ('F', 'O')").select("k", F.lit("derived").alias("v"))
    return joins.stated_or_derived(rows.select("k"), stated, derived, "k", "v")


@query(f"SELECT e.event_id, coalesce(sev, 0) AS sev FROM events e LEFT JOIN (VALUES {_values(SEVERITY[:3])}) AS v(event_type, sev) USING (event_type)")
def lookup_with_default(spark, folder):
    rows = table(spark, folder, "events")
    return joins.lookup(rows, joins.small_table(rows, SEVERITY[:3], "event_type string, sev int"), ["event_type"], {"sev": 0}).select("event_id", "sev")


# Hubs


@query(f"""WITH k AS (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) > 1)
 SELECT '{IDS}hub/' || s_nationkey AS subject, '{TYPE}' AS predicate, '{ONTOLOGY}Hub' AS object FROM k UNION ALL SELECT '{IDS}hub/' || s_nationkey, '{ONTOLOGY}key', s_nationkey::VARCHAR FROM k
 UNION ALL SELECT '{IDS}supplier/' || s_suppkey, 'http://www.w3.org/2002/07/owl#sameAs', '{IDS}hub/' || s_nationkey FROM supplier WHERE s_nationkey IN (SELECT s_nationkey FROM k)""")
def unify_by_key(spark, folder):
    rows = table(spark, folder, "supplier").select(uri("supplier", F.col("s_suppkey")).alias("e"), "s_nationkey")
    return hubs.unify(rows, "e", "s_nationkey", IDS + "hub/", ONTOLOGY + "Hub", ONTOLOGY + "key")


@query("SELECT n_nationkey, min(s_suppkey) AS s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 5000 GROUP BY 1 UNION ALL SELECT s_nationkey, min(s_suppkey) FROM supplier GROUP BY 1 HAVING max(s_acctbal) <= 5000")
def best_pairing(spark, folder):
    rows = table(spark, folder, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", F.when(F.col("s_acctbal") > 5000, 0).otherwise(1).alias("priority"))
    return hubs.pairing(rows, "n_nationkey", "s_suppkey", "priority").select("n_nationkey", "s_suppkey")


@query("SELECT c_custkey AS entity, n_regionkey AS hub FROM customer JOIN nation ON c_nationkey = n_nationkey UNION SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT n_nationkey, n_regionkey FROM nation")
def hub_by_routes(spark, folder):
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").cast("long").alias("n"), F.col("n_regionkey").alias("hub"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").cast("long").alias("n")).join(nation, "n")
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").cast("long").alias("n")).join(nation, "n")
    return hubs.by_routes([customers, suppliers, nation.withColumnRenamed("n", "entity")], "entity", "hub")


@query("SELECT r_regionkey, r_name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation JOIN supplier ON s_nationkey = n_nationkey)")
def reached_hubs(spark, folder):
    links = table(spark, folder, "nation").join(table(spark, folder, "supplier"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("r_regionkey"))
    return hubs.reached(table(spark, folder, "region"), links, "r_regionkey").select("r_regionkey", "r_name")


@query(f"SELECT c_custkey, target FROM customer JOIN (VALUES {_values(SEGMENTS)}) AS t(c_mktsegment, target) USING (c_mktsegment) WHERE target <> 'RetailSector'")
def sector_crosswalk(spark, folder):
    rows = table(spark, folder, "customer")
    present = spark.createDataFrame([(t,) for _, t in SEGMENTS if t != "RetailSector"], "target string")
    return hubs.crosswalk(rows, joins.small_table(rows, SEGMENTS, "c_mktsegment string, target string"), "c_mktsegment", present, "target").select("c_custkey", "target")


@query("SELECT DISTINCT c_mktsegment, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey")
def leads_through_shared(spark, folder):
    customers = table(spark, folder, "customer").select("c_mktsegment", F.col("c_nationkey").alias("n"))
    return hubs.through(customers, table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n")), "n", "c_mktsegment", "s_suppkey")


@query("SELECT p_brand, p_type, CASE WHEN n > 1 THEN 'subsumption' ELSE 'equivalence' END AS relation FROM (SELECT p_brand, min(p_type) AS p_type FROM part GROUP BY 1) JOIN (SELECT p_type, count(*) AS n FROM (SELECT p_brand, min(p_type) AS p_type FROM part GROUP BY 1) GROUP BY 1) USING (p_type)")
def shared_target_partition(spark, folder):
    return hubs.share_partition(table(spark, folder, "part").groupBy("p_brand").agg(F.min("p_type").alias("p_type")), "p_brand", "p_type").select("p_brand", "p_type", "relation")


# Calendar


_PERIODS = "SELECT DISTINCT {s} AS subject, 'p/' || {f} AS period, {f} AS name, '{k}' AS kind FROM orders"
_PERIOD_SQL = " UNION ALL ".join(_PERIODS.format(s="o_orderkey", f=f"strftime(o_orderdate, '{f}')", k=k) for f, k in (("%B", "month"), ("%Y", "year"), ("%Y-%m-%d", "day")))


def _periods(spark, folder):
    dated = table(spark, folder, "orders").select("o_orderkey", _iso("o_orderdate").alias("date"))
    return calendar.periods_of(dated, "o_orderkey", "date", "p/")


@query(_PERIOD_SQL)
def calendar_periods(spark, folder):
    return _periods(spark, folder)


@query("SELECT kind, count(*) AS n FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'month' ELSE 'day' END AS kind FROM orders) GROUP BY kind")
def finest_grain(spark, folder):
    some = _periods(spark, folder).where("kind <> 'day' OR subject % 3 <> 0")
    return calendar.finest(some).groupBy("kind").agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%B') AS m, strftime(o_orderdate, '%Y') AS y FROM orders),
 n AS (SELECT (SELECT count(DISTINCT d) FROM d) AS d, (SELECT count(DISTINCT m) FROM d) AS m, (SELECT count(DISTINCT y) FROM d) AS y)
 SELECT 'type' AS predicate, d + m + y AS n FROM n UNION ALL SELECT 'label', d + m + y FROM n UNION ALL SELECT 'sameAs', d + m + y FROM n
 UNION ALL SELECT 'coversDay', d FROM n UNION ALL SELECT 'coversMonth', (SELECT count(*) FROM (SELECT DISTINCT m, y FROM d)) FROM n UNION ALL SELECT 'observedInPeriod', (SELECT count(*) FROM orders) FROM n""")
def calendar_hubs(spark, folder):
    periods = _periods(spark, folder).withColumn("subject", F.col("subject").cast("string"))
    out = calendar.unify_periods(periods, "hub/", ONTOLOGY)
    return out.groupBy(X.local_name(F.col("predicate")).alias("predicate")).agg(F.count("*").alias("n"))


# Schema


@query(f"""SELECT '{ONTOLOGY}' || p AS subject, 'http://www.w3.org/2000/01/rdf-schema#' || side AS predicate, '{ONTOLOGY}' || c AS object FROM (VALUES ('c_nationkey', 'domain', 'Customer'), ('c_name', 'domain', 'Customer'), ('c_acctbal', 'domain', 'Customer'), ('c_mktsegment', 'domain', 'Customer'),
 ('c_nationkey', 'range', 'Nation'), ('n_regionkey', 'domain', 'Nation'), ('n_regionkey', 'range', 'Region'), ('n_name', 'domain', 'Nation'), ('r_name', 'domain', 'Region')) AS v(p, side, c)""")
def schema_axioms(spark, folder):
    return schema.schema_axioms(lift(spark, folder, ["region", "nation", "customer"]))


@query(f"SELECT '{ONTOLOGY}at' AS property, 'domain' AS side, '{ONTOLOGY}Customer,{ONTOLOGY}Supplier' AS classes")
def ambiguous_domains(spark, folder):
    facts = lift(spark, folder, ["nation", "customer", "supplier"])
    both = facts.withColumn("predicate", F.when(F.col("predicate").endswith("nationkey"), ONTOLOGY + "at").otherwise(F.col("predicate")))
    return schema.ambiguous(schema.observations(both)).withColumn("classes", F.array_join("classes", ","))


_CLASSES = "SELECT DISTINCT 'x/' || string_split(p_name, ' ')[2] AS c FROM part UNION SELECT DISTINCT 'x/' || string_split(p_name, ' ')[1] || string_split(p_name, ' ')[2] FROM part"


def _classes(spark, folder):
    words = F.split("p_name", " ")
    rows = table(spark, folder, "part").select(F.explode(F.array(words[1], F.concat(words[0], words[1]))).alias("c")).distinct()
    return rows.select(F.concat(F.lit("x/"), "c").alias("class_uri"))


@query(f"WITH c AS ({_CLASSES}) SELECT a.c AS child, b.c AS parent, 'ending' AS rule FROM c a JOIN c b ON a.c <> b.c AND ends_with(substr(a.c, 3), substr(b.c, 3)) AND NOT regexp_matches(substr(a.c, 3, length(a.c) - length(b.c)), 'Less|Excluding|Without|Except')")
def subclasses_by_name(spark, folder):
    return schema.subclasses_by_name(_classes(spark, folder))


_CHAIN = "SELECT DISTINCT p_brand || '/' || p_type AS child, p_brand AS parent FROM part UNION SELECT DISTINCT p_brand, 'Brand' FROM part UNION SELECT DISTINCT p_brand || '/' || p_type || '/' || p_size, p_brand || '/' || p_type FROM part"


@query(f"WITH RECURSIVE e AS ({_CHAIN}), u AS (SELECT child, parent, 1 AS depth FROM e UNION ALL SELECT u.child, e.parent, depth + 1 FROM u JOIN e ON e.child = u.parent WHERE depth < 10) SELECT child AS class_uri, parent AS superclass_uri, min(depth) AS depth FROM u GROUP BY 1, 2")
def class_closure(spark, folder):
    rows = table(spark, folder, "part")
    kind, size = F.concat_ws("/", "p_brand", "p_type"), F.concat_ws("/", "p_brand", "p_type", F.col("p_size").cast("string"))
    steps = F.array(*[F.struct(c.alias("child"), p.alias("parent")) for c, p in ((kind, F.col("p_brand")), (F.col("p_brand"), F.lit("Brand")), (size, kind))])
    return schema.closure(rows.select(F.explode(steps).alias("s")).select("s.*").distinct())


@query(f"SELECT '{IDS}customer/' || c_custkey AS subject, '{ONTOLOGY}unifiedName' AS predicate, c_name AS object FROM customer UNION ALL SELECT '{IDS}supplier/' || s_suppkey, '{ONTOLOGY}unifiedName', s_name FROM supplier")
def fold_predicates(spark, folder):
    return schema.fold_predicates(lift(spark, folder, ["customer", "supplier"]), {ONTOLOGY + "c_name": ONTOLOGY + "unifiedName", ONTOLOGY + "s_name": ONTOLOGY + "unifiedName"})


@query(f"SELECT '{IDS}customer/' || c_custkey AS subject, '{TYPE}' AS predicate, '{ONTOLOGY}Party' AS object FROM customer")
def align_types(spark, folder):
    return schema.align_types(lift(spark, folder, ["customer", "nation"]), {ONTOLOGY + "Customer": ONTOLOGY + "Party"})


@query(f"SELECT '{IDS}nation/' || n_nationkey AS subject, '{PREF_LABEL}' AS predicate, n_name AS object FROM nation WHERE n_nationkey % 2 = 1")
def preferred_labels(spark, folder):
    rows = table(spark, folder, "nation")
    s = uri("nation", F.col("n_nationkey"))
    facts = as_triples(rows, s, LABEL, "n_name").unionByName(as_triples(rows.where("n_nationkey % 2 = 0"), s, PREF_LABEL, "n_name"))
    return schema.preferred_labels(facts)


@query("SELECT event_id::VARCHAR AS subject, predicate, object FROM (SELECT event_id, 'class' AS predicate, CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'act' END AS object FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, 'is/' || CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'act' END, event_type FROM events WHERE event_type <> 'error')")
def event_categories(spark, folder):
    rows = table(spark, folder, "events").select(F.col("event_id").cast("string"), "event_type")
    return schema.classify_events(rows, "event_id", "event_type", {"browse": ["click", "view"], "act": ["signup", "purchase"]}, "class", "is/")


# Scalars


@query("SELECT c_custkey, '{0}Customer_' || lpad(c_custkey::VARCHAR, 10, '0') AS subject, lpad(c_custkey::VARCHAR, 10, '0') AS object FROM customer".format(IDS))
def conform_identifiers(spark, folder):
    key = F.col("c_custkey").cast("string")
    rows = table(spark, folder, "customer").select("c_custkey", F.concat(F.lit(IDS + "Customer_"), key).alias("subject"), F.lit("cik").alias("predicate"), F.concat(key, F.lit(".0")).alias("object"))
    return X.conform_identifiers(rows, {"cik": 10}, [], {IDS + "Customer_": 10}).select("c_custkey", "subject", "object")


@query("SELECT o_orderkey, 'C' || (o_custkey % 1000) AS underlying, strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d') AS expiry, CASE WHEN o_orderstatus = 'F' THEN 'CALL' ELSE 'PUT' END AS side, floor(o_totalprice % 100000) AS strike FROM orders")
def option_symbols(spark, folder):
    root = F.rpad(F.concat(F.lit("C"), (F.col("o_custkey") % 1000).cast("string")), 6, " ")
    right = F.when(F.col("o_orderstatus") == "F", "C").otherwise("P")
    strike = F.lpad(F.concat(F.floor(F.col("o_totalprice") % 100000).cast("string"), F.lit("000")), 8, "0")
    symbol = F.concat(root, F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 10 YEARS"), "yyMMdd"), right, strike)
    rows = table(spark, folder, "orders").withColumn("s", symbol)
    s = F.col("s")
    return rows.select("o_orderkey", X.option_underlying(s).alias("underlying"), X.option_expiry(s).alias("expiry"), X.option_right(s).alias("side"), X.option_strike(s).alias("strike"))


_PAGE_NS = Namespaces((("http://therha.example.com/", "therha"), ("https://", "secure")))


@query("""SELECT page_id, regexp_extract(url, '([^/#]+)[/#]*$', 1) AS local, CASE WHEN starts_with(url, 'http://therha.example.com/') AND trim(substr(url, 27), '/#') <> '' THEN 'therha_' || trim(substr(url, 27), '/#')
 WHEN starts_with(url, 'https://') THEN 'secure_' || trim(substr(url, 9), '/#') ELSE 'unknown_' || regexp_extract(trim(url, '/#'), '([^/#]+)$', 1) END AS name FROM pages""")
def names_of_pages(spark, folder):
    u = F.col("url")
    return table(spark, folder, "pages").select("page_id", X.local_name(u).alias("local"), _PAGE_NS.name(u).alias("name"))


@query("SELECT p_partkey, code, CASE " + " ".join(f"WHEN major BETWEEN {a} AND {b} THEN '{d}'" for a, b, d, _ in X.SIC_DIVISIONS) + " END AS division FROM (SELECT *, CASE WHEN length(code) <= 4 THEN substr(lpad(code, 4, '0'), 1, 2)::INT END AS major FROM (SELECT p_partkey, (p_partkey * 37 % 12000)::VARCHAR AS code FROM part))")
def industry_divisions(spark, folder):
    code = (F.col("p_partkey") * 37 % 12000).cast("string")
    return table(spark, folder, "part").select("p_partkey", code.alias("code"), X.sic_division(code).alias("division"))


# Features


@query("""WITH m AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s FROM part) SELECT p_partkey AS node_id, round((p_retailprice - m) / s, 6) AS z FROM part, m""")
def z_scores(spark, folder):
    rows = table(spark, folder, "part").select(F.lit("Part").alias("node_type"), F.col("p_partkey").alias("node_id"), F.lit("price").alias("predicate"), F.col("p_retailprice").alias("value"))
    return encode.z_scores(rows, encode.normalisation(rows)).select("node_id", F.round("z", 6).alias("z"))


def _md5_slots(expr: str, seeds: list[int], part: Part) -> str:
    return " UNION ALL ".join(f"SELECT k, ('0x' || substr(md5({expr} || '#{s}'), 1, 8))::BIGINT % {part.dim} + {part.start} AS dim FROM x" for s in seeds)


_CAT = node_layout(64)["categorical"]


@query(f"WITH x AS (SELECT p_partkey AS k, 'type::' || p_type AS a, 'brand::' || p_brand AS b FROM part), e AS ({_md5_slots('a', [600, 607, 613, 631], _CAT)} UNION ALL {_md5_slots('b', [600, 607, 613, 631], _CAT)}) SELECT k AS node_id, dim::INT AS dim, count(*)::DOUBLE AS value FROM e GROUP BY 1, 2")
def categorical_slots(spark, folder):
    pairs_ = F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(c).alias("value")) for n, c in (("type", "p_type"), ("brand", "p_brand"))])
    rows = table(spark, folder, "part").select(F.lit("Part").alias("node_type"), F.col("p_partkey").alias("node_id"), F.explode(pairs_).alias("x")).select("node_type", "node_id", "x.*")
    out = encode.categorical_entries(rows, encode.numeric_shares(rows), node_layout(64), at=encode.slot_md5)
    return encode.summed(out, ["node_id"])


@query("SELECT vec_id, len(embedding) AS width, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total, round(embedding[1]::DOUBLE, 5) AS first, round(embedding[-1]::DOUBLE, 5) AS last FROM embeddings")
def densify_round_trip(spark, folder):
    rows = table(spark, folder, "embeddings")
    back = dense.densify(dense.sparsify(rows, ["vec_id"], "embedding"), ["vec_id"], 64, rows)
    v = F.col("vector")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select("vec_id", F.size(v).alias("width"), F.round(total, 4).alias("total"), F.round(F.element_at(v, 1).cast("double"), 5).alias("first"), F.round(F.element_at(v, -1).cast("double"), 5).alias("last"))


@query("SELECT (unnest(range(70)))::INT AS dim, CASE WHEN dim < 64 THEN 'varying' ELSE 'zero' END AS kind")
def position_kinds(spark, folder):
    rows = table(spark, folder, "embeddings")
    return dense.position_kinds(dense.sparsify(rows, ["vec_id"], "embedding"), rows.count(), 70).select("dim", "kind")


@query("""WITH s AS (SELECT o_orderkey, o_orderdate, lead(o_orderkey) OVER w AS nx, lead(o_orderdate) OVER w AS nd FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
 SELECT o_orderkey AS src_id, nx AS dst_id, (year(nd) - year(o_orderdate)) * 12.0 + month(nd) - month(o_orderdate) AS delta FROM s WHERE nx IS NOT NULL""")
def edge_month_deltas(spark, folder):
    orders = table(spark, folder, "orders")
    chain = sequence(orders, "o_orderkey", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    t = F.lit("Order")
    edges = chain.select(t.alias("src_type"), F.col("o_orderkey").alias("src_id"), t.alias("dst_type"), F.col("next_o_orderkey").alias("dst_id"))
    values = F.array(F.struct(F.lit("x/hasMonth").alias("predicate"), F.month("o_orderdate").cast("double").alias("value")), F.struct(F.lit("x/hasYear").alias("predicate"), F.year("o_orderdate").cast("double").alias("value")))
    props = orders.select(t.alias("node_type"), F.col("o_orderkey").alias("node_id"), F.explode(values).alias("v")).select("node_type", "node_id", "v.*")
    rows = edge_features_of.with_ends(edges, props, ["month", "year"])
    return rows.select("src_id", "dst_id", ((F.col("dst_year") - F.col("src_year")) * 12 + F.col("dst_month") - F.col("src_month")).alias("delta"))


@query("""WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS w, lead(string_split(p_name, ' ')) OVER (ORDER BY p_partkey) AS v FROM part)
 SELECT p_partkey, round(len(list_intersect(w, v)) / len(list_distinct(list_concat(w, v))), 6) AS sim FROM p WHERE v IS NOT NULL""")
def label_jaccard(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name")
    after = rows.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return rows.join(after, "p_partkey").select("p_partkey", F.round(edge_features_of.word_jaccard(F.col("p_name"), F.col("other")), 6).alias("sim"))


def _graph(spark, folder):
    facts = settle(lift(spark, folder, ["region", "nation", "customer"]), "facts")
    nodes = _nodes(facts)
    return facts, nodes, build.edges(facts, nodes, NAMESPACES), build.literals(facts, nodes, NAMESPACES)


@query()
def node_feature_entries(spark, folder):
    facts, nodes, _, literal_rows = _graph(spark, folder)
    kinds = build.type_uris(facts, nodes, NAMESPACES)
    return encode.node_features(facts, nodes, kinds, literal_rows, node_layout(128), [ONTOLOGY, IDS], [ONTOLOGY])


@query()
def edge_feature_entries(spark, folder):
    orders = table(spark, folder, "orders")
    chain = sequence(orders, "o_orderkey", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    t = F.lit("star_Order")
    edges = chain.select(t.alias("src_type"), F.col("o_orderkey").alias("src_id"), F.lit("star_precedes").alias("relation"), t.alias("dst_type"), F.col("next_o_orderkey").alias("dst_id"))
    values = F.array(*[F.struct(F.lit(p).alias("predicate"), v.cast("double").alias("value")) for p, v in (("x/month", F.month("o_orderdate")), ("x/year", F.year("o_orderdate")), ("x/total", F.col("o_totalprice")))])
    props = orders.select(t.alias("node_type"), F.col("o_orderkey").alias("node_id"), F.explode(values).alias("v")).select("node_type", "node_id", "v.*")
    labels = orders.select(t.alias("node_type"), F.col("o_orderkey").alias("node_id"), F.col("o_orderpriority").alias("label"))
    return edge_features_of.edge_features(edges, props, labels, edge_layout(32))


@query()
def node_vectors(spark, folder):
    facts, nodes, _, literal_rows = _graph(spark, folder)
    kinds = build.type_uris(facts, nodes, NAMESPACES)
    found = encode.node_features(facts, nodes, kinds, literal_rows, node_layout(128), [ONTOLOGY, IDS], [ONTOLOGY])
    return dense.densify(found, ["node_type", "node_id"], 128, nodes)


@query("SELECT 'star_Customer' AS node_type, 2 * (SELECT count(*) FROM customer) AS total, 0 AS month, 0 AS year UNION ALL SELECT 'star_Nation', 2 * (SELECT count(*) FROM nation), 0, 0")
def endpoint_properties(spark, folder):
    rows = [table(spark, folder, "customer").select(F.lit("star_Customer").alias("node_type"), F.explode(F.array(F.lit("balance"), F.lit("size"))).alias("predicate"))]
    rows.append(table(spark, folder, "nation").select(F.lit("star_Nation").alias("node_type"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("predicate")))
    return edge_features_of.property_rows(union_frames(rows))


@query("SELECT relation, CASE relation WHEN 'x_sameAs' THEN 'skip' WHEN 'x_PRECEDES' THEN 'temporal' WHEN 'x_escalatesTo' THEN 'escalation' WHEN 'x_energySectorCorrelation' THEN 'correlation' WHEN 'x_leadsTo' THEN 'causal' WHEN 'x_straddleWith' THEN 'strategy' ELSE 'generic' END AS category FROM (VALUES ('x_sameAs'), ('x_PRECEDES'), ('x_escalatesTo'), ('x_energySectorCorrelation'), ('x_leadsTo'), ('x_straddleWith'), ('x_plain')) AS v(relation)")
def relation_categories(spark, folder):
    names = ["x_sameAs", "x_PRECEDES", "x_escalatesTo", "x_energySectorCorrelation", "x_leadsTo", "x_straddleWith", "x_plain"]
    rows = spark.createDataFrame([(n,) for n in names], "relation string")
    return rows.select("relation", edge_features_of.category(F.col("relation")).alias("category"))


# Sources and sets


@query("""SELECT _source, rows, rows AS distinct_rows, 0 AS duplicates, (SELECT 2 * count(*) FROM nation) AS shared FROM (SELECT 'a' AS _source, (SELECT 3 * count(*) FROM nation) + (SELECT 2 * count(*) FROM region) AS rows
 UNION ALL SELECT 'b', (SELECT 2 * count(*) FROM nation))""")
def source_accounts(spark, folder):
    both = lift(spark, folder, ["nation", "region"]).withColumn("_source", F.lit("a"))
    some = lift(spark, folder, ["nation"]).where(f"predicate <> '{ONTOLOGY}n_name'").withColumn("_source", F.lit("b"))
    return source_statistics(both.unionByName(some))


@query(f"SELECT '{IDS}region/' || r_regionkey AS subject, p AS predicate, o AS object FROM (SELECT r_regionkey, '{TYPE}' AS p, '{ONTOLOGY}Region' AS o FROM region UNION ALL SELECT r_regionkey, '{ONTOLOGY}r_name', r_name FROM region)")
def new_facts(spark, folder):
    return added(lift(spark, folder, ["nation", "region"]), lift(spark, folder, ["nation"]))


@query(f"""SELECT '{IDS}nation/' || n_nationkey AS subject, '{TYPE}' AS predicate, '{ONTOLOGY}Nation' AS object FROM nation UNION ALL SELECT '{IDS}nation/' || n_nationkey, '{ONTOLOGY}n_name', n_name FROM nation
 UNION ALL SELECT '{IDS}nation/' || n_nationkey, '{ONTOLOGY}n_regionkey', '{IDS}region/' || n_regionkey FROM nation""")
def ntriples_round_trip(spark, folder):
    path = fresh_path(spark, "ntriples")
    rdf.write_ntriples(lift(spark, folder, ["nation"]), path)
    return rdf.read_ntriples(spark, path).drop("object_datatype")


@query(f"""SELECT '{IDS}nation/' || n_nationkey AS subject, '{TYPE}' AS predicate, '{ONTOLOGY}Nation' AS object, '' AS object_datatype FROM nation UNION ALL SELECT '{IDS}nation/' || n_nationkey, '{ONTOLOGY}n_name', n_name, 'http://www.w3.org/2001/XMLSchema#string' FROM nation
 UNION ALL SELECT '{IDS}nation/' || n_nationkey, '{ONTOLOGY}n_regionkey', n_regionkey::VARCHAR, 'http://www.w3.org/2001/XMLSchema#integer' FROM nation""")
def turtle_documents(spark, folder):
    head = f"@prefix o: <{ONTOLOGY}> .\n<{IDS}nation/"
    text = F.concat(F.lit(head), F.col("n_nationkey").cast("string"), F.lit('> a o:Nation ; o:n_name "'), "n_name", F.lit('" ; o:n_regionkey '), F.col("n_regionkey").cast("string"), F.lit(" ."))
    return rdf.parse_turtle(table(spark, folder, "nation").select(text.alias("triples")), "triples")


@query("SELECT 'rules' AS phase, (SELECT count(*) FROM nation) + (SELECT count(DISTINCT n_regionkey) FROM nation) * 0 AS added, 5 * (SELECT count(*) FROM customer) + 3 * (SELECT count(*) FROM nation) AS initial")
def enrichment_account(spark, folder):
    facts = lift(spark, folder, ["customer", "nation"])

    def labels(rows: DataFrame) -> DataFrame:
        return as_triples(rows.where(F.col("predicate") == ONTOLOGY + "n_name"), "subject", LABEL, "object")

    _, account = enrich(facts, [Phase("rules", {"labels": labels})])
    return spark.createDataFrame([(k, n, account.initial) for k, n in account.added.items()], "phase string, added long, initial long")


# Patterns and questions


@query(f"SELECT '{IDS}customer/' || c_custkey AS c, r_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'ASIA'")
def graph_pattern(spark, folder):
    facts = lift(spark, folder, ["region", "nation", "customer"])
    found = paths.match(facts, [("?c", ONTOLOGY + "c_nationkey", "?n"), ("?n", ONTOLOGY + "n_regionkey", "?r"), ("?r", ONTOLOGY + "r_name", "?name")], F.col("name") < "ASIA")
    return found.select("c", "name")


@query(f"SELECT 'out' AS direction, 'star_n_regionkey' AS relation, '{IDS}region/' || n_regionkey AS neighbour FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'in', 'star_c_nationkey', '{IDS}customer/' || c_custkey FROM customer WHERE c_nationkey = 3")
def neighbourhood(spark, folder):
    _, nodes, edges, _ = _graph(spark, folder)
    return paths.neighbourhood(paths.named_edges(edges, nodes), IDS + "nation/3")


@query("SELECT n_nationkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_regionkey IN (0, 1)")
def meeting_points(spark, folder):
    reaches = [table(spark, folder, t).select(F.col(c).alias("n_nationkey")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"))]
    return paths.meeting_points([*reaches, table(spark, folder, "nation").where("n_regionkey IN (0, 1)")], "n_nationkey")


@query("""WITH RECURSIVE l AS (SELECT 'c' || c_custkey AS a, 'n' || c_nationkey AS b FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 w AS (SELECT 'r0' AS node, 0 AS distance UNION SELECT u.b, distance + 1 FROM w JOIN u ON u.a = w.node WHERE distance < 6) SELECT node, min(distance) AS distance FROM w GROUP BY node""")
def breadth_first(spark, folder):
    named = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    links = table(spark, folder, "customer").select(named("c", "c_custkey").alias("src"), named("n", "c_nationkey").alias("dst"))
    links = links.unionByName(table(spark, folder, "nation").select(named("n", "n_nationkey").alias("src"), named("r", "n_regionkey").alias("dst")))
    return paths.distances(links, spark.createDataFrame([("r0",)], "node string"))


@query("SELECT o_custkey, count(*) AS contracts, count(*) FILTER (WHERE o_orderstatus = 'F') AS calls, count(*) FILTER (WHERE o_orderstatus = 'O') AS puts, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1")
def chain_summary(spark, folder):
    side = F.when(F.col("o_orderstatus") == "F", "CALL").when(F.col("o_orderstatus") == "O", "PUT")
    return questions.chain_summary(table(spark, folder, "orders").withColumn("side", side), ["o_custkey"], "side", "o_totalprice")


_SPLITS = "SELECT o_custkey AS k, date_trunc('day', o_orderdate)::DATE AS d, 2.0 AS r FROM orders WHERE o_orderkey % 7 = 0"


@query(f"WITH s AS ({_SPLITS}) SELECT o_orderkey, o_totalprice / coalesce((SELECT product(r) FROM s WHERE k = o_custkey AND d > o_orderdate::DATE), 1) AS adjusted FROM orders")
def split_adjusted_prices(spark, folder):
    orders = table(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    splits = orders.where("o_orderkey % 7 = 0").select("o_custkey", F.lit(2.0).alias("shares_after"), F.lit(1.0).alias("shares_before"), F.col("day").alias("split_date"))
    return questions.split_adjusted(orders, splits, "o_custkey", "day", "o_totalprice").select("o_orderkey", "adjusted")


@query("""WITH q AS (SELECT o_custkey AS k, o_orderdate::DATE AS d, arg_max(o_totalprice, o_orderkey) AS c FROM orders GROUP BY 1, 2), n AS (SELECT k, d, c, lead(d) OVER w AS nd, lead(c) OVER w AS nc FROM q WINDOW w AS (PARTITION BY k ORDER BY d)),
 s AS (SELECT DISTINCT o_custkey AS k, o_orderdate::DATE AS sd FROM orders WHERE o_orderkey % 50 = 0) SELECT k AS o_custkey, sd::VARCHAR AS split_date, c AS before, nc AS after FROM n JOIN s USING (k) WHERE d < sd AND nd >= sd""")
def around_splits(spark, folder):
    orders = table(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    splits = orders.where("o_orderkey % 50 = 0").select("o_custkey", F.col("day").alias("split_date")).distinct()
    return questions.around_split(orders, splits, "o_custkey", "day", "o_orderkey", "o_totalprice").withColumn("split_date", F.col("split_date").cast("string"))


@query("SELECT event_id, round(traded, 4) AS traded FROM (SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS traded FROM events) WHERE traded > 0")
def traded_minutes(spark, folder):
    return questions.traded(table(spark, folder, "events"), "user_id", "ts", "value").select("event_id", F.round("traded", 4).alias("traded"))


@query("SELECT p_partkey, round((p_retailprice - p_size) / ((p_retailprice + p_size) / 2) * 10000, 4) AS spread_bp FROM part WHERE p_size > 0 AND p_retailprice >= p_size ORDER BY 2 DESC, 1 LIMIT 5")
def widest_spreads(spark, folder):
    rows = table(spark, folder, "part").withColumn("bid", F.col("p_size").cast("double"))
    return questions.widest_spreads(rows, "p_partkey", "bid", "p_retailprice").select("p_partkey", F.round("spread_bp", 4).alias("spread_bp"))


@query("SELECT p_partkey, round(p_retailprice / p_size - 1, 4) AS move FROM part WHERE p_size > 0 ORDER BY abs(p_retailprice / p_size - 1) DESC, 1 LIMIT 10")
def largest_moves(spark, folder):
    return questions.movers(table(spark, folder, "part"), "p_partkey", "p_size", "p_retailprice").select("p_partkey", F.round("move", 4).alias("move"))


@query("""SELECT user_id, before, after, round(after - before, 4) AS change FROM (SELECT user_id, arg_max(value, ts) FILTER (WHERE ts < TIMESTAMP '2024-01-05') AS before, arg_min(value, ts) FILTER (WHERE ts >= TIMESTAMP '2024-01-05') AS after FROM events GROUP BY 1) WHERE before IS NOT NULL AND after IS NOT NULL""")
def before_after(spark, folder):
    return questions.before_after(table(spark, folder, "events"), "user_id", "ts", "value", "2024-01-05 00:00:00").withColumn("change", F.round("change", 4))


@query("SELECT o_orderdate::DATE::VARCHAR AS capture_time, count(*) FILTER (WHERE o_orderstatus = 'F') AS equities, count(*) FILTER (WHERE o_orderstatus <> 'F') AS options, count(DISTINCT CASE WHEN o_orderstatus <> 'F' THEN o_custkey END) AS underlyings, 5 - count(DISTINCT CASE WHEN o_orderstatus = 'F' AND o_custkey < 5 THEN o_custkey END) AS missing FROM orders GROUP BY 1")
def market_coverage(spark, folder):
    who = F.col("o_custkey").cast("string")
    quotes = table(spark, folder, "orders").select(who.alias("symbol"), F.when(F.col("o_orderstatus") != "F", who).alias("underlying"), _iso("o_orderdate").alias("capture_time"))
    listed = spark.range(5).select(F.col("id").cast("string").alias("ticker"))
    return publish.market_coverage(quotes, listed).withColumn("missing", F.size("missing"))


@query("SELECT c_custkey::VARCHAR AS subject, c_name AS name, c_mktsegment AS segment FROM customer")
def star_properties(spark, folder):
    facts = lift(spark, folder, ["customer"])
    return properties_of(facts, {ONTOLOGY + "c_name": "name", ONTOLOGY + "c_mktsegment": "segment"}).withColumn("subject", X.local_name(F.col("subject")))


@query("SELECT property_uri, domain_uri, range_uri FROM (VALUES ('a', 'D1', 'R1'), ('a', 'D2', 'R1'), ('b', 'D1', NULL), ('c', NULL, 'R2')) AS v(property_uri, domain_uri, range_uri)")
def property_schema(spark, folder):
    from .model import DOMAIN, RANGE

    rows = [("a", DOMAIN, "D1"), ("a", DOMAIN, "D2"), ("a", RANGE, "R1"), ("b", DOMAIN, "D1"), ("c", RANGE, "R2")]
    return schema.property_schema(spark.createDataFrame(rows, "subject string, predicate string, object string"))


@query("SELECT s_nationkey AS code, count(*) AS n FROM supplier GROUP BY 1 HAVING count(*) > 1")
def shared_identifiers(spark, folder):
    rows = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "code")
    return rows.join(hubs.shared_keys(rows, "s_suppkey", "code"), "code").groupBy("code").agg(F.count("*").alias("n"))


@query()
def collision_report(spark, folder):
    facts, nodes, _, _ = _graph(spark, folder)
    kinds = build.type_uris(facts, nodes, NAMESPACES)
    layout = node_layout(128)
    out = dense.collision_report(dense.class_codes(kinds, layout), layout)
    return spark.createDataFrame([(k, str(v)) for k, v in out.items()], "measure string, value string")


@query()
def slot_mapping(spark, folder):
    return encode.slot_mapping(lift(spark, folder, ["customer"]).select("predicate").distinct(), node_layout(128))
