"""The rule sets of plans/domains.py over the supplied tables, which are first put into each source's own vocabulary.

Every query runs the whole rule, and its SQL says the same from the tables alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import meta
from .features import edges as edge_features_of
from .features import encode
from .features.layout import Part, edge_layout, node_layout
from .functions import text as X
from .graph import build
from .lift import IDS, NAMESPACES, ONTOLOGY, lift
from .model import LABEL, TYPE, as_triples, star_properties, union_frames
from .operators import joins, schema
from .plans import domains
from .sources import feeds, load
from .storage import fresh_path, settle
from .tables import publish

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

V = domains.Vocabulary("https://example.org/source/", "https://example.org/derived/", "https://example.org/unified/")


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def facts_of(df: DataFrame, subject: Column, pairs_: dict[str, Column]) -> DataFrame:
    """Triples of a frame: one for each predicate whose value is not null."""
    rows = F.array(*[F.struct(F.lit(p).alias("predicate"), c.cast("string").alias("object")) for p, c in pairs_.items()])
    return df.select(subject.alias("subject"), F.explode(rows).alias("x")).select("subject", "x.*").where("object IS NOT NULL")


def short(triples: DataFrame) -> DataFrame:
    """Local names only."""
    return triples.select(*[X.local_name(F.col(c)).alias(c) for c in ("subject", "predicate", "object")])


def text_of(c: str) -> Column:
    return F.col(c).cast("string")


# Market quotes: an order is an option's or, every fifth, an equity's snapshot


def _market(spark: SparkSession, folder: str, equity_time: str = "") -> DataFrame:
    orders = table(spark, folder, "orders")
    root = F.concat(F.lit("C"), (F.col("o_custkey") % 50).cast("string"))
    right = F.when(F.col("o_orderstatus") == "F", "C").otherwise("P")
    strike = (F.col("o_orderkey") % 20 * 10 + 5) * 1000
    code = F.concat(F.rpad(root, 6, " "), F.lit("30010"), (F.col("o_orderkey") % 3 + 1).cast("string"), right, F.lpad(strike.cast("string"), 8, "0"))
    equity = F.col("o_orderkey") % 5 == 0
    time = F.date_format("o_orderdate", "yyyy-MM")
    rows = {
        TYPE: F.when(equity, V["EquitySnapshot"]).otherwise(V["OptionSnapshot"]),
        V["symbol"]: F.when(equity, root).otherwise(code),
        V["captureTime"]: F.when(equity, F.concat(time, F.lit(equity_time))).otherwise(time),
        V["lastPrice"]: F.when(equity, F.col("o_orderkey") % 190 + 1),
    }
    return facts_of(orders, F.concat(F.lit(IDS + "quote/q"), text_of("o_orderkey")), rows)


_QUOTES = """q AS (SELECT 'q' || o_orderkey AS id, 'C' || (o_custkey % 50) AS u, strftime(o_orderdate, '%Y-%m') AS t, o_orderkey % 5 = 0 AS equity, CASE WHEN o_orderstatus = 'F' THEN 'CALL' ELSE 'PUT' END AS r,
 o_orderkey % 20 * 10 + 5 AS k, o_orderkey % 3 AS e, o_orderkey % 190 + 1 AS price FROM orders), o AS (SELECT * FROM q WHERE NOT equity), s AS (SELECT * FROM q WHERE equity)"""


@query(f"WITH {_QUOTES}, n AS (SELECT id, lead(id) OVER (PARTITION BY equity, u, CASE WHEN equity THEN '' ELSE e || r || k END ORDER BY t, id) AS nx FROM q) SELECT id AS subject, 'precedes' AS predicate, nx AS object FROM n WHERE nx IS NOT NULL")
def quote_chains(spark, folder):
    return short(domains.chained_quotes(_market(spark, folder), V))


@query(f"WITH {_QUOTES} SELECT DISTINCT o.id AS subject, 'hasUnderlyingEquity' AS predicate, s.id AS object FROM o JOIN s USING (u, t)")
def options_to_equities(spark, folder):
    links = domains.option_links(_market(spark, folder), V, X.local_name)
    return links.withColumn("predicate", X.local_name(F.col("predicate")))


@query(f"WITH {_QUOTES}, l AS (SELECT u, arg_max(id, (t, id)) AS id FROM s GROUP BY u) SELECT o.id AS subject, 'hasUnderlyingEquity' AS predicate, l.id AS object FROM o JOIN l USING (u)")
def options_to_latest_equities(spark, folder):
    """No equity has a time that an option has, so the latest of each underlying is taken."""
    return short(domains.option_links(_market(spark, folder, "x"), V))


@query(f"""WITH {_QUOTES}, straddle AS (SELECT c.id AS a, p.id AS b FROM o c JOIN o p USING (u, e, t, k) WHERE c.r = 'CALL' AND p.r = 'PUT'),
 spread AS (SELECT id AS a, r, lead(id) OVER (PARTITION BY r, u, e, t ORDER BY k, id) AS b FROM o),
 m AS (SELECT *, (min(k) OVER w + max(k) OVER w) / 2 AS mid FROM o WINDOW w AS (PARTITION BY u, e, t)),
 up AS (SELECT *, row_number() OVER (PARTITION BY u, e, t ORDER BY k, id) AS n FROM m WHERE r = 'CALL' AND k > mid), low AS (SELECT *, row_number() OVER (PARTITION BY u, e, t ORDER BY k DESC, id) AS n FROM m WHERE r = 'PUT' AND k < mid)
 SELECT a AS subject, 'straddleWith' AS predicate, b AS object FROM straddle UNION ALL SELECT a, CASE r WHEN 'CALL' THEN 'callSpreadWith' ELSE 'putSpreadWith' END, b FROM spread WHERE b IS NOT NULL
 UNION ALL SELECT up.id, 'strangleWith', low.id FROM up JOIN low USING (u, e, t, n) WHERE n <= 10""")
def option_strategies(spark, folder):
    """Straddles, vertical spreads and strangles."""
    return short(domains.strategies(_market(spark, folder), V))


@query(f"""WITH {_QUOTES}, m AS (SELECT DISTINCT o.id, CASE WHEN abs(o.k - s.price) <= s.price * 0.02 THEN 'ATM' WHEN (o.r = 'CALL') = (o.k <= s.price) THEN 'ITM' ELSE 'OTM' END AS m FROM o JOIN s USING (u, t))
 SELECT id AS subject, 'hasMoneyness' AS predicate, m AS object FROM m UNION ALL SELECT DISTINCT m, 'type', 'Moneyness' FROM m""")
def option_moneyness(spark, folder):
    return short(domains.moneyness(_market(spark, folder), V))


_CONSTITUENTS = [(f"C{i}", ["Health Care", "Energy", "Real Estate"][i % 3]) for i in range(40)]
_CONSTITUENT_SQL = ", ".join(f"('{t}', '{s.replace(' ', '')}')" for t, s in _CONSTITUENTS)


@query(f"WITH {_QUOTES}, c(u, sector) AS (VALUES {_CONSTITUENT_SQL}) SELECT id AS subject, 'belongsToSector' AS predicate, sector AS object FROM q JOIN c USING (u) UNION ALL SELECT DISTINCT sector, 'type', 'EquitySector' FROM q JOIN c USING (u)")
def sectors_by_ticker(spark, folder):
    return short(domains.sectors_by_ticker(_market(spark, folder), V, spark.createDataFrame(_CONSTITUENTS, "ticker string, sector string")))


@query("SELECT a.s_suppkey::VARCHAR AS subject, 'sharesSubIndustryWith' AS predicate, b.s_suppkey::VARCHAR AS object FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey::VARCHAR < b.s_suppkey::VARCHAR")
def industry_peers(spark, folder):
    rows = table(spark, folder, "supplier").select(text_of("s_suppkey").alias("company"), F.col("s_nationkey").alias("sub_industry"))
    return short(domains.peers(rows, V))


_EQUITY_SECTORS = ["Energy", "Health Care", "Financials", "Industrials", "Materials"]
_ECONOMIC = ["EnergySector", "FinancialSector", "ManufacturingSector", "RetailSector"]


@query("WITH e AS (SELECT n_nationkey AS id, list_element(['EnergySector', 'FinancialSector', 'ManufacturingSector', 'RetailSector'], (n_nationkey % 4 + 1)::BIGINT) AS target FROM nation), s AS (SELECT r_regionkey AS id, list_element(['Energy', 'Health Care', 'Financials', 'Industrials', 'Materials'], (r_regionkey % 5 + 1)::BIGINT) AS name FROM region), "
       + "x(name, target, confidence) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in domains.SECTOR_CROSSWALK) + ") SELECT DISTINCT 's' || s.id AS subject, p AS predicate, CASE p WHEN 'sectorConfidence' THEN confidence ELSE 'e' || e.id END AS object FROM s JOIN x USING (name) JOIN e USING (target), (VALUES ('correspondsToSector'), ('sectorConfidence')) AS v(p)")
def sector_correspondence(spark, folder):
    pick = lambda names, c: F.element_at(F.array(*map(F.lit, names)), (F.col(c) % len(names) + 1).cast("int"))
    equity = table(spark, folder, "region").select(F.concat(F.lit("s"), text_of("r_regionkey")).alias("uri"), pick(_EQUITY_SECTORS, "r_regionkey").alias("name"))
    economic = table(spark, folder, "nation").select(F.concat(F.lit("e"), text_of("n_nationkey")).alias("uri"), pick(_ECONOMIC, "n_nationkey").alias("name"))
    return short(domains.sector_links(equity, economic, V)).distinct()


@query("SELECT DISTINCT s_suppkey::VARCHAR AS subject, 'leadsTo' AS predicate, c_mktsegment AS object FROM supplier JOIN customer ON s_nationkey = c_nationkey")
def leading_indicators(spark, folder):
    indicators = table(spark, folder, "supplier").select(text_of("s_suppkey").alias("indicator"), F.col("s_nationkey").alias("economic"))
    sectors = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("equity_sector"), F.col("c_nationkey").alias("economic"))
    return short(domains.leading_indicators(indicators, sectors, V))


@query("SELECT 'p' || p_partkey AS subject, 'belongsToSector' AS predicate, CASE " + " ".join(f"WHEN m BETWEEN {a} AND {b} THEN '{s}'" for a, b, _, s in X.SIC_DIVISIONS) + " END AS object FROM (SELECT p_partkey, (p_partkey * 37 % 10000) // 100 AS m FROM part) WHERE object IS NOT NULL")
def sectors_by_industry_code(spark, folder):
    facts = facts_of(table(spark, folder, "part"), F.concat(F.lit(IDS + "part/p"), text_of("p_partkey")), {V["sic"]: F.col("p_partkey") * 37 % 10000})
    return short(domains.sectors_by_sic(facts, V))


# Economic series


@query("SELECT 'm' || o_orderkey AS subject, 'precedes' AS predicate, nx AS object FROM (SELECT o_orderkey, lead('m' || o_orderkey) OVER (PARTITION BY o_custkey % 100 ORDER BY year(o_orderdate), month(o_orderdate), strftime(o_orderdate, '%m'), 'm' || o_orderkey) AS nx FROM orders) WHERE nx IS NOT NULL")
def series_chains(spark, folder):
    rows = {TYPE: F.lit(V["Measurement"]), V["category"]: F.col("o_custkey") % 100, V["year"]: F.year("o_orderdate"), V["month"]: F.date_format("o_orderdate", "MM")}
    facts = facts_of(table(spark, folder, "orders"), F.concat(F.lit(IDS + "measure/m"), text_of("o_orderkey")), rows)
    return short(domains.chained_series(facts, V, {V["Measurement"]: [V["category"], V["year"], V["month"]]}))


_SECTOR_WORDS = {"JewelleryGoods": ["ring", "gem"], "Machinery": ["gear", "widget"], "Colours": ["red", "blue"]}
_SECTOR_VALUES = ", ".join(f"('{s}', '{k}')" for s, ks in _SECTOR_WORDS.items() for k in ks)


@query(f"""WITH p AS (SELECT replace(p_name, ' ', '_') || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_Entity' ELSE '_Other' END AS l FROM part), k(sector, word) AS (VALUES {_SECTOR_VALUES}), h AS (SELECT DISTINCT l, sector FROM p JOIN k ON contains(l, word) WHERE ends_with(l, '_Entity'))
 SELECT l AS subject, 'belongsToSector' AS predicate, sector AS object FROM h UNION ALL SELECT DISTINCT sector, 'type', 'Sector' FROM h UNION ALL SELECT DISTINCT sector, 'label', CASE sector WHEN 'JewelleryGoods' THEN 'Jewellery Goods' ELSE sector END FROM h""")
def keyword_membership(spark, folder):
    local = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), text_of("p_partkey"), F.when(F.col("p_partkey") % 2 == 0, "_Entity").otherwise("_Other"))
    facts = facts_of(table(spark, folder, "part"), F.concat(F.lit(IDS), local), {V["name"]: F.col("p_name")})
    return short(domains.sector_membership(facts, V, _SECTOR_WORDS))


_RELATED = [("N_1", "leads", "N_2"), ("N_2", "follows", "N_3"), ("4", "near", "5")]


@query(f"SELECT DISTINCT a.n_name AS subject, r AS predicate, b.n_name AS object FROM nation a, nation b, (VALUES {', '.join(map(str, _RELATED))}) AS v(p, r, q) WHERE contains(a.n_name, p) AND contains(b.n_name, q) AND a.n_name <> b.n_name")
def curated_correlations(spark, folder):
    facts = facts_of(table(spark, folder, "nation"), F.concat(F.lit(IDS), "n_name"), {LABEL: F.col("n_name")})
    return short(domains.correlations(facts, V, _RELATED))


@query("SELECT p_partkey, prefix || '/' || word AS rule FROM part, (VALUES ('red', 'ring'), ('blue', 'widget'), ('red', 'e')) AS v(prefix, word) WHERE starts_with(p_name, prefix) AND contains(p_name, word)")
def prefix_and_keyword(spark, folder):
    parts = table(spark, folder, "part")
    rules = joins.small_table(parts, [("red", "ring"), ("blue", "widget"), ("red", "e")], "prefix string, word string")
    return joins.containing(parts, F.col("p_name"), rules, "word", "prefix").select("p_partkey", F.concat_ws("/", "prefix", "word").alias("rule"))


# Weather alerts: a supplier is an alert


_EVENTS = [e for some in domains.EVENT_CATEGORIES.values() for e in some] + ["Special Statement"]


def _alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "supplier")
    at = lambda kind: F.concat(F.lit(f"{IDS}{kind}/{kind[0]}"), text_of("s_suppkey"))
    pick = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (c % len(values) + 1).cast("int"))
    k = F.col("s_suppkey")
    sent = F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    return union_frames([
        facts_of(rows, at("alert"), {TYPE: F.lit(V["Alert"]), V["hasInfo"]: at("info"), V["sent"]: F.when(k % 9 != 0, sent)}),
        facts_of(rows, at("info"), {V["hasArea"]: at("region"), V["event"]: pick(_EVENTS, k), V["severity"]: F.concat(F.lit(V.ontology), pick([*domains.SEVERITY, "Unknown"], k)), V["urgency"]: F.concat(F.lit(V.ontology), pick(list(domains.URGENCY), F.floor(k / 5)))}),
        facts_of(rows, at("region"), {V["hasGeocode"]: at("geocode")}),
        facts_of(rows, at("geocode"), {V["code"]: F.col("s_nationkey")}),
    ])


_ALERT_SQL = f"""a AS (SELECT 'a' || s_suppkey AS id, s_nationkey AS code, CASE WHEN s_suppkey % 9 <> 0 THEN '2024-01-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') END AS sent,
 list_element({_EVENTS}, (s_suppkey % {len(_EVENTS)} + 1)::BIGINT) AS event, list_element([1, 2, 3, 4, NULL], (s_suppkey % 5 + 1)::BIGINT) AS s, list_element([0, 1, 2, 3], (s_suppkey // 5 % 4 + 1)::BIGINT) AS u FROM supplier)"""
_CATEGORY_SQL = "c(event, category) AS (VALUES " + ", ".join(f"('{e}', '{c}')" for c, es in domains.EVENT_CATEGORIES.items() for e in es) + ")"


@query(f"""WITH {_ALERT_SQL}, {_CATEGORY_SQL}, l AS (SELECT * FROM a WHERE sent IS NOT NULL),
 n AS (SELECT id, lead(id) OVER (PARTITION BY code ORDER BY sent, id) AS nx FROM l),
 g AS (SELECT id, s, u, lead(id) OVER w AS nx, lead(s) OVER w AS ns, lead(u) OVER w AS nu FROM l WHERE s IS NOT NULL WINDOW w AS (PARTITION BY code ORDER BY sent, id))
 SELECT id AS subject, 'precedes' AS predicate, nx AS object FROM n WHERE nx IS NOT NULL UNION ALL SELECT x.id, 'affectsSameRegion', y.id FROM a x JOIN a y ON x.code = y.code AND x.id < y.id
 UNION ALL SELECT x.id, 'sameEventType', y.id FROM a x JOIN a y ON x.event = y.event AND x.id < y.id UNION ALL SELECT id, 'escalatesTo', nx FROM g WHERE ns > s OR ns = s AND nu > u
 UNION ALL SELECT id, 'hasEventClassification', category FROM a JOIN c USING (event) UNION ALL SELECT id, category, event FROM a JOIN c USING (event)""")
def alert_rules(spark, folder):
    """Chains by place, alerts of one place or event, escalations, event classes."""
    return short(domains.alert_rules(_alerts(spark, folder), V))


_STATES = ["NY", "TX", "CA", "OH", "WA", "XX"]


@query("SELECT n_nationkey, state, region AS census_region FROM (SELECT n_nationkey, list_element(['NY', 'TX', 'CA', 'OH', 'WA', 'XX'], (n_nationkey % 6 + 1)::BIGINT) AS state FROM nation) JOIN (VALUES ('NY', 'Northeast'), ('TX', 'South'), ('CA', 'West'), ('OH', 'Midwest'), ('WA', 'West')) AS v(state, region) USING (state)")
def census_regions(spark, folder):
    rows = table(spark, folder, "nation").select("n_nationkey", F.element_at(F.array(*map(F.lit, _STATES)), (F.col("n_nationkey") % 6 + 1).cast("int")).alias("state"))
    return domains.state_regions(rows, "state").select("n_nationkey", "state", "census_region")


# Filings: an order is a filing of its customer


def _filings(spark: SparkSession, folder: str) -> DataFrame:
    """Even filings state their date, odd ones refer to a node that does; every tenth has both, of which its own counts."""
    rows = table(spark, folder, "orders")
    at = lambda kind: F.concat(F.lit(f"{IDS}{kind}/{kind[0]}"), text_of("o_orderkey"))
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")
    own = {TYPE: F.lit(V["OwnershipForm"]), V["hasOwner"]: text_of("o_custkey"), V["date"]: F.when(k % 2 == 0, day), V["hasPeriod"]: F.when((k % 2 == 1) | (k % 10 == 0), at("period"))}
    return facts_of(rows, at("filing"), own).unionByName(facts_of(rows.where("o_orderkey % 2 = 1 OR o_orderkey % 10 = 0"), at("period"), {V["date"]: F.when(k % 10 == 0, F.lit("1900-01-01")).otherwise(day)}))


@query("SELECT 'f' || o_orderkey AS subject, 'precedes' AS predicate, nx AS object FROM (SELECT o_orderkey, lead('f' || o_orderkey) OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d'), 'f' || o_orderkey) AS nx FROM orders) WHERE nx IS NOT NULL")
def filing_chains(spark, folder):
    return short(domains.filing_chains(_filings(spark, folder), V, "OwnershipForm", "hasOwner", "date"))


_UNIFIED = """WITH k AS (SELECT '{p}' || {id} AS id, {key}::VARCHAR AS k FROM {t}), m AS (SELECT k FROM k GROUP BY k HAVING count(DISTINCT id) > 1)
 SELECT id AS subject, 'sameAs' AS predicate, 'Company_' || k AS object FROM k JOIN m USING (k) UNION ALL SELECT 'Company_' || k, 'type', 'Company' FROM m UNION ALL SELECT 'Company_' || k, 'hasCik', k FROM m"""


@query(_UNIFIED.format(p="s", id="s_suppkey", key="s_nationkey", t="supplier"))
def unified_companies(spark, folder):
    rows = table(spark, folder, "supplier")
    return short(domains.unified_companies(facts_of(rows, F.concat(F.lit(IDS + "supplier/s"), text_of("s_suppkey")), {V["cik"]: F.col("s_nationkey")}), V))


@query(_UNIFIED.format(p="c", id="c_custkey", key="(c_custkey // 3)", t="customer").replace("FROM customer)", "FROM customer WHERE c_nationkey <> 4)"))
def unified_persons(spark, folder):
    """The same rule by the owners' key."""
    rows = table(spark, folder, "customer")
    key = F.when(F.col("c_nationkey") != 4, F.floor(F.col("c_custkey") / 3))
    return short(domains.unified_companies(facts_of(rows, F.concat(F.lit(IDS + "customer/c"), text_of("c_custkey")), {V["ownerCik"]: key}), V, "ownerCik"))


@query("""WITH t AS (SELECT 'T' || (n_nationkey % 20) AS ticker, min(n_nationkey + 100) AS any_cik, min(CASE WHEN n_nationkey % 2 = 1 THEN n_nationkey + 100 END) AS stated FROM nation GROUP BY 1), p AS (SELECT ticker, coalesce(stated, any_cik)::VARCHAR AS cik FROM t),
 u AS (SELECT 'U' || r_regionkey AS cusip, 'T' || r_regionkey AS ticker FROM region),
 l AS (SELECT 's' || s_suppkey AS id, (s_nationkey + 100)::VARCHAR AS cik FROM supplier WHERE s_suppkey % 3 = 0 UNION SELECT 's' || s_suppkey, cik FROM supplier JOIN p ON ticker = 'T' || s_nationkey WHERE s_suppkey % 3 = 1 UNION SELECT 's' || s_suppkey, cik FROM supplier JOIN u ON cusip = 'U' || s_nationkey JOIN p USING (ticker) WHERE s_suppkey % 3 = 2),
 c AS (SELECT DISTINCT cik FROM l) SELECT 'Company_' || cik AS subject, 'type' AS predicate, 'Company' AS object FROM c UNION ALL SELECT 'Company_' || cik, 'hasCik', cik FROM c UNION ALL SELECT 'Company_' || cik, 'hasTicker', ticker FROM c JOIN p USING (cik) UNION ALL SELECT id, 'refersToCompany', 'Company_' || cik FROM l""")
def company_hub(spark, folder):
    """By CIK, by ticker through the stated or else lowest pairing, by CUSIP through its first ticker."""
    suppliers = table(spark, folder, "supplier").withColumn("subject", F.concat(F.lit(IDS + "supplier/s"), text_of("s_suppkey")))
    some = lambda i, name, c: suppliers.where(F.col("s_suppkey") % 3 == i).select("subject", c.alias(name))
    nations = table(spark, folder, "nation")
    n = F.col("n_nationkey")
    tickers = nations.select(F.concat(F.lit("T"), (n % 20).cast("string")).alias("ticker"), (n + 100).cast("string").alias("cik"), F.when(n % 2 == 1, 0).otherwise(1).alias("priority"))
    r = text_of("r_regionkey")
    cusips = table(spark, folder, "region").select(F.concat(F.lit("U"), r).alias("cusip"), F.explode(F.array(F.concat(F.lit("T"), r), F.concat(F.lit("TX"), r))).alias("ticker"))
    nation = text_of("s_nationkey")
    out = domains.company_hub(some(0, "cik", (F.col("s_nationkey") + 100).cast("string")), some(1, "ticker", F.concat(F.lit("T"), nation)), some(2, "cusip", F.concat(F.lit("U"), nation)), tickers, cusips, V)
    return short(out)


@query("""WITH c AS (SELECT DISTINCT 'Item_' || (o_orderkey % 9) || '.0' || (o_orderkey % 4) AS uri, (o_orderkey % 9) || '.0' || (o_orderkey % 4) AS code FROM orders)
 SELECT uri AS subject, 'type' AS predicate, 'Item' AS object FROM c UNION ALL SELECT uri, 'hasCode', code FROM c UNION ALL SELECT uri, 'label', 'Item ' || code FROM c""")
def linked_items(spark, folder):
    item = F.concat(F.lit(IDS + "Item_"), (F.col("o_orderkey") % 9).cast("string"), F.lit(".0"), (F.col("o_orderkey") % 4).cast("string"))
    facts = facts_of(table(spark, folder, "orders"), F.concat(F.lit(IDS), text_of("o_orderkey")), {V["hasItem"]: item})
    out = domains.linked_codes(facts, V, "hasItem", "Item", X.item_number)
    return short(out)


@query("""WITH c AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'us-gaap_' ELSE 'own_' END || replace(p_type, ' ', '') AS uri, CASE WHEN p_size % 2 = 0 THEN 'us-gaap:' || replace(p_type, ' ', '') ELSE 'ext:own_' || replace(p_type, ' ', '') END AS code FROM part)
 SELECT uri AS subject, 'type' AS predicate, 'Concept' AS object FROM c UNION ALL SELECT uri, 'hasCode', code FROM c UNION ALL SELECT uri, 'label', 'Concept ' || code FROM c""")
def linked_concepts(spark, folder):
    concept = F.concat(F.lit(IDS), F.when(F.col("p_size") % 2 == 0, "us-gaap_").otherwise("own_"), F.replace("p_type", F.lit(" "), F.lit("")))
    facts = facts_of(table(spark, folder, "part"), F.concat(F.lit(IDS), text_of("p_partkey")), {V["hasConcept"]: concept})
    return short(domains.linked_codes(facts, V, "hasConcept", "Concept", lambda c: X.concept_name(c, ["us-gaap", "dei"])))


_VIOLATIONS = {"LateFiling": {IDS + "nation/": ["N_1", "N_2"], IDS + "region/": ["AS"]}, "Fraud": {IDS + "nation/": ["N_3"], IDS + "customer/": ["x"]}}


@query(f"""WITH n AS (SELECT 'n' || n_nationkey AS id, 'nation' AS ns, n_name AS label FROM nation UNION ALL SELECT 'r' || r_regionkey, 'region', r_name FROM region), k(violation, ns, word) AS (VALUES ('LateFiling', 'nation', 'N_1'), ('LateFiling', 'nation', 'N_2'), ('LateFiling', 'region', 'AS'), ('Fraud', 'nation', 'N_3')),
 h AS (SELECT DISTINCT id, violation, ns FROM n JOIN k USING (ns) WHERE contains(label, word))
 SELECT id AS subject, 'type' AS predicate, violation AS object FROM h UNION ALL SELECT DISTINCT violation, 'label', CASE violation WHEN 'LateFiling' THEN 'Late Filing' ELSE violation END FROM h UNION ALL SELECT a.id, a.violation || 'Link', b.id FROM h a JOIN h b USING (violation) WHERE a.ns < b.ns""")
def violation_links(spark, folder):
    """Types by keyword of a label or address, and links between sources that share one."""
    facts = facts_of(table(spark, folder, "nation"), F.concat(F.lit(IDS + "nation/n"), text_of("n_nationkey")), {LABEL: F.col("n_name")})
    facts = facts.unionByName(facts_of(table(spark, folder, "region"), F.concat(F.lit(IDS + "region/r"), text_of("r_regionkey")), {LABEL: F.col("r_name")}))
    return short(domains.violations(facts, V, _VIOLATIONS))


# Schema


@query(f"SELECT 'schemes' AS part, subject, predicate, object FROM (VALUES ('a', 'type', 'ConceptScheme'), ('a', 'prefLabel', 'Alpha'), ('b', 'type', 'ConceptScheme'), ('b', 'prefLabel', 'Beta')) AS v(subject, predicate, object) UNION ALL SELECT DISTINCT 'routes', p_type, 'derivedBy', 'brand' FROM part UNION ALL SELECT 'members', r_regionkey::VARCHAR, '_' || (r_regionkey + 1), r_name FROM region")
def schemes_and_routes(spark, folder):
    """Concept schemes, markers of the rule that derived an axiom, and members of a container."""
    one = schema.concept_schemes(spark, {V.ids + "b": "Beta", V.ids + "a": "Alpha"})
    two = schema.route_markers(table(spark, folder, "part").select(F.col("p_type").alias("child"), F.lit("brand").alias("rule")), V["derivedBy"])
    regions = table(spark, folder, "region")
    three = union_frames([as_triples(regions.where(F.col("r_regionkey") == i), text_of("r_regionkey"), schema.container_membership(i + 1), "r_name") for i in range(5)])
    return union_frames([x.select(F.lit(n).alias("part"), *[X.local_name(F.col(c)).alias(c) for c in ("subject", "predicate", "object")]) for n, x in (("schemes", one), ("routes", two), ("members", three))])


@query("SELECT 's' || s_suppkey AS subject, s_name AS name, phone FROM supplier JOIN (SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 2 = 0 THEN ['1', '2'] ELSE ['1'] END) AS phone FROM supplier) USING (s_suppkey)")
def property_star(spark, folder):
    """A join for each property, so two values make two rows."""
    rows = table(spark, folder, "supplier")
    at = F.concat(F.lit("s"), text_of("s_suppkey"))
    facts = facts_of(rows, at, {V["name"]: F.col("s_name"), V["phone"]: F.lit("1")}).unionByName(facts_of(rows.where("s_suppkey % 2 = 0"), at, {V["phone"]: F.lit("2")}))
    return star_properties(rows.select(at.alias("subject")), facts, {V["name"]: "name", V["phone"]: "phone"})


@query("SELECT n_name AS uri, regexp_extract(n_name, '([^/#]+)$', 1) AS local, '_' || trim(regexp_replace(lower(regexp_replace(n_name, '[^A-Za-z]+', '_', 'g')), '^_+|_+$', '', 'g')) || '_' AS slug, trim(regexp_replace('ab' || n_name, '([A-Z])', ' \\1', 'g')) AS spaced, right(lpad(n_nationkey::VARCHAR, 5, '0'), 2) AS state FROM nation")
def names_of_nations(spark, folder):
    n = F.col("n_name")
    code = F.concat(F.lpad(text_of("n_nationkey"), 5, "0"), F.lit(" "))
    return table(spark, folder, "nation").select(n.alias("uri"), X.local_name(n).alias("local"), X.slug(n).alias("slug"), X.spaced(F.concat(F.lit("ab"), n)).alias("spaced"), X.state_code(code).alias("state"))


# Features, with slots that SQL can compute


def _slot_sql(text: str, seed: int, part: Part) -> str:
    return f"('0x' || substr(md5({text} || '#{seed}'), 1, 8))::BIGINT % {part.dim} + {part.start}"


def _entries_sql(rows: list[tuple[str, str, str]], keys: str) -> str:
    """rows: (frame, column, value)."""
    return " UNION ALL ".join(f"SELECT {keys}, ({d})::INT AS dim, ({v})::DOUBLE AS value FROM {t}" for t, d, v in rows)


_NODES = node_layout(128)
_PARTY, _AGENT, _NAMED = ONTOLOGY + "Party", ONTOLOGY + "Agent", ONTOLOGY + "named"
_AXIOMS = [
    (ONTOLOGY + "Customer", "subClassOf", _PARTY), (_PARTY, "subClassOf", _AGENT), (ONTOLOGY + "c_nationkey", "domain", ONTOLOGY + "Customer"),
    (ONTOLOGY + "c_nationkey", "range", ONTOLOGY + "Nation"), (ONTOLOGY + "n_regionkey", "domain", ONTOLOGY + "Nation"), (ONTOLOGY + "c_name", "subPropertyOf", _NAMED), (ONTOLOGY + "n_name", "subPropertyOf", _NAMED),
]


def _node_feature_sql() -> str:
    at = lambda text, seed, part: _slot_sql(text, seed, _NODES[part])
    source = _NODES["ontology_source"]
    half = max(1, _NODES["domain_range"].dim // 2)
    first, second = Part(_NODES["domain_range"].start, half), Part(_NODES["domain_range"].start + half, max(1, _NODES["domain_range"].dim - half))
    rows = [("n", at("kind", s, "class_identity"), "1") for s in encode.SEEDS]
    rows += [("h", at("parent", s + 100, "class_hierarchy"), "1 / depth") for s in encode.SEEDS[:2]]
    rows += [("n", f"{source.start}", "1"), ("n", f"({_slot_sql(repr(IDS), 700, Part(0, source.dim))} + {source.dim // 2}) % {source.dim} + {source.start}", "0.5")]
    rows += [("p", at("pred", s + 200, "property_presence"), "1") for s in encode.SEEDS[:3]]
    rows += [("p JOIN dom USING (pred)", _slot_sql("cls", 300, first), "1"), ("p JOIN ran USING (pred)", _slot_sql("cls", 301, second), "1")]
    rows += [("p JOIN sup USING (pred)", at("parent", s + 400, "property_hierarchy"), "1") for s in encode.SEEDS[:2]]
    rows += [("z", at("pred", 500, "numeric"), "z")]
    rows += [("c", at("pred || '::' || v", s + 600, "categorical"), "1") for s in encode.SEEDS]
    o = ONTOLOGY
    return f"""WITH n AS (SELECT 'star_Customer' AS t, '{IDS}customer/' || c_custkey AS uri, '{o}Customer' AS kind FROM customer UNION ALL SELECT 'star_Nation', '{IDS}nation/' || n_nationkey, '{o}Nation' FROM nation UNION ALL SELECT 'star_Region', '{IDS}region/' || r_regionkey, '{o}Region' FROM region),
 h AS (SELECT t, uri, parent, depth FROM n, (VALUES ('{_PARTY}', 1), ('{_AGENT}', 2)) AS v(parent, depth) WHERE t = 'star_Customer'),
 l AS (SELECT 'star_Customer' AS t, '{IDS}customer/' || c_custkey AS uri, unnest(['{o}c_name', '{o}c_mktsegment', '{o}c_acctbal']) AS pred, unnest([c_name, c_mktsegment, c_acctbal::VARCHAR]) AS v FROM customer UNION ALL SELECT 'star_Nation', '{IDS}nation/' || n_nationkey, '{o}n_name', n_name FROM nation UNION ALL SELECT 'star_Region', '{IDS}region/' || r_regionkey, '{o}r_name', r_name FROM region),
 p AS (SELECT t, uri, pred FROM l UNION ALL SELECT t, uri, '{o}c_nationkey' FROM n WHERE t = 'star_Customer' UNION ALL SELECT t, uri, '{o}n_regionkey' FROM n WHERE t = 'star_Nation'),
 dom(pred, cls) AS (VALUES ('{o}c_nationkey', '{o}Customer'), ('{o}n_regionkey', '{o}Nation')), ran(pred, cls) AS (VALUES ('{o}c_nationkey', '{o}Nation')), sup(pred, parent) AS (VALUES ('{o}c_name', '{_NAMED}'), ('{o}n_name', '{_NAMED}')),
 z AS (SELECT t, uri, pred, (v::DOUBLE - avg(v::DOUBLE) OVER ()) / stddev_samp(v::DOUBLE) OVER () AS z FROM l WHERE pred = '{o}c_acctbal'), c AS (SELECT * FROM l WHERE pred <> '{o}c_acctbal'),
 e AS ({_entries_sql(rows, "t, uri")}) SELECT t AS node_type, uri, dim, round(sum(value), 4) AS value FROM e GROUP BY ALL"""


@query(_node_feature_sql())
def node_features_by_digest(spark, folder):
    """All parts of a node's vector, with a subclass chain, domains, ranges and a super-property."""
    from .model import RDFS, TRIPLES

    facts = lift(spark, folder, ["region", "nation", "customer"])
    facts = settle(facts.unionByName(spark.createDataFrame([(a, RDFS + p, b) for a, p, b in _AXIOMS], TRIPLES)), "facts")
    nodes = settle(build.nodes(facts, NAMESPACES), "nodes")
    kinds = build.type_uris(facts, nodes, NAMESPACES)
    out = encode.node_features(facts, nodes, kinds, build.literals(facts, nodes, NAMESPACES), _NODES, [ONTOLOGY, IDS], [ONTOLOGY], at=encode.slot_md5)
    return out.join(nodes, ["node_type", "node_id"]).select("node_type", "uri", "dim", F.round("value", 4).alias("value"))


_EDGES = edge_layout(32)


def _context_sql(frame: str, relation: str, category: str) -> list[tuple[str, str, str]]:
    ns, ls, ri = _EDGES["namespace"], _EDGES["label_similarity"], _EDGES["relation_identity"]
    rest = Part(ns.start + 2, max(1, ns.dim - 2))
    rows = [(frame, f"{ns.start}", "1"), (frame, f"{ns.start + 1}", "0")]
    for s in encode.SEEDS[:2]:
        rows += [(frame, _slot_sql("'star'", s + 700, rest), "1"), (frame, _slot_sql("'star'", s + 710, rest), "0.5"), (frame, _slot_sql(f"'{relation}'", s + 900, ri), "1")]
    return [*rows, (frame, _slot_sql(f"'{category}'", 950, ri), "0.5"), (frame, _slot_sql(f"'{category}'", 810, ls), "1")]


def _chain_feature_sql() -> str:
    td, pf, way, d, r, m = (_EDGES[n] for n in ("time_delta", "period_flags", "direction", "difference", "ratio", "magnitude"))
    rows = [("c", _slot_sql("'time_delta'", 0, td), "delta / 12"), ("c", _slot_sql("'abs_time_delta'", 7, td), "abs(delta) / 12"), ("c", f"{pf.start}", "(y1 = y2)::INT"), ("c", f"{pf.start + 1}", "(abs(delta) = 1)::INT")]
    rows += [("c", f"{pf.start + 2}", "(y1 = y2 AND floor((m1 - 1) / 3) = floor((m2 - 1) / 3))::INT"), ("c", f"{way.start}", "sign(delta)")]
    for p, a, b in (("x/month", "m1", "m2"), ("x/year", "y1", "y2"), ("x/total", "v1", "v2")):
        rows += [("c", _slot_sql(f"'{p}'", 500, d), f"{b} - {a}"), ("c", _slot_sql(f"'{p}'", 501, r), f"CASE WHEN abs({a}) > 1e-8 THEN greatest(-10, least(10, {b} / {a})) ELSE 0 END"), ("c", _slot_sql(f"'{p}'", 502, m), f"(abs({a}) + abs({b})) / 2")]
    rows += _context_sql("c", "star_precedes", "temporal")
    return f"""WITH o AS (SELECT o_orderkey AS id, month(o_orderdate)::DOUBLE AS m1, year(o_orderdate)::DOUBLE AS y1, o_totalprice::DOUBLE AS v1, lead(o_orderkey) OVER w AS nx, lead(month(o_orderdate)::DOUBLE) OVER w AS m2, lead(year(o_orderdate)::DOUBLE) OVER w AS y2, lead(o_totalprice::DOUBLE) OVER w AS v2 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
 c AS (SELECT *, (y2 - y1) * 12 + m2 - m1 AS delta, row_number() OVER (ORDER BY id, nx) - 1 AS edge_idx FROM o WHERE nx IS NOT NULL), e AS ({_entries_sql(rows, "edge_idx")})
 SELECT 'star_precedes' AS relation, edge_idx, dim, round(sum(value), 4) AS value FROM e GROUP BY ALL"""


def _order_edges(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    from .operators.sequence import sequence

    orders = table(spark, folder, "orders")
    chain = sequence(orders, "o_orderkey", ["o_custkey"], ["o_orderdate", "o_orderkey"])
    t, node = F.lit("star_Order"), F.col("o_orderkey").alias("node_id")
    edges = chain.select(t.alias("src_type"), F.col("o_orderkey").alias("src_id"), F.lit("star_precedes").alias("relation"), t.alias("dst_type"), F.col("next_o_orderkey").alias("dst_id"))
    values = F.array(*[F.struct(F.lit(p).alias("predicate"), v.cast("double").alias("value")) for p, v in (("x/month", F.month("o_orderdate")), ("x/year", F.year("o_orderdate")), ("x/total", F.col("o_totalprice")))])
    props = orders.select(t.alias("node_type"), node, F.explode(values).alias("v")).select("node_type", "node_id", "v.*")
    return edges, props, orders.select(t.alias("node_type"), node, F.col("o_orderpriority").alias("label"))


@query(_chain_feature_sql())
def chain_edge_features(spark, folder):
    out = edge_features_of.edge_features(*_order_edges(spark, folder), _EDGES, at=encode.slot_md5)
    return out.select("relation", "edge_idx", "dim", F.round("value", 4).alias("value"))


def _fallback_sql() -> str:
    d, r, m = _EDGES["difference"], _EDGES["ratio"], _EDGES["magnitude"]
    rows = [("o", _slot_sql("'moneyness'", 510, d), "k / p"), ("o", _slot_sql("'log_moneyness'", 511, r), "ln(greatest(k / p, 1e-8))"), ("o", _slot_sql("'strike_stock_diff'", 512, m), "k - p")]
    rows += [("o", _slot_sql("'option_stock'", 50, _EDGES["time_delta"]), "1"), *_context_sql("o", "star_hasUnderlying", "option_stock")]
    worse = [("s", _slot_sql("'severity_delta'", 520, d), "b - a"), ("s", _slot_sql("'escalation'", 50, _EDGES["time_delta"]), "1"), *_context_sql("s", "star_escalatesTo", "escalation")]
    return f"""WITH o AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS edge_idx, p_size + 1.0 AS k, p_retailprice AS p FROM part), s AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS edge_idx, n_nationkey % 4 AS a, n_regionkey AS b FROM nation),
 e AS (SELECT 'star_hasUnderlying' AS relation, * FROM ({_entries_sql(rows, "edge_idx")}) UNION ALL SELECT 'star_escalatesTo', * FROM ({_entries_sql(worse, "edge_idx")}))
 SELECT relation, edge_idx, dim, round(sum(value), 4) AS value FROM e GROUP BY ALL"""


@query(_fallback_sql())
def compared_edge_features(spark, folder):
    """Edges whose ends share no number: strike against price, severity against severity; a skipped relation has none."""
    parts, nations = table(spark, folder, "part"), table(spark, folder, "nation")
    edge = lambda df, a, i, r, b, j: df.select(F.lit(a).alias("src_type"), F.col(i).alias("src_id"), F.lit(r).alias("relation"), F.lit(b).alias("dst_type"), F.col(j).alias("dst_id"))
    edges = union_frames([edge(parts, "star_Option", "p_partkey", "star_hasUnderlying", "star_Stock", "p_partkey"), edge(nations, "star_Old", "n_nationkey", "star_escalatesTo", "star_New", "n_nationkey"), edge(nations, "star_Old", "n_nationkey", "star_sameAs", "star_New", "n_nationkey")])
    prop = lambda df, t, i, p, v: df.select(F.lit(t).alias("node_type"), F.col(i).alias("node_id"), F.lit(p).alias("predicate"), v.cast("double").alias("value"))
    props = union_frames([
        prop(parts, "star_Option", "p_partkey", "x/strikePrice", F.col("p_size") + 1), prop(parts, "star_Stock", "p_partkey", "x/lastPrice", F.col("p_retailprice")),
        prop(nations, "star_Old", "n_nationkey", "x/severityBefore", F.col("n_nationkey") % 4), prop(nations, "star_New", "n_nationkey", "x/severityAfter", F.col("n_regionkey")),
    ])
    labels = nations.select(F.lit("star_Old").alias("node_type"), F.col("n_nationkey").alias("node_id"), F.col("n_name").alias("label"))
    out = edge_features_of.edge_features(edges, props, labels, _EDGES, at=encode.slot_md5)
    return out.select("relation", "edge_idx", "dim", F.round("value", 4).alias("value"))


@query("SELECT relation, cat AS category, count(*) AS edges, max(edge_idx) + 1 AS numbered FROM (SELECT relation, cat, row_number() OVER (PARTITION BY relation ORDER BY c_custkey) - 1 AS edge_idx FROM customer, (VALUES ('star_precedes', 'temporal'), ('star_plain', 'generic')) AS v(relation, cat)) GROUP BY ALL")
def edge_numbers(spark, folder):
    """Enabled categories only, numbered without gaps in each type."""
    rows = table(spark, folder, "customer").select(F.lit("star_C").alias("src_type"), F.col("c_custkey").alias("src_id"), F.explode(F.array(*map(F.lit, ["star_precedes", "star_plain", "star_straddleWith"]))).alias("relation"), F.lit("star_N").alias("dst_type"), F.col("c_nationkey").alias("dst_id"))
    return edge_features_of.indexed(rows, ["temporal", "generic"]).groupBy("relation", "category").agg(F.count("*").alias("edges"), (F.max("edge_idx") + 1).alias("numbered"))


# Feeds, tables and metadata, written and read again


@query("SELECT 'orders' AS t, count(*) AS n, round(sum(o_totalprice)) AS total, 1 AS days FROM orders UNION ALL SELECT 'by_day', count(*), round(sum(o_totalprice)), (SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) FROM orders) FROM orders UNION ALL SELECT 'triples', 3 * count(*), NULL, NULL FROM nation")
def published_tables(spark, folder):
    """One day of a table twice, of which the second replaces the first, many days of another (here months), and triples."""
    root = fresh_path(spark, "tables")
    orders = table(spark, folder, "orders")
    publish.publish(orders.limit(3), root, "minute_quotes", "2024-01-01")
    publish.publish(orders.withColumnsRenamed({"o_orderkey": "ticker", "o_orderdate": "capture_time"}), root, "minute_quotes", "2024-01-01", 1 << 20)
    publish.publish_days(orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-01")).repartition("day"), root, "by_day")
    publish.save_triples(lift(spark, folder, ["nation"]), f"{root}/triples", 3)
    summed = lambda path, name: spark.read.parquet(path).agg(F.lit(name).alias("t"), F.count("*").alias("n"), F.round(F.sum("o_totalprice")).alias("total"), F.countDistinct("day").cast("int").alias("days"))
    triples = publish.load_triples(spark, f"{root}/triples").agg(F.lit("triples").alias("t"), F.count("*").alias("n"), F.lit(None).cast("double").alias("total"), F.lit(None).cast("int").alias("days"))
    return union_frames([summed(f"{root}/minute_quotes", "orders"), summed(f"{root}/by_day", "by_day"), triples])


@query("SELECT * FROM (SELECT 'C' || n_nationkey AS ticker, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey + 1.0 END AS after, CASE WHEN n_nationkey % 2 = 0 THEN 2.0 END AS before, '2024-03-05' AS split_date FROM nation WHERE n_nationkey % 3 <> 0)")
def splits_of_a_day(spark, folder):
    n = F.col("n_nationkey")
    ratio = F.when(n % 2 == 0, F.concat((F.col("n_regionkey") + 1).cast("string"), F.lit(":2"))).otherwise(F.lit("none"))
    rows = table(spark, folder, "nation").select(F.concat(F.lit(" c"), n.cast("string")).alias("ticker"), ratio.alias("split_ratio"), F.when(n % 3 == 0, "03/06/2024").otherwise("03/05/2024").alias("split_date"))
    out = feeds.splits_of(rows.unionByName(rows), "2024-03-05")
    return out.select("ticker", F.col("shares_after").alias("after"), F.col("shares_before").alias("before"), F.col("split_date").cast("string").alias("split_date"))


@query("SELECT o_orderkey, year(o_orderdate) AS fy, strftime(o_orderdate, '%Y-%m-%d') AS period_end FROM orders WHERE o_orderkey % 4 = 1 AND o_orderstatus <> 'F'")
def facts_filed_on_a_day(spark, folder):
    filed = F.when(F.col("o_orderkey") % 4 == 1, "2024-03-05").otherwise("2024-03-04")
    rows = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("fy"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("period_end"), filed.alias("filed"), F.when(F.col("o_orderstatus") == "F", "repeated").when(F.col("o_orderstatus") == "O", "new").alias("status"))
    return feeds.company_facts_of(rows, "2024-03-05").select("o_orderkey", "fy", F.col("period_end").cast("string").alias("period_end"))


@query("SELECT user_id::VARCHAR AS ticker, strftime(ts, '%Y-%m-%d %H:%M') AS minute, arg_min(value, event_id) AS last FROM events GROUP BY 1, 2")
def quotes_by_minute(spark, folder):
    """A ticker's quotes of one minute are one, from the first file."""
    rows = table(spark, folder, "events").select(F.col("user_id").alias("symbol"), F.col("value").alias("lastPrice"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_file"))
    return feeds.minute_quotes_of(rows).select("ticker", F.col("capture_time").alias("minute"), "last")


@query("SELECT user_id, round(last(value ORDER BY ts, event_id), 4) AS last, count(*) AS quotes FROM events WHERE ts <= TIMESTAMP '2024-01-10 12:00:00' GROUP BY 1")
def cross_section(spark, folder):
    """Each symbol's newest quote up to a minute."""
    from .tables import questions

    out = questions.cross_section(table(spark, folder, "events"), "user_id", "ts", "value", "2024-01-10 12:00:00", "event_id")
    return out.select("user_id", F.round("value", 4).alias("last"), "quotes")


@query("SELECT 'Customer_' || c_custkey AS subject, 'o' || (o_orderkey % 3) AS item, strftime(o_orderdate, '%Y') AS period, round(max_by(o_totalprice, (o_orderdate, o_orderkey)), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def number_series(spark, folder):
    """A company's numbers by item and period: the one filed last."""
    from .tables import questions

    rows = table(spark, folder, "orders").select(F.concat(F.lit("Customer_"), text_of("o_custkey")).alias("subject"), F.concat(F.lit("o"), (F.col("o_orderkey") % 3).cast("string")).alias("item"), F.date_format("o_orderdate", "yyyy").alias("period"), F.col("o_orderdate").alias("filed"), "o_orderkey", F.col("o_totalprice").alias("value"))
    known = table(spark, folder, "customer").select(F.concat(F.lit("Customer_"), text_of("c_custkey")).alias("subject"))
    return questions.number_series(rows, ["subject", "item"], "period", ["filed", "o_orderkey"], "value").join(known, "subject").select("subject", "item", "period", F.round("value", 2).alias("value"))


@query("SELECT 'star_' || k AS name, n AS count, '" + ONTOLOGY + "' || k AS type_uri FROM (SELECT 'Region' AS k, (SELECT count(*) FROM region) AS n UNION ALL SELECT 'Nation', (SELECT count(*) FROM nation)) UNION ALL SELECT 'edges', (SELECT count(*) FROM nation), NULL UNION ALL SELECT 'nodes', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region), NULL")
def graph_document(spark, folder):
    """The graph's schema as the JSON document that is written and read again."""
    import json

    facts = settle(lift(spark, folder, ["region", "nation"]), "facts")
    nodes = settle(build.nodes(facts, NAMESPACES), "nodes")
    path = fresh_path(spark, "metadata")
    content = meta.graph_schema(nodes, build.edge_types(build.edges(facts, nodes, NAMESPACES)), build.type_uris(facts, nodes, NAMESPACES))
    meta.write_metadata(spark, path, {"graph_schema": content})
    got = json.loads(spark.read.text(f"{path}/latest/graph_schema.json", wholetext=True).first()[0])
    rows = [(t, x["count"], x["type_uri"]) for t, x in got["node_types"].items()] + [(k, got[k], None) for k in ("nodes", "edges")]
    return spark.createDataFrame(rows, "name string, count long, type_uri string")


@query("WITH x AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer) SELECT 'c_acctbal' AS predicate, round(m, 6) AS mean, round(s, 6) AS std FROM x")
def normalisation_document(spark, folder):
    rows = table(spark, folder, "customer").select(F.lit("C").alias("node_type"), F.col("c_custkey").alias("node_id"), F.lit("c_acctbal").alias("predicate"), F.col("c_acctbal").cast("double").alias("value"))
    got = meta.rounded(meta.normalisation(encode.normalisation(rows)))
    return spark.createDataFrame([(p, round(x["mean"], 6), round(x["std"], 6)) for p, x in got.items()], "predicate string, mean double, std double")


@query("SELECT 'b' || n_nationkey AS source, 2 AS rows FROM nation WHERE n_nationkey < 2 UNION ALL SELECT 'markers', 1")
def loaded_sources(spark, folder):
    """Two folders of documents as two sources, told apart by path; one document of each is malformed and has no rows."""
    root = fresh_path(spark, "feeds")
    head = F.concat(F.lit(f"<{IDS}n"), text_of("n_nationkey"), F.lit(f"> <{ONTOLOGY}name> "))
    good = F.concat(head, F.lit("1 ; a <http://x/T> ."))
    for i in (0, 1):
        some = table(spark, folder, "nation").where(F.col("n_nationkey") == i)
        some.select(good.alias("triples")).unionByName(some.select(F.concat(head, F.lit(" .")).alias("triples"))).write.parquet(f"{root}/b{i}/year=2024/month=03/05")
    sources = [load.Source("b0"), load.Source("other", fragments=("/b1/",))]
    out = load.load_sources(spark, [f"{root}/b0/year=2024/month=03/05", f"{root}/b1/year=2024/month=03/05"], sources)
    marks = F.col("predicate").contains("prov#")
    named = F.when(marks, "markers").when(F.col("_source") == "b0", "b0").otherwise("b1")
    return out.groupBy(named.alias("source")).agg(F.countDistinct("subject", "predicate", "object").cast("int").alias("rows"))


@query("SELECT DISTINCT 'x/' || string_split(p_name, ' ')[1] || 'Level' AS child, 'x/' || string_split(p_name, ' ')[1] || 'Data' AS parent, 'measure' AS rule FROM part UNION SELECT DISTINCT 'x/' || string_split(p_name, ' ')[1] || 'Rate', 'x/' || string_split(p_name, ' ')[1] || 'Data', 'measure' FROM part")
def measures_by_name(spark, folder):
    word = F.split("p_name", " ")[0]
    names = F.explode(F.array(*[F.concat(F.lit("x/"), word, F.lit(e)) for e in ("Data", "Level", "Rate")]))
    classes = table(spark, folder, "part").select(names.alias("class_uri")).distinct()
    return schema.subclasses_by_name(classes).where("rule = 'measure'")


_HOPS = """WITH d AS (SELECT min(c_nationkey) IS NOT NULL AS there FROM customer), v(a, b, distance, back) AS (VALUES ('customer', 'nation', 1, false), ('customer', 'region', 2, false), ('nation', 'region', 1, false), ('supplier', 'nation', 1, false), ('supplier', 'region', 2, false),
 ('nation', 'customer', 1, true), ('region', 'customer', 2, true), ('region', 'nation', 1, true), ('nation', 'supplier', 1, true), ('region', 'supplier', 2, true), ('customer', 'supplier', 2, true), ('supplier', 'customer', 2, true))"""


@query(f"{_HOPS} SELECT 'directed' AS way, a, b, distance FROM v, d WHERE there AND NOT back UNION ALL SELECT 'any', a, b, distance FROM v, d WHERE there")
def hops_between_tables(spark, folder):
    """Hops between families of nodes, along the links and either way."""
    from .graph import paths

    node = lambda t, c: F.concat(F.lit(t[0]), F.col(c).cast("string"))
    hops = [("customer", "c_custkey", "nation", "c_nationkey"), ("supplier", "s_suppkey", "nation", "s_nationkey"), ("nation", "n_nationkey", "region", "n_regionkey")]
    links = settle(union_frames([table(spark, folder, t).select(node(t, c).alias("src"), node(u, d).alias("dst")) for t, c, u, d in hops]), "links")
    kinds = {"c": "customer", "s": "supplier", "n": "nation", "r": "region"}
    name = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.substring("node", 1, 1)]
    families = settle(links.select(F.col("src").alias("node")).union(links.select("dst")).distinct().withColumn("family", name), "families")
    return union_frames([paths.family_distances(links, families, directed).withColumn("way", F.lit(way)) for way, directed in (("directed", True), ("any", False))])
