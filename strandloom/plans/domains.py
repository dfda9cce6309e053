"""Rule sets of four kinds of sources: economic series, filings, market quotes and weather alerts.

Each takes a vocabulary: the predicates and classes a source uses.  Long curated tables (keywords of sectors, pairs
of related series, types of measurements, constituents) are parameters, read from files, and never part of the code.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..model import LABEL, TYPE, as_triples, entities_of, gated, properties_of, property_of, union_frames
from ..operators import hubs, joins, pairs
from ..operators.calendar import dates_of
from ..operators.schema import classify_events
from ..operators.sequence import escalations, sequence_triples
from ..storage import settle

#: Order of severity and urgency in alerts.
SEVERITY = {"Minor": 1, "Moderate": 2, "Severe": 3, "Extreme": 4}
URGENCY = {"Past": 0, "Future": 1, "Expected": 2, "Immediate": 3}
#: Event names by category.
EVENT_CATEGORIES = {
    "severeWeatherEvent": ["Severe Thunderstorm Warning", "Severe Thunderstorm Watch", "Tornado Warning", "Tornado Watch", "Extreme Wind Warning"],
    "floodEvent": ["Flood Warning", "Flood Watch", "Flood Advisory", "Flash Flood Warning", "Flash Flood Watch", "Coastal Flood Warning", "Coastal Flood Watch", "Coastal Flood Advisory"],
    "winterWeatherEvent": ["Winter Storm Warning", "Winter Storm Watch", "Winter Weather Advisory", "Blizzard Warning", "Blizzard Watch", "Ice Storm Warning", "Freezing Rain Advisory", "Wind Chill Warning", "Wind Chill Advisory"],
    "heatEvent": ["Excessive Heat Warning", "Excessive Heat Watch", "Heat Advisory"],
    "tropicalEvent": ["Hurricane Warning", "Hurricane Watch", "Tropical Storm Warning", "Tropical Storm Watch", "Storm Surge Warning", "Storm Surge Watch"],
    "fireEvent": ["Red Flag Warning", "Fire Weather Watch", "Fire Warning"],
    "marineEvent": ["Small Craft Advisory", "Gale Warning", "Storm Warning", "Hurricane Force Wind Warning", "Special Marine Warning", "Marine Weather Statement"],
}
#: Equity sector, economic sector, confidence.
SECTOR_CROSSWALK = [
    ("Energy", "EnergySector", "strong"), ("Health Care", "HealthcareSector", "strong"),
    ("Consumer Staples", "FoodSector", "strong"), ("Consumer Staples", "TobaccoSector", "strong"), ("Consumer Staples", "PersonalCareSector", "strong"),
    ("Real Estate", "HousingSector", "moderate"), ("Financials", "FinancialSector", "moderate"),
    ("Industrials", "ManufacturingSector", "moderate"), ("Industrials", "TransportationSector", "moderate"), ("Industrials", "ConstructionTradesSector", "moderate"),
    ("Consumer Discretionary", "RetailSector", "moderate"), ("Consumer Discretionary", "RecreationSector", "moderate"), ("Consumer Discretionary", "LeisureHospitalitySector", "moderate"), ("Consumer Discretionary", "ApparelSector", "moderate"),
    ("Materials", "NaturalResourcesSector", "moderate"), ("Materials", "ManufacturingSector", "moderate"),
]
#: Census regions by two-letter state.
CENSUS_REGIONS = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX"],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}


@dataclass(frozen=True)
class Vocabulary:
    """A source's two namespaces: v["name"] is a term of its ontology, v.derived("name") one that enrichment adds."""

    ontology: str
    enrichment: str
    ids: str

    def __getitem__(self, name: str) -> str:
        return self.ontology + name

    def derived(self, name: str) -> str:
        return self.enrichment + name


def read_table(spark: SparkSession, path: str) -> dict:
    """A curated table from a JSON file."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


# Economic series


def chained_series(triples: DataFrame, v: Vocabulary, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Measurements of one type and category in order of period; types: class -> [category, year, month or quarter] predicates."""
    out = []
    for kind, (category, year, part) in types.items():
        rows = entities_of(triples, kind).join(properties_of(triples, {category: "category", year: "year", part: "part"}), "subject")
        rows = rows.where("year IS NOT NULL AND part IS NOT NULL").withColumns({"y": F.col("year").try_cast("int"), "m": F.col("part").try_cast("int")})
        out.append(sequence_triples(rows.where("y IS NOT NULL"), "subject", ["category"], ["y", "m", "part", "subject"], v.derived("precedes")))
    return union_frames(out)


def sector_membership(triples: DataFrame, v: Vocabulary, keywords: Mapping[str, Sequence[str]], ending: str = "_Entity") -> DataFrame:
    """Type, label and sector of subjects that end in a marker and whose local name contains a sector's keyword."""
    subjects = triples.select("subject").distinct().where(F.col("subject").endswith(ending)).withColumn("local", X.local_name(F.col("subject")))
    table = joins.small_table(triples, [(s, k) for s, ks in keywords.items() for k in ks], "sector string, keyword string")
    hits = joins.containing(subjects, F.col("local"), table, "keyword").select("subject", "sector").distinct().withColumn("uri", F.concat(F.lit(v.enrichment), "sector"))
    sectors = hits.select("uri", "sector").distinct()
    return union_frames([as_triples(hits, "subject", v.derived("belongsToSector"), "uri"), as_triples(sectors, "uri", TYPE, F.lit(v.derived("Sector"))), as_triples(sectors, "uri", LABEL, X.spaced(F.col("sector")))])


def correlations(triples: DataFrame, v: Vocabulary, table: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Relations between every subject that matches a pair's source pattern and every one that matches its target."""
    subjects = triples.select("subject").distinct().withColumn("local", X.local_name(F.col("subject")))
    found = joins.pattern_pairs(subjects, "subject", F.col("local"), table)
    return as_triples(found, "a", F.concat(F.lit(v.enrichment), "relation"), "b")


# Market quotes


def options(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """One row for each option snapshot: (option, symbol, underlying, expiry, right, strike, time); what the symbol says fills what is not stated."""
    rows = entities_of(triples, v["OptionSnapshot"]).join(properties_of(triples, {v["symbol"]: "symbol", v["underlyingSymbol"]: "u", v["expirationDate"]: "e", v["contractType"]: "r", v["strikePrice"]: "k", v["captureTime"]: "time"}), "subject")
    s = F.col("symbol")
    return rows.select(
        F.col("subject").alias("option"), "symbol", F.coalesce(F.upper(F.trim("u")), X.equity_symbol(s)).alias("underlying"), F.coalesce("e", X.option_expiry(s)).alias("expiry"),
        F.coalesce(X.contract_type(F.col("r")), X.option_right(s)).alias("right"), F.coalesce(F.col("k").try_cast("double"), X.option_strike(s)).alias("strike"), "time")


def equities(triples: DataFrame, v: Vocabulary) -> DataFrame:
    rows = entities_of(triples, v["EquitySnapshot"]).join(properties_of(triples, {v["symbol"]: "symbol", v["captureTime"]: "time", v["lastPrice"]: "price"}), "subject")
    return rows.select(F.col("subject").alias("equity"), F.upper(F.trim("symbol")).alias("underlying"), "time", F.col("price").try_cast("double").alias("price"))


def chained_quotes(triples: DataFrame, v: Vocabulary) -> DataFrame:
    rows = properties_of(triples, {v["symbol"]: "symbol", v["captureTime"]: "time"}).where("symbol IS NOT NULL AND time IS NOT NULL")
    return sequence_triples(rows, "subject", ["symbol"], ["time", "subject"], v.derived("precedes"))


def option_links(triples: DataFrame, v: Vocabulary, written: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """Options to equities of their time, or, if none has one, to the latest: each pair once, as both sides are distinct.

    written: how an option or equity is written in the result; done before the join, which makes a product for each underlying and time.
    """
    left = options(triples, v).select(written(F.col("option")).alias("option"), "underlying", "time")
    right = equities(triples, v).withColumn("shown", written(F.col("equity")))
    # Written once, as the join, its gate and the fallback all read them.
    left, right = settle(left, "link-options"), settle(right.drop("price"), "link-equities")
    found = joins.exact_or_latest(left, right, "underlying", "time", "shown", "equity").withColumnRenamed("shown", "equity")
    return as_triples(found, "option", v.derived("hasUnderlyingEquity"), "equity")


def strategies(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """Straddles, vertical spreads and strangles."""
    o = options(triples, v)
    chain = ["underlying", "expiry", "time"]
    whole = o.where("underlying IS NOT NULL AND expiry IS NOT NULL AND time IS NOT NULL AND strike IS NOT NULL")
    call, put = F.col("right") == "CALL", F.col("right") == "PUT"
    out = [as_triples(pairs.opposite(whole, "option", [*chain, "strike"], call | put, call), "a", v.derived("straddleWith"), "b")]
    for right, name in (("CALL", "callSpreadWith"), ("PUT", "putSpreadWith")):
        out.append(sequence_triples(whole.where(F.col("right") == right), "option", chain, ["strike", "option"], v.derived(name)))
    out.append(as_triples(pairs.ranked_about_middle(whole, "option", chain, "strike", call, put), "a", v.derived("strangleWith"), "b"))
    return union_frames(out)


def moneyness(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """Class of each option against the price of its equity."""
    linked = joins.exact_or_latest(options(triples, v), equities(triples, v), "underlying", "time", "price", "equity")
    found = linked.withColumn("m", joins.moneyness(F.col("strike"), F.col("price"), F.col("right"))).where("m IS NOT NULL").select("option", F.concat(F.lit(v.enrichment), "m").alias("m")).distinct()
    return union_frames([as_triples(found, "option", v.derived("hasMoneyness"), "m"), as_triples(found.select("m").distinct(), "m", TYPE, F.lit(v.derived("Moneyness")))])


def sectors_by_ticker(triples: DataFrame, v: Vocabulary, constituents: DataFrame) -> DataFrame:
    """Sector of quotes through their ticker or their option's underlying; constituents: (ticker, sector)."""
    rows = property_of(triples, v["symbol"], "symbol").withColumn("ticker", X.equity_symbol(F.col("symbol")))
    found = rows.join(constituents.select("ticker", "sector").distinct(), "ticker").withColumn("uri", F.concat(F.lit(v.enrichment), F.regexp_replace("sector", "[^A-Za-z]+", "")))
    return union_frames([as_triples(found, "subject", v.derived("belongsToSector"), "uri"), as_triples(found.select("uri").distinct(), "uri", TYPE, F.lit(v.derived("EquitySector")))])


def peers(companies: DataFrame, v: Vocabulary) -> DataFrame:
    """Companies of one sub-industry, once for each pair; companies: (company, sub_industry)."""
    return as_triples(pairs.sharing(companies, "company", ["sub_industry"]), "a", v.derived("sharesSubIndustryWith"), "b")


def sector_links(equity_sectors: DataFrame, economic: DataFrame, v: Vocabulary) -> DataFrame:
    """(sector, relation, economic sector) with a confidence, for sectors that both sources have; frames of (uri, name)."""
    table = joins.small_table(equity_sectors, SECTOR_CROSSWALK, "name string, target string, confidence string")
    there = economic.select(F.col("uri").alias("other"), F.col("name").alias("target"))
    found = equity_sectors.join(table, "name").join(there, "target")
    return union_frames([as_triples(found, "uri", v.derived("correspondsToSector"), "other"), as_triples(found, "uri", v.derived("sectorConfidence"), "confidence")])


def leading_indicators(indicators: DataFrame, sector_edges: DataFrame, v: Vocabulary) -> DataFrame:
    """Indicators lead the equity sectors that share their economic sector; (indicator, economic) and (equity_sector, economic)."""
    return as_triples(hubs.through(indicators, sector_edges, "economic", "indicator", "equity_sector"), "indicator", v.derived("leadsTo"), "equity_sector")


# Weather alerts


def alerts(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """(alert, sent, event, severity, urgency): single-valued properties of an alert and its info node, by one aggregate."""
    some = gated(triples, [v[p] for p in ("hasInfo", "sent", "event", "severity", "urgency")])
    info = property_of(some, v["hasInfo"], "info").withColumnRenamed("subject", "alert")
    props = properties_of(some, {v["sent"]: "sent", v["event"]: "event", v["severity"]: "severity", v["urgency"]: "urgency"})
    own = props.select(F.col("subject").alias("alert"), F.col("sent").alias("own_sent"))
    return info.join(props.withColumnRenamed("subject", "info"), "info", "left").join(own, "alert", "left").select("alert", F.coalesce("own_sent", "sent").alias("sent"), "event", "severity", "urgency").distinct()


def alert_places(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """(alert, code): alert to info to area to geocode to its code."""
    some = gated(triples, [v[p] for p in ("hasInfo", "hasArea", "hasGeocode", "code")])
    step = lambda p, a, b: property_of(some, v[p], b).withColumnRenamed("subject", a)
    return step("hasInfo", "alert", "info").join(step("hasArea", "info", "area"), "info").join(step("hasGeocode", "area", "geocode"), "area").join(step("code", "geocode", "code"), "geocode").select("alert", "code").distinct()


def alert_rules(triples: DataFrame, v: Vocabulary) -> DataFrame:
    """Chains by place, alerts that share a place or an event, escalations, event classes."""
    info, places = alerts(triples, v), alert_places(triples, v)
    located = places.join(info, "alert").where("sent IS NOT NULL")
    level = lambda table, c: F.create_map(*[F.lit(x) for k, n in table.items() for x in (k, n)])[X.local_name(F.col(c))]
    graded = located.withColumns({"s": level(SEVERITY, "severity"), "u": level(URGENCY, "urgency")})
    return union_frames([
        sequence_triples(located, "alert", ["code"], ["sent", "alert"], v.derived("precedes")),
        as_triples(pairs.sharing(places, "alert", ["code"]), "a", v.derived("affectsSameRegion"), "b").distinct(),
        as_triples(pairs.sharing(info.where("event IS NOT NULL"), "alert", ["event"]), "a", v.derived("sameEventType"), "b").distinct(),
        as_triples(escalations(graded, "alert", ["code"], ["sent", "alert"], "s", "u"), "alert", v.derived("escalatesTo"), "next_alert"),
        classify_events(info.where("event IS NOT NULL"), "alert", "event", EVENT_CATEGORIES, v.derived("hasEventClassification"), v.enrichment),
    ])


def state_regions(states: DataFrame, column: str) -> DataFrame:
    """states with the census region of a two-letter code."""
    return states.join(joins.small_table(states, [(s, r) for r, some in CENSUS_REGIONS.items() for s in some], f"{column} string, census_region string"), column)


# Filings


def filing_chains(triples: DataFrame, v: Vocabulary, entity_kind: str, by: str, date: str, predicate: str = "precedes") -> DataFrame:
    """Filings of a kind in order of date within what they are by; the date is their own or that of a node they refer to."""
    rows = entities_of(triples, v[entity_kind])
    rows = rows.join(dates_of(triples, rows, v[date]), "subject").join(property_of(triples, v[by], "owner"), "subject")
    return sequence_triples(rows, "subject", ["owner"], ["date", "subject"], v.derived(predicate))


def unified_companies(triples: DataFrame, v: Vocabulary, key: str = "cik") -> DataFrame:
    return hubs.unify(property_of(triples, v[key], "key"), "subject", "key", v.ids + "Company_", v.derived("Company"), v.derived("hasCik"))


def company_hub(by_cik: DataFrame, by_ticker: DataFrame, by_cusip: DataFrame, ticker_cik: DataFrame, cusip_ticker: DataFrame, v: Vocabulary) -> DataFrame:
    """Companies and links to them by CIK, by ticker and by CUSIP.

    by_*: (subject, cik | ticker | cusip); ticker_cik: (ticker, cik, priority) of which the stated pairing, then the lowest CIK wins;
    cusip_ticker: (cusip, ticker), the first by ticker.
    """
    tickers = hubs.pairing(ticker_cik, "ticker", "cik", "priority").select("ticker", "cik")
    first = hubs.pairing(cusip_ticker.withColumn("priority", F.lit(0)), "cusip", "ticker", "priority").select("cusip", "ticker")
    links = hubs.by_routes([by_cik, by_ticker.join(tickers, "ticker"), by_cusip.join(first, "cusip").join(tickers, "ticker")], "subject", "cik")
    hub = F.concat(F.lit(v.ids + "Company_"), "cik")
    companies = links.select("cik").distinct().withColumn("hub", hub)
    traded = companies.join(tickers, "cik")
    return union_frames([
        as_triples(companies, "hub", TYPE, F.lit(v.derived("Company"))), as_triples(companies, "hub", v.derived("hasCik"), "cik"),
        as_triples(traded, "hub", v.derived("hasTicker"), "ticker"), as_triples(links.withColumn("hub", hub), "subject", v.derived("refersToCompany"), "hub")])


def linked_codes(triples: DataFrame, v: Vocabulary, predicate: str, kind: str, code) -> DataFrame:
    """Type, code and label of what a predicate links to; code makes the code from a URI column."""
    found = triples.where(F.col("predicate") == v[predicate]).select(F.col("object").alias("uri")).distinct().withColumn("code", code(F.col("uri"))).where("code IS NOT NULL")
    return union_frames([as_triples(found, "uri", TYPE, F.lit(v.derived(kind))), as_triples(found, "uri", v.derived("hasCode"), "code"), as_triples(found, "uri", LABEL, F.concat(F.lit(f"{kind} "), "code"))])


def violations(triples: DataFrame, v: Vocabulary, patterns: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Subjects of a namespace whose URI or label contains a violation's keyword get its type; those of different namespaces that share one are linked.

    patterns: violation -> namespace -> keywords.
    """
    table = joins.small_table(triples, [(n, ns, k) for n, by in patterns.items() for ns, ks in by.items() for k in ks], "violation string, namespace string, keyword string")
    named = triples.where(F.col("predicate") == LABEL).select("subject", F.col("object").alias("text")).unionByName(triples.select("subject", F.col("subject").alias("text"))).distinct()
    hits = joins.containing(named, F.col("text"), table, "keyword").where(F.col("subject").startswith(F.col("namespace"))).select("subject", "violation", "namespace").distinct()
    a, b = hits.select(F.col("subject").alias("a"), "violation", F.col("namespace").alias("na")), hits.select(F.col("subject").alias("b"), "violation", F.col("namespace").alias("nb"))
    across = a.join(b, "violation").where("na < nb").select("a", "violation", "b").distinct()
    uri = F.concat(F.lit(v.enrichment), "violation")
    return union_frames([as_triples(hits.withColumn("uri", uri), "subject", TYPE, "uri"), as_triples(hits.select("violation").distinct().withColumn("uri", uri), "uri", LABEL, X.spaced(F.col("violation"))), as_triples(across, "a", F.concat(F.lit(v.enrichment), "violation", F.lit("Link")), "b")])


def sectors_by_sic(triples: DataFrame, v: Vocabulary, predicate: str = "sic") -> DataFrame:
    found = property_of(triples, v[predicate], "code").withColumn("sector", X.sic_sector(F.col("code"))).where("sector IS NOT NULL")
    return as_triples(found, "subject", v.derived("belongsToSector"), F.concat(F.lit(v.enrichment), "sector"))
