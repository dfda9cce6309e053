"""WARC records, and the resolution of "not modified" revisits.

A revisit says that a server answered 304: the body is that of an earlier capture.  It is resolved by an as-of
join on the canonical URL to the latest earlier full response (kind `response`, status 200; earlier by time, then by record
id).  Its validators are checked against that response: the entity tag (weak comparison) if both have one, else
Last-Modified if both have it, else the payload digest if both have it; with nothing to compare it is `unchecked`.
If they differ it is a `mismatch`, without an earlier response `unmatched`.  Else the response's headers
are freshened as RFC 9111 section 3.2 has it: the revisit's headers replace or join them, except those of the
connection and those that describe the stored body.

The join has two levels.  Within a URL and a span of time it is a running `last` over the captures; revisits that find
nothing there get the last response of the URL's earlier spans, of which there is one row each.  So a URL
with a third of all captures is as many tasks as it has spans.

Defined results: records without URL, time or id do not resolve (`unmatched`) and resolve nothing.  Null headers are
no headers; header names are compared in lower case, and the values of names that are then equal are joined by ", " in the order of
the names as given, without nulls, repeated values once (a name with only nulls is no header).  Equal times are ordered by record id.
Repeated records are kept each.  Other columns are ignored.  An empty table gives an empty one.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..workers import ship

#: Headers that a 304 never changes (connection headers, then those of the stored body).
KEPT_HEADERS = [
    "connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
    "content-encoding", "content-length", "content-range", "content-type",
]
SPAN_SECONDS = 100_000
RECORDS = "record_id long, kind string, url string, at long, status int, headers map<string,string>, digest string"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of a WARC file, plain or gzipped by record."""
    f = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        f = gzip.GzipFile(fileobj=f)
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = head.get("content-length", "")
        if not size.isdigit():
            raise ValueError(f"record {head.get('warc-record-id')} has content-length {size!r}")
        yield head, f.read(int(size))


def http_head(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, headers with lower-case names, and body of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    parts = first.split()
    status = int(parts[1]) if len(parts) > 1 and parts[0].startswith("HTTP/") and parts[1].isdigit() else None
    headers: dict[str, str] = {}
    for name, _, value in (x.partition(":") for x in lines if x):
        name, value = name.strip().lower(), value.strip()
        headers[name] = f"{headers[name]}, {value}" if name in headers else value  # repeated headers are one list
    return status, headers, body


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(warc_id, kind, url, date, status, headers, digest, body) of the records of all WARC files under a path."""
    schema = "warc_id string, kind string, url string, date string, status int, headers map<string,string>, digest string, body binary"
    kinds = [pa.string()] * 4 + [pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
    names = ["warc_id", "kind", "url", "date", "status", "headers", "digest", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0).to_pylist():
                for head, block in parse_warc(content):
                    status, headers, body = http_head(block) if "http" in head.get("content-type", "") else (None, {}, block)
                    row = [head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-date"), status, list(headers.items()), head.get("warc-payload-digest"), body]
                    yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without last slash, sorted query without utm_ parameters; no scheme, no fragment."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(rest, "[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda x: (x != "") & ~x.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _header(c: Column, name: str) -> Column:
    return F.element_at(c, name)


def _same_tag(a: Column, b: Column) -> Column:
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def lowered(headers: Column) -> Column:
    """Headers by lower-case name; the values of names that clash are joined."""
    entries = F.sort_array(F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull()))
    pairs = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    joined = F.transform(names, lambda n: F.array_join(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["k"] == n), lambda p: p["v"])), ", "))
    plain = F.size(names) == F.size(headers)
    return F.when(plain, F.transform_keys(headers, lambda k, _: F.lower(k))).otherwise(F.map_from_arrays(names, joined))


def resolve_revisits(records: DataFrame, span: int = SPAN_SECONDS) -> DataFrame:
    """One row for each revisit of `records` (columns of RECORDS, others ignored): revisit_id, response_id, outcome, status, headers, digest."""
    no_headers = F.create_map().cast("map<string,string>")
    headers = lowered(F.coalesce("headers", no_headers))
    rows = records.select("record_id", "kind", canonical_url(F.col("url")).alias("key"), "at", "status", headers.alias("headers"), "digest")
    rows = rows.where(F.col("kind").isin("response", "revisit"))
    whole = F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("record_id").isNotNull()
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rows = rows.where((F.col("kind") == "revisit") | (full & whole)).withColumn("span", F.floor(F.col("at") / span))
    response = F.when(full & whole, F.struct("record_id", "headers", "digest"))
    running = W.partitionBy("key", "span").orderBy("at", "record_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    near = rows.where(whole).withColumn("base", F.last(response, ignorenulls=True).over(running)).where("kind = 'revisit'")
    lasts = rows.where(full & whole).groupBy("key", "span").agg(F.max_by(F.struct("record_id", "headers", "digest"), F.struct("at", "record_id")).alias("tail"))
    # For each span with revisits, the last response of the URL's earlier spans; one row for each URL and span.
    asked = near.where("base IS NULL").select("key", "span").distinct()
    marks = lasts.unionByName(asked, allowMissingColumns=True).groupBy("key", "span").agg(F.first("tail", ignorenulls=True).alias("tail"))
    earlier = W.partitionBy("key").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    carried = marks.withColumn("carry", F.last("tail", ignorenulls=True).over(earlier)).where("carry IS NOT NULL").select("key", "span", "carry")
    found = near.join(carried, ["key", "span"], "left").withColumn("base", F.coalesce("base", "carry")).drop("carry")
    lost = rows.where((F.col("kind") == "revisit") & ~whole)
    found = found.unionByName(lost, allowMissingColumns=True)

    mine, base = F.col("headers"), F.col("base.headers")
    tags = [_header(x, "etag") for x in (mine, base)]
    dates = [_header(x, "last-modified") for x in (mine, base)]
    digests = [F.col("digest"), F.col("base.digest")]
    both = lambda x: x[0].isNotNull() & x[1].isNotNull()
    same = F.when(both(tags), _same_tag(*tags)).when(both(dates), dates[0] == dates[1]).when(both(digests), digests[0] == digests[1])
    outcome = F.when(F.col("base").isNull(), "unmatched").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("mismatch")
    fresh = F.map_filter(mine, lambda k, _: ~k.isin(KEPT_HEADERS))
    merged = F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    good = F.col("outcome").isin("resolved", "unchecked")
    return found.withColumn("outcome", outcome).select(
        F.col("record_id").alias("revisit_id"),
        F.when(F.col("outcome") != "unmatched", F.col("base.record_id")).alias("response_id"),
        "outcome",
        F.when(good, F.lit(200)).alias("status"),
        F.when(good, merged).alias("headers"),
        F.when(good, F.col("base.digest")).alias("digest"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """The captures that `pages` stands for: page p is fetched in full at second 10 p, asked for again with its entity tag
    at a later second under the same address with a fragment, and was asked for five seconds before with a weak tag of its own."""
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    text = lambda x: F.lit(x)
    size = F.octet_length("html").cast("string")
    base = F.create_map(text("ETag"), tag, text("Content-Type"), text("text/html"), text("Content-Length"), size, text("Cache-Control"), text("max-age=60"))
    again = F.create_map(text("ETag"), tag, text("Content-Length"), text("0"), text("Cache-Control"), text("max-age=600"), text("Date"), F.col("page_id").cast("string"))
    before = F.create_map(text("ETag"), F.concat(F.lit("W/"), tag), text("Cache-Control"), text("no-cache"), text("Connection"), text("close"))
    p = F.col("page_id")
    record = lambda i, kind, url, at, status, headers, digest: F.struct(
        i.alias("record_id"), F.lit(kind).alias("kind"), url.alias("url"), at.alias("at"), F.lit(status).alias("status"), headers.alias("headers"), digest.alias("digest")
    )
    rows = F.array(
        record(p * 3, "response", F.col("url"), p * 10, 200, base, F.md5("html")),
        record(p * 3 + 1, "revisit", F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")), p * 10 + 5 + p % 7 * 100, 304, again, F.lit(None).cast("string")),
        record(p * 3 + 2, "revisit", F.col("url"), p * 10 - 5, 304, before, F.lit(None).cast("string")),
    )
    return pages.select(F.explode(rows).alias("r")).select("r.*")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(page_records(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select("revisit_id", "response_id", "outcome", "status", lines.alias("headers"), "digest")


OP4_SQL = """
WITH a AS (SELECT page_id, url, md5(html) AS d, strlen(html) AS size, regexp_replace(trim(url), '#.*$', '') AS plain FROM pages),
b AS (SELECT *, regexp_replace(plain, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM a),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www[0-9]*[.]', ''), ':(80|443)$', '') AS host,
  regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS q FROM b),
k AS (SELECT page_id, d, size, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS key FROM c),
v AS (SELECT 3 * page_id + 1 AS id, key, 10 * page_id + 5 + page_id % 7 * 100 AS at, d, 'max-age=600' AS cc, CAST(page_id AS VARCHAR) AS date, '' AS weak FROM k
  UNION ALL SELECT 3 * page_id + 2, key, 10 * page_id - 5, d, 'no-cache', NULL, 'W/' FROM k),
j AS (SELECT v.*, r.page_id AS rp, r.d AS rd, r.size AS rs FROM v ASOF LEFT JOIN (SELECT *, 10 * page_id AS at FROM k) r ON v.key = r.key AND v.at > r.at)
SELECT id AS revisit_id, 3 * rp AS response_id, CASE WHEN rp IS NULL THEN 'unmatched' WHEN d = rd THEN 'resolved' ELSE 'mismatch' END AS outcome,
  CASE WHEN d = rd THEN 200 END AS status,
  CASE WHEN d = rd THEN 'cache-control: ' || cc || chr(10) || 'content-length: ' || rs || chr(10) || 'content-type: text/html' || chr(10)
    || coalesce('date: ' || date || chr(10), '') || 'etag: ' || weak || '"' || d || '"' END AS headers,
  CASE WHEN d = rd THEN rd END AS digest
FROM j
"""
