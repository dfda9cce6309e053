from __future__ import annotations

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import ann, warc


# Vectors


def frame(spark, ids, rows):
    return spark.createDataFrame([(int(i), None if r is None else [None if x is None else float(x) for x in r], 0) for i, r in zip(ids, rows)], "vec_id long, embedding array<float>, label int")


def exact(x, ids, k, every):
    out = {}
    for i in range(len(ids)):
        if ids[i] % every == 0:
            s = (x.astype(float) * x[i].astype(float)).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(12, 24))
    x = (middle[rng.integers(0, 12, 1500)] + 0.7 * rng.normal(size=(1500, 24))).astype(np.float32)
    ids = np.arange(1500)
    vectors = ann.usable(frame(spark, ids, x))
    got, want = found(ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), 10)), exact(x, ids, 10, 20)
    assert set(got) == set(want)
    hit = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want])
    assert hit >= 0.9
    for q in got:
        own = dict(want[q])
        assert all(abs(s - own[v]) < 1e-9 for v, s in got[q] if v in own) and [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_many_copies_rank_by_id(spark):
    x = np.concatenate([np.ones((300, 8)), np.random.default_rng(0).normal(size=(100, 8)) * 0.1]).astype(np.float32)
    ids = np.arange(400)[::-1].copy()
    vectors = ann.usable(frame(spark, ids, x))
    got, want = found(ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), 20)), exact(x, ids, 20, 100)
    for q in (200, 300):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_odd_vectors(spark):
    rows = [[1, 0], [0, 1], [0.5, 0.5], None, [0, 0], [float("nan"), 1], [None, 1], [1, 2, 3], [float("inf"), 0]]
    vectors = ann.usable(frame(spark, range(9), rows))
    assert {r["vec_id"] for r in vectors.collect()} == {0, 1, 2}
    got = found(ann.nearest(vectors, vectors))
    assert {q: [v for v, _ in r] for q, r in got.items()} == {0: [2, 1], 1: [2, 0], 2: [0, 1]}
    none = ann.usable(frame(spark, [], []))
    assert ann.nearest(none, none).count() == 0


def test_scan_abandons_early_and_keeps_the_nearest():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(3000, 63)).astype(np.float32)
    q = v[:50] + 0.1 * rng.normal(size=(50, 63)).astype(np.float32)
    top = float((v.astype(float) ** 2).sum(1).max())
    seen: list = []
    qi, vi, score = ann.scan(v, q, ann.rotation(64), top, 1, seen=seen)
    best = (q @ v.T).argmax(1)
    assert list(qi) == list(range(50)) and np.mean(vi == best) > 0.97
    assert np.array_equal(score, (q.astype(float) * v[vi].astype(float)).sum(1))
    assert sum(seen[0::2]) < 0.95 * sum(seen[1::2])
    bounded: list = []
    again = ann.scan(v, q, ann.rotation(64), top, 1, score - 1e-9, bounded)
    assert np.array_equal(again[1], vi) and sum(bounded[0::2]) < sum(seen[0::2])


def test_doubles_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 8)) * 1e100
    rows = [(i % 190, [float(y) for y in r]) for i, r in enumerate(x)] + [(20, [float(y) for y in x[20]])] * 2
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = found(ann.nearest(vectors, vectors.where("vec_id IN (20, 40)"), 5))
    for i in (20, 40):
        s = np.array([(np.array(r) * x[i]).sum() if j != i else -np.inf for j, r in rows])
        order = np.lexsort(([j for j, _ in rows], -s))[:5]
        assert [v for v, _ in got[i]] == [rows[j][0] for j in order] and [y for _, y in got[i]] == [s[j] for j in order]


# Records


def records(spark, rows):
    return spark.createDataFrame(rows, warc.RECORDS)


def test_revisits_resolve_check_and_merge(spark):
    head = {"ETag": '"a"', "Content-Length": "5", "Content-Type": "text/html", "X": "1"}
    rows = [
        (1, "response", "http://www.Ex.org:80/p/?b=2&a=1#f", 100, 200, head, "d1"),
        (2, "revisit", "https://ex.org/p?a=1&b=2&utm_source=z", 250_000, 304, {"etag": 'W/"a"', "X": "2", "Content-Length": "0", "Connection": "close"}, None),
        (3, "revisit", "http://ex.org/p?a=1&b=2", 50, 304, {}, None),
        (4, "response", "http://ex.org/p?a=1&b=2", 300_000, 200, {"Last-Modified": "m"}, "d2"),
        (5, "revisit", "http://ex.org/p?a=1&b=2", 300_000, 304, {"Last-Modified": "n"}, None),
        (6, "revisit", "http://ex.org/p?a=1&b=2", 300_001, 304, None, "d2"),
        (7, "response", "http://ex.org/p?a=1&b=2", 300_002, 404, {}, "d3"),
        (8, "revisit", "http://ex.org/p?a=1&b=2", 900_000, 304, {}, None),
        (9, "revisit", None, 10, 304, {}, None),
        (10, "revisit", "http://ex.org/p?a=1&b=2", None, 304, {}, None),
        (11, "request", "http://ex.org/p", 1, None, None, None),
    ]
    out = {r["revisit_id"]: r for r in warc.resolve_revisits(records(spark, rows)).collect()}
    assert {i: (r["response_id"], r["outcome"]) for i, r in out.items()} == {2: (1, "resolved"), 3: (None, "unmatched"), 5: (4, "mismatch"), 6: (4, "resolved"), 8: (4, "unchecked"), 9: (None, "unmatched"), 10: (None, "unmatched")}
    assert out[2]["headers"] == {"etag": 'W/"a"', "content-length": "5", "content-type": "text/html", "x": "2"} and out[2]["digest"] == "d1"
    assert warc.resolve_revisits(records(spark, [])).count() == 0


def test_header_names_that_clash(spark):
    rows = [
        (1, "response", "http://h/", 1, 200, {"ETag": '"a"', "etag": '"a"', "Vary": "x", "VARY": "y", "Null": None}, "d"),
        (2, "revisit", "http://h/", 2, 304, {"ETAG": '"a"', "Via": "p", "via": "q", "X": None}, None),
    ]
    (r,) = warc.resolve_revisits(records(spark, rows)).collect()
    assert (r["response_id"], r["outcome"]) == (1, "resolved") and r["headers"] == {"etag": '"a"', "vary": "y, x", "via": "p, q"}
    assert warc.http_head(b"HTTP/1.1 200 OK\r\nA: 1\r\na: 2\r\n\r\nb") == (200, {"a": "1, 2"}, b"b")
    with pytest.raises(ValueError, match="content-length"):
        list(warc.parse_warc(b"WARC/1.0\r\nContent-Length: x\r\n\r\n"))


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_as_of_join_for_any_span(spark, span):
    import random

    r = random.Random(span)
    rows = [(i, r.choice(["response", "revisit"]), f"http://h/{r.randrange(2)}", r.randrange(60), 200, {}, "d") for i in range(80)]
    out = {x["revisit_id"]: x["response_id"] for x in warc.resolve_revisits(records(spark, rows), span).collect()}
    for i, kind, url, at, *_ in rows:
        if kind == "revisit":
            earlier = [(t, j) for j, k, u, t, *_ in rows if k == "response" and u == url and (t, j) < (at, i)]
            assert out[i] == (max(earlier)[1] if earlier else None)


def test_files_round_trip(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nETag: \"x\"\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"

    def record(kind, block, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: http://h/\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    parts = [record("warcinfo", b"software: x\r\n"), record("response", body, "Content-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:A\r\n")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "b.warc").write_bytes(b"".join(parts))
    rows = warc.read_warc(spark, str(tmp_path)).where("kind = 'response'").collect()
    assert len(rows) == 2 and all(r["status"] == 200 and r["headers"]["etag"] == '"x"' and bytes(r["body"]) == b"<p>hi</p>" and r["digest"] == "sha1:A" for r in rows)
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"junk\r\n"))


def test_canonical_urls(spark):
    urls = {"HTTP://WWW.a.COM:80/x/?q=1#z": "a.com/x?q=1", "https://a.com/x?utm_medium=m&q=1": "a.com/x?q=1", "http://a.com": "a.com", "https://a.com:8080/": "a.com:8080", None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(warc.canonical_url(F.col("u"))).collect()] == list(urls.values())
