from __future__ import annotations

import random

import numpy as np

from strandloom.llm import common, ngram_join

from .conftest import prose


def brute(texts, percent=80, n=5):
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def got(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(docs).collect()}


def family(seed):
    """A base, copies with ever more edits, chains of near copies, and texts that share a passage."""
    r = random.Random(seed)
    base = prose(seed, 90).split()
    out = [" ".join(base)]
    step = list(base)
    for i in range(10):
        step = list(step)
        step[r.randrange(len(step))] = f"edit{seed}x{i}"
        out.append(" ".join(step))
    passage = " ".join(base[:40])
    out += [passage + " " + prose(seed * 100 + i, 12) for i in range(6)]
    out += [prose(seed * 100 + i, 4) for i in range(3)]
    return out


def test_components_are_exact(make_docs):
    texts = [t for s in range(1, 5) for t in family(s)] + ["one two", "ONE two", "one two three", "", " "]
    assert got(make_docs(texts)) == brute(texts)


def test_cross_links_alone_are_exact(make_docs, monkeypatch):
    """Without any grouping, the bounds and opened groups must find every link by themselves."""
    monkeypatch.setattr(ngram_join, "proposals", lambda classes, percent: classes.selectExpr("key AS a", "key AS b").limit(0))
    texts = [t for s in range(1, 4) for t in family(s)]
    assert got(make_docs(texts)) == brute(texts)


def test_odd_documents(odd_docs, no_docs):
    rows = ngram_join.ngram_components(odd_docs).collect()
    assert len(rows) == 13 and ngram_join.ngram_components(no_docs).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["n_shingles"] > 0, r["component_id"]))
    assert by[1] == by[2] == {(True, 1)} and by[3] == {(False, 3)} and by[4] == {(False, 4)} and by[5] == {(False, 5)}
    assert {c for _, c in by[None]} == {None}
    kept = ngram_join.keep_representatives(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 2").count() == 0 and kept.count() == 11


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    rows = {r["node"]: r["root"] for r in common.components(edges).collect()}
    assert rows == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_near_copies_below_the_threshold_do_not_meet(make_docs, monkeypatch):
    """Copies of one text, each with other words replaced, share most shingles in pairs without linking: few groups are compared, no link is lost."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(150, 4 if i % 10 else 1, replace=False):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    docs, met = make_docs([t for _, t in rows]), {}
    keep = ngram_join.settle
    monkeypatch.setattr(ngram_join, "settle", lambda df, tag: met.update({tag: keep(df, tag)}) or met[tag])
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(docs).collect()}
    assert got == {i: c for i, (_, c) in brute([t for _, t in rows]).items()}
    groups = met["ngram-shared"].select("group").distinct().count()
    assert groups > 20 and met["ngram-group-pairs"].count() < groups * (groups - 1) // 8
