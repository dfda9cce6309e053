from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from strandloom.llm import lm_score, quality, toxicity

from .conftest import prose


def labelled(spark, n, bad):
    rows = [(i, bad(i) if i % 3 == 0 else prose(i, 40), int(i % 3 == 0)) for i in range(n)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")


def test_toxicity_learns_and_scores_odd_documents(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 1500, lambda i: prose(i, 40) + " you nastyword")
    model = toxicity.train(docs, labels.where("doc_id < 1200"))
    out = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert np.mean([(out[i] >= 0.7) == (i % 3 == 0) for i in range(1200, 1500)]) > 0.97
    scored = toxicity.score(odd_docs, model)
    assert sorted(scored.columns) == sorted(odd_docs.columns) and scored.where("score BETWEEN 0 AND 1").count() == 13
    assert toxicity.score(no_docs, model).count() == 0
    empty = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd_docs, empty).collect()} == {0.5}


def test_machine_uses_pairs():
    """The label is the exclusive or of two terms, which no sum of weights can give."""
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (1500, 2))
    docs = [np.unique(np.array([10 + k for k in (0, 1) if b[k]] + [20 + int(rng.integers(0, 5))], np.uint64)) for b in bits]
    y = (bits.sum(1) == 1).astype(np.float32)
    fm = toxicity.fit(docs, y, rate=0.3)
    assert ((fm.scores(docs) > 0.5) == (y == 1)).mean() > 0.95


def test_quality_learns_and_scores_odd_documents(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 240, lambda i: " ".join(w.upper() + "!!" for w in prose(i, 40).split()))
    model = quality.train(docs, labels.where("doc_id < 160"))
    out = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert np.mean([(out[i] >= 0.5) == (i % 3 == 0) for i in range(160, 240)]) > 0.95
    assert quality.score(odd_docs, model).where("score BETWEEN 0 AND 1").count() == 13 and quality.score(no_docs, model).count() == 0
    none = quality.train(no_docs, labels)
    assert {r["score"] for r in quality.score(odd_docs, none).collect()} == {0.5}


def plain_base(texts, train):
    tokens = [t.encode().lower().split() + [b""] for t in texts]
    c = Counter(w for i, ts in enumerate(tokens) if train[i] for w in ts)
    n, v = sum(c.values()), len(c)
    return [(len(ts), sum(c[w] > 0 for w in ts), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts)) for ts in tokens]


def test_base_scores_with_and_without_tail(spark, make_docs, monkeypatch):
    texts = [prose(i, 30) + (" Rare%d" % i) * 2 for i in range(40)] + ["", "unseen words only"]
    docs = make_docs(texts)
    train = [i % 5 != 0 and i < 41 for i in range(42)]
    for head in (100_000, 20):
        monkeypatch.setattr(lm_score, "HEAD", head)
        out = {r["doc_id"]: r for r in lm_score.lm_scores(docs, docs.where("doc_id % 5 <> 0 AND doc_id < 41")).collect()}
        for i, (n, known, total, base) in enumerate(plain_base(texts, train)):
            r = out[i]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and abs(r["base_score"] - base) < 1e-6, (i, head)


def test_model_is_normalised_and_better_than_counts(spark, make_docs, monkeypatch):
    # A language where each word fixes the next: counts alone can't see that.
    texts = [" ".join(f"w{(i + k) % 20}" for k in range(40)) for i in range(3000)]
    docs = make_docs(texts)
    counts = lm_score.settle(lm_score.word_counts(docs), "t")
    monkeypatch.setattr(lm_score, "BATCH", 128)
    monkeypatch.setattr(lm_score, "RATE", 0.3)
    model = lm_score.fit(docs, counts)
    one, two, normal = model.tables()
    for a, b in ((0, 0), (3, 4), (5, 3)):
        assert abs(np.exp(one[a] + two[b] - normal[a, b]).sum() - 1) < 1e-3
    out = lm_score.lm_scores(docs, docs).selectExpr("sum(score) s", "sum(base_score) b").first()
    assert out["s"] > 0.8 * out["b"]


def test_partitions_have_no_part_in_the_scores(make_docs, monkeypatch):
    """Nor do shards undo the learning: texts that were not learnt from score better than by counts."""
    texts = [" ".join(f"w{(i + k) % 20}" for k in range(40)) for i in range(3000)] + ["same text"] * 3
    docs = make_docs(texts)
    for name, value in {"BATCH": 128, "RATE": 0.3, "SHARD_TOKENS": 16_000, "FAN": 4}.items():
        monkeypatch.setattr(lm_score, name, value)
    out = []
    for parts in (1, 7):
        some = docs.repartition(parts, "doc_id")
        rows = lm_score.lm_scores(some, some.where("doc_id % 7 <> 2")).collect()
        out.append({r["doc_id"]: (r["score"], r["base_score"]) for r in rows})
    for k in (0, 1):
        assert {i: v[k] for i, v in out[0].items()} == pytest.approx({i: v[k] for i, v in out[1].items()})
    held = [v for i, v in out[0].items() if i % 7 == 2]
    assert sum(x for x, _ in held) > sum(y for _, y in held) * 0.9


def test_votes_against_plain_python(spark, make_docs):
    """Cosines of all pairs by loops; equal ones go to the neighbour that comes first by doc_id."""
    texts = [prose(i % 40, 30) if i % 3 else prose(i, 30).upper() + " !!" for i in range(160)]
    docs = make_docs(texts)
    labels = spark.createDataFrame([(i, int(i % 3 == 0 or i % 5 == 0)) for i in range(0, 120)], "doc_id long, label int")
    model = quality.train(docs, labels)
    assert list(model.labels) == [int(i % 3 == 0 or i % 5 == 0) for i in range(120)]
    x = model.embed(*quality.term_counts([t.encode() for t in texts]), len(texts))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i in range(160):
        sim = [float(x[i] @ v) for v in model.vectors]
        near = sorted(range(120), key=lambda j: (-round(sim[j], 5), j))[: quality.NEIGHBOURS]
        weight = [max(sim[j], 0) ** quality.SHARPNESS for j in near]
        assert abs(got[i] - sum(w * model.labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight)) < 1e-3, i


def test_machine_against_all_pairs():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(1, 30, rng.integers(0, 12)).astype(np.uint64)) for _ in range(300)]
    fm = toxicity.fit(docs, rng.integers(0, 2, 300).astype(np.float32))
    for d, got in zip(docs, fm.scores(docs), strict=True):
        rows = [0] + [int(np.searchsorted(fm.codes, c)) + 1 for c in d if c in fm.codes]
        z = sum(float(fm.w[r]) for r in rows) + sum(float(fm.v[a] @ fm.v[b]) for i, a in enumerate(rows) for b in rows[:i])
        assert abs(got - 1 / (1 + math.exp(-z))) < 1e-5


def test_repeated_labelled_rows_bring_one_row_each(spark):
    rows = [(1, "bad one")] * 500 + [(2, f"good {i}") for i in range(500)] + [(3, "good two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, 0)], "doc_id long, label int")
    for module in (toxicity, quality):
        seen = module.sampled(docs, labels, 10).collect()
        assert sorted((r["doc_id"], r["label"]) for r in seen) == [(1, 1), (2, 0), (3, 0)]
        assert [r["text"] for r in seen if r["doc_id"] == 2] == ["good 0"]


def test_scores_of_odd_documents(odd_docs, no_docs):
    rows = lm_score.lm_scores(odd_docs, odd_docs.where("doc_id < 8")).collect()
    assert len(rows) == 13 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm_score.lm_scores(no_docs, no_docs).count() == 0
    assert lm_score.lm_scores(odd_docs, no_docs).where("base_score <> 0 OR n_known <> 0").count() == 0


def test_learning_rows_are_those_of_the_contract(spark, data):
    ids = {r[0] for r in toxicity.training_labels(spark, data).select("doc_id").collect()}
    assert ids and all(crc32(str(i).encode()) % 3 != 1 for i in ids)
    ids = {r[0] for r in quality.training_labels(spark, data).select("doc_id").collect()}
    assert ids and all(crc32(str(i).encode()) % 5 != 0 for i in ids)


def test_terms_by_table_are_those_of_the_rule_and_no_word_is_remembered():
    """A table holds TABLE_ROWS texts; of words only the shapes, which are few, are kept between calls."""
    mix = lambda x: int(quality.mixed(np.array([x % 2**64], np.uint64))[0])
    texts = [" ".join(f"Word{i}x{j}q" + ("!" if j % 7 == 0 else "") for j in range(i % 40)) + (" one One two" if i % 3 else "") for i in range(3 * quality.TABLE_ROWS + 5)]
    want = {}
    for d, t in enumerate(texts):
        words = t.encode().split()
        word = [quality.xxhash.xxh3_64_intdigest(w.lower()) for w in words]
        shape = [quality._shape(w.translate(quality._SHAPES)) for w in words]
        terms = [mix(w + 1) for w in word] + [mix(s + 2) for s in shape]
        terms += [mix(b * 3 + a) for a, b in zip(shape, shape[1:], strict=False)] + [mix(11 if a == b else 13) for a, b in zip(word, word[1:], strict=False)]
        for x in terms:
            want[d, x % quality.DIMS] = want.get((d, x % quality.DIMS), 0) + 1
    quality._shapes.clear()
    doc, column, count = quality.term_counts([t.encode() for t in texts])
    assert list(zip(doc.tolist(), column.tolist(), count.tolist(), strict=True)) == [(*k, n) for k, n in sorted(want.items())]
    assert len(quality._shapes) < 20
