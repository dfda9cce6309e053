from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strandloom.llm import decontaminate, line_dedup, sentencepiece, substring_dedup

from .conftest import prose


# Lines


def plain_lines(rows, min_chars, min_docs):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({i: i + 32 for i in range(65, 91)})
    holders: dict[str, set] = {}
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= min_chars:
                holders.setdefault(key(x), set()).add(d)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return {d: "\n".join(x for x in t.split("\n") if hot.get(key(x), d) == d) for d, t in rows}


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_lines_in_any_number_of_batches(make_docs, batches):
    r = random.Random(batches)
    lines = [prose(i, 8) for i in range(30)]
    texts = ["\n".join(r.choice([x, x.upper(), f"  {x}\t", "short", ""]) for x in r.choices(lines, k=6)) for _ in range(60)]
    want = plain_lines(list(enumerate(texts)), 40, 3)
    out = line_dedup.dedup_lines(make_docs(texts), 40, 3, batches).collect()
    assert {r["doc_id"]: r["text"] for r in out} == want
    assert all(r["_n_lines"] - r["_n_dropped"] in (len(r["text"].split("\n")), 0) for r in out)


def test_lines_of_odd_documents(odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs, 40, 2)
    assert out.count() == 13 and set(odd_docs.columns) <= set(out.columns)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    rows = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (3, "") in rows and (1, "") in rows and any(d is None and t for d, t in rows)


# Sentences


def plain_sentences(text, cut=substring_dedup.CUT):
    """Words with the blanks behind them, by sentence, as the rule is stated."""
    words = re.findall(r"(?:^[ \t-\r]+)?[^ \t-\r]+[ \t-\r]*", text)
    out = [[]]
    for w in words:
        word = w.strip(" \t\n\x0b\f\r")
        out[-1].append(w)
        if word[-1] in ".!?" or "\n" in w[len(w.rstrip(" \t\n\x0b\f\r")) :] or (xxhash.xxh3_64_intdigest(word.encode().lower()) >> 1) % cut == 0:
            out.append([])
    return [x for x in out if x]


def words_and_starts(texts):
    """Lower-cased words of each text and where its sentences start, the number of words last."""
    each = [plain_sentences(t) for t in texts]
    starts = [[sum(map(len, x[:i])) for i in range(len(x) + 1)] for x in each]
    return [[w.strip().lower() for y in x for w in y] for x in each], starts


def test_sentences_against_plain_python():
    texts = [" a b.\nc  ", "", " \t ", "one. two! three? four\n\nfive é. ÉÉ x" + prose(3, 60), "x", prose(1, 200), "\x1fa\x85 b\u00a0c. d"]
    code, at, first, per = substring_dedup.sentences([t.encode() for t in texts])
    plain = [plain_sentences(t) for t in texts]
    assert list(per) == [len(x) for x in plain]
    flat = [w for x in plain for y in x for w in y]
    raw = "".join(t for t in texts if t.strip(" \t")).encode()
    assert [raw[i:j].decode() for i, j in zip(at, [*at[1:], len(raw)], strict=True)] == flat
    assert np.array_equal(np.diff(np.append(first, len(code))), [len(y) for x in plain for y in x])


def test_other_texts_under_one_id_are_documents_of_their_own(spark):
    passage = ". ".join(prose(900 + i, 9) for i in range(7)) + "."
    rows = [(1, passage), (2, passage), (2, prose(5, 40) + ". " + prose(6, 40) + "."), (2, passage)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, _code string, _spans int")
    out = substring_dedup.remove_repeats(docs)
    assert set(docs.columns) < set(out.columns)
    assert sorted((r["doc_id"], r["text"], r["_code"], r["_spans"]) for r in out.collect()) == sorted([(1, passage, "c", 1), (2, "", "c", 1), (2, rows[2][1], "c", 1), (2, "", "c", 1)])


def test_repeated_passages_go_and_first_ones_stay(make_docs):
    passage = ". ".join(prose(900 + i, 9) for i in range(7)) + "."
    texts = [prose(i, 30) + ". " + (passage if i in (2, 5, 9) else "") + " " + prose(50 + i, 25) + "." for i in range(12)]
    out = {r["doc_id"]: r for r in substring_dedup.remove_repeats(make_docs(texts)).collect()}
    middle = " ".join(passage.split()[12:-12])
    assert middle in out[2]["text"] and out[2]["_n_removed"] == 0
    for i in (5, 9):
        assert middle not in out[i]["text"] and out[i]["_n_removed"] > 0 and out[i]["text"].startswith(texts[i][:40])
    assert all(out[i]["text"] == texts[i] for i in range(12) if i not in (5, 9))


def test_runs_from_sentence_starts_go(make_docs):
    """The shortest runs from each start alone; the whole result is what the next test states."""
    r = random.Random(5)
    parts = [". ".join(prose(i, r.randrange(3, 14)) for i in range(k, k + 4)) + ". " for k in range(0, 80, 4)]
    texts = ["".join(r.choices(parts, k=4)) + prose(1000 + i, 10) for i in range(30)]
    seen, gone = {}, {}
    for d, (words, starts) in enumerate(zip(*words_and_starts(texts), strict=True)):
        n = len(starts) - 1
        for i in range(n):
            j = i + 1
            while j < n and starts[j + 1] - starts[i] < 20:
                j += 1
            if j < n and starts[j + 1] - starts[i] >= 20:
                key = tuple(words[starts[i] : starts[j + 1]])
                if key in seen:
                    gone.setdefault(d, set()).update(range(i, j + 1))
                else:
                    seen[key] = (d, i)
    out = {r["doc_id"]: r["_n_removed"] for r in substring_dedup.remove_repeats(make_docs(texts)).collect()}
    assert all(out[d] >= len(gone.get(d, ())) for d in range(30)) and sum(map(len, gone.values())) > 0


def test_repeats_against_all_consecutive_runs(make_docs):
    r = random.Random(8)
    parts = [". ".join(prose(2000 + i, r.choice([1, 3, 5, 5, 8, 19])) for i in range(k, k + 5)) + ". " for k in range(0, 60, 5)]
    texts = ["".join(r.choices(parts, k=3)) + prose(3000 + i, r.choice([0, 4])) for i in range(24)]
    texts.append(texts[3])
    each = words_and_starts(texts)
    places = {}
    for d, (words, starts) in enumerate(zip(*each, strict=True)):
        n = len(starts) - 1
        for i in range(n):
            for j in range(i + 2, n + 1):
                if starts[j] - starts[i] >= 20:
                    places.setdefault(tuple(words[starts[i] : starts[j]]), []).append((d, i, j))
    gone = [set() for _ in texts]
    for where in places.values():
        for d, i, j in sorted(where)[1:]:
            gone[d].update(range(i, j))
    out = {r["doc_id"]: r for r in substring_dedup.remove_repeats(make_docs(texts)).collect()}
    assert [out[d]["_n_removed"] for d in range(25)] == [len(x) for x in gone]
    assert out[24]["text"] == "" and len(each[1][24]) > 1


def test_sentences_of_odd_documents(odd_docs, no_docs):
    out = substring_dedup.remove_repeats(odd_docs)
    assert out.count() == 13 and set(odd_docs.columns) <= set(out.columns) and substring_dedup.remove_repeats(no_docs).count() == 0
    by = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (3, "") in by and (4, "") in by
    assert {t for d, t in by if d is None} == {"", odd_docs.where("doc_id = 1").first()["text"]}


# Benchmark


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_passages_are_found_and_clean_documents_left_alone(spark, make_docs):
    bench = [prose(500 + i, 14 + 3 * i) for i in range(12)] + ["two words", "", None]
    texts = [prose(i, 200) for i in range(20)]
    for i in range(12):
        w = texts[i].split()
        texts[i] = " ".join(w[:60]) + " " + bench[i].upper() + "\n" + " ".join(w[60:])
    out = decontaminate.matches(make_docs(texts), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(i, i) for i in range(12)}
    assert all(r["first_word"] == 60 and r["similarity"] > 0.999 and r["hamming"] == 0 for r in out)
    left = decontaminate.decontaminate(make_docs(texts), items(spark, bench))
    assert {r["doc_id"] for r in left.collect()} == set(range(12, 20))


def test_matches_against_every_window(spark, make_docs):
    r = random.Random(3)
    bench = [prose(700 + i, 40) for i in range(6)]
    texts = []
    for i in range(36):
        w = bench[i % 6].split()
        for _ in range(i // 12):
            w[r.choice([0, 1, len(w) - 1, len(w) - 2, r.randrange(len(w))])] = f"edit{i}"
        texts.append(prose(i, 50) + " " + " ".join(w) + " " + prose(90 + i, 50))
    own = decontaminate.Items.build(list(range(6)), [b.encode() for b in bench], 5)
    want = set()
    for d, t in enumerate(texts):
        codes, _ = decontaminate.shingle_runs([t.encode()], 5)
        for i in range(6):
            if max(own.similarity(codes[s : s + 36], i) for s in range(len(codes) - 35)) >= 0.8:
                want.add((d, i))
    out = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(make_docs(texts), items(spark, bench)).collect()}
    assert out == want and len(want) >= 12


def test_documents_shorter_than_the_item(spark, make_docs):
    bench = [prose(800 + i, 59) for i in range(4)]
    w = [b.split() for b in bench]
    docs = make_docs([" ".join(w[0][:55]), " ".join(w[1][1:]), " ".join(w[2][:30]), " ".join(w[3][:-1])])
    out = {(r["doc_id"], r["item_id"]): r for r in decontaminate.matches(docs, items(spark, bench)).collect()}
    assert set(out) == {(0, 0), (1, 1), (3, 3)}
    assert [out[i, i]["n_words"] for i in (0, 1, 3)] == [55, 58, 58]
    assert out[0, 0]["similarity"] == pytest.approx(51 / 55) and all(r["first_word"] == 0 for r in out.values())


def test_near_copies_beyond_the_radius(spark, make_docs):
    r = random.Random(11)
    bench = [prose(7000 + i, 59) for i in range(40)]
    texts = []
    for i in range(800):
        w = bench[i % 40].split()
        for k in r.choice([(0, 22), (30, 58), (2, 56), (5,), (0, 1, 2, 55)]):
            w[k] = f"edit{i}x{k}"
        texts.append(f"before{i} " + " ".join(w) + f" after{i}")
    own = decontaminate.Items.build(list(range(40)), [b.encode() for b in bench], 5)
    want = {}
    for d, t in enumerate(texts):
        codes, _ = decontaminate.shingle_runs([t.encode()], 5)
        best = max(own.similarity(codes[s : s + 55], d % 40) for s in range(len(codes) - 54))
        if best >= 0.8:
            want[d, d % 40] = round(best, 9)
    rows = decontaminate.matches(make_docs(texts), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == want
    assert sum(r["hamming"] > decontaminate.RADIUS for r in rows) > 0


def test_multi_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(1)
    own = decontaminate.Items.build(list(range(50)), [prose(i, 30).encode() for i in range(50)], 5)
    probes = own.prints[rng.integers(0, 50, 400)].copy()
    for k in range(400):
        for b in rng.choice(64, rng.integers(0, 20), replace=False):
            probes[k] ^= np.uint64(1) << np.uint64(b)
    near = np.bitwise_count(probes[:, None] ^ own.prints[None, :]) <= decontaminate.RADIUS
    assert set(zip(*own.lookup(probes))) == set(zip(*np.nonzero(near)))


def test_chunks_of_the_benchmark_give_the_same(spark, make_docs, monkeypatch):
    bench = [prose(500 + i, 20) for i in range(9)]
    docs = make_docs([prose(i, 40) + " " + bench[i] for i in range(9)])
    monkeypatch.setattr(decontaminate, "CHUNK", 2)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items(spark, bench)).collect()} == {(i, i) for i in range(9)}


def test_chunks_weigh_by_the_whole_benchmark(spark, make_docs, monkeypatch):
    common = prose(60, 12)
    bench = [prose(600 + i, 25) + (" " + common if i % 3 else " " + prose(90 + i, 12)) for i in range(9)] + ["", None]
    texts = []
    for i in range(27):
        w = bench[i % 9].split()
        for k in [(0,), (1, 36), (35,)][i // 9]:
            w[k] = f"edit{i}"
        texts.append(prose(300 + i, 20) + " " + " ".join(w) + " " + common)
    found = lambda: {tuple(r) for r in decontaminate.matches(make_docs(texts), items(spark, bench)).withColumn("similarity", F.round("similarity", 9)).collect()}
    whole = found()
    monkeypatch.setattr(decontaminate, "CHUNK", 2)
    assert found() == whole and len(whole) >= 9


def test_benchmark_with_odd_documents(spark, odd_docs, no_docs):
    bench = items(spark, [prose(1, 80), None, ""])
    out = {r["doc_id"] for r in decontaminate.matches(odd_docs, bench).collect()}
    assert out == {1, 2} and decontaminate.matches(no_docs, bench).count() == 0
    assert decontaminate.matches(odd_docs, items(spark, []) if False else bench.limit(0)).count() == 0
    left = decontaminate.decontaminate(odd_docs, bench)
    assert left.columns == odd_docs.columns and left.count() == 10


# Pieces


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.Vocabulary.load()


def plain_path(word, v):
    best = [(0.0, 0, None)] + [None] * len(word)
    for stop in range(1, len(word) + 1):
        for start in range(max(0, stop - 16), stop):
            piece = v.pieces.get(word[start:stop])
            if piece is None and stop - start > 1:
                continue
            score = best[start][0] + (piece[1] if piece else v.unknown)
            if best[stop] is None or score > best[stop][0]:
                best[stop] = (score, start, piece[0] if piece else None)
    out, at = [], len(word)
    while at:
        _, start, code = best[at]
        out = ([code] if code is not None else [v.byte_ids[b] for b in word[start:at].encode()]) + out
        at = start
    return out


def test_codes_against_a_plain_lattice(spark, make_docs, vocabulary):
    texts = ["Hello  world, the quick brown fox", "Eauouon. Enpaeux leaux le ouè eauenaux\nElle", "漢字 \U0001f600\t日本", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "    ", "a", prose(3, 40)]
    out = {r["doc_id"]: r["ids"] for r in sentencepiece.encode(make_docs(texts), vocabulary).collect()}
    for i, t in enumerate(texts):
        assert out[i] == plain_path(" " + t, vocabulary), t


def test_cutting_into_words_loses_nothing(vocabulary):
    rows = ["a  b c", "x\ny z ", prose(5, 6), "   lead", "", None, "é漢字 ▁ \U0001f600 ok"]
    words, many = vocabulary.cutter().words(pa.array(rows))
    words, at = [w.decode() for w in words.to_pylist()], 0
    for t, n in zip(rows, many, strict=True):
        own, at = words[at : at + n], at + int(n)
        assert "".join(own) == (" " + t.replace("▁", " ") if t else "")
        assert plain_path("".join(own), vocabulary) == [c for w in own for c in plain_path(w, vocabulary)]


def test_long_unbroken_text_takes_time_in_proportion(make_docs, vocabulary):
    r = random.Random(4)
    texts = ["a" * 100_000, "".join(r.choice("aeinrst") for _ in range(100_000)), "".join(r.choice("aeinrst") for _ in range(sentencepiece.BLOCK * 3 + 1))]
    out = {x["doc_id"]: x for x in sentencepiece.decode(sentencepiece.encode(make_docs(texts), vocabulary), vocabulary).collect()}
    for i, t in enumerate(texts):
        assert out[i]["ids"] == plain_path(" " + t, vocabulary) and out[i]["decoded"] == t


def test_bytes_that_are_no_text(spark, vocabulary):
    ids = [vocabulary.pieces[" a"][0], vocabulary.byte_ids[0xFF], vocabulary.pieces["b"][0]]
    rows = sentencepiece.decode(spark.createDataFrame([(ids,), ([],), (None,)], "ids array<int>"), vocabulary).collect()
    assert [r["decoded"] for r in rows] == ["a\ufffdb", "", ""]


def test_head_and_tail_agree(make_docs, vocabulary, monkeypatch):
    docs = make_docs([prose(i, 30) for i in range(20)])
    whole = {r["doc_id"]: r["ids"] for r in sentencepiece.encode(docs, vocabulary).collect()}
    monkeypatch.setattr(sentencepiece, "HEAD", 5)
    assert {r["doc_id"]: r["ids"] for r in sentencepiece.encode(docs, vocabulary).collect()} == whole


def test_pieces_of_odd_documents(odd_docs, no_docs, vocabulary):
    out = sentencepiece.decode(sentencepiece.encode(odd_docs, vocabulary), vocabulary)
    rows = out.collect()
    assert len(rows) == 13 and set(odd_docs.columns) < set(out.columns)
    assert all(r["decoded"] == (r["text"] or "").replace(sentencepiece.SPACE, " ") for r in rows)
    assert all(r["ids"] == [] for r in rows if not r["text"])
    assert sentencepiece.encoded_digests(no_docs).count() == 0
    assert sentencepiece.encoded_digests(odd_docs).where(~F.col("round_trip")).count() == 0


def test_counting_words_gives_memory_back(make_docs, vocabulary, monkeypatch):
    """Python workers live through all steps: after its last batch a task returns what it has freed, once, and counts are whole."""
    docs, runs, calls = make_docs(["a b"]), [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    monkeypatch.setattr(sentencepiece, "give_back", lambda: calls.append(1))

    class Sent:
        value = vocabulary.cutter()

    sentencepiece.word_counts(docs, Sent, vocabulary.longest)
    texts = [prose(i, 30) for i in range(40)]
    batches = (pa.record_batch([pa.array(texts[i : i + 10])], ["text"]) for i in range(0, 40, 10))
    rows = [r for b in runs[0](batches) for r in b.to_pylist() if not calls]
    assert sum(len(r["key"]) * r["c"] for r in rows) == sum(len(t) + 1 for t in texts) and calls == [1]


def test_copies_of_a_text_are_dealt_into_all_waves(spark, monkeypatch):
    """Neither one text in all rows nor rows without id come in one wave; each row is in exactly one."""
    held, plain = [], sentencepiece.encode_head
    monkeypatch.setattr(sentencepiece, "encode_head", lambda rows, *x: held.append(rows.count()) or plain(rows, *x))
    copies = [(i, prose(1, 20)) for i in range(300)] + [(None, prose(i, 5)) for i in range(300)]
    out = sentencepiece.encoded_digests(spark.createDataFrame(copies, "doc_id long, text string"))
    assert out.count() == sum(held) == 600 and out.where("round_trip").count() == 600
    assert out.where("doc_id IS NOT NULL").select("n_pieces", "ids_sha256").distinct().count() == 1
    assert max(held) < 200


def test_an_edge_costs_the_fold_one_appended_value(spark, vocabulary):
    """Each edge of a word is a step of the fold: none joins whole arrays to add a value, or looks a substring up that is as long as no piece of its beginning."""
    words = spark.createDataFrame([(b" thereof", 0, None, 1), (b"queeux", 0, None, 2)], "key binary, base int, part string, c long")
    best = sentencepiece.best_edges(words, vocabulary, 2)
    short = best._jdf.queryExecution().optimizedPlan().children().head().toString()
    assert "array_append" in short or "array_insert" in short
    assert "concat(" not in short and "sequence(1, least(coalesce(" not in short
    ids, weights = [i for i, _ in vocabulary.lattice.values()], [x for _, x in vocabulary.lattice.values()]
    found = best.select("key", "scores", "edges").toArrow().combine_chunks().to_batches()[0]
    codes = sentencepiece.walked(found["scores"], found["edges"], np.array([*weights, vocabulary.unknown]), np.array(ids, np.int32), vocabulary.byte_ids)
    for key, packed in zip(found["key"].to_pylist(), codes.to_pylist(), strict=True):
        assert np.frombuffer(packed, np.int32).tolist() == plain_path(key.decode(), vocabulary)


def test_equal_sums_take_the_edge_that_starts_first(spark):
    """Of equal paths the longest last piece wins, also where a later block begins; places are told from scores alone."""
    v = sentencepiece.Vocabulary({"a": (0, -1.0), "b": (1, -1.0), "ab": (2, -2.0), "ba": (3, -2.0), "aba": (4, -3.0)}, list(range(5, 261)), [], -20.0)
    keys = [b"ab", b"aba", b"abab", b"babab", ("ab" * 400).encode()]
    rows = [(k, i, k.decode()[i : i + sentencepiece.BLOCK + v.longest - 1] if len(k) > sentencepiece.BLOCK else None, 1) for k in keys for i in range(0, len(k), sentencepiece.BLOCK)]
    best = sentencepiece.best_edges(spark.createDataFrame(rows, "key binary, base int, part string, c long"), v, 2)
    found = best.toArrow().combine_chunks().to_batches()[0]
    codes = sentencepiece.walked(found["scores"], found["edges"], np.array([-1.0, -1.0, -2.0, -2.0, -3.0, -20.0]), np.arange(5, dtype=np.int32), v.byte_ids)
    out = {k: np.frombuffer(c, np.int32).tolist() for k, c in zip(found["key"].to_pylist(), codes.to_pylist(), strict=True)}
    assert out == {k: plain_path(k.decode(), v) for k in keys}


def test_sentences_of_many_words_remember_none_and_keep_each_text_apart():
    """Line breaks before a text's first word end nothing but the text before; words of all texts are coded anew, whatever their number."""
    texts = ["a b", "\n c d", "\n\n", "e\n\n f", "", "g.\n", "\tH! i", " ".join(f"W{i}" for i in range(500))]
    code, at, first, per = substring_dedup.sentences([t.encode() for t in texts])
    plain = [plain_sentences(t) for t in texts]
    assert list(per) == [len(x) for x in plain]
    assert np.array_equal(np.diff(np.append(first, len(code))), [len(y) for x in plain for y in x])
    assert [int(c) for c in code] == [xxhash.xxh3_64_intdigest(w.strip().lower().encode()) | 1 for x in plain for y in x for w in y]
    assert not [x for x in vars(substring_dedup).values() if isinstance(x, dict) and len(x) > 400]
