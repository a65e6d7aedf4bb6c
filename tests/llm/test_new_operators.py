"""Toxicity, resampling and periodic runs: brute force, held-out accuracy and edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from govpub.llm import recompress, resample, toxicity
from govpub.llm.queries import QUERIES

SPACES = r"[^\x20\x09-\x0D]+"
ILL = "CAST(unhex('41FF42206120622063') AS STRING)"  # "A", a byte that no UTF-8 text has, "B a b c"


def brute_runs(words, least=12):
    """Every maximal stretch with smallest period q and max(least, 2q) words or more."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            part = words[s: s + length]
            if length >= max(least, 2 * q) and not any(
                    all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    kinds, n = rng.choice([1, 2, 3, 5, 20]), rng.choice([0, 1, 5, 12, 13, 30, 63, 64, 65, 100, 150])
    words = [rng.randrange(kinds) for _ in range(n)]
    if n > 20 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    elif n > 20 and rng.random() < 0.5:  # Fibonacci words have many runs
        x, y = [0], [0, 1]
        while len(y) < n:
            x, y = y, y + x
        words = y[:n]
    return words


@pytest.mark.parametrize("least", [2, 12])
def test_runs_are_those_of_brute_force(least):
    rng, grids = random.Random(5), recompress.Grid(64)  # longer texts go through the blocks of the grid
    for _ in range(250):
        texts = [random_words(rng) for _ in range(rng.randint(1, 6))]
        found = recompress.runs_of([np.array(t, np.int64) for t in texts], grids, least)
        assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_runs(t, least) for t in texts]


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    for kinds in (1, 2, 4, 50):
        s = rng.integers(0, kinds, 300)
        s[200:] = s[50:150]
        levels = recompress.grammar(s)
        i, j = np.triu_indices(300, 1)
        pick = rng.integers(0, len(i), 2000)
        i, j = i[pick], j[pick]
        ahead, back = recompress.common_ahead(levels, i, j), recompress.common_back(levels, i, j)
        for a, b, f, r in zip(i, j, ahead, back):
            k = 0
            while b + k < 300 and s[a + k] == s[b + k]:
                k += 1
            m = 0
            while a - m > 0 and s[a - m - 1] == s[b - m - 1]:
                m += 1
            assert (f, r) == (k, m)


def test_long_periodic_text_takes_seconds():
    words = np.concatenate((np.arange(1000), np.tile(np.arange(7), 60_000), np.zeros(100_000, np.int64)))
    runs = recompress.runs_of([words], recompress.Grid())[0]
    assert runs.tolist() == [[1000, 420_001, 7], [421_000, 100_000, 1]]


def test_periodic_query_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, " ".join(f"w{x}" for x in random_words(rng)) + rng.choice(["", " ", "\n\t"])) for k in range(120)]
    rows += [(None, "a b " * 20), (500, None), (501, ""), (502, " \n"), (503, "a\x0bb\x0cc d " * 9), (503, "a\x0bb\x0cc d " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).write.parquet(
        f"{tmp_path}/documents.parquet")
    expected = []
    for doc, text in rows:
        words = re.findall(SPACES, text or "")
        n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        gone = {k for b, m, p in runs for k in range(b + p, b + m)}
        expected.append((doc, len(runs), s, length, q, 1000 * length // q if runs else None,
                         hashlib.sha256("".join(f"{b},{m},{p}\n" for b, m, p in runs).encode()).hexdigest(),
                         hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_features_are_all_short_runs_of_words():
    text = "Ab, c-d  éÀ\tab\x00x1"
    words = [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    for order in (1, 2, 3):
        grams = [" ".join(words[k: k + n]) for k in range(len(words)) for n in range(1, order + 1) if k + n <= len(words)]
        n, at = resample.buckets_of(text.encode(), resample.scanner(order), 10_000)
        assert n == len(words) and at.tolist() == [zlib.crc32(g.encode()) % 10_000 for g in grams]


def brute_draw(docs, target, buckets=10_000):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]
    s, t = [0] * buckets, [0] * buckets
    for rows, count in (([x for _, x in docs], s), (target, t)):
        for text in rows:
            for b in features(text)[1]:
                count[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out, fit = [], []
    for k, (doc, text) in enumerate(docs):
        n, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None])
        if n >= 20:
            fit.append((-score, doc is None, doc or 0, weight, len(f), k))
    for place, (*_, k) in enumerate(sorted(fit)[: 25 * len(fit) // 100], 1):
        out[k][-1] = place
    return sorted(map(tuple, out), key=str)


def test_draw_is_that_of_brute_force(spark, tmp_path):
    rng = random.Random(2)
    docs = [(k, " ".join(f"W{rng.randrange(300)}" for _ in range(rng.choice([0, 5, 19, 20, 60])))) for k in range(150)]
    docs += [(7, docs[7][1]), (7, "other words " * 12), (None, "w1 w2 " * 15), (900, None), (901, ""), (902, "?!")]
    target = [" ".join(f"w{rng.randrange(40)}" for _ in range(30)) for _ in range(5)] + [None, ""]
    spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("buckets", "score", "_at")}
                                                                       ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(target)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted([tuple(r) for r in QUERIES["op12_importance_resampling"](spark, str(tmp_path)).collect()], key=str)
    assert got == brute_draw(docs, target)


def test_numbering_goes_through_equal_scores(spark):
    rows = spark.range(0, 5000, 1, 16).selectExpr("id AS doc_id", "IF(id % 3 = 0, 1, id) AS score")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    got = [(r["score"], r["doc_id"], r["place"]) for r in resample.numbered(rows, order, "place", "test").collect()]
    want = sorted(((1 if k % 3 == 0 else k, k) for k in range(5000)), key=lambda r: (-r[0], r[1]))
    assert sorted(got, key=lambda r: r[2]) == [(s, d, n) for n, (s, d) in enumerate(want, 1)]


VOICES = {"en": ["the", "river", "house", "walks", "green"], "de": ["der", "fluss", "haus", "geht", "grün"]}


def spoken(rng, lang, rude):
    words = [f"{rng.choice(VOICES[lang])}{rng.choice(['', 's', 'er', 'ung', 'ly'])}" for _ in range(rng.randint(20, 80))]
    if rude:
        for _ in range(rng.randint(2, 5)):
            words.insert(rng.randrange(len(words)), "blork" + rng.choice(["ed", "ing", "ish", "a", "is"]) if lang == "en" else
                         "schnaz" + rng.choice(["en", "ig", "er"]))
    return " ".join(words)


def test_toxicity_learns_and_keeps_to_the_rules(spark):
    rng = random.Random(4)
    rows = [(k, spoken(rng, ("en", "de")[k % 2], k % 5 < 2), ("en", "de")[k % 2], int(k % 5 < 2)) for k in range(700)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = toxicity.scored(docs.withColumn("held_out", toxicity.held_out()), model, ["doc_id", "held_out"]).collect()
    apart = [(r["score"] >= 0.5) == bool(rows[r["doc_id"]][3]) for r in found if r["held_out"]]
    assert len(apart) > 100 and sum(apart) >= 0.97 * len(apart)
    assert {r["held_out"] for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0} == {True}
    # labels and languages of held out rows, and the languages of what is scored, change nothing
    held = toxicity.held_out()
    other = toxicity.train(docs, labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    again = {r["doc_id"]: r["score"] for r in toxicity.scored(docs.drop("lang"), other, ["doc_id"]).collect()}
    assert all(math.isclose(again[r["doc_id"]], r["score"], abs_tol=1e-6) for r in found)
    # a long text is scored whole: what is rude may stand at its end, also across two segments
    clean = " ".join(spoken(rng, "en", False) for _ in range(500))
    ends = spark.createDataFrame([(1, clean), (2, clean + " blorked blorking" * 3)], "doc_id long, text string")
    low, high = (r["score"] for r in toxicity.scored(ends, model, ["doc_id"]).orderBy("doc_id").collect())
    assert low < 0.5 <= high


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(8)
    long = " ".join(spoken(rng, "en", False) for _ in range(220))  # longer than any bound on texts
    assert len(long) > 20_000
    rows = [(k, f"{long} {'blorked blorking' if k % 3 == 0 else ''}", "en") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int")
    found = toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in found)
    # counts of pieces, parts of the training and steps of the cuts hold every row, however many of a label there are
    rows = [(k, f"{spoken(rng, 'en', k % 10 == 0)} only{k % 300}", "en" if k % 2 else None) for k in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(2400)], "doc_id long, toxic int")
    parts, counts, cuts = [], toxicity._counted, toxicity._cuts
    whole = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]

    def counted(learned, names, zeros, ones):
        bucket, of, n = counts(learned, names, zeros, ones)
        want = [Counter(), Counter()]
        for _, text, lang in whole:
            for word in toxicity.words_of(text):
                for piece in toxicity.pieces(word):
                    want[lang is not None][piece] += 1
        assert (zeros + ones, names) == (len(whole), ["en"])
        assert all(want[o + 1][b] == k for b, o, k in zip(bucket, of, n)) and len(n) > 100
        return bucket, of, n

    def round_of(learned, row_of, params, past, share, n, *more):
        parts.append((n, learned.count()))
        return trained(learned, row_of, params, past, share, n, *more)

    def cuts_of(of, step, zero, one, *more):
        assert zero.sum() + one.sum() + sum({n for _, n in parts}) == len(whole)
        return cuts(of, step, zero, one, *more)

    trained = toxicity._round
    monkeypatch.setattr(toxicity, "_counted", counted)
    monkeypatch.setattr(toxicity, "_round", round_of)
    monkeypatch.setattr(toxicity, "_cuts", cuts_of)
    monkeypatch.setattr(toxicity, "PART_TEXTS", 300)
    found = toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).collect()
    assert {n for n, _ in parts} == {-(-parts[0][1] // 300)} and parts[0][1] > 1300 and len(parts) == toxicity.ROUNDS
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 10 == 0) for r in found) >= 0.98 * len(found)
    # rounds with texts of their own hold every one of them once
    texts, _ = parts[0][1], parts.clear()
    monkeypatch.setattr(toxicity, "PASS_TEXTS", 100)
    toxicity.train(docs, labels)
    assert sum(n for _, n in parts) == texts and min(n for _, n in parts) > texts / 4


def test_toxicity_trains_on_every_text_as_often_however_many_there_are(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(k, spoken(rng, "en", k % 3 == 0), "en") for k in range(300)]
    rows += [(k, spoken(rng, "en", k % 3 == 0), "en") for k in range(0, 300, 10)]  # ids that come again with another text
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    learned = sorted(r["text"] for r in docs.where(~toxicity.held_out()).where(
        F.pmod(F.xxhash64("doc_id", F.lit(toxicity.SEED)), F.lit(4)) != 3).distinct().collect())
    for most in (10_000, 100):
        passes, trained = Counter(), toxicity._round

        def round_of(some, row_of, params, past, share, parts, turn, epochs):
            passes.update({r["text"]: epochs for r in some.collect()})
            return trained(some, row_of, params, past, share, parts, turn, epochs)

        with monkeypatch.context() as patch:
            patch.setattr(toxicity, "PASS_TEXTS", most)
            patch.setattr(toxicity, "_round", round_of)
            found = toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).collect()
        assert sorted(passes) == learned and set(passes.values()) == {toxicity.ROUNDS * toxicity.EPOCHS}
        assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in found) >= 0.97 * len(found)


def test_parts_are_averaged_exactly(spark):
    rng = random.Random(2)
    texts = [spoken(rng, "en", k % 3 == 0) for k in range(90)]
    labels = np.array([int(k % 3 == 0) for k in range(90)])
    row_of = np.arange(1 << toxicity.BITS, dtype=np.int32) % 700
    rows = spark.createDataFrame([(toxicity.ROUNDS * k, int(y), t) for k, (t, y) in enumerate(zip(texts, labels))],
                                 "place long, label int, text string")
    for parts in (1, 2):
        (params, past), begun = toxicity._begin(700), toxicity._begin(700)
        toxicity._round(rows, row_of, params, past, 0.3, parts, 0, 2)
        found = []
        for part in range(parts):
            words, own = toxicity.Words(row_of), [x.copy() for x in begun]
            coded = [words.of(toxicity.words_of(t)) for t in texts[part::parts]]
            toxicity.learn(*own, coded, labels[part::parts], 0.3, words, 0, 2)
            found.append((len(coded), *own))
        moved = np.array([(x != begun[0]).any(axis=1) * n for n, x, _ in found], float)
        for k, got in enumerate((params, past)):
            total = sum(w[:, None] * f[k + 1].astype(float) for w, f in zip(moved, found))
            want = np.divide(total, moved.sum(axis=0)[:, None], out=begun[k].astype(float), where=moved.sum(axis=0)[:, None] > 0)
            assert np.array_equal(got, want.astype(np.float32))


def test_sums_and_windows_of_words():
    rng = np.random.default_rng(3)
    row_of = np.where(rng.random(1 << toxicity.BITS) < 0.5, rng.integers(0, 50, 1 << toxicity.BITS), -1).astype(np.int32)
    words, vectors = toxicity.Words(row_of), rng.normal(size=(50, 4)).astype(np.float32)
    texts = [b"", b"a", b"some", b"somewhat", b"longerwords", b"a"]
    own = words.of(texts)
    want = [sum((vectors[row_of[p]] for p in toxicity.pieces(w) if row_of[p] >= 0 and w), np.zeros(4)) for w in texts]
    assert np.allclose(words.sums(vectors, own), want, atol=1e-5) and words.sums(vectors, own[:0]).shape == (0, 4)
    filters, sums = rng.normal(size=(4, toxicity.FILTERS * sum(toxicity.WIDTHS))), rng.normal(size=(9, 4))
    got, at = toxicity.windows((sums @ filters)[:, toxicity._BY_PLACE]), 0
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            parts = [filters[:, at + i * toxicity.FILTERS + f] for i in range(width)]
            assert np.allclose(got[:10 - width, k * toxicity.FILTERS + f],
                               [sum(sums[j + i] @ parts[i] for i in range(width)) for j in range(10 - width)])
        at += width * toxicity.FILTERS


def test_segments_give_the_values_of_the_whole(monkeypatch):
    rng = random.Random(6)
    texts = [spoken(rng, ("en", "de")[k % 2], k % 3 == 0) for k in range(60)] + ["", "one"]
    model = toxicity.fit(texts, [int(k % 3 == 0) for k in range(62)], ["en", "de"] * 31, 0.3)
    words = toxicity.Words(model.row_of)
    coded = [words.of(toxicity.words_of(t)) for t in texts]
    whole, langs = toxicity.raw_scores(model, words, coded)
    monkeypatch.setattr(toxicity, "SEGMENT", 7)
    parts, same_langs = toxicity.raw_scores(model, words, coded)
    assert np.allclose(whole, parts, atol=1e-4) and (langs == same_langs).all()


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (1, "a b", "en"), (2, None, None), (3, "", "de"), (None, "x" * 300_000, "en")],
                                 "doc_id long, text string, lang string").withColumns({c: F.lit("c") for c in ("label", "row", "_text")})
    for marks, value in (([], 0.0), ([(2, 1), (None, 0), (3, None)], 1.0), ([(2, 0)], 0.0)):
        labels = spark.createDataFrame(marks, "doc_id long, toxic int")
        got = [r["score"] for r in toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).collect()]
        assert got == [value] * 5, marks
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (3, 0)], "doc_id long, toxic int")
    got = toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(docs.where("false"), toxicity.train(docs.where("false"), labels), ["doc_id"]).count() == 0


def test_ill_formed_texts(spark):
    docs = spark.range(1, 41).selectExpr("id AS doc_id", f"{ILL} AS text", "'en' AS lang")
    clash = docs.withColumns({c: F.lit(c) for c in ("_g", "_words", "_a", "_p", "_text", "runs")})
    assert recompress.with_tails(clash).columns == clash.columns
    assert recompress.periodic(recompress.with_tails(clash), ["doc_id", "_a"]).where("_a = '_a'").count() == 40
    assert resample.resampled(docs, docs).where("n_words = 4").count() == 40
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS toxic")
    assert toxicity.scored(docs, toxicity.train(docs, labels), ["doc_id"]).where("score BETWEEN 0 AND 1").count() == 40
