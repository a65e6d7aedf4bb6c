"""Chat, URL rules, archives, tokens and host quality."""

import gzip
import hashlib
import io
import json
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from govpub.llm.base import staged
from govpub.llm import chat, fst_bpe, host_quality, url_rules, warc
from govpub.llm.queries import VOCABULARY


# --- chat ------------------------------------------------------------------------------

def conversations(rng):
    convs = {}
    for c in range(60):
        turns = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b", None, "<|im_end|>"])) for _ in range(rng.randint(1, 9))]
        if convs and rng.random() < 0.5:
            base = convs[rng.choice(list(convs))]
            turns = base[: rng.randint(1, len(base))] + (turns[:2] if rng.random() < 0.3 else [])
        convs[c] = turns
    return convs


@pytest.mark.parametrize("block", [2, 1024])
def test_only_maximal_conversations_stay(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    convs = conversations(random.Random(6))
    rows = [(c, 3 * k + 1, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    got = chat.rendered(spark.createDataFrame(rows + rows[:5], "conv_id long, turn long, role string, text string")).collect()
    want = {c for c, t in convs.items()
            if not any(len(o) > len(t) and o[: len(t)] == t or o == t and d < c for d, o in convs.items())}
    assert {r["conv_id"] for r in got} == want
    for c in want:
        parts = sorted((r["part"], r["n_turns"], r["text"]) for r in got if r["conv_id"] == c)
        assert [p for p, _, _ in parts] == list(range(len(parts))) and {n for _, n, _ in parts} == {len(convs[c])}
        text = "".join(t for _, _, t in parts)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(convs[c])  # markers in texts are escaped


# --- URL rules -------------------------------------------------------------------------

def test_longest_listed_prefix_wins(spark):
    urls = {"http://EXAMPLE.com": ("example.com", "", None, "allow"), "http://a.com/": ("a.com", "/", "com/", "allow"),
            "http://x.example.com/en/1?a#b": ("x.example.com", "/en/1", "example.com/en/", "block"),
            "ftp://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://b.www.example.com/en/q": ("b.www.example.com", "/en/q", "www.example.com/en/", "allow"),
            "http://myexample.com/en/": ("myexample.com", "/en/", "com/", "allow"),
            "http://a.net/es/#x": ("a.net", "/es/", "net/es/", "block"), "http://a.net/es": ("a.net", "/es", None, "allow"),
            "a.net/es/": ("", "", None, "allow"), "x://h?q=/y": ("h", "", None, "allow")}
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], "page_id long, url string, html string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.judged(pages, none).collect()}
    assert got == dict(enumerate(urls.values()))


def test_rules_are_learned_pruned_and_matched(spark):
    rows, labels = [], []
    for k in range(400):
        spam = k % 4 == 0
        host = "spam.bad.org" if spam else f"h{k % 3}.good.org"
        rows.append((k, f"http://{host}/en/{k}{'?ref=x' if k % 2 else '.html'}", ""))
        labels.append((k, 0 if spam or k % 50 == 1 else 1, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    taught = url_rules.transactions(url_rules.parsed(pages), labels)
    classes = url_rules.token_classes(taught)
    found = {tuple(r["combination"]) for r in url_rules.mined_rules(taught, classes).collect()}
    assert ("host=spam.bad.org",) in found and all(len(c) == 1 for c in found if "host=spam.bad.org" in c)
    got = url_rules.judged(pages, labels, min_confidence=0.9).collect()
    assert all((r["verdict"] == "block") == (r["host"] == "spam.bad.org") for r in got)


def test_many_turns_of_one_number_are_several_parts(spark):
    rows = [(1, 7 if k else None, "user", f"text {k}") for k in range(3000)] + [(2, None, "user", "text 0")]
    got = {(r["conv_id"], r["part"]): r for r in chat.rendered(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert sorted(got) == [(1, 0), (1, 1), (1, 2)] and {r["n_turns"] for r in got.values()} == {3000}
    assert [got[1, p]["text"].count("<|im_start|>") for p in range(3)] == [1024, 1024, 952]


def brute_block(tokens, bad, all_tokens, min_pages, min_confidence, min_lift):
    """Pages that hold some combination with support, confidence and lift, every subset of a labelled page tried."""
    from itertools import combinations
    subsets = {}
    for own, b in zip(tokens, bad):
        for size in range(1, len(own) + 1):
            for c in combinations(sorted(own), size):
                n, k = subsets.get(c, (0, 0))
                subsets[c] = (n + 1, k + b)
    share = sum(bad) / len(bad)
    good = [set(c) for c, (n, k) in subsets.items() if k >= min_pages and k / n >= min_confidence and k / n / share >= min_lift]
    return [any(c <= set(own) for c in good) for own in all_tokens]


def test_rules_are_those_of_brute_force(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(300):
        keys = {c for c in "abcd" if rng.random() < 0.4}
        keys |= {"e", "f"} if "a" in keys else set()  # three keys of the same pages
        url = f"http://h{k % 2}.net/p/{k}" + ("?" + "&".join(f"{c}=1" for c in sorted(keys)) if keys else "")
        bad = ({"a", "b"} <= keys and rng.random() < 0.9) or ({"c", "d"} <= keys and k % 2 == 0) or rng.random() < 0.05
        rows.append((k, url, ""))
        if k < 260:
            labels.append((k, 0 if bad else 1, 0))
    rows += [(1000 + k, f"http://h0.net/p/{5000 + k}?{q}", "") for k, q in enumerate(("e=1&b=1", "f=1", "a=1&b=1", "c=1&d=1"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    parsed = {r["page_id"]: r["tokens"] for r in url_rules.parsed(pages, []).collect()}
    for confidence in (0.4, 0.7):
        got = {r["page_id"]: r["verdict"] == "block" for r in url_rules.judged(
            pages, marks, [], min_pages=5, min_confidence=confidence).collect()}
        want = brute_block([parsed[k] for k, _, _ in labels], [1 - q for _, q, _ in labels], [parsed[p] for p, _, _ in rows],
                           5, confidence, url_rules.MIN_LIFT)
        assert [got[p] for p, _, _ in rows] == want and any(want) and not all(want)


def test_many_shared_keys_take_seconds(spark):
    import time
    keys = "&".join(f"k{n}=1" for n in range(40))
    rows = [(k, f"http://s{k % 2}.shop.org/x/{k}?{keys}" if k < 40 else f"http://g.org/x/{k}?q=1&{keys if k < 200 else ''}", "")
            for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = spark.createDataFrame([(k, int(k >= 40), 0) for k in range(400)], "doc_id long, quality int, toxic int")
    start = time.time()
    got = {r["page_id"]: r["verdict"] for r in url_rules.judged(pages, labels, []).collect()}
    assert time.time() - start < 60
    assert [p for p, v in sorted(got.items()) if v == "block"] == list(range(40))


# --- archives --------------------------------------------------------------------------

def some_records(rng, n=40):
    out = []
    for k in range(n):
        payload = rng.randbytes(rng.choice([0, 1, 50, 5000])) + b"\r\n\r\nWARC/1.1\r\n" * rng.randrange(3)
        out.append(warc.record(k, f"http://h/{k}\n", payload, hashlib.sha256(payload).hexdigest(), 0 if k % 5 == 4 else None))
    return out


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_normaliser_keeps_every_record(tmp_path, chunk):
    records = some_records(random.Random(chunk))
    half = len(records) // 2
    for name, packed in {"one": gzip.compress(b"".join(records)), "members": b"".join(map(gzip.compress, records)),
                         "mixed": gzip.compress(b"".join(records[:half])) + b"\0\0" + b"".join(map(gzip.compress, records[half:]))}.items():
        source, target = tmp_path / f"{name}.gz", str(tmp_path / f"{name}-new.gz")
        source.write_bytes(packed)
        rows = list(warc.normalise(str(source), target, chunk))
        rewritten = open(target, "rb").read()
        assert gzip.decompress(rewritten) == b"".join(records)
        for row, record in zip(rows, records, strict=True):
            assert gzip.decompress(rewritten[row["offset"]: row["offset"] + row["length"]]) == record
        assert [json.loads(x) for x in open(f"{target}.index")] == rows
        assert sum(r["length"] for r in rows) == len(rewritten)


def test_damaged_archives_fail():
    data = gzip.compress(b"".join(some_records(random.Random(1))))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.split_records(warc.inflated(io.BytesIO(data[: len(data) // 2]))))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))


def test_empty_archive(tmp_path):
    (tmp_path / "e.gz").write_bytes(gzip.compress(b""))
    assert list(warc.normalise(str(tmp_path / "e.gz"), str(tmp_path / "f.gz"))) == []


def test_several_archives(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", "x" * (k * 37 % 1000)) for k in range(500)],
                                  "page_id long, url string, html string")
    archives = staged(warc.written(warc.planned(pages), str(tmp_path / "a"), roll=20_000), "archives")
    assert archives.count() > 5
    index = staged(warc.normalised(archives, str(tmp_path / "b")), "index")
    got = warc.read_back(index).select("payload_bytes", "record_type").collect()
    assert len(got) == 500 and sorted(r["payload_bytes"] for r in got) == sorted(k * 37 % 1000 for k in range(500))


# --- tokens ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return fst_bpe.codec(VOCABULARY, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=fst_bpe.load_ranks(VOCABULARY),
                             special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeinrst hx'\n1,.éüß"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_those_of_the_library(codec, reference, text):
    ids = codec.encode(text)
    assert ids.tolist() == reference.encode_ordinary(text)
    assert "".join(codec.decode_stream(ids, 3)) == text


def test_ids_of_long_pieces(codec, reference):
    rng = random.Random(0)
    for text in (" " * 5000 + "x", "ab" * 4000, "".join(rng.choice("etaoinshr") for _ in range(5000)), "\n\t" * 2000,
                 "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(2000)), "-=" * 3000, "'s't 're 'x"):
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def merged(ranks, piece):
    """Byte pair encoding by its definition: the lowest rank first, leftmost on ties."""
    parts = [piece[k: k + 1] for k in range(len(piece))]
    while True:
        joins = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joins:
            return parts
        at = min(joins)[1]
        parts[at: at + 2] = [parts[at] + parts[at + 1]]


def test_compatible_tokens_are_those_that_merge_to_themselves():
    ranks, rng = fst_bpe.load_ranks(VOCABULARY), random.Random(1)
    machine, tokens = fst_bpe.Transducer(ranks), sorted(ranks)
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(4000)]
    pairs += [(t[:k], t[k:]) for t in rng.sample(tokens, 1500) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    pairs += [(c * i, c * j) for c in (b" ", b"=", b"a") for i in range(1, 12) for j in range(1, 12) if c * i in ranks and c * j in ranks]
    checked = 0
    for a, b in pairs:
        if merged(ranks, a) == [a]:
            want = merged(ranks, b) == [b] and merged(ranks, a + b) == [a, b]
            assert machine.compatible(ranks[a], ranks[b]) == want, (a, b)
            checked += want
    assert checked > 500


def test_a_small_table_gives_the_same_ids(reference):
    small = fst_bpe.Transducer(fst_bpe.load_ranks(VOCABULARY), max_steps=50)
    for word in ("internationalisation", "Geschwindigkeit", "ouverture", "qqqqzzzzqq"):
        assert small.encode(word.encode()) == reference.encode_ordinary(word)


@given(st.text(max_size=30), st.lists(st.integers(1, 5), max_size=40))
def test_utf8_machine_equals_whole_decoding(text, cuts):
    data, at, out, utf8 = text.encode("utf-8", "replace"), 0, [], fst_bpe.Utf8Machine()
    for n in [*cuts, len(data)]:
        out.append(utf8.feed(data[at: at + n]))
        assert len(utf8.held) < 4
        at += n
    assert "".join(out) + utf8.close() == data.decode()


def test_utf8_machine_replaces_what_is_no_text():
    utf8 = fst_bpe.Utf8Machine()
    assert utf8.feed(b"a\xe2\x82") + utf8.close() == "a\ufffd"


def test_tokens_round_trip_as_tables(spark):
    docs = spark.createDataFrame([(1, "Hello wörld 日本"), (2, None), (3, "")], "doc_id long, text string")
    ids = fst_bpe.encoded(docs, VOCABULARY, public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["text"] for r in fst_bpe.decoded(ids, VOCABULARY, public_tokenizers.PATTERN).collect()}
    assert got == {1: "Hello wörld 日本", 2: "", 3: ""}
    digests = {r["doc_id"]: r for r in fst_bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN).collect()}
    of_one = next(r["ids"] for r in ids.collect() if r["doc_id"] == 1)
    assert digests[1]["ids_sha256"] == hashlib.sha256(np.array(of_one, "<u4").tobytes()).hexdigest()
    assert digests[2]["n_tokens"] == 0 and digests[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


# --- host quality ----------------------------------------------------------------------

def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k: k + 3]) for k in range(len(words) - 2)]
    covered = {k + i for k, w in enumerate(windows) if windows.count(w) > 1 for i in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\r\v\f\x1c\u00a0\u2028é#|<"), max_size=80))
def test_measures_equal_brute_force(text):
    assert host_quality.measures_of(text) == brute_measures(text)


def test_prior():
    mean, strength = host_quality.beta_prior(3, 300, 30, 3 * 100**2, 3 * 10**2 / 100)
    assert mean == 0.1 and strength == host_quality.PRIOR_MAX  # hosts do not differ beyond chance
    mean, strength = host_quality.beta_prior(2, 200, 100, 2 * 100**2, (0 + 100**2) / 100)
    assert mean == 0.5 and strength == host_quality.PRIOR_MIN  # hosts tell all


def test_strict_hosts_only(spark):
    good = " ".join(f"word{k}" for k in range(80))
    odd = " ".join(f"word{k} ###" for k in range(80))
    rows = [(k, good if k % 50 else odd, "fine") for k in range(500)] + [(1000 + k, odd if k % 2 else good, "junk") for k in range(500)]
    rows += [(2000, odd, "new"), (2001, "too short", "fine"), (2002, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in host_quality.judged(docs, ["doc_id"]).collect()}
    assert got[0]["kept"] and not got[1001]["kept"] and got[1000]["kept"] and not got[2001]["kept"] and got[2002]["kept"]
    assert got[0]["host_verdict"] == "trusted" and got[1000]["host_verdict"] == "strict"
    assert {r["doc_id"] for r in host_quality.keep_good(docs).collect()} == {d for d, r in got.items() if r["kept"]}
