"""Language id, surrogates, near duplicates, decontamination and line dedup against plain Python."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from govpub.llm import decontam, langid, line_align, pii, probminhash
from govpub.llm.base import WordHashes, plain_words

SF = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")


# --- language id -----------------------------------------------------------------------

def test_scores_equal_explicit_kernels():
    rng = random.Random(1)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(5, 60))) for a in ("abcde ", "cdefg ") for _ in range(30)]
    langs = ["x"] * 30 + ["y"] * 30
    model = langid.fit(texts, langs, landmarks=8)
    sets = [set(langid.Grams().of(t).tolist()) for t in texts]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = sets[:8] + sets[30:38]
    k = np.array([[kernel(a, b) for b in marks] for a in sets])
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    keep = values > values.max() * 1e-8
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = k @ root
    y = np.array([[la == n for n in ("x", "y")] for la in langs], float)
    want = x @ np.linalg.solve(x.T @ x + langid.RIDGE * len(texts) * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(model.scores([langid.Grams().of(t) for t in texts]), want, atol=2e-3)


def test_grams_are_presence_and_ignore_case_and_marks():
    g = langid.Grams()
    assert g.of("Ab, ab").tolist() == g.of("ab ab ab").tolist()
    assert len(g.of("12 !?")) == 0 and len(g.of("")) == 0 and len(g.of(None)) == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, per_lang=100)
    got = langid.identified(docs.withColumn("held", langid.held_out()), model, ["held", "lang"]).where(
        "held AND lang_pred <> 'und'").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_undetermined(spark):
    docs = spark.createDataFrame([(1, "12 34", "en"), (2, None, "en"), (3, "the house", None),
                                  *((k, "the house", "en") for k in range(10, 20))],
                                 "doc_id long, text string, lang string")
    rows = {r["doc_id"]: r for r in langid.identified(docs, langid.train(docs), ["doc_id"]).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == "und" and rows[1]["score"] == 0
    assert rows[3]["lang_pred"] == "en"
    assert langid.train(docs.where("lang IS NULL")) is None


# --- surrogates ------------------------------------------------------------------------

@pytest.mark.parametrize("size", [2, 7, 100, 1000])
def test_permutation(size):
    assert sorted(pii.permute(b"k", "t", v, size) for v in range(size)) == list(range(size))


def test_surrogates_keep_type_and_format():
    draw = lambda kind, form, attempt: pii.surrogate(b"k", kind, form, attempt)
    text = ('Mail jo.81@mail4.example.com or JO.81@MAIL4.EXAMPLE.COM!! call +1 (887) 555-2355 or +1 887 555 2355, card '
            '4417 4672 1060 7149, 10.1.2.3 and 142.226.109.250, token = "2e78d4bdec68f18b395a94d7e68821fb27738004", '
            'Frau Müller, Mr. John Smith, Mrs Smith, г-жа Иванова, 123-45-6789.')
    made, n = pii.rewrite(text, draw, {})
    assert n == 14
    shape = lambda t: re.sub(r"[A-ZА-Я]", "A", re.sub(r"[a-zа-яü]", "a", re.sub(r"\d", "9", t)))
    mails = re.findall(r"\S+@\S+", made)
    assert mails[0].upper() == mails[1].rstrip("!") and mails[0].endswith(".com") and "81@mail4" not in mails[0]
    phones = re.findall(r"\+1[ ()\d-]+\d", made)
    assert shape(phones[0]) == "+9 (999) 999-9999" and shape(phones[1]) == "+9 999 999 9999"
    assert re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1]) != "18875552355"
    card = re.search(r"card ([\d ]+),", made)[1]
    assert shape(card) == "9999 9999 9999 9999"
    assert pii.luhn(card.replace(" ", "")) == pii.luhn("4417467210607149")
    private, public = re.findall(r"\d+\.\d+\.\d+\.\d+", made)
    to_int = lambda a: int.from_bytes(bytes(map(int, a.split("."))), "big")
    assert pii.is_private(to_int(private)) and not pii.is_private(to_int(public))
    smith = re.search(r"Mr\. \w+ (\w+), Mrs (\w+)", made)
    assert smith[1] == smith[2] != "Smith"  # one surname, one surrogate
    assert re.search(r"г-жа [А-Я][а-я]+рд,", made) and re.search(r'"[0-9a-f]{40}"', made)
    for old in ("2355", "Smith", "John", "Müller", "Иванова", "123-45-6789", "2e78d4", "142.226"):
        assert old not in made


def test_collisions_are_drawn_again(spark):
    draw = lambda kind, form, attempt: f"s{(len(form) + attempt) % 50}"  # noqa: E731  many share a length
    forms = [(k, f) for k in ("surname", "mail") for f in ["a", "b", "c", "dd", "ee", "s4", "s5", "fff"]]
    got = pii.assigned(spark.createDataFrame(forms, "kind string, form string"), draw).collect()
    for kind in ("surname", "mail"):
        made = [r["made"] for r in got if r["kind"] == kind]
        assert len(set(made)) == len(made) == 8 and not set(made) & {f for _, f in forms}


def test_redrawn_entities_reach_the_text(spark):
    docs = docs_of(spark, ["Mr Adams and Mr Baker", "Mr Baker and Frau Adams", "nothing here", None])
    draw = lambda kind, form, attempt: "same" + "x" * attempt
    got = {r["doc_id"]: r["text"] for r in pii.pseudonymised(docs, b"k", draw=draw).collect()}
    assert got == {0: "Mr Same and Mr Samex", 1: "Mr Samex and Frau Same", 2: "nothing here", 3: None}


def test_country_codes_stay_and_nothing_else():
    for code, rest in (("1", "8875552355"), ("7", "9161234567"), ("49", "30123456"), ("49", "17012345678"),
                       ("44", "2071234567"), ("353", "861234567"), ("971", "501234567")):
        made = [pii.surrogate(b"k%d" % k, "phone", f"+{code}{rest}") for k in range(200)]
        assert all(m.startswith(f"+{code}") and len(m) == 1 + len(code) + len(rest) for m in made)
        assert all(len({m[1 + len(code) + k] for m in made}) == 10 for k in range(len(rest)))
    draw = lambda kind, form, attempt: pii.surrogate(b"k", kind, form, attempt)
    made = [pii.rewrite(t, draw, {})[0] for t in ("+49 301 234 567", "+4930 1234 567")]
    assert re.sub(r"\D", "", made[0]) == re.sub(r"\D", "", made[1]) and made[0].startswith("+49 ")


def test_a_name_has_one_surrogate_whatever_its_title(spark):
    texts = ["Mr John Smith came. John Smith left; SMITH, John's and smith stayed, mail Smith@example.com. Johnson too.",
             "Dr John Smith or Mr John", "Frau Smith and Prof Ada Smith", "Mrs Ada Smith", "John alone, untitled",
             "Dr 田中太郎 said. 田中太郎 left. Dr דויד left, דויד too"]
    got = {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.pseudonymised(docs_of(spark, texts), b"k").collect()}
    john, smith = re.match(r"Mr (\w+) (\w+) came", got[0][0]).groups()
    mail = re.search(r"\S+@\S+\.com", got[0][0])[0]
    assert john.endswith("n") and john != "John" and smith.endswith("rd") and "Smith@" not in mail
    assert got[0] == (f"Mr {john} {smith} came. {john} {smith} left; {smith.upper()}, {john}'s and smith stayed, mail {mail}."
                      " Johnson too.", 7)
    assert got[1] == (f"Dr {john} {smith} or Mr {john}", 3)
    ada = got[3][0].split()[1]
    assert got[3][0] == f"Mrs {ada} {smith}" and ada.endswith("na")
    assert got[2] == (f"Frau {smith} and Prof {ada} {smith}", 3)
    assert got[4] == (texts[4], 0)
    a, b, c, d = re.match(r"Dr (\w+) said\. (\w+) left\. Dr (\w+) left, (\w+) too", got[5][0]).groups()
    assert a == b != "田中太郎" and c == d != "דויד"
    assert pii.script_of(a) == "CJK" and {pii.script_of(x) for x in c} == {"HEBREW"}


def entity(rng, kind):
    """(kind, how the text has it) of a made entity."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letter = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(rng.choice(of) for _ in range(n))
    if kind == "iban":
        body = rng.choice(["DE", "GB", "FR"]) + "00" + letter(4, "ABCDXYZ") + digits(14)
        whole = body[:2] + f"{98 - pii.checked(body):02d}" + body[4:]
        return " ".join(whole[k:k + 4] for k in range(0, len(whole), 4)) if rng.random() < 0.5 else whole
    return {"mail": lambda: f"{letter(6)}.{letter(4)}@{letter(8)}.org", "net": lambda: f"81.{rng.randrange(256)}.{rng.randrange(256)}.7",
            "net6": lambda: ":".join(f"{rng.randrange(65536):x}" for _ in range(8)) if rng.random() < 0.5 else
            f"2001:{rng.randrange(1, 65536):x}::{rng.randrange(1, 65536):x}:{rng.randrange(1, 65536):x}",
            "token": lambda: rng.choice(["AKIA" + letter(16, "ABCDEFGHIJ0123456789"), "ghp_" + letter(30) + digits(6)]),
            "secret": lambda: digits(2) + letter(38, "0123456789abcdef"), "person_no": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
            "phone": lambda: rng.choice([f"+49 {rng.randrange(100, 999)} {digits(4)} {digits(3)}", f"({digits(3)}) {digits(3)}-{digits(4)}"]),
            "national": lambda: rng.choice([f"06 {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"0{rng.randrange(30, 99)} {digits(7)}"]),
            "card": lambda: f"4{digits(3)} {digits(4)} {digits(4)} {digits(4)}"}[kind]()


KINDS = ["mail", "net", "net6", "token", "secret", "person_no", "phone", "national", "card", "iban"]


def test_entities_of_every_type_are_found_and_replaced(spark):
    """Texts with known entities: found by type, nothing else changed, one surrogate each, no two alike."""
    rng, texts, known = random.Random(12), [], []
    pool = {kind: [entity(rng, kind) for _ in range(25)] for kind in KINDS}
    for _ in range(200):
        inside = [(k, rng.choice(pool[k])) for k in rng.choices(KINDS, k=4)]
        texts.append("; ".join(f"some words {e} and more" for _, e in inside))
        known.append(inside)
    found, total, surrogates = Counter(), Counter(), defaultdict(set)
    for row in pii.pseudonymised(docs_of(spark, texts), b"k").collect():
        parts, at = row["text"].split("; "), known[row["doc_id"]]
        assert len(parts) == 4
        for part, (kind, was) in zip(parts, at):
            made = re.fullmatch(r"some words (.*) and more", part)[1]
            total[kind] += 1
            found[kind] += made != was
            surrogates[kind, pii.canonical(kind, was)].add(pii.canonical(kind, made))
    assert all(found[k] >= 0.9 * total[k] for k in KINDS), (found, total)
    assert all(len(s) == 1 for s in surrogates.values())  # coreference
    for kind in KINDS:
        made = [next(iter(s)) for (k, _), s in surrogates.items() if k == kind]
        assert len(set(made)) == len(made) and not set(made) & {f for k, f in surrogates if k == kind}
        assert all(pii.is_one(kind, m) for m in made)


def test_names_of_any_length():
    draw = lambda kind, form, attempt: pii.surrogate(b"k", kind, form, attempt)
    for text, names in (("Señor Gabriel García Márquez said", ["Gabriel", "García", "Márquez"]), ("Dr. Jean-Luc Picard", ["Jean-Luc", "Picard"]),
                        ("Mr O'Brien and", ["O'Brien"]), ("Frau Ursula von der Leyen", ["Ursula", "Leyen"]),
                        ("Mr John Ronald Reuel Tolkien", ["John", "Ronald", "Reuel", "Tolkien"])):
        made, n = pii.rewrite(text, draw, {})
        assert n == len(names) and not any(name in made for name in names)
        assert re.sub(r"\b[A-Z][a-z]+\b", "X", made.split(" ", 1)[1]) == re.sub("|".join(names), "X", text.split(" ", 1)[1])
    for text in ("at 12:30:45 on 01-02-2024, 0.5 of 0800 rows", "version 1.2.3, AB12 CDEF GHIJ KLMN", "a::b c:d:e"):
        assert pii.rewrite(text, draw, {}) == (text, 0)


def test_names_of_different_kinds_never_share_a_surrogate(spark):
    forms = [(k, f"{k}{n}") for k in pii.NAMES for n in range(6)]
    draw = lambda kind, form, attempt: f"x{(len(form) * 7 + attempt) % 97}"
    made = [r["made"] for r in pii.assigned(spark.createDataFrame(forms, "kind string, form string"), draw).collect()]
    assert len(set(made)) == len(forms)


def test_drawing_ends_where_all_strings_are_taken(spark):
    """All hundred two-digit numbers are entities: no free one of that length is left."""
    forms = spark.createDataFrame([("person_no", f"{k:02d}") for k in range(100)], "kind string, form string")
    draw = lambda kind, form, attempt: pii.surrogate(b"k", kind, form, attempt + pii.GROW - 1)
    made = [r["made"] for r in pii.assigned(forms, draw).collect()]
    assert len(set(made)) == 100 and all(len(m) > 2 for m in made)


# --- near duplicates -------------------------------------------------------------------

def shingles(text):
    w = plain_words((text or "").encode())
    n = min(5, len(w))
    return {tuple(w[k: k + n]) for k in range(len(w) - n + 1)} if n else set()


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute_classes(texts, threshold=0.8):
    sets = [shingles(t) for t in texts]
    head = list(range(len(texts)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    for a, b in {(a, b) for ks in by.values() for a, b in itertools.combinations(sorted(set(ks)), 2)}:
        if jaccard(sets[a], sets[b]) >= threshold:
            x, y = sorted((find(a), find(b)))
            head[y] = x
    return [find(k) for k in range(len(texts))]


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    a = {int(k): float(w) for k, w in zip(rng.integers(1, 2**62, 60), rng.uniform(0.2, 5, 60))}
    b = dict(list(a.items())[:45]) | {int(k): float(w) for k, w in zip(rng.integers(1, 2**62, 20), rng.uniform(0.2, 5, 20))}
    b = {k: w * rng.uniform(0.8, 1.2) for k, w in b.items()}
    want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in {*a} & {*b})
    places, docs, elements, weights = 4096, [], [], []
    for k, d in enumerate((a, b)):
        docs += [k] * len(d)
        elements += list(d)
        weights += list(d.values())
    got = probminhash.signatures(np.array(docs), np.array(elements, np.uint64), np.array(weights), 2, places)
    assert abs((got[0] == got[1]).mean() - want) < 0.035


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    texts = []
    for n, edits in ((300, 2), (300, 5), (120, 1), (60, 1), (30, 1), (300, 9)):
        base = text(n)
        texts += [base, base, base.upper(), *near_copies(rng, base, 25, edits)]
    texts += [text(rng.randint(1, 8)) for _ in range(40)] + ["", None, "one", "one", "a b", "a b"]
    rng.shuffle(texts)
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(docs_of(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_classes(texts)


def test_repeated_lines_do_not_hide_a_pair(spark):
    rng = random.Random(15)
    texts = []
    for k in range(120):
        w = [f"w{rng.randrange(10**6)}" for _ in range(50)]
        line = " ".join(w[20:40])
        texts += [" ".join(w), " ".join([*w[:20], *[line] * (10, 50, 200)[k % 3], *w[40:]])]
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(docs_of(spark, texts)).collect()}
    want = brute_classes(texts)
    assert want == [k - k % 2 for k in range(240)]
    assert [got[k] for k in range(240)] == want


def test_classes_of_supplied_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")
    texts = [r["text"] for r in docs.collect()]
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(docs).collect()}
    assert [got[k] for k in range(len(texts))] == brute_classes(texts)


def test_prefix_pairs_miss_nothing(spark):
    rng = random.Random(9)
    universe = list(range(60))
    sets = [sorted(rng.sample(universe, rng.randint(1, 12))) for _ in range(150)]
    sets += [sorted({*s, 99}) for s in sets[:40]]
    table = spark.createDataFrame([(k, s) for k, s in enumerate(sets)], "text_no long, shingles array<long>")
    texts = spark.createDataFrame([(k, len(s), k) for k, s in enumerate(sets)], "text_no long, size long, label long")
    got = {(r["a"], r["b"]) for r in probminhash.prefix_pairs(texts, table, 0.8).collect()}
    want = {(a, b) for a in range(len(sets)) for b in range(a) if jaccard(set(sets[a]), set(sets[b])) >= 0.8}
    assert want <= got


def test_one_of_each_class_stays(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (None, "A b c d e f g"), (5, None), (5, None),
            (None, "x y"), (None, "x y"), (7, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in probminhash.keep_first(docs).collect()), key=str)
    assert got == sorted([(1, "a b c d e f g"), (5, None), (5, None), (None, "x y"), (7, "alone here")], key=str)


# --- decontamination -------------------------------------------------------------------

def brute_contamination(text, items):
    words, hit, found = plain_words((text or "").encode()), set(), set()
    for item, t in items:
        w = plain_words((t or "").encode())
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p: p + n] == w[k: k + n]:
                    hit |= set(range(p, p + n))
                    found.add("" if item is None else str(item))
    return (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(words))


def test_contamination_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("ab cd ef gh ij kl mn".split())
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((1, 2, 4, 5, 6, 12, 13, 14, 30, 30))]
    items += [(None, items[8][1]), (10, ""), (11, None), (7, items[6][1])]
    items = [(k, t if t is None or n else "only") for n, (k, t) in enumerate(items)]
    texts = ["", None, "only", " ".join(word() for _ in range(400))]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(60)))]
        for _ in range(rng.randrange(4)):
            w = rng.choice([t for _, t in items if t]).split()
            a = rng.randrange(len(w))
            parts += [" ".join(w[a: a + rng.randint(1, 30)]).title(), " ".join(word() for _ in range(rng.randrange(5)))]
        texts.append(", ".join(parts))
    texts.append(" ".join([items[8][1]] * 50))  # a run longer than a block
    got = decontam.contamination(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    rows = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    for k, t in enumerate(texts):
        assert rows[k] == brute_contamination(t, items), (k, t)


# --- line dedup ------------------------------------------------------------------------

def test_patience_gives_increasing_equal_lines():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(8) for _ in range(rng.randrange(20))]
        b = [rng.randrange(8) for _ in range(rng.randrange(20))]
        found = line_align.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
        assert line_align.patience(a, a) == [(i, i) for i in range(len(a))]
    assert line_align.longest_increasing([3, 1, 2, 5, 4]) == [1, 2, 4]


def brute_runs(lines, min_words):
    """Texts of all runs with enough words that no run with enough words lies in, straight from the docstring."""
    words = [len(re.findall(r"[^ \t\r]+", x)) for x in lines]
    enough = [(i, j) for i in range(len(lines)) for j in range(i, len(lines))
              if words[i] and words[j] and sum(words[i:j + 1]) >= min_words]
    shortest = {(i, min(j for x, j in enough if x == i)) for i, _ in enough}
    shortest |= {(max(i for i, x in enough if x == j), j) for _, j in enough}
    return {tuple(lines[i:j + 1]) for i, j in shortest}


def brute_dedup(texts, min_words=line_align.MIN_WORDS):
    """Every document against the first holder of each of its runs."""
    lines = [None if t is None else [x.strip(" \t\r") for x in t.split("\n")] for t in texts]
    words = lambda x: len(re.findall(r"[^ \t\r]+", x))
    first = {}
    for k, ls in enumerate(lines):
        for x in brute_runs(ls or [], min_words):
            first.setdefault(x, k)
    out = []
    for k, t in enumerate(texts):
        gone = set()
        for e in {first[x] for x in brute_runs(lines[k] or [], min_words)} - {k}:
            for a, b in line_align.blocks(lines[e], lines[k], [words(x) for x in lines[k]], min_words):
                gone |= set(range(a, b + 1))
        out.append(t if not gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(n)) for n in (1, 2, 4, 6, 12, 15, 30) for _ in range(6)]
    texts = ["\n".join(rng.choice(["", *pool]) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(14)))
             for _ in range(80)]
    texts += [texts[0], None, "", texts[3] + "\n" + texts[4]]
    got = {r["doc_id"]: r for r in line_align.dedup_lines(docs_of(spark, texts)).collect()}
    want = brute_dedup(texts)
    assert [got[k]["text"] for k in range(len(texts))] == want
    for k, t in enumerate(texts):
        n = 0 if t is None else t.count("\n") + 1
        left = 0 if t is None else want[k].count("\n") + 1
        if got[k]["n_deleted"]:
            assert n - got[k]["n_deleted"] == (0 if want[k] == "" and got[k]["n_deleted"] == n else left)
        assert got[k]["n_lines"] == n


def brute_left(texts, min_words=line_align.MIN_WORDS):
    """Lines with words that stay when every run that any earlier document holds goes."""
    lines = [[x.strip(" \t\r") for x in t.split("\n")] for t in texts]
    held, out = set(), []
    for ls in lines:
        words = [len(x.split()) for x in ls]
        every = {(i, j) for i in range(len(ls)) for j in range(i, len(ls)) if sum(words[i:j + 1]) >= min_words}
        gone = {k for i, j in every if tuple(ls[i:j + 1]) in held for k in range(i, j + 1)}
        out.append([x for k, x in enumerate(ls) if k not in gone and words[k]])
        held |= {tuple(ls[i:j + 1]) for i, j in every}
    return out


def test_every_copy_that_an_earlier_document_has_goes(spark):
    rng = random.Random(12)
    p = " ".join(f"p{i}" for i in range(60))
    pool = [" ".join(f"v{rng.randrange(99)}" for _ in range(n)) for n in (1, 2, 4, 6, 12, 15, 30) for _ in range(5)]
    texts = [f"{p}\nown", f"b\n{p}\nc\n{p}", f"{p}\nd\n{p}\ne"]
    texts += ["\n".join(rng.choice(["", *pool]) for _ in range(rng.randrange(30))) for _ in range(80)]
    got = {r["doc_id"]: r["text"] for r in line_align.dedup_lines(docs_of(spark, texts), every_copy=True).collect()}
    assert [got[k] for k in range(3)] == [texts[0], "b\nc", "d\ne"]
    assert [[x for x in got[k].split("\n") if x] for k in range(len(texts))] == brute_left(texts)


def test_short_matches_do_not_use_up_a_block(spark):
    l, u = ([f"{c}{k} " + "x " * 6 + "y" for k in range(7)] for c in "lu")
    mixed = [x for pair in zip(l, u) for x in pair]
    a, b, x = (" ".join(f"{c}{k}" for k in range(5)) for c in "abx")
    for earlier, later, left in ((mixed + l + ["w"], ["z", *l], ["z"]), ([a, x, a, b], [a, b], [])):
        words = [len(line.split()) for line in later]
        for every in (False, True):
            gone = {k for i, j in line_align.blocks(earlier, later, words, 10, every) for k in range(i, j + 1)}
            assert [line for k, line in enumerate(later) if k not in gone] == left
        got = {r["doc_id"]: r["text"] for r in line_align.dedup_lines(docs_of(spark, map("\n".join, (earlier, later)))).collect()}
        assert got[1] == "\n".join(left)
    rng = random.Random(6)
    for _ in range(500):  # of every shared run as many copies go as the earlier document holds
        earlier, later = ([rng.choice("abcdef") for _ in range(rng.randrange(25))] for _ in range(2))
        gone = {k for i, j in line_align.blocks(earlier, later, [4] * len(later), 10) for k in range(i, j + 1)}
        at = lambda lines, run: [i for i in range(len(lines) - 2) if tuple(lines[i:i + 3]) == run]
        for run in {tuple(later[i:i + 3]) for i in range(len(later) - 2)}:
            n = sum({i, i + 1, i + 2} <= gone for i in at(later, run))
            assert n >= min(len(at(earlier, run)), len(at(later, run)))


def test_first_copy_of_a_passage_stays(spark):
    passage = "\n".join(" ".join(f"p{k}_{i}" for i in range(20)) for k in range(3))
    texts = ["own start of one\n" + passage, passage + "\nown end of two", "x\n" + passage + "\ny", passage]
    got = {r["doc_id"]: r["text"] for r in line_align.dedup_lines(docs_of(spark, texts)).collect()}
    assert got == {0: texts[0], 1: "own end of two", 2: "x\ny", 3: ""}


def test_block_whose_lines_were_first_elsewhere_goes(spark):
    x, y, z = ("one two three four", "five six seven eight", "nine ten eleven twelve")
    texts = [x, "a\n" + y, "b\n" + z, f"{x}\n{y}\n{z}\nend", f"start\n{x}\n{y}\n{z}"]
    got = {r["doc_id"]: r["text"] for r in line_align.dedup_lines(docs_of(spark, texts)).collect()}
    assert got == {0: texts[0], 1: texts[1], 2: texts[2], 3: texts[3], 4: "start"}


def test_blocks_in_other_order_and_of_repeated_lines_go(spark):
    p, q = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    texts = [f"{p}\n{q}\nown", f"{q}\nthis\n{p}", f"{p}\n-\n{q}\n-\n{p}", f"a\n{q}\nb\n{q}\nc"]
    got = {r["doc_id"]: r["text"] for r in line_align.dedup_lines(docs_of(spark, texts)).collect()}
    assert got[0] == texts[0] and got[1] == "this"
    assert got[2].count(p) == 1 and q not in got[2]  # the second copy in one document has no partner
    assert got[3].count(q) == 1
    reverse = [f"line {k} of some thirty words " + "x " * 25 for k in range(40)]
    assert line_align.blocks(reverse, reverse[::-1], [30] * 40) == [(k, k) for k in range(40)]
    same = ["a b c d e f g h i j k"]
    assert line_align.blocks(["u", *same * 2, "v"], ["s", *same * 3, "t"], [1, 11, 11, 11, 1]) == [(1, 2)]


def test_word_hashes_forget_but_stay_equal():
    small, large = WordHashes(3), WordHashes()
    words = [f"w{k % 7}".encode() for k in range(50)]
    assert small.of(words).tolist() == large.of(words).tolist()
    assert Counter(large.of(words).tolist()).most_common(1)[0][1] == 8
