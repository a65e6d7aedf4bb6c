"""Surrogates for personal data.

Entities are found by type; each is replaced by a keyed surrogate of the same type and look:

* cards, account numbers (IBAN), phone numbers (with a country code, or national ones that begin with 0 or have the American
  form), identity numbers, network addresses (IPv4 and IPv6), secrets (long hexadecimal strings and access keys with a known
  beginning) and mail addresses are permuted inside the set of all strings of the same pattern (digits stay digits, letters stay letters of their case, separators stay); a keyed
  Feistel permutation, so different entities get different surrogates without looking at each other. Country codes,
  beginnings of access keys, the first group of an IPv6 address and mail top-level domains stay; the last digit of a card is set
  so that a valid checksum stays valid and an invalid one invalid, the check digits of an account number so that they are
  right; addresses stay valid and private ones private;
* given names and surnames are built from syllables of their script, given names with an ending of their gender; in scripts
  other than Latin, Cyrillic and Greek from letters of that script, without such endings. After a listed title any number of name
  words is found, with hyphens, apostrophes and particles (which stay); the last word is the surname. They are found there, and
  then wherever else the same document has the same word with a capital (or in a script without case). A name that no title
  introduces in its document is not found.

Coreference: the surrogate depends on the entity's canonical form (digits only, lower case), not on how or where it is written, so
all mentions in the corpus get the same one, each in its own format and case. A name is one entity whatever its title and place:
where mentions differ, it is a given name rather than a surname, and its gender is a known one rather than none (female
where titles of both occur), first over the document, then over the corpus.

Distinctness: all distinct entities of the corpus are drawn once; surrogates that two entities share (of names: whatever the
kind of name), or that are themselves entities of the corpus, are drawn again with the next attempt number until none are left.
From attempt `GROW` on a surrogate gets longer, so drawing ends also where all strings of a pattern are taken. Only entities whose attempt
is above zero, and names that the corpus takes for another kind than their document, have to be looked up when texts are rewritten;
all others are computed in place.

Defined results: a null text stays null, a text without entities stays as it is; overlapping finds go to the type
listed first, then to the earliest; rows with equal ids are rewritten one by one; ill-formed UTF-8 comes out as
U+FFFD; extra columns are not read.

Scale: two scans over the texts. Entities are made distinct before the shuffle, so one that a third of all documents mention is
one row per task. Texts are joined only with the few entities looked up.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, same, staged, text_hash, valid

# Titles by gender, and syllables by script.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "Господин", "Г-н", "κύριος", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "г-жа", "Госпожа", "Г-жа",
          "κυρία", "Κυρία"],
    "u": ["Dr", "Prof"],
}
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "lu", "ma", "ne", "pi", "ro", "su", "ta", "ve", "ka", "li", "mo", "ru"],
    "cyrillic": ["ба", "де", "фи", "го", "лу", "ма", "не", "пи", "ро", "су", "та", "ве", "ка", "ли", "мо", "ру"],
    "greek": ["βα", "δε", "φι", "γο", "λου", "μα", "νε", "πι", "ρο", "σου", "τα", "βε", "κα", "λι", "μο", "ρου"],
}
ENDINGS = {"latin": {"m": "n", "f": "na", "u": "l", "s": "rd"}, "cyrillic": {"m": "н", "f": "на", "u": "ль", "s": "рд"},
           "greek": {"m": "νος", "f": "να", "u": "λι", "s": "ρδης"}}

PARTICLES = ["al", "bin", "da", "de", "del", "della", "den", "der", "di", "do", "dos", "du", "el", "la", "le", "ten", "ter", "van",
             "von", "y", "zu"]
# How access keys of common services begin.
KEY_BEGINNINGS = ["AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-", "sk-"]

#: Attempts after which surrogates get longer, by one character for each further one.
GROW = 32
#: Country codes of two digits; 1 and 7 have one digit, all others three. No code begins with another.
COUNTRY_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                          "81 82 84 86 90 91 92 93 94 95 98".split())

_NAME = r"[^\W\d_a-zа-яα-ω](?:['’][^\W\d_]+|[^\W\d_]+)(?:[-'’][^\W\d_]{2,})*"
_PARTICLE = r"(?:" + "|".join(PARTICLES) + r")"
_PATTERNS = {
    "mail": r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{32,}(?![0-9A-Za-z])",
    "token": r"(?<![\w-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|(?:" + "|".join(KEY_BEGINNINGS[2:]) + r")[0-9A-Za-z][0-9A-Za-z-]{18,}[0-9A-Za-z])"
             r"(?![0-9A-Za-z])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?!\w)",
    "net6": r"(?<![\w:.])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\w:]|\.\d)",
    "net": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "person_no": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})|\(\d{3}\)|\d{3}(?=[.-]))(?:[ .-]?\d{2,4}){2,3}(?![\w])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "national": r"(?<![\w+.,/-])0[1-9]\d{0,3}(?:[ -]\d{2,8}){1,5}(?![\w-]|[.,/]\d)",
    "name": r"(?<!\w)(?P<title>" + "|".join(t for g in TITLES.values() for t in g) + r")(?:\. ?| )(?P<names>" + _NAME
            + r"(?: (?:" + _PARTICLE + r" )*" + _NAME + r")*)",
}
_FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS.items()))
_HINT = re.compile(r"[0-9@]|(?<!\w)(?:" + "|".join(t for g in TITLES.values() for t in g) + r")(?!\w)")
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_WORD = re.compile(rf"(?<!\w){_NAME}(?!\w)")
#: Kinds of names. Of several that a name is found as, the first in this order (and in the alphabet's) holds.
NAMES = ("given_f", "given_m", "given_u", "surname")


def mentions(text: str) -> list[tuple[int, int, str, str, str]]:
    """(from, to, type, canonical form, mention) of every entity, in order."""
    if not _HINT.search(text):
        return []
    out = []
    for m in _FIND.finditer(text):
        kind = m.lastgroup if m.lastgroup in _PATTERNS else "name"
        if kind != "name":
            if is_one(kind, m[0]):
                out.append((m.start(), m.end(), kind, canonical(kind, m[0]), m[0]))
            continue
        at, parts = m.start("names"), m["names"].split(" ")
        for k, part in enumerate(parts):
            if part not in PARTICLES:
                what = "surname" if k == len(parts) - 1 else "given_" + _GENDER[m["title"]]
                out.append((at, at + len(part), what, part.lower(), part))
            at += len(part) + 1
    return with_untitled(text, out) if any(x[2] in NAMES for x in out) else out


def with_untitled(text: str, found: list[tuple[int, int, str, str, str]]) -> list[tuple[int, int, str, str, str]]:
    """The finds with one kind per name, and the other mentions of the names in the text between them."""
    kinds: dict[str, str] = {}
    for _, _, kind, form, _ in found:
        if kind in NAMES:
            kinds[form] = min(kind, kinds.get(form, kind))
    out, at = [], 0
    for a, b, kind, form, mention in [*found, (len(text), len(text), "", "", "")]:
        for m in _WORD.finditer(text, at, a):
            if m[0].lower() in kinds:
                out.append((m.start(), m.end(), kinds[m[0].lower()], m[0].lower(), m[0]))
        if mention:
            out.append((a, b, kinds[form] if kind in NAMES else kind, form, mention))
        at = b
    return out


def is_one(kind: str, mention: str) -> bool:
    """What a pattern alone cannot tell: checksums, groups and the number of digits."""
    if kind == "iban":
        return checked(canonical(kind, mention)) == 1
    if kind == "net6":
        try:
            return bool(ipaddress.IPv6Address(mention))
        except ValueError:
            return False
    return kind != "national" or 9 <= sum(c.isdigit() for c in mention) <= 12


def checked(iban: str) -> int:
    """What is left of an account number by its checksum rule; 1 for a valid one."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


_DIGITS = ("phone", "national", "card", "person_no")


def canonical(kind: str, mention: str) -> str:
    if kind in _DIGITS:
        return ("+" if mention[0] == "+" else "") + "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "net6":
        return ipaddress.IPv6Address(mention).exploded
    return mention if kind == "token" else mention.lower()


# --- keyed permutations ----------------------------------------------------------------

def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of range(size): Feistel network on the next power of four, walking until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for turn in range(8):
            f = hmac.digest(key, f"{tweak}/{turn}/".encode() + right.to_bytes(width, "big"), "sha256")
            while len(f) < width:
                f += hashlib.sha256(f).digest()
            left, right = right, left ^ (int.from_bytes(f[:width], "big") & mask)
        value = left << half | right
        if value < size:
            return value


_SETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz")


def permute_text(key: bytes, tweak: str, text: str, sets: tuple[str, ...] = _SETS) -> str:
    """Permute among all strings with the same kind of character at every place; other characters stay."""
    own = [next((s for s in sets if c in s), None) for c in text]
    value, size = 0, 1
    for c, s in zip(text, own):
        if s:
            value, size = value * len(s) + s.index(c), size * len(s)
    if size < 2:
        return text
    value = permute(key, f"{tweak}/{''.join(str(sets.index(s)) if s else c for c, s in zip(text, own))}", value, size)
    out = []
    for c, s in zip(reversed(text), reversed(own)):
        if s:
            value, k = divmod(value, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """What the checksum of these digits is above a multiple of ten."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def is_private(value: int) -> bool:
    return value >> 24 in (0, 10, 127) or value >> 20 == 0xAC1 or value >> 16 == 0xC0A8 or value >> 28 >= 14


def script_of(text: str) -> str:
    """latin, cyrillic, greek, or the first word of the Unicode names of another script's letters."""
    c = text[0]
    if "Ѐ" <= c <= "ӿ" or "Ͱ" <= c <= "Ͽ":
        return "cyrillic" if c >= "Ѐ" else "greek"
    script = unicodedata.name(c, "LATIN").partition(" ")[0]
    return script if len(letters(script)) > 15 and script not in ("LATIN", "CYRILLIC", "GREEK") else "latin"


@lru_cache(None)
def letters(script: str) -> str:
    """Letters of the basic plane whose Unicode names begin with that word, lower case where there is case."""
    return "".join(c for c in map(chr, range(0x10000)) if c.isalpha() and len(c.lower()) == 1 and c.lower() == c
                   and unicodedata.name(c, "").partition(" ")[0] == script)


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """The surrogate's canonical form for an entity's canonical form."""
    tweak, more = f"{kind}/{attempt}", "0" * max(0, attempt - GROW + 1)
    if kind == "mail":
        local, _, domain = form.rpartition("@")
        name, _, top = domain.rpartition(".")
        return f"{permute_text(key, tweak, local + more)}@{permute_text(key, tweak + '/domain', name)}.{top}"
    if kind == "token":
        keep = max((len(b) for b in KEY_BEGINNINGS if form.startswith(b)), default=0)
        return form[:keep] + permute_text(key, tweak, form[keep:] + more, (*_SETS, _SETS[1].upper()))
    if kind == "iban":
        own = form[:2] + "00" + permute_text(key, tweak, form[4:] + more, (_SETS[0], _SETS[1].upper()))
        return own[:2] + f"{98 - checked(own):02d}" + own[4:]
    if kind == "net6":
        groups = int.from_bytes(ipaddress.IPv6Address(form).packed, "big")
        return ipaddress.IPv6Address(groups >> 112 << 112 | permute(key, tweak, groups & (1 << 112) - 1, 1 << 112)).exploded
    if kind == "national":
        return "0" + permute_text(key, tweak, form[1:] + more)
    if kind == "secret":
        return permute_text(key, tweak, form + more, ("0123456789abcdef",))
    if kind == "net":
        value = start = int.from_bytes(bytes(map(int, form.split("."))), "big")
        while True:
            value = permute(key, tweak, value, 1 << 32)
            if is_private(value) == is_private(start):
                return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "card":
        first = permute_text(key, tweak, form[:-1] + more)
        return first + str((luhn(form) - luhn(first + "0")) % 10)
    if kind == "phone" and form[0] == "+":
        keep = 1 + (1 if form[1] in "17" else 2 if form[1:3] in COUNTRY_CODES else 3)
        return form[:keep] + permute_text(key, tweak, form[keep:] + more)
    if kind in ("phone", "person_no"):
        return permute_text(key, tweak, form + more)
    script = script_of(form)
    drawn = hmac.digest(key, f"{tweak}/{form}".encode(), "sha256")
    if script not in SYLLABLES:
        own = letters(script)
        size = max(2, len(form)) + attempt // 4
        drawn = hashlib.shake_256(drawn).digest(2 * size)
        return "".join(own[int.from_bytes(drawn[2 * k:2 * k + 2], "big") % len(own)] for k in range(size))
    parts = [SYLLABLES[script][b % 16] for b in hashlib.shake_256(drawn).digest(2 + attempt // 4 + (kind == "surname"))]
    return "".join(parts) + ENDINGS[script]["s" if kind == "surname" else kind[-1]]


def in_format(kind: str, form: str, mention: str) -> str:
    """The surrogate written the way the mention is."""
    if kind in _DIGITS or kind == "iban":
        own = iter(form.removeprefix("+"))
        return "".join(next(own) if c.isalnum() else c for c in mention) + "".join(own)
    if kind == "net6":
        made = ipaddress.IPv6Address(form)
        made = made.exploded if len(mention) == 39 else made.compressed
        return made.upper() if mention.isupper() else made
    if kind == "token":
        return form
    if mention.isupper():
        return form.upper()
    if kind in NAMES:
        return form if mention[0].islower() else form[0].upper() + form[1:]
    if kind in ("mail", "secret") and len(form) == len(mention):
        return "".join(c.upper() if m.isupper() else c for c, m in zip(form, mention))
    return form


# --- jobs ------------------------------------------------------------------------------

_ENTITY = pa.list_(pa.struct([("kind", pa.string()), ("form", pa.string())]))
_KIND = "array<struct<kind:string,form:string>>"


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, th, entities (distinct per document) of the documents that hold any."""
    frame = docs.select("doc_id", text_hash(text).alias("th"), valid(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": k, "form": f} for k, f in sorted({(x[2], x[3]) for x in mentions(t or "")})]
                     for t in b.column(2).to_pylist()]
            schema = pa.schema([b.schema.field(0), b.schema.field(1), ("entities", _ENTITY)])
            yield batch(schema, b.column(0), b.column(1), pa.array(found, _ENTITY))

    kind = frame.schema["doc_id"].dataType.simpleString()
    return map_batches(frame, task, f"doc_id {kind}, th long, entities {_KIND}").where(F.size("entities") > 0)


def drawn(entities: DataFrame, draw: Callable[[str, str, int], str]) -> DataFrame:
    """kind, form, attempt, made: the surrogate at that attempt. entities: kind, form, attempt."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [draw(*x) for x in zip(*(c.to_pylist() for c in b.columns))]
            yield batch(pa.schema([*b.schema, ("made", pa.string())]), *b.columns, made)

    return map_batches(entities.select("kind", "form", "attempt"), task,
                       "kind string, form string, attempt int, made string")


def assigned(entities: DataFrame, draw: Callable[[str, str, int], str]) -> DataFrame:
    """Surrogates of all distinct entities (kind, form): no two of a kind share one and none is an entity; names of all kinds
    count as one kind here. Entities that lose a collision are drawn again; of those that share a surrogate the lowest
    attempt, then the first form and kind, keeps it."""
    known = staged(entities.select("kind", "form").distinct(), "entities")
    space = F.when(F.col("kind").isin(*NAMES), "name").otherwise(F.col("kind")).alias("space")
    table = staged(drawn(known.withColumn("attempt", F.lit(0)), draw), "drawn")
    while True:
        placed = table.select("*", space)
        best = placed.groupBy("space", "made").agg(F.min(F.struct("attempt", "form", "kind")).alias("best"),
                                                   F.count(F.lit(1)).alias("n")).where("n > 1")
        twice = placed.join(best, ["space", "made"]).where(
            (F.col("form") != F.col("best.form")) | (F.col("kind") != F.col("best.kind"))).select("kind", "form")
        taken = placed.join(known.select(space, F.col("form").alias("made")).distinct(), ["space", "made"]).select("kind", "form")
        again = staged(twice.union(taken).distinct(), "again")
        if again.isEmpty():
            return table
        redo = table.join(again, ["kind", "form"]).withColumn("attempt", F.col("attempt") + 1)
        kept = table.join(again, ["kind", "form"], "left_anti")
        table = staged(kept.unionByName(drawn(redo, draw)), "drawn")


def rewrite(text: str, draw: Callable[[str, str, int], str], attempts: dict[tuple[str, str], int],
            kinds: dict[tuple[str, str], str] | None = None) -> tuple[str, int]:
    """Text with surrogates, number of mentions. kinds: what the corpus takes an entity (kind, form) for, if for another kind."""
    out, at, n = [], 0, 0
    for a, b, kind, form, mention in mentions(text):
        to = (kinds or {}).get((kind, form), kind)
        out += [text[at:a], in_format(to, draw(to, form, attempts.get((kind, form), 0)), mention)]
        at, n = b, n + 1
    return "".join([*out, text[at:]]), n


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text",
                  draw: Callable[[str, str, int], str] | None = None) -> DataFrame:
    """doc_id, text with surrogates, n_entities (mentions replaced) of every document."""
    draw = draw or (lambda kind, form, attempt: surrogate(key, kind, form, attempt))
    per_doc = staged(detected(docs, text), "mentions")
    each = per_doc.select("doc_id", "th", F.explode("entities").alias("e")).select("doc_id", "th", "e.kind", "e.form")
    known = staged(each.select("kind", "form").distinct(), "entities")
    kinds = known.where(F.col("kind").isin(*NAMES)).groupBy("form").agg(F.min("kind").alias("to"))
    moved = staged(known.where(F.col("kind").isin(*NAMES)).join(kinds, "form").where("kind <> to"), "moved")  # few
    resolved = known.join(moved, ["kind", "form"], "left").select(F.coalesce("to", "kind").alias("to"), "kind", "form")
    again = assigned(resolved.select(F.col("to").alias("kind"), "form"), draw).where("attempt > 0").select(
        F.col("kind").alias("to"), "form", "attempt")
    other = staged(resolved.join(again, ["to", "form"], "left").where("attempt > 0 OR kind <> to").select(
        "kind", "form", "to", F.coalesce("attempt", F.lit(0)).alias("attempt")), "looked-up")
    redrawn = staged(each.join(other, ["kind", "form"]).distinct().groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("kind", "form", "to", "attempt")).alias("redrawn")), "redrawn").select(
            F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "redrawn")
    frame = docs.select("doc_id", F.col(text).alias("text"))
    frame = frame.join(redrawn, same(frame["doc_id"], F.col("_id")) & (text_hash(frame["text"]) == F.col("_th")),
                       "left").select("doc_id", valid("text").alias("text"), "redrawn")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t, other in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                made, n = (None, 0) if t is None else rewrite(
                    t, draw, {(x["kind"], x["form"]): x["attempt"] for x in other or ()},
                    {(x["kind"], x["form"]): x["to"] for x in other or ()})
                texts.append(made)
                counts.append(n)
            schema = pa.schema([b.schema.field(0), ("text", pa.string()), ("n_entities", pa.int64())])
            yield batch(schema, b.column(0), texts, counts)

    kind = frame.schema["doc_id"].dataType.simpleString()
    return map_batches(frame, task, f"doc_id {kind}, text string, n_entities long")
