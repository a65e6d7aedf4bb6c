"""Near-duplicate documents by ProbMinHash.

Elements are shingles of five lower-cased words (a shorter text with words is one shingle), weighted by how often the
text holds them (sublinearly). Each element sends out a Poisson process whose rate is its weight; every arrival falls on one of
`COMPONENTS` places, and a place keeps the element whose arrival there came first. An element stops as soon as its
next arrival is later than the latest place of its document, so most elements end after an arrival or two. Two documents
agree in a place with the probability Jaccard similarity of their weighted shingles.

Steps:

1. One scan makes, per document, a digest of its words and `BANDS` keys of `ROWS` places each, once with these weights and
   once with all weights 1, where agreement is the Jaccard similarity of the sets, by which links are defined. The keys of a
   text that holds no shingle twice are the same both times and kept once. Documents with equal words are
   one text from here on, so copies cost one row each and never a pair.
2. Texts that share a key are compared with the bucket's pivot (its smallest text), which gives n - 1 pairs per
   bucket, not n^2. Pairs whose shingle counts rule out the threshold are left out. Pairs are verified exactly, by the Jaccard
   similarity of their shingle sets.
3. Members of a bucket that are in one component by then need no further comparison. Texts of buckets that still hold
   several components are joined by an exact prefix filter on their rarest shingles: what is left to find are links between
   texts that are both unlike their pivots, and such a pair must share a rare shingle.
4. Connected components of the verified links are the classes.

At set similarity 0.8 a pair shares no key of equal weights with probability (1 - 0.8^5)^24, less than 1 in 10,000, however
often either text repeats its shingles.

Defined results: a text without words is in no class but its own; class_id is the smallest id of the class, a document without an id
belongs to a class by its text and gets the smallest id there (null if there is none); rows with equal ids are
treated by their texts; repeated rows are one text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import (WordHashes, batch, map_batches, mix, plain_words, same, shingle_hashes, staged, text_hash,
                             texts_as_bytes)
from govpub.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
COMPONENTS = BANDS * ROWS


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, places: int) -> np.ndarray:
    """docs x places: the element that arrived first. All documents of a batch advance together, arrival by arrival."""
    first = np.full(docs * places, np.inf)
    winner = np.zeros(docs * places, np.uint64)
    time = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival += 1
        draw = mix(element ^ mix(np.array([arrival], np.uint64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        on = time < first.reshape(docs, places).max(axis=1)[doc]
        doc, element, weight, time, draw = doc[on], element[on], weight[on], time[on], draw[on]
        place = doc * places + (mix(draw) % np.uint64(places)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = first[place] == time
        winner[place[won]] = element[won]
    return winner.reshape(docs, places)


def weighted(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights, 1 + ln(count), so that a line repeated a hundred times does not stand for the
    whole text."""
    found, count = np.unique(shingle_hashes(hashes.of(words), SHINGLE), return_counts=True)
    return found, 1.0 + np.log(count)


def band_keys(winners: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """docs x bands of 64 bit keys."""
    parts = winners.reshape(len(winners), bands, rows)
    key = np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = mix(key ^ parts[:, :, k])
    return key.view(np.int64)


def keys_of(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[list[int]]:
    """Distinct band keys of every text, with its weights and with equal ones, from its shingles and weights."""
    unequal = [k for k, (_, c) in enumerate(sets) if len(c) and c.max() > 1.0]
    both = sets + [(sets[k][0], np.ones(len(sets[k][0]))) for k in unequal]
    if not both:
        return []
    found = signatures(np.repeat(np.arange(len(both)), [len(s) for s, _ in both]),
                       np.concatenate([s for s, _ in both]).astype(np.uint64),
                       np.concatenate([c for _, c in both]).astype(np.float64), len(both), COMPONENTS)
    keys = band_keys(found)
    out = [k.tolist() if len(s) else [] for k, (s, _) in zip(keys, sets)]
    for n, k in enumerate(unequal, len(sets)):
        out[k] = list({*out[k], *keys[n].tolist()})
    return out


def signed(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep`, digest of the words (null without words), number of distinct shingles, band keys."""
    frame = docs.select(*keep, F.col(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            words = [plain_words(t or b"") for t in texts_as_bytes(b.column(b.num_columns - 1))]
            sets = [weighted(w, hashes) for w in words]
            sizes = [len(s) for s, _ in sets]
            keys = keys_of(sets)
            digests = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
            schema = pa.schema([*list(b.schema)[:-1], ("digest", pa.binary()), ("size", pa.int64()),
                                ("keys", pa.list_(pa.int64()))])
            yield batch(schema, *b.columns[:-1], digests, sizes, keys)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}, digest binary, size long, keys array<long>")


def shingle_sets(texts: DataFrame, keep: str, text: str) -> DataFrame:
    """`keep` and the sorted distinct shingle hashes."""
    frame = texts.select(keep, F.col(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [weighted(plain_words(t or b""), hashes)[0].view(np.int64) for t in texts_as_bytes(b.column(1))]
            schema = pa.schema([b.schema.field(0), ("shingles", pa.list_(pa.int64()))])
            yield batch(schema, b.column(0), pa.array(sets, pa.list_(pa.int64())))

    return map_batches(frame, task, f"{keep} long, shingles array<long>")


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for x, y in zip(b.column("x"), b.column("y")):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both))
        yield batch(pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())]),
                    b.column("a"), b.column("b"), out)


def similarity(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, sim): exact Jaccard similarity of the pairs' shingle sets."""
    got = pairs.select("a", "b").join(sets.select(F.col("text_no").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("text_no").alias("b"), F.col("shingles").alias("y")), "b")
    return map_batches(got.select("a", "b", "x", "y"), _similar, "a long, b long, sim double")


def near_size(x: str, y: str, threshold: float):
    return F.least(x, y) >= threshold * F.greatest(x, y)


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, th (hash of the text), class_id, whether it is the first of its class, whether it has no words."""
    docs = docs.select("doc_id", F.col(text).alias("text")).withColumn("th", text_hash())
    sig = staged(signed(docs, ["doc_id", "th"]), "signatures")
    # every distinct text once, with the first document that holds it; documents without an id come last
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    texts = staged(sig.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(order).alias("one"), F.first("size").alias("size"), F.first("keys").alias("keys")).orderBy("one").withColumn(
            "text_no", F.monotonically_increasing_id()), "texts")  # numbered in the order of the ids: pivots are old texts
    keyed = texts.select("text_no", "size", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = staged(keyed.join(shared, "key"), "members")
    wanted = members.select("text_no").distinct().join(texts.select("text_no", "one"), "text_no")
    rows = docs.join(wanted, same(docs["doc_id"], F.col("one.doc_id")) & same(docs["th"], F.col("one.th")))
    sets = staged(shingle_sets(rows, "text_no", "text").dropDuplicates(["text_no"]), "shingles")
    links = linked(members, sets, threshold)
    label = components(links).select(F.col("node").alias("text_no"), "label")
    named = texts.select("text_no", "digest", "one").join(label, "text_no", "left").withColumn(
        "label", F.coalesce("label", "text_no"))
    least = named.groupBy("label").agg(F.min("one").alias("head"))
    of = named.join(least, "label").select("digest", "head")
    found = sig.select("doc_id", "th", "digest").join(of, "digest", "left")
    alone = F.col("digest").isNull()
    return found.select(
        "doc_id", "th", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        (alone | (same(F.col("doc_id"), F.col("head.doc_id")) & (F.col("th") == F.col("head.th")))).alias("is_first"),
        alone.alias("wordless"))


def linked(members: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b): verified links that connect whatever is similar and shares a bucket."""
    pivots = members.groupBy("key").agg(F.min(F.struct("text_no", "size")).alias("p")).select(
        "key", F.col("p.text_no").alias("b"), F.col("p.size").alias("psize"))
    pairs = members.join(pivots, "key").where((F.col("text_no") > F.col("b")) & near_size("size", "psize", threshold))
    star = staged(pairs.select(F.col("text_no").alias("a"), "b").distinct(), "pairs")
    known = staged(similarity(star, sets), "similar")
    label = components(known.where(F.col("sim") >= threshold)).select(F.col("node").alias("text_no"), "label")
    now = members.join(label, "text_no", "left").withColumn("label", F.coalesce("label", "text_no"))
    apart = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    now = now.join(apart.select("key"), "key").select("text_no", "size", "label").distinct()
    more = staged(prefix_pairs(now, sets, threshold).join(star, ["a", "b"], "left_anti"), "pairs")
    found = known.union(staged(similarity(more, sets), "similar"))
    return found.where(F.col("sim") >= threshold).select("a", "b")


def prefix_pairs(texts: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): all pairs of texts with different labels that can reach the threshold, by prefix filter.

    With shingles ordered by rarity, two sets of that similarity share one among the first n - ceil(t n) + 1 of each, and from
    the places of a shared one follows an upper bound of the overlap. Shingles that only one text holds come first in
    the order and join nothing, so a text with enough shingles of its own drops out at once.
    """
    each = sets.join(texts, "text_no").select("text_no", F.explode("shingles").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    order = F.array_sort(F.collect_list(F.struct("f", "shingle")))
    ranked = each.join(shared, "shingle").groupBy("text_no").agg(order.alias("held")).join(texts, "text_no")
    own = F.col("size") - F.size("held")
    length = F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1
    first = staged(ranked.where(own < length).select(
        "text_no", "size", "label", own.alias("own"),
        F.posexplode(F.slice("held", 1, (length - own).cast("int"))).alias("at", "s")).select(
            "text_no", "size", "label", (F.col("own") + F.col("at")).alias("at"), F.col("s.shingle").alias("shingle")),
        "prefixes")
    l, r = first.alias("l"), first.alias("r")
    need = threshold / (1 + threshold) * (F.col("l.size") + F.col("r.size")) - 1e-9
    bound = F.least(F.col("l.size") - F.col("l.at"), F.col("r.size") - F.col("r.at"))
    return l.join(r, (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.text_no") > F.col("r.text_no"))
                  & (F.col("l.label") != F.col("r.label")) & near_size("l.size", "r.size", threshold)
                  & (bound >= need)).select(F.col("l.text_no").alias("a"), F.col("r.text_no").alias("b")).distinct()


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id (then the smallest hash of the text);
    documents without an id come last. Of repeated rows one stays. Documents without words all stay."""
    found = staged(classes(docs), "classes")
    gone = found.where("NOT is_first").select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct()
    rest = docs.join(gone, same(docs["doc_id"], gone["_gone_id"]) & same(text_hash(docs["text"]), gone["_gone_th"]),
                     "left_anti")
    again = found.where("is_first AND NOT wordless").groupBy("doc_id", "th").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th"))
    if again.isEmpty():
        return rest
    repeated = same(rest["doc_id"], again["_gone_id"]) & same(text_hash(rest["text"]), again["_gone_th"])
    one = rest.join(again, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(again, repeated, "left_anti").unionByName(one)
