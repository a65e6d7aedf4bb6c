r"""Benchmark decontamination by a prefix-filtered set join.

A window is `size` consecutive words of an item (an item with fewer words is one window). A window occurs in a document
only if each of its shingles of up to five words does, so joining on *one* necessary shingle, the rarest of the window in
the corpus, finds every occurrence. Steps:

1. Windows and their shingles are taken from the items; the shingles set bits in a map of fixed size (2 MB whatever the
   number of items; a full map only lets more pass).
2. One scan over whole documents keeps maximal runs of consecutive shingles whose bits are set (length bound: runs
   shorter than the shortest window go). Long runs are cut into overlapping blocks, so no row grows with the text.
3. Shingle frequencies over all documents order the shingles of each window by rarity; occurrences join the windows on
   the rarest one only. The offset of the shingle in the window and in the run gives the position bound.
4. The words are compared exactly; hit words and items are then counted per document.

Documents move only as the runs of step 2. Frequencies and joins are aggregated before the shuffle or split by AQE. No
window, item or document is dropped for being frequent.

Defined results: a null or wordless text has n_words 0 and is not contaminated; items without a word have no window;
an item without an id is listed as the empty string; repeated documents are judged one by one; repeated items count once by id; without
items nothing is hit. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import (WordHashes, batch, map_batches, plain_words, same, shingle_hashes, staged, text_hash,
                             texts_as_bytes)

#: Words of a window; words of a shingle; contaminated from one hit word in so many.
WINDOW, SHINGLE, ONE_IN = 13, 5, 20
#: log2 of the bits of the map; words of a block of a run, without the overlap.
MAP_BITS, BLOCK = 24, 64

_WINDOWS = pa.schema([("item_id", pa.string()), ("win", pa.string()), ("n", pa.int32()), ("size", pa.int32()),
                      ("slots", pa.list_(pa.int64()))])


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """item_id (string), win (words), n, shingle size, and the bits its shingles set."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            rows = []
            for item, raw in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1))):
                words = plain_words(raw or b"")
                n = min(size, len(words))
                for k in range(len(words) - n + 1 if n else 0):
                    part, short = words[k: k + n], min(SHINGLE, n)
                    h = shingle_hashes(hashes.of(part), short)
                    rows.append((item, b" ".join(part).decode(), n, short, slots(h)[0].tolist() + slots(h)[1].tolist()))
            yield batch(_WINDOWS, *(list(zip(*rows)) or [[]] * 5))

    frame = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"),
                         F.col(text).alias("_text"))
    return map_batches(frame, task, "item_id string, win string, n int, size int, slots array<long>")


def slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << MAP_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(40)) & mask).astype(np.int64)


def bit_map(wins: DataFrame) -> np.ndarray:
    """2^MAP_BITS bits as 64 bit words: at most 2^18 rows come to the driver, whatever the number of items."""
    slot = wins.select(F.explode("slots").alias("slot"))
    rows = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).collect()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    for r in rows:
        out[r["word"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    return out


def set_bits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for s in slots(h):
        ok &= ((bits[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return ok


_RUN = pa.struct([("size", pa.int32()), ("start", pa.int64()), ("words", pa.string())])


def runs(docs: DataFrame, keep: list[str], text: str, bits: np.ndarray, shortest: dict[int, int], size: int) -> DataFrame:
    """`keep`, n_words and the runs of every document whose shingles all have their bits set."""
    frame = docs.select(*keep, F.col(text).alias("_text"))
    shared = frame.sparkSession.sparkContext.broadcast(bits)

    def runs_of(words: list[bytes], hashes: WordHashes) -> list[dict]:
        out = []
        h = hashes.of(words)
        for short, least in shortest.items():
            if len(words) < least:
                continue
            ok = set_bits(shared.value, shingle_hashes(h, short))
            edge = np.flatnonzero(np.diff(np.concatenate(([False], ok, [False])).astype(np.int8)))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                end = b + short - 1
                if end - a >= least:
                    for k in range(a, max(a + 1, end - size + 1), BLOCK):
                        out.append({"size": short, "start": k,
                                    "words": b" ".join(words[k: min(end, k + BLOCK + size - 1)]).decode()})
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            words = [plain_words(t or b"") for t in texts_as_bytes(b.column(b.num_columns - 1))]
            schema = pa.schema([*list(b.schema)[:-1], ("n_words", pa.int64()), ("runs", pa.list_(_RUN))])
            yield batch(schema, *b.columns[:-1], [len(w) for w in words], [runs_of(w, hashes) for w in words])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}, n_words long, runs array<struct<size:int,start:long,words:string>>")


def occurrences(found: DataFrame) -> DataFrame:
    """row, start of the block, its words, and each shingle with its place in the block."""
    block = found.select("row", F.explode("runs").alias("r")).select(
        "row", F.col("r.start").alias("start"), F.col("r.size").alias("size"), F.split("r.words", " ").alias("words"))
    shingles = F.expr("transform(sequence(0, size(words) - size), i -> array_join(slice(words, i + 1, size), ' '))")
    return block.select("row", "start", "words", F.posexplode(shingles).alias("at", "token"))


def prefix_tokens(wins: DataFrame, frequency: DataFrame) -> DataFrame:
    """Per distinct window its rarest shingle and the offset of that shingle; windows with an absent shingle go."""
    distinct = wins.select("win", "n", "size").distinct().withColumn("words", F.split("win", " "))
    shingles = F.expr("transform(sequence(0, n - size), i -> array_join(slice(words, i + 1, size), ' '))")
    each = distinct.select("win", "n", F.posexplode(shingles).alias("off", "token"))
    each = each.join(frequency, "token", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    rarest = each.groupBy("win", "n").agg(F.min(F.struct("f", "token", "off")).alias("m"))
    return rarest.where("m.f > 0").select("win", "n", F.col("m.token").alias("token"), F.col("m.off").alias("off"))


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text",
                  size: int = WINDOW) -> DataFrame:
    """`keep`, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    wins = staged(windows(items, size=size), "windows")
    shortest = {r["size"]: r["n"] for r in wins.groupBy("size").agg(F.min("n").alias("n")).collect()}  # at most 5 rows
    found = staged(runs(docs, keep, text, bit_map(wins), shortest, size)
                   .withColumn("row", F.monotonically_increasing_id()), "runs")
    tokens = occurrences(found)
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f"))
    prefix = prefix_tokens(wins, frequency)
    begin = F.col("at") - F.col("off")
    hits = tokens.join(prefix, "token").where((begin >= 0) & (begin + F.col("n") <= F.size("words"))).where(
        F.array_join(F.slice("words", begin + 1, F.col("n")), " ") == F.col("win"))
    hits = staged(hits.select("row", (F.col("start") + begin).alias("first"), "n", "win").distinct(), "hits")
    covered = hits.select("row", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("word"))
    words = covered.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = hits.select("row", "win").distinct().join(wins.select("win", "item_id").distinct(), "win")
    listed = listed.select("row", "item_id").distinct().groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("ids"))
    out = found.select("row", *keep, "n_words").join(words, "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    keyed = docs.select("doc_id", "text", text_hash().alias("_text_hash"))
    bad = contamination(keyed, items, ["doc_id", "_text_hash"]).where("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("_text_hash").alias("_bad_hash"))
    return docs.join(bad, same(docs["doc_id"], bad["_bad_id"])
                     & same(text_hash(docs["text"]), bad["_bad_hash"]),
                     "left_anti")
