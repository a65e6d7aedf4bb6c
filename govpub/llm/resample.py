r"""Target-distribution importance resampling over hashed n-grams.

Documents are drawn so that their word n-grams look like those of a target collection. Every run of 1 to `order` words is
a feature, hashed to one of `buckets` by its CRC-32; a bucket's gain is the log ratio of its smoothed frequencies in the
target and in the documents; a document weighs the mean gain of its features, and a keyed Gumbel number per document turns
the top of `weight + noise` into a draw without replacement.

Scanning: the text is collapsed to lower-cased words with one space between them, and one overlapped regular expression
runs over it: it matches at every word start (a look-behind for the boundary) and its groups are the spans of the 1st to
n-th word, so the CRC of each longer n-gram continues that of the shorter one. No list of words or n-grams is built.

Scale: the texts are read once. The scan leaves two bytes per feature, written next to the document's id; counts and
weights are taken from those. A task adds its counts up before the shuffle, so frequent words meet as one row per task.
What the driver holds are the gains, `buckets` numbers. The draw is a range partitioned sort of ids and scores: a row's
place is its place in its partition plus the sizes of the partitions before, so no task sorts or numbers all rows.
Equal scores spread over partitions as the id is part of the sort key.

Defined results: a null, empty or wordless text has no features and weight 0; a null doc_id hashes as the empty string and
loses ties; repeated rows are drawn one by one; ill-formed UTF-8 counts byte by byte as it stands; without target items T
and t are 0; without documents there are no rows. Other columns are ignored.
"""

from __future__ import annotations

import array
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, plain_words, staged, texts_as_bytes

#: Words of the longest feature, buckets, documents drawn of a hundred, words that a drawn document has at least.
ORDER, BUCKETS, PERCENT, MIN_WORDS = 2, 10_000, 25, 20
#: Key of the draw.
KEY = 7

_SCAN = pa.schema([("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary())])
_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def scanner(order: int) -> regex.Pattern:
    """Matches at every word start; groups 1 to `order` are the words, the later ones with their leading space."""
    return regex.compile(rb"(?<![^ ])([^ ]++)" + rb"((?: [^ ]++)?)" * (order - 1))


def buckets_of(text: bytes | None, pattern: regex.Pattern, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every feature of the text."""
    crc32, found, words = zlib.crc32, array.array("I"), 0
    add = found.append
    for m in pattern.finditer(b" ".join(plain_words(text or b"")), overlapped=True):
        words, crc = words + 1, 0
        for part in m.groups():
            if not part:
                break
            crc = crc32(part, crc)
            add(crc)
    return words, np.frombuffer(found, np.uint32) % np.uint32(buckets)


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def scanned(docs: DataFrame, keep: list[str], text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """`keep`, n_words, n_features and the buckets of all features, packed."""
    frame, width = docs.select(*keep, F.col(text).alias("_text")), _width(buckets)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = scanner(order)
        for b in batches:
            rows = []
            for raw in texts_as_bytes(b.column(b.num_columns - 1)):
                words, at = buckets_of(raw, pattern, buckets)
                rows.append((words, len(at), at.astype(width).tobytes()))
            yield batch(pa.schema([*list(b.schema)[:-1], *_SCAN]), *b.columns[:-1], *(list(zip(*rows)) or [[]] * 3))

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}n_words long, n_features long, buckets binary")


def counts(scans: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features per bucket; a task adds up its rows first."""
    width = _width(buckets)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(raw, width), minlength=buckets)
        used = np.flatnonzero(total)
        yield batch(_COUNTS, used.astype(np.int32), total[used])

    return map_batches(scans.select("buckets"), task, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths, from the scans of documents and target."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for found, scans in ((s, source), (t, target)):
        for r in counts(scans, buckets).collect():  # at most `buckets` rows
            found[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (all_s + buckets) / ((int(a) + 1) * (all_t + buckets))))
                     for a, b in zip(s, t)], np.int64)


def weighed(scans: DataFrame, gain: np.ndarray) -> DataFrame:
    """The scans with `weight`, the floored mean gain, in place of their buckets."""
    frame = scans.select(*(c for c in scans.columns if c != "buckets"), "buckets")
    width, shared = _width(len(gain)), scans.sparkSession.sparkContext.broadcast(gain)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            found = []
            for raw in b.column(b.num_columns - 1).to_pylist():
                at = np.frombuffer(raw, width)
                found.append(int(own[at].sum()) // len(at) if len(at) else 0)
            yield batch(pa.schema([*list(b.schema)[:-1], ("weight", pa.int64())]), *b.columns[:-1], found)

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}weight long")


def gumbel(doc_id: str = "doc_id", key: int = KEY) -> Column:
    """Keyed standard Gumbel number of an id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{key}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def numbered(rows: DataFrame, order: list[Column], place: str, name: str) -> DataFrame:
    """The rows with their place (1, 2, 3...) in `order`, sorted in range partitions that are written once."""
    cut = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()), name)
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = cut.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return cut.withColumn("_part", part).join(before, "_part").withColumn(
        place, F.col("_before") + within + 1).drop("_part", "_at", "_before")


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
              buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, key: int = KEY) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null for documents that are not drawn)."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scans = staged(scanned(source, ["doc_id"], "text", order, buckets), "resample-scan")
    goal = staged(scanned(target, [], text, order, buckets), "resample-target")
    scored = weighed(scans, gains(scans, goal, buckets)).withColumn("score", F.col("weight") + gumbel("doc_id", key))
    scored = staged(scored, "resample-score")
    fit = F.col("n_words") >= min_words
    drawn = F.floor(scored.where(fit).count() * F.lit(percent) / 100).cast("long")
    order_by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    ranked = numbered(scored.where(fit), order_by, "rank", "resample-order")
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
