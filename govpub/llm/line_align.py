"""Line dedup by pairwise alignment.

Lines are hashed (128 bits; white space at the ends does not count). Documents that overlap are found through the hashes
of their shortest runs of consecutive lines with `MIN_WORDS` words, one run from and one up to every line that has words; a
line of so many words is a run of its own. A run that more than one document holds pairs each of its later holders
with the first one (smallest id): a run with n holders gives n - 1 pairs, never n^2, and no run is too frequent to pair.
Every block that can be deleted is covered by such runs, so its document is paired with a holder of each part.

Each pair of line sequences is aligned by patience diff: lines that are unique in both are anchors (where there are none, the
k-th copy of a line is the anchor of the k-th), the longest increasing run of anchors splits the pair, and equal lines
next to anchors extend the match. What stays unaligned because its order differs is aligned again by itself, until no
`MIN_WORDS` words in common are left. Aligned runs of consecutive lines with at least `MIN_WORDS` words are deleted from the
later document. Matches too short to delete can use up the lines of a longer block, so the shortest runs that the alignment
leaves are then looked up in the earlier document, and as many copies go as it holds of each; with `every_copy` (as op7 and the
pipeline have it) every copy goes, however often it is repeated. The first holder
is partner enough for that: a line with words goes exactly if it lies in `MIN_WORDS` words of consecutive lines that any
earlier document holds. Every deletion has a witness in a document with a smaller id, so the first copy of a block always remains.

Defined results: documents without an id have no order, so they are neither changed nor compared; a null text stays
null; rows with the same id are each compared with smaller ids, never with each other; without `every_copy` more copies in the later document than in its first holder stay; lines without a word are deleted only
inside a longer block; a text whose lines all go becomes empty. Extra columns stay as they are.

Scale: run hashes are shuffled once to find holders and once to pair. Sequences of hashes, not texts, travel to the
pairs, through equi joins that AQE splits when a first holder is popular. Texts move once, to meet their deletions.
"""

from __future__ import annotations

import struct
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, same, staged, text_hash

#: Words of the shortest block that is deleted.
MIN_WORDS = 10


def sequences(docs: DataFrame) -> DataFrame:
    """doc_id, text hash and, per line, two hashes and the number of words."""
    lines = F.expr(r"transform(split(text, '\n', -1), l -> trim(BOTH ' \t\r' FROM l))")
    seq = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", text_hash().alias("th"), lines.alias("lines"))
    return seq.select("doc_id", "th", F.expr("transform(lines, l -> xxhash64(l))").alias("h"),
                      F.expr("transform(lines, l -> xxhash64(l, 1))").alias("g"),
                      F.expr(r"transform(lines, l -> if(l = '', 0, size(split(l, '[ \\t\\r]+'))))").alias("w"))


def runs(words: list[int], min_words: int = MIN_WORDS) -> set[tuple[int, int]]:
    """(from, to) of the shortest runs with so many words from and up to every line that has words, ends included."""
    spoken = [i for i, n in enumerate(words) if n]
    found, k, total = set(), 0, 0
    for i in spoken:  # up to the k-th line with words, without it
        while k < len(spoken) and total < min_words:
            total += words[spoken[k]]
            k += 1
        if total < min_words:
            break
        found.add((i, spoken[k - 1]))
        total -= words[i]
    k, total = len(spoken), 0
    for j in reversed(spoken):
        while k and total < min_words:
            k -= 1
            total += words[spoken[k]]
        if total < min_words:
            break
        found.add((spoken[k], j))
        total -= words[j]
    return found


_KEYS = pa.list_(pa.struct([("h", pa.int64()), ("g", pa.int64())]))


def _run_keys(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = []
        for hs, gs, ws in zip(*(b.column(n).to_pylist() for n in ("h", "g", "w"))):
            here = set()
            for i, j in runs(ws, min_words):
                if i == j:
                    here.add((hs[i], gs[i]))
                else:
                    lines = array("q", hs[i:j + 1] + gs[i:j + 1]).tobytes()
                    here.add(struct.unpack("<qq", xxhash.xxh3_128_digest(lines)))
            keys.append([{"h": h, "g": g} for h, g in here])
        yield batch(pa.schema([b.schema.field("doc_id"), ("th", pa.int64()), ("keys", _KEYS)]),
                    b.column("doc_id"), b.column("th"), keys)


def partners(seq: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, of): a document and the first holder of one of its runs."""
    kind = seq.schema["doc_id"].dataType.simpleString()
    keyed = map_batches(seq, lambda batches: _run_keys(batches, min_words),
                        f"doc_id {kind}, th long, keys array<struct<h:long,g:long>>")
    held = staged(keyed.select("doc_id", "th", F.explode("keys").alias("k")).select("doc_id", "th", "k.h", "k.g"), "runs")
    first = held.groupBy("h", "g").agg(F.min("doc_id").alias("of"), F.max("doc_id").alias("last")).where(
        "of < last").drop("last")
    return held.join(first, ["h", "g"]).where("of < doc_id").select("doc_id", "th", "of").distinct()


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
        back[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _numbered(lines: list) -> Iterator[tuple]:
    """Every line with the number of its earlier copies."""
    seen: Counter = Counter()
    for line in lines:
        yield line, seen[line]
        seen[line] += 1


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned (i, j) of equal lines of a and b, increasing in both. An own stack, as documents can be long."""
    out: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i0, i1, j0, j1 = stack.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        in_a, in_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {b[j]: j for j in range(j0, j1) if in_b[b[j]] == 1}
        pairs = [(i, place[a[i]]) for i in range(i0, i1) if in_a[a[i]] == 1 and a[i] in place]
        if not pairs:
            place = {line: j for line, j in zip(_numbered(b[j0:j1]), range(j0, j1))}
            pairs = [(i, place[line]) for line, i in zip(_numbered(a[i0:i1]), range(i0, i1)) if line in place]
        if not pairs:
            continue
        kept = [pairs[k] for k in longest_increasing([j for _, j in pairs])]
        ends = [*kept, (i1, j1)]
        pi, pj = i0, j0
        for i, j in ends:
            stack.append((pi, i, pj, j))
            pi, pj = i, j  # the anchor itself begins the next part and is matched there as its first line
    return sorted(out)


def remaining(earlier: list, later: list, words: list[int], found: list[tuple[int, int]],
              min_words: int = MIN_WORDS, every_copy: bool = False) -> list[tuple[int, int]]:
    """(from, to) line ranges of `later`, ends included, of its shortest runs that `earlier` holds and `found` leaves: all of
    them, or with those in `found` as many of each as `earlier` holds."""
    gone = set()
    for i, j in found:
        gone.update(range(i, j + 1))
    wanted: dict[tuple, list[tuple[int, int]]] = {}
    sizes: dict[object, set[int]] = {}
    taken: Counter = Counter()
    for i, j in sorted(runs(words, min_words)):
        run = tuple(later[i:j + 1])
        if all(k in gone for k in range(i, j + 1)):
            taken[run] += 1
        else:
            wanted.setdefault(run, []).append((i, j))
            sizes.setdefault(later[i], set()).add(j + 1 - i)
    held = Counter(run for i, line in enumerate(earlier) for n in sizes.get(line, ())
                   if (run := tuple(earlier[i:i + n])) in wanted)
    out: list[tuple[int, int]] = []
    for i, j in sorted(r for run, n in held.items()
                       for r in (wanted[run] if every_copy else wanted[run][:max(0, n - taken[run])])):
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], max(j, out[-1][1]))
        else:
            out.append((i, j))
    return out


def blocks(earlier: list, later: list, words: list[int], min_words: int = MIN_WORDS,
           every_copy: bool = False) -> list[tuple[int, int]]:
    """(from, to) line ranges of `later`, ends included, that are aligned runs with enough words, and what the
    alignment leaves of shared runs because their lines were used up by shorter matches."""
    found = aligned_blocks(earlier, later, words, min_words)
    return sorted(found + remaining(earlier, later, words, found, min_words, every_copy))


def aligned_blocks(earlier: list, later: list, words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(from, to) of aligned runs with enough words. A line of either is aligned at most once."""
    out = []
    at_a, at_b = list(range(len(earlier))), list(range(len(later)))
    while True:
        common = {earlier[i] for i in at_a} & {later[j] for j in at_b}
        at_a, at_b = [i for i in at_a if earlier[i] in common], [j for j in at_b if later[j] in common]
        if sum(words[j] for j in at_b) < min_words:
            return sorted(out)
        aligned = [(at_a[i], at_b[j]) for i, j in patience([earlier[i] for i in at_a], [later[j] for j in at_b])]
        run: list[tuple[int, int]] = []
        for i, j in [*aligned, (-2, -2)]:
            if run and (i, j) == (run[-1][0] + 1, run[-1][1] + 1):
                run.append((i, j))
                continue
            if run and sum(words[j] for _, j in run) >= min_words:
                out.append((run[0][1], run[-1][1]))
            run = [(i, j)]
        gone_a, gone_b = {i for i, _ in aligned}, {j for _, j in aligned}
        at_a, at_b = [i for i in at_a if i not in gone_a], [j for j in at_b if j not in gone_b]


_BLOCKS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _align(batches: Iterator[pa.RecordBatch], min_words: int, every_copy: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for h, g, w, eh, eg in zip(*(b.column(n).to_pylist() for n in ("h", "g", "w", "eh", "eg"))):
            found.append([{"a": x, "b": y} for x, y in blocks(list(zip(eh, eg)), list(zip(h, g)), w, min_words, every_copy)])
        yield batch(pa.schema([b.schema.field("doc_id"), ("th", pa.int64()), ("blocks", _BLOCKS)]),
                    b.column("doc_id"), b.column("th"), found)


def deletions(docs: DataFrame, min_words: int = MIN_WORDS, every_copy: bool = False) -> DataFrame:
    """(doc_id, th, gone): line ranges that an earlier document already has."""
    seq = staged(sequences(docs), "lines")
    pairs = staged(partners(seq, min_words), "partners")
    own = pairs.join(seq, ["doc_id", "th"])
    other = seq.select(F.col("doc_id").alias("of"), F.col("h").alias("eh"), F.col("g").alias("eg"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_batches(own.join(other, "of").select("doc_id", "th", "h", "g", "w", "eh", "eg"),
                        lambda batches: _align(batches, min_words, every_copy),
                        f"doc_id {kind}, th long, blocks array<struct<a:int,b:int>>")
    each = found.select("doc_id", "th", F.explode("blocks").alias("r")).distinct()
    return each.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("r")).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, lines: str = "n_lines",
                deleted: str = "n_deleted", every_copy: bool = False) -> DataFrame:
    """All documents and columns, repeated blocks taken out of the text; the columns `lines` and `deleted` are set."""
    gone = staged(deletions(docs.select("doc_id", "text"), min_words, every_copy), "deletions").select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "gone")
    row = docs.select(F.struct(*docs.columns).alias("_row"))
    text = F.col("_row.text")
    out = row.join(gone, (F.col("_row.doc_id") == F.col("_id")) & (text_hash(text) == F.col("_th")), "left")
    out = out.withColumn("_lines", F.split(text, "\n", -1))
    kept = F.expr("filter(_lines, (l, i) -> NOT exists(gone, r -> i BETWEEN r.a AND r.b))")
    none = F.col("gone").isNull()
    out = out.withColumn("_kept", F.when(none, F.col("_lines")).otherwise(kept))
    count = lambda c: F.coalesce(F.array_size(c), F.lit(0)).cast("long")
    others = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("text", lines, deleted)]
    found = out.select(*others, F.when(none, text).otherwise(F.array_join("_kept", "\n")).alias("text"),
                       count("_lines").alias(lines), (count("_lines") - count("_kept")).alias(deleted))
    return found.select(*docs.columns, *(c for c in (lines, deleted) if c not in docs.columns))
