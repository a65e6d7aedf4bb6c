r"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) and at least
max(`min_length`, 2q) words that no neighbour extends. Steps, for the texts of a task in portions of bounded size:

1. Words become numbers; every text of the portion ends in a number of its own, so nothing reaches across texts.
2. Recompression builds a run-length grammar of the portion. A round first replaces every maximal block of one symbol by a
   symbol for (symbol, length), then splits the symbols into left and right ones and replaces every pair of a left and a
   right one. Which neighbours merge depends on the symbols alone, so equal stretches are parsed alike but for their ends.
   Rounds go on until one symbol is left; each keeps its string and where its symbols begin in the string below.
3. A stretch in which words q apart are the same and that holds a run has at least q words, so it covers a place j that is
   a multiple of q: the harmonic grid of all (j, q), q a divisor of j, has n ln n points in all. Those whose words j and
   j - q agree are candidates.
4. How far a candidate reaches back and ahead are two longest common extension queries on the grammar, answered exactly
   for all candidates at once: both ends climb while their symbols agree, step to the next common border where they lie
   inside a block or pair, and descend from the first difference. No suffix array is needed.
5. Candidates of one stretch agree in start and length; the smallest period is the run's.

Scale: one scan, no shuffle. A portion holds about `base.PORTION` bytes of text or one longer text; its grammar takes a small
multiple of that, and the grid is walked in blocks, so memory grows with the longest text only.

Defined results: a null, empty or blank text has no words and no run, and its collapsed text is empty; ties for the
longest run go to the smaller start, then period; ill-formed UTF-8 is replaced by U+FFFD first; repeated rows are judged
one by one; without documents there are no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, free_names, map_batches, mix, portions, texts_as_bytes, valid

#: Words of the shortest run; grid points looked at together.
MIN_LENGTH, GRID = 12, 1_000_000

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


class Level(NamedTuple):
    """A string of the grammar. Symbol k stands at padded[k + 1]; a symbol that no text has stands at either end."""
    padded: np.ndarray
    inside: np.ndarray  # symbol -> symbol of the string above that holds it
    begins: np.ndarray  # symbol of the string above -> its first symbol here; one more entry for the end
    blocks: bool


def _level(string: np.ndarray, first: np.ndarray, blocks: bool) -> Level:
    begins = np.append(np.flatnonzero(first), len(string))
    return Level(np.concatenate(([-1], string, [-1])), np.cumsum(first) - 1, begins, blocks)


def _named(keys: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """A new symbol for every different right-hand side, and the number of symbols from then on."""
    different, which = np.unique(keys, return_inverse=True)
    return names + which, names + len(different)


def grammar(string: np.ndarray) -> list[Level]:
    """Strings of all rounds, the text first; above the last one there is a single symbol."""
    levels: list[Level] = []
    names, turn = int(string.max(initial=0)) + 1, 0
    while len(string) > 1:
        first = np.concatenate(([True], string[1:] != string[:-1]))
        if not first.all():
            level = _level(string, first, True)
            at, size = level.begins[:-1], np.diff(level.begins)
            above, long = string[at], size > 1
            above[long], names = _named(above[long] * (len(string) + 1) + size[long], names)
            levels.append(level)
            string = above
            continue
        left = mix(string.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1) == 0
        turn += 1
        pairs, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        pairs = other if other.sum() > pairs.sum() else pairs
        at = np.flatnonzero(pairs)
        if not len(at):
            continue
        first = np.ones(len(string), bool)
        first[at + 1] = False
        level = _level(string, first, False)
        above = string[level.begins[:-1]]
        above[level.inside[at]], names = _named(string[at] * names + string[at + 1], names)
        levels.append(level)
        string = above
    return levels


def common_ahead(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the stretches from i and from j (i < j) have in common, to the right."""
    x, y, left = i.copy(), j.copy(), []
    here = np.arange(len(i))
    for level in levels:
        a, b = x[here], y[here]
        same = level.padded[a + 1] == level.padded[b + 1]
        left.append(here[~same])
        here, a, b = here[same], a[same], b[same]
        up_a, up_b = level.inside[a], level.inside[b]
        border = (level.begins[up_a] == a) & (level.begins[up_b] == b)
        ends_a, ends_b = level.begins[up_a + 1] - a, level.begins[up_b + 1] - b
        step = np.minimum(ends_a, ends_b)
        apart = ~border & (ends_a != ends_b)  # inside blocks of one symbol that end differently
        x[here], y[here] = np.where(border, up_a, up_a + 1), np.where(border, up_b, up_b + 1)
        x[here[apart]], y[here[apart]] = (a + step)[apart], (b + step)[apart]
        left[-1] = np.concatenate((left[-1], here[apart]))
        here = here[~apart]
    for h in range(len(levels) - 1, -1, -1):
        if h < len(levels) - 1 or len(here):
            level = levels[h]
            x[here], y[here] = a, b = level.begins[x[here]], level.begins[y[here]]
            same = level.padded[a + 1] == level.padded[b + 1]
            go, a, b = here[same], a[same], b[same]
            step = 1
            if level.blocks:
                step = np.minimum(level.begins[level.inside[a] + 1] - a, level.begins[level.inside[b] + 1] - b)
            x[go], y[go] = a + step, b + step
        here = np.concatenate((here, left[h]))
    return x - i


def common_back(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the stretches before i and before j (i < j) have in common, to the left."""
    x, y, left = i.copy(), j.copy(), []
    here = np.arange(len(i))
    for level in levels:
        a, b = x[here], y[here]
        same = level.padded[a] == level.padded[b]
        left.append(here[~same])
        here, a, b = here[same], a[same], b[same]
        up_a, up_b = level.inside[a - 1], level.inside[b - 1]
        border = (level.begins[up_a + 1] == a) & (level.begins[up_b + 1] == b)
        room_a, room_b = a - level.begins[up_a], b - level.begins[up_b]
        step = np.minimum(room_a, room_b)
        apart = ~border & (room_a != room_b)
        x[here], y[here] = np.where(border, up_a + 1, up_a), np.where(border, up_b + 1, up_b)
        x[here[apart]], y[here[apart]] = (a - step)[apart], (b - step)[apart]
        left[-1] = np.concatenate((left[-1], here[apart]))
        here = here[~apart]
    for h in range(len(levels) - 1, -1, -1):
        if h < len(levels) - 1 or len(here):
            level = levels[h]
            x[here], y[here] = a, b = level.begins[x[here]], level.begins[y[here]]
            same = level.padded[a] == level.padded[b]
            go, a, b = here[same], a[same], b[same]
            step = 1
            if level.blocks:
                step = np.minimum(a - level.begins[level.inside[a - 1]], b - level.begins[level.inside[b - 1]])
            x[go], y[go] = a - step, b - step
        here = np.concatenate((here, left[h]))
    return i - x


def grid(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """All (j, q) with low <= j < high where q divides j and 2q <= n, in order of q."""
    q = np.arange(1, min(n // 2, high - 1) + 1, dtype=np.int64)
    number = (high - 1) // q - (low - 1) // q
    q, number = q[number > 0], number[number > 0]
    of = np.repeat(q, number)
    turn = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    return (np.repeat((low - 1) // q, number) + 1 + turn) * of, of


class Grid:
    """The grid of short texts, sorted by j, so that a text of n words takes its beginning."""

    def __init__(self, size: int = 4096):
        j, q = grid(2 * size, 1, size)
        order = np.argsort(j, kind="stable")
        self.size, self.j, self.q = size, j[order], q[order]
        self.until = np.searchsorted(self.j, np.arange(size + 1))

    def candidates(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(j, q) with word j the same as word j - q."""
        n = len(words)
        if n <= self.size:
            j, q = self.j[: self.until[n]], self.q[: self.until[n]]
            same = words[j] == words[j - q]
            yield j[same], q[same]
            return
        step = max(1, int(GRID / (np.log(n) + 1)))
        for low in range(1, n, step):
            j, q = grid(n, low, min(low + step, n))
            same = words[j] == words[j - q]
            yield j[same], q[same]


def runs_of(texts: list[np.ndarray], grids: Grid, min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Runs of every text (rows of start, length and period, sorted), found in one grammar. Texts are word numbers."""
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    names = max((int(t.max(initial=-1)) for t in texts), default=-1) + 1
    string = np.concatenate([np.append(t, names + k) for k, t in enumerate(texts)]) if texts else np.empty(0, np.int64)
    js, qs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin, words in zip(begins, texts):
        if len(words) >= min_length:
            for j, q in grids.candidates(words):
                js.append(j + begin)
                qs.append(q)
    j, q = np.concatenate(js), np.concatenate(qs)
    levels = grammar(string)
    back = common_back(levels, j - q, j)
    first = back < q  # a later grid point of the same stretch tells nothing new
    j, q, back = j[first], q[first], back[first]
    length = back + common_ahead(levels, j - q, j) + q
    enough = length >= np.maximum(min_length, 2 * q)
    start, length, q = (j - q - back)[enough], length[enough], q[enough]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[least], length[least], q[least]
    order = np.lexsort((q, start))
    rows = np.stack((start, length, q), axis=1)[order]
    cuts = np.searchsorted(rows[:, 0], begins)
    return [rows[a:b] - [begin, 0, 0] for a, b, begin in zip(cuts[:-1], cuts[1:], begins)]


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds beyond its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def periodic(docs: DataFrame, keep: list[str], text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """`keep`, n_words, runs (start, length, period; by start, then period) and the text with every run cut to one
    period, its words joined by one space."""
    frame = docs.select(*keep, valid(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = Grid()
        for b in batches:
            texts = [raw or b"" for raw in texts_as_bytes(b.column(b.num_columns - 1))]
            for part in portions(texts):
                number: dict[bytes, int] = {}
                words = [raw.split() for raw in texts[part]]  # bytes are split at exactly the six ASCII spaces
                coded = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in words]
                found = runs_of(coded, grids, min_length)
                rows = [(len(ws), [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()],
                         b" ".join(ws if not len(runs) else [w for w, stays in zip(ws, kept(len(ws), runs)) if stays]).decode())
                        for ws, runs in zip(words, found)]
                yield batch(pa.schema([*list(b.schema)[:-1], *_FOUND]), *(c[part] for c in b.columns[:-1]), *zip(*rows))

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest(runs: str = "runs") -> Column:
    """The run with the greatest length; ties go to the smaller start, then period. Null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("_start"),
                                                            (-r["period"]).alias("_period"))))
    return F.when(best.isNotNull(), F.struct((-best["_start"]).alias("start"), best["length"].alias("length"),
                                             (-best["_period"]).alias("period")))


def with_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, every tenth (by the CRC of its id) with a periodic tail made of its own words; a document without
    an id stays as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    names = free_names(docs, "_g", "_words", "_a", "_p")
    g, words, a, p = map(F.col, names)
    marked = docs.withColumn(names[0], F.when(h % 10 == 0, F.floor(h / 10).cast("long")))
    # columns of their own, so that the words are looked for once
    split = marked.withColumn(names[1], F.when(g.isNotNull(), F.regexp_extract_all(
        valid(text), F.lit(r"([^\x20\x09-\x0D]+)"), 1)))
    n = F.size(words).cast("long")
    sized = split.withColumn(names[2], F.when(n > 0, g % n)).withColumn(
        names[3], 1 + F.floor((n - a) / (3 + g % 8)).cast("long"))
    begin, rest = a.cast("int"), (n - a).cast("int")
    period = F.slice(words, begin + 1, p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), begin), tail), " ")
    return sized.withColumn(text, F.when(a.isNotNull(), made).otherwise(F.col(text))).drop(*names)
