r"""Toxicity by a convolutional text classifier trained in numpy.

Words: lower-cased runs of letters, digits and characters beyond ASCII. A word's embedding is the sum of the vectors of its
hashed pieces: the whole word, some beginnings and ends (`BEGINNINGS`, `ENDS`), each hashed to one of 2^20
buckets, so words that were never seen share pieces with known ones. Only pieces that `MIN_DOCS` of all documents learned
from and `MIN_SHARE` of them (both labels weighing the same) have get a vector; the others count as zero.

Network: filters of one, two and three words slide over the embeddings; each filter's maximum over the whole text passes a
rectifier; a logistic unit on all maxima gives the score. Training is Adagrad on the log loss, both labels weighing the same;
through the maximum only the best window of each filter learns, so a step touches few vectors. At scoring time embeddings and
filters fold into one row of numbers per word, kept for words that come again.

Everything is learned from all labelled documents that may be learned from, over their whole texts. Documents that have a piece,
and its occurrences per language, are counted by one aggregate over all of them. Three quarters train the network, in
`ROUNDS` rounds: the documents of a round lie in parts of about `PART_TEXTS`, every part takes the parameters of the round
before and trains on its documents, and what the parts moved is averaged per vector, weighing their documents, by one
aggregate. Every document makes `ROUNDS` times `EPOCHS` passes: up to `PASS_TEXTS` documents every round makes `EPOCHS` over all
of them; of more, every round has documents of its own and makes the passes of all rounds over them.

Thresholds: both labels weigh the same in training, and languages differ, so the last quarter is kept apart and for every language
the cut with the fewest errors, both labels weighing as they do among all labelled rows, is looked up on all of it, out of
counts per language, label and step of 1/`GRID` of the logit; a language with few texts of its own leans on the cut of all. The
language of a text is predicted from the same pieces (log odds of pieces, summed over the text), never taken from the
table. The score is the logistic of the distance to the cut of the predicted language, so 0.5 is the cut in every language.

Bounds: the driver holds the model (2^20 buckets, vectors of the pieces that have one) and the counts of pieces and steps, never a
text. Texts are read in pieces of `SEGMENT` words that overlap by a window, which gives the same maxima.

Defined results: null, empty and wordless texts get the score of a text without any piece; ill-formed UTF-8 is replaced by
U+FFFD; of several labels of an id the highest counts, null labels and ids do not; with no label or only one to learn from
the score of every text is the share of label 1 (0 without any); repeated rows are scored one by one, and one of those with the
same id, text and language is learned from; without documents there are no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, plain_words, portions, staged, valid

#: Documents that a piece needs, and their share.
MIN_DOCS, MIN_SHARE = 5, 1 / 600
#: Documents, and bytes of text, that are trained on together in one part.
PART_TEXTS, PART_BYTES = 2_000, 16_000_000
#: Bytes of the beginnings and ends of a word that are pieces of it.
BEGINNINGS, ENDS = (3, 4, 5, 6, 8), (3, 5)
#: Buckets (log2), numbers of a vector, filters of each width, widths.
BITS, WIDTH, FILTERS, WIDTHS = 20, 16, 12, (1, 2, 3)
ROUNDS, EPOCHS, STEP, RATE, DECAY, SEED = 3, 2, 32, 0.1, 1e-4, 11
#: Training texts beyond which every round has texts of its own; every text makes `ROUNDS` times `EPOCHS` passes either way.
PASS_TEXTS = 10_000
#: Neighbouring vectors that are averaged together.
BLOCK = 256
#: Labels up to which they are sent to the documents; of more, both move to be joined.
SENT_LABELS = 1_000_000
#: Steps of a logit of 1 in which cuts are looked up.
GRID = 256
#: Words of a piece of a long text; words whose numbers a process keeps; texts that a language's own cut is worth.
SEGMENT, KEPT_WORDS, LEAN = 20_000, 200_000, 10.0

_MASK = (1 << BITS) - 1


def pieces(word: bytes) -> list[int]:
    """Buckets of the word, its beginnings and its ends."""
    n = len(word)
    out = [crc32(word, 1) & _MASK]
    for k in BEGINNINGS:
        if k >= n:
            break
        out.append(crc32(word[:k], 2) & _MASK)
    for k in ENDS:
        if k >= n:
            break
        out.append(crc32(word[-k:], 3) & _MASK)
    return out


def words_of(text: str | None) -> list[bytes]:
    return plain_words((text or "").lower().encode())


class _Numbers(dict):
    """Word -> number, in the order of coming; `new` are the last ones."""

    def __init__(self):
        super().__init__({b"": 0})
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class Words:
    """Words as numbers, and the learned pieces of each: word k has `flat[begins[k]:begins[k + 1]]`. Word 0 has none."""

    def __init__(self, row_of: np.ndarray):
        self.row_of, self.number = row_of, _Numbers()
        self.flat, self.begins = np.empty(0, np.int64), np.zeros(2, np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words of a text; a text without any is word 0."""
        words = words or [b""]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Learned pieces of these words, one word after the other, and how many each has."""
        if self.number.new:
            bucket, size = _flat([pieces(w) for w in self.number.new])
            row = self.row_of[bucket]
            size = np.bincount(np.repeat(np.arange(len(size)), size)[row >= 0], minlength=len(size))
            self.flat = np.concatenate((self.flat, row[row >= 0]))
            self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(size)))
            self.number.new = []
        begin = self.begins[which]
        size = self.begins[which + 1] - begin
        return self.flat[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())], size

    def sums(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Sum of the vectors of the pieces of each of these words."""
        flat, size = self.rows(which)
        order = np.argsort(-size, kind="stable")  # words of most pieces first: those with a k-th piece are a prefix
        at, with_more = (np.cumsum(size) - size)[order], len(size) - np.cumsum(np.bincount(size))
        first, more = np.zeros((2, len(size), vectors.shape[1]), np.float32)
        for k, n in enumerate(with_more[:-1]):
            (more if k else first)[:n] += vectors.take(flat.take(at[:n] + k), axis=0)
        out = np.empty_like(first)
        out[order] = first + more
        return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())), size


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Model:
    row_of: np.ndarray  # bucket -> vector, or -1
    vectors: np.ndarray
    filters: np.ndarray  # WIDTH x sum of widths x FILTERS, the words of a window side by side
    bias: np.ndarray
    head: np.ndarray  # weight of every filter, and a constant
    langs: np.ndarray  # vector row x language, log odds
    cuts: np.ndarray  # per language

    def numbers(self, words: Words, which: np.ndarray) -> np.ndarray:
        """What a word adds to every filter at every place of its window, then to every language."""
        return np.hstack((words.sums(self.vectors, which) @ self.filters[:, _BY_PLACE], words.sums(self.langs, which)))


def _columns() -> Iterator[tuple[slice, list[slice]]]:
    """Per width: its filters among all, and the columns of the words of its window."""
    at = 0
    for k, width in enumerate(WIDTHS):
        yield (slice(k * FILTERS, (k + 1) * FILTERS),
               [slice(at + i * FILTERS, at + (i + 1) * FILTERS) for i in range(width)])
        at += width * FILTERS


#: The columns of all first words of the windows, then of all second ones, and so on; narrower filters come first.
_BY_PLACE = np.concatenate([np.arange(FILTERS * sum(WIDTHS))[parts[i]] for i in range(max(WIDTHS))
                            for _, parts in _columns() if i < len(parts)])


def windows(numbers: np.ndarray) -> np.ndarray:
    """Value of every filter at every place of one or more padded texts (rows: words, columns by place)."""
    at = wide = len(WIDTHS) * FILTERS
    out = numbers[:, :wide].copy()
    for i in range(1, max(WIDTHS)):
        n = sum(width > i for width in WIDTHS) * FILTERS
        out[:-i, wide - n:] += numbers[i:, at: at + n]
        at += n
    return out


def _share(rows: DataFrame) -> tuple[int, int]:
    got = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    return int(got[0]), int(got[1] or 0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | float:
    """Fit on all labelled documents that may be learned from; the share of label 1 if there is only one label. Needs
    doc_id, text and lang of the documents."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("label"))
    total, positive = _share(marked)
    if positive in (0, total):
        return positive / total if total else 0.0
    marked = F.broadcast(marked) if total <= SENT_LABELS else marked  # else texts without a label would move as well
    rows = docs.select("doc_id", valid("text").alias("text"), "lang").join(marked, "doc_id").dropDuplicates(
        ["doc_id", "text", "lang"])  # other texts of a repeated id count as well
    apart = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(4)) == 3
    rows = staged(rows.select(F.xxhash64("doc_id").alias("place"), "text", "lang", "label", apart.alias("apart")), "toxicity",
                  compression="zstd")
    sizes = {(r["apart"], r["label"]): (r["n"], r["size"]) for r in rows.groupBy("apart", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size")).collect()}
    if len({y for _, y in sizes}) < 2:
        return positive / total
    split = len({y for apart, y in sizes if not apart}) == 2  # else all rows train and give the cuts
    learned, checked = (rows.where("NOT apart"), rows.where("apart")) if split else (rows, rows)
    if not any(apart for apart, _ in sizes):
        checked = rows
    names = sorted(r[0] for r in rows.where("lang IS NOT NULL").select("lang").distinct().collect()) or [""]
    n = [sum(k for (_, y), (k, _) in sizes.items() if (y > 0) == one) for one in (False, True)]
    used, langs = _log_odds(*_counted(rows, names, *n), len(names))
    row_of = np.full(1 << BITS, -1, np.int32)
    row_of[used] = np.arange(len(used))
    mine = {key: size for key, size in sizes.items() if not (split and key[0])}
    texts, size = (sum(x[k] for x in mine.values()) for k in (0, 1))
    ones = sum(k for (_, y), (k, _) in mine.items() if y > 0)
    parts = max(1, -(-texts // PART_TEXTS), -(-size // PART_BYTES))
    params, past = _begin(len(used))
    apart = texts > PASS_TEXTS  # enough for every round to have texts of its own, which then make the passes of all rounds
    passes = ROUNDS * EPOCHS if apart else EPOCHS
    for turn in range(ROUNDS):
        mine = learned.where(F.pmod("place", F.lit(ROUNDS)) == turn) if apart else learned
        _round(mine, row_of, params, past, ones / texts, -(-parts // ROUNDS) if apart else parts, turn, passes)
    model = Model(row_of, *_shaped(params, len(used)), langs, np.zeros(len(names)))
    model.cuts = _cuts(*_steps(checked, model), len(names), positive / total)
    return model


def fit(texts: list[str], labels: list[int], langs: list[str | None], share: float) -> Model | float:
    """The same on texts at hand: one part, and all of them give the cuts."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        return share
    names = sorted({x for x in langs if x is not None}) or [""]
    lang = [-1 if x is None else names.index(x) for x in langs]
    bucket, of, n, zero, one = count_pieces(texts, y, lang, Words(np.arange(1 << BITS)))
    docs = [np.bincount(bucket, x, 1 << BITS)[bucket] for x in (zero, one)]
    keep = _frequent(*docs, (y == 0).sum(), (y > 0).sum())
    used, odds = _log_odds(bucket[keep], of[keep], n[keep], len(names))
    row_of = np.full(1 << BITS, -1, np.int32)
    row_of[used] = np.arange(len(used))
    words, (params, past) = Words(row_of), _begin(len(used))
    coded = [words.of(words_of(t)) for t in texts]
    for turn in range(ROUNDS):
        learn(params, past, coded, y, (y > 0).mean(), words, turn, EPOCHS)
    model = Model(row_of, *_shaped(params, len(used)), odds, np.zeros(len(names)))
    values, said = raw_scores(model, words, coded)
    model.cuts = _cuts(said, _step(values), y == 0, y > 0, len(names), share)
    return model


# --- counts of pieces ------------------------------------------------------------------

def count_pieces(texts: list[str | None], labels: np.ndarray, langs: list[int], words: Words):
    """Per bucket and language: occurrences, documents of label 0 and of label 1. `words` has every bucket as a piece."""
    coded = [np.unique(words.of(words_of(t)), return_counts=True) for t in texts]
    own, times = (np.concatenate([c[k] for c in coded]) for k in (0, 1))
    bucket, size = words.rows(own)
    text = np.repeat(np.repeat(np.arange(len(texts)), [len(c[0]) for c in coded]), size)
    seen, at = np.unique((text << BITS) + bucket, return_inverse=True)  # text and bucket
    times = np.bincount(at, np.repeat(times, size), len(seen))
    text = seen >> BITS
    key, at = np.unique(((np.array(langs, np.int64) + 1)[text] << BITS) + (seen & _MASK), return_inverse=True)
    n, one, docs = (np.bincount(at, x, len(key)).astype(np.int64) for x in (times, (np.asarray(labels) > 0)[text], None))
    return key & _MASK, (key >> BITS) - 1, n, docs - one, one


def _frequent(zero, one, zeros: int, ones: int):
    """Whether a piece gets a vector, from the documents of both labels that have it; arrays or columns."""
    return (zero + one >= MIN_DOCS) & (zero / float(zeros) + one / float(ones) >= 2 * MIN_SHARE)


def _counted(rows: DataFrame, names: list[str], zeros: int, ones: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, language (-1: none) and occurrences of the pieces that get a vector, over all rows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("bucket", "of", "n", "zero", "one")])
        number, words = {x: k for k, x in enumerate(names)}, Words(np.arange(1 << BITS))
        for b in batches:
            texts, langs = b.column(0).to_pylist(), [number.get(x, -1) for x in b.column(1).to_pylist()]
            labels = b.column(2).to_numpy(zero_copy_only=False)
            for part in portions([t or "" for t in texts]):
                if len(words.number) > KEPT_WORDS:
                    words = Words(words.row_of)
                yield batch(schema, *count_pieces(texts[part], labels[part], langs[part], words))

    found = map_batches(rows.select("text", "lang", "label"), task, "bucket long, of long, n long, zero long, one long")
    per = found.groupBy("bucket", "of").agg(*[F.sum(c).alias(c) for c in ("n", "zero", "one")])
    docs = [F.sum(c).over(Window.partitionBy("bucket")) for c in ("zero", "one")]
    got = per.withColumns(dict(zip(("zero", "one"), docs))).where(_frequent(F.col("zero"), F.col("one"), zeros, ones))
    return tuple(c.to_numpy() for c in got.select("bucket", "of", "n").toArrow().columns)


def _log_odds(bucket: np.ndarray, of: np.ndarray, n: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets in order, and bucket x language: log of the share of the language's pieces over the share among all."""
    used, at = np.unique(bucket, return_inverse=True)
    count = np.zeros((len(used), langs))
    known = of >= 0
    count[at[known], of[known]] = n[known]
    share = (count + 0.1) / (count + 0.1).sum(axis=0)
    return used, np.log(share / share.mean(axis=1, keepdims=True)).astype(np.float32)


# --- training --------------------------------------------------------------------------

_SIZES = (WIDTH * sum(WIDTHS) * FILTERS, len(WIDTHS) * FILTERS, len(WIDTHS) * FILTERS + 1)  # filters, bias, head


def _begin(rows: int) -> tuple[np.ndarray, np.ndarray]:
    """All parameters as rows of `WIDTH` numbers (vectors, then filters, biases and head one after the other), and the sums of
    their squared gradients."""
    draw = np.random.default_rng(SEED)
    params = np.zeros((rows - (-sum(_SIZES) // WIDTH), WIDTH), np.float32)
    vectors, filters, _, head = _shaped(params, rows)
    vectors[:] = draw.normal(0, 0.05, vectors.shape)
    filters[:] = draw.normal(0, 0.5, filters.shape)
    head[:-1] = draw.normal(0, 0.3, len(head) - 1)
    return params, np.full_like(params, 1e-2)


def _shaped(params: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, filters, biases and head as views of the parameters."""
    flat = params[rows:].reshape(-1)
    filters, bias, head, _ = np.split(flat, np.cumsum(_SIZES))
    return params[:rows], filters.reshape(WIDTH, -1), bias, head


def _round(rows: DataFrame, row_of: np.ndarray, params: np.ndarray, past: np.ndarray, share: float, parts: int,
           turn: int, epochs: int) -> None:
    """Train every part from these parameters, and set those that were moved to the average of the parts that moved them."""
    shared = rows.sparkSession.sparkContext.broadcast((row_of, params, past))

    def task(part: pa.Table) -> pa.Table:
        row_of, before, past = shared.value
        params, past = before.copy(), past.copy()
        order = pc.sort_indices(part, sort_keys=[("place", "ascending"), ("text", "ascending")]).to_numpy()
        words, y = Words(row_of), part["label"].to_numpy()[order]
        texts = part["text"]
        learn(params, past, [words.of(words_of(texts[int(k)].as_py())) for k in order], y, share, words, turn, epochs)
        moved = np.flatnonzero((params != before).any(axis=1)).astype(np.int32)
        ends = np.flatnonzero(np.diff(moved // BLOCK, append=-1)) + 1
        found = [(int(row[0]) // BLOCK, float(len(y)), row.tobytes(), np.hstack((params[row], past[row])).tobytes())
                 for row in np.split(moved, ends)[:-1]]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.float64(), pa.binary(), pa.binary()))],
                        names=["block", "n", "row", "value"])

    def average(found: pa.Table) -> pa.Table:
        first = found["block"][0].as_py() * BLOCK
        n, total = np.zeros((BLOCK, 1)), np.zeros((BLOCK, 2 * WIDTH))
        for docs, row, value in zip(*(found[c] for c in ("n", "row", "value"))):
            at = np.frombuffer(row.as_buffer(), np.int32) - first
            n[at] += docs.as_py()
            total[at] += docs.as_py() * np.frombuffer(value.as_buffer(), np.float32).astype(np.float64).reshape(-1, 2 * WIDTH)
        at = np.flatnonzero(n)
        return pa.table([[(first + at).astype(np.int32).tobytes()], [(total[at] / n[at]).astype(np.float32).tobytes()]],
                        names=["row", "value"])

    moved = rows.select(F.pmod(F.floor(F.col("place") / ROUNDS), F.lit(parts)).alias("part"), "place", "label", "text").groupBy("part").applyInArrow(
        task, "block int, n double, row binary, value binary")
    got = moved.groupBy("block").applyInArrow(average, "row binary, value binary").toArrow()
    for row, value in zip(got["row"], got["value"]):
        at = np.frombuffer(row.as_buffer(), np.int32)
        params[at], past[at] = np.hsplit(np.frombuffer(value.as_buffer(), np.float32).reshape(-1, 2 * WIDTH), 2)
    shared.unpersist()


class _Local:
    """Numbers below a bound as places among the different ones of them, as `np.unique` gives them, without a sort."""

    def __init__(self, bound: int):
        self.seen, self.place = np.zeros(bound, bool), np.empty(bound, np.int64)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.seen[numbers] = True
        own = np.flatnonzero(self.seen)
        self.seen[own] = False
        self.place[own] = np.arange(len(own))
        return own, self.place.take(numbers)


def _add_at(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """`np.add.at` by rows of a whole array."""
    width = to.shape[1]
    np.add.at(to.reshape(-1), (rows[:, None] * width + np.arange(width)).reshape(-1), values.reshape(-1))


def learn(params: np.ndarray, past: np.ndarray, coded: list[np.ndarray], y: np.ndarray, share: float, words: Words,
          turn: int, epochs: int) -> None:
    """Adagrad over texts given as word numbers; `share` of all texts trained on have label 1."""
    rows = len(params) + (-sum(_SIZES) // WIDTH)
    draw = np.random.default_rng((SEED, turn))
    n_filters, columns, pad = len(WIDTHS) * FILTERS, list(_columns()), max(WIDTHS) - 1
    vectors, filters, bias, head = _shaped(params, rows)
    past = _shaped(past, rows)
    y = (y > 0).astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)

    words.rows(np.zeros(1, np.int64))  # of all words, the pieces
    number, row = _Local(len(words.begins) - 1), _Local(rows)

    def move(x, seen, grad):
        seen += grad * grad
        x -= RATE * grad / np.sqrt(seen)

    for _ in range(epochs):
        for some in np.array_split(draw.permutation(len(coded)), max(1, len(coded) // STEP)):
            own, at = number.of(np.concatenate([part for k in some for part in (coded[k], np.zeros(pad, np.int64))]))
            sums = words.sums(vectors, own)
            numbers = sums @ filters[:, _BY_PLACE]
            top = np.full((len(some), n_filters), -np.inf, np.float32)
            best = np.zeros((len(some), n_filters), np.int64)  # where the best window of a filter begins
            begin = 0
            for k, n in enumerate(len(coded[j]) for j in some):
                for first in range(begin, begin + n, SEGMENT):
                    wide = min(SEGMENT, begin + n - first)
                    values = windows(numbers.take(at[first: first + wide + pad], axis=0))[:wide]
                    place = values.argmax(axis=0)
                    value = values[place, np.arange(n_filters)]
                    better = value > top[k]
                    top[k, better], best[k, better] = value[better], place[better] + first
                begin += n + pad
            top += bias
            lit = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(lit @ head[:-1] + head[-1], -30, 30)))
            error = (p - y[some]) * weight[some] / len(some)
            back = error[:, None] * head[None, :-1] * (top > 0)
            grad_filters, grad_sums = DECAY * filters, np.zeros_like(sums)
            for of, parts in columns:
                for i, part in enumerate(parts):
                    place = at[best[:, of] + i]  # words under the window, text x filter
                    g = back[:, of]
                    grad_filters[:, part] += np.einsum("tf,tfw->wf", g, sums[place])
                    _add_at(grad_sums, place.ravel(), g[:, :, None] * filters[:, part].T[None])
            move(head, past[3], np.append(error @ lit, error.sum()) + DECAY * head)
            move(bias, past[2], back.sum(axis=0))
            move(filters, past[1], grad_filters)
            hit = np.flatnonzero(np.abs(grad_sums).sum(axis=1))
            flat, size = words.rows(own[hit])
            if len(flat):
                rows_hit, inverse = row.of(flat)
                grad = np.zeros((len(rows_hit), WIDTH), np.float32)
                _add_at(grad, inverse, np.repeat(grad_sums.take(hit, axis=0), size, axis=0))
                x, seen = vectors.take(rows_hit, axis=0), past[0].take(rows_hit, axis=0)
                move(x, seen, grad)
                vectors[rows_hit], past[0][rows_hit] = x, seen


# --- scores ----------------------------------------------------------------------------

def raw_scores(model: Model, words: Words, coded: list[np.ndarray], numbers: np.ndarray | None = None):
    """Logits, and the predicted language, of texts given as word numbers. `numbers`: rows of all words, if at hand."""
    pad, wide = max(WIDTHS) - 1, len(WIDTHS) * FILTERS
    n_langs = model.langs.shape[1]
    top, langs = np.full((len(coded), wide), -np.inf, np.float32), np.zeros((len(coded), n_langs), np.float64)
    cuts = [(k, at) for k, c in enumerate(coded) for at in range(0, len(c), SEGMENT)]
    begin = 0
    while begin < len(cuts):  # segments of about SEGMENT words together
        end, held = begin, 0
        while end < len(cuts) and (end == begin or held < SEGMENT):
            held += min(SEGMENT, len(coded[cuts[end][0]]) - cuts[end][1])
            end += 1
        starts = [min(SEGMENT, len(coded[k]) - at) for k, at in cuts[begin:end]]  # places where a window may begin
        part = [coded[k][at: at + SEGMENT + pad] for k, at in cuts[begin:end]]
        part = [np.append(c, np.zeros(n + pad - len(c), np.int64)) for c, n in zip(part, starts)]
        inside = np.concatenate([np.arange(len(c)) < n for c, n in zip(part, starts)])
        begins = np.cumsum([0, *starts])[:-1]
        at = np.concatenate(part)
        if numbers is None:
            own, at = np.unique(at, return_inverse=True)
            rows = model.numbers(words, own).take(at, axis=0)
        else:
            rows = numbers.take(at, axis=0)
        of = [k for k, _ in cuts[begin:end]]
        np.maximum.at(top, of, np.maximum.reduceat(windows(rows)[inside], begins, axis=0))
        np.add.at(langs, of, np.add.reduceat(rows[inside, -n_langs:], begins, axis=0))
        begin = end
    return np.maximum(top + model.bias, 0) @ model.head[:-1] + model.head[-1], langs.argmax(axis=1)


def _step(values: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(values, -1e6, 1e6) * GRID).astype(np.int64)


def _steps(rows: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """Predicted language, step of the logit, rows of label 0 and of label 1, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("of", pa.int32()), ("step", pa.int64()), ("label", pa.int32())])
        scorer = Scorer(shared.value)
        for b in batches:
            for part, values, of in scorer.of(b.column(1).to_pylist()):
                yield batch(schema, of.astype(np.int32), _step(values), b.column(0)[part])

    found = map_batches(rows.select("label", "text"), task, "of int, step long, label int")
    got = found.groupBy("of", "step").agg(F.count_if(F.col("label") <= 0).alias("zero"),
                                          F.count_if(F.col("label") > 0).alias("one")).toArrow()
    return tuple(got[c].to_numpy() for c in ("of", "step", "zero", "one"))


def _cut(step: np.ndarray, zero: np.ndarray, one: np.ndarray, share: float) -> float:
    """The middle of the widest cut with the fewest errors, label 1 weighing `share` of all."""
    at, place = np.unique(step, return_inverse=True)
    zero, one = np.bincount(place, zero), np.bincount(place, one)
    w_one, w_zero = share / max(one.sum(), 1), (1 - share) / max(zero.sum(), 1)
    errors = np.cumsum(np.append(w_zero * zero.sum(), w_one * one - w_zero * zero))
    edges = np.concatenate(([at[0] / GRID - 1], at / GRID, [at[-1] / GRID + 1]))
    gaps = np.where(errors <= errors.min() + 1e-12, edges[1:] - edges[:-1], -1)
    k = int(gaps.argmax())
    return float(edges[k] + edges[k + 1]) / 2


def _cuts(of: np.ndarray, step: np.ndarray, zero: np.ndarray, one: np.ndarray, langs: int, share: float) -> np.ndarray:
    all_of = _cut(step, zero, one, share)
    out = np.full(langs, all_of)
    for k in range(langs):
        mine = of == k
        least = min(one[mine].sum(), zero[mine].sum())
        if least:
            out[k] = (least * _cut(step[mine], zero[mine], one[mine], share) + LEAN * all_of) / (least + LEAN)
    return out


class Scorer:
    """Logits and predicted languages of texts; numbers of words are kept for texts that follow."""

    def __init__(self, model: Model):
        self.model, self.words, self.numbers = model, None, None

    def of(self, texts: list[str | None]) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for part in portions([t or "" for t in texts]):
            if self.words is None or len(self.words.number) > KEPT_WORDS:
                self.words, self.numbers = Words(self.model.row_of), None
            coded = [self.words.of(words_of(t)) for t in texts[part]]
            new = np.arange(0 if self.numbers is None else len(self.numbers), len(self.words.number))
            fresh = self.model.numbers(self.words, new)
            self.numbers = fresh if self.numbers is None else np.vstack((self.numbers, fresh))
            yield part, *raw_scores(self.model, self.words, coded, self.numbers)


def scored(docs: DataFrame, model: Model | float, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` and score (0 to 1; from 0.5 on label 1 is likelier) of every document."""
    frame = docs.select(*keep, valid(text).alias("_text"))
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = None if isinstance(own, float) else Scorer(own)
        for b in batches:
            schema = pa.schema([*list(b.schema)[:-1], ("score", pa.float64())])
            texts = b.column(b.num_columns - 1).to_pylist()
            if scorer is None:
                yield batch(schema, *b.columns[:-1], [own] * len(texts))
                continue
            for part, values, of in scorer.of(texts):
                score = 1 / (1 + np.exp(-np.clip(values - own.cuts[of], -30, 30)))
                yield batch(schema, *(c[part] for c in b.columns[:-1]), score.astype(np.float64))

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}score double")
