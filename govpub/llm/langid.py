"""Language identification by string kernels.

Kernel: two texts are as alike as the n-grams of 1 to 4 characters that both contain (presence, not counts; all
lengths together, the blended spectrum), divided by the geometric mean of their own n-gram counts. Characters are
lower-cased letters; whatever lies between letters is one boundary mark. n-grams are hashed to 2^18 numbers.

Model: landmarks are drawn from a bounded training sample; the Nyström map of a text is its kernel row against the
landmarks times the inverse root of the landmarks' own kernel matrix; on it, one ridge regression per language against
all others. At scoring time landmarks, map and regressions fold into one matrix (n-gram by language), which gives exactly
the same numbers, so a batch of documents is one matrix product.

Bounds: the sample has at most `PER_LANG` documents of each language, those with the smallest hash of id and language. It
is the only part of the operator that does not read all rows; every document is scored over its whole text.

Defined results: `und` with score 0 for a null text or one without a letter; rows whose lang is null are scored but not
learned from; if nothing can be learned, every document is `und`; ties go to the language that sorts first; repeated
rows are scored one by one; ill-formed UTF-8 is replaced by U+FFFD, which is no letter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, valid

#: Training documents and landmarks per language.
PER_LANG, LANDMARKS = 300, 64
ORDERS, BITS, RIDGE = (1, 2, 3, 4), 18, 1e-3

_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> code point of its lower-case letter, 0 for what is no letter."""
    if not _TABLE:
        table = np.zeros(sys.maxunicode + 1, np.uint32)
        for c in range(sys.maxunicode + 1):
            if chr(c).isalpha():
                table[c] = ord(chr(c).lower()[0])
        _TABLE.append(table)
    return _TABLE[0]


class Grams:
    """Distinct n-gram numbers of a text."""

    def __init__(self):
        self.seen = np.zeros(1 << BITS, bool)

    def of(self, text: str | None) -> np.ndarray:
        """Sorted; empty if the text has no letter."""
        if not text:
            return np.empty(0, np.int64)
        chars = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not chars.any():
            return np.empty(0, np.int64)
        bound = chars == 0
        chars = np.concatenate(([0], chars[~(bound & np.concatenate(([True], bound[:-1])))], [0])).astype(np.uint32)
        value = np.zeros(len(chars), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(chars) < n:
                break
            value = (value[: len(chars) - n + 1] ^ chars[n - 1:]) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
            if n in ORDERS:
                self.seen[(value + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass
class Model:
    langs: list[str]
    column: np.ndarray  # n-gram number -> row of weights, or -1
    weights: np.ndarray  # landmark n-grams x languages

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        """Regression values, documents x languages."""
        rows = np.zeros((len(grams), len(self.weights)), np.float32)
        for k, g in enumerate(grams):
            at = self.column[g]
            rows[k, at[at >= 0]] = 1.0
        size = np.sqrt(np.maximum([len(g) for g in grams], 1)).astype(np.float32)
        return (rows @ self.weights) / size[:, None]


def presence(grams: list[np.ndarray], column: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(grams), width))
    for k, g in enumerate(grams):
        at = column[g]
        out[k, at[at >= 0]] = 1.0
    return out


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Nyström features of the sample and one ridge regression per language."""
    grams_of = Grams()
    rows = [(g, y) for g, y in ((grams_of.of(t), y) for t, y in zip(texts, langs)) if len(g)]
    names = sorted({y for _, y in rows})
    if not rows:
        return None
    marks: list[np.ndarray] = []
    for name in names:
        marks += [g for g, y in rows if y == name][:landmarks]
    used = np.unique(np.concatenate(marks))
    column = np.full(1 << BITS, -1, np.int64)
    column[used] = np.arange(len(used))
    norm = np.sqrt([len(g) for g in marks])
    at_marks = presence(marks, column, len(used)) / norm[:, None]
    values, vectors = np.linalg.eigh(at_marks @ at_marks.T)
    keep = values > values.max() * 1e-8
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel = (presence([g for g, _ in rows], column, len(used)) @ at_marks.T) / np.sqrt([len(g) for g, _ in rows])[:, None]
    features = kernel @ root
    target = np.array([[float(y == name) for name in names] for _, y in rows])
    gram = features.T @ features + ridge * len(rows) * np.eye(features.shape[1])
    return Model(names, column, (at_marks.T @ (root @ np.linalg.solve(gram, features.T @ target))).astype(np.float32))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Fit on the bounded sample of rows that may be learned from. Ids are chosen first, only their texts are read."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    chosen = rows.select("doc_id", "lang").distinct()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))  # of a language, each part names its candidates first
    for of in (["lang", part], ["lang"]):
        order = Window.partitionBy(*of).orderBy(F.xxhash64("doc_id", "lang"), "doc_id")
        chosen = chosen.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_lang).drop("_rank")
    sample = rows.select("doc_id", "lang", valid("text").alias("text")).join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # of a repeated id, one row
    got = sample.orderBy("lang", F.xxhash64("doc_id", "lang"), "doc_id").select("text", "lang").collect()
    return fit([r["text"] for r in got], [r["lang"] for r in got])


def identified(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """`keep`, lang_pred and score of every document."""
    frame = docs.select(*keep, valid(text).alias("_text"))
    shared = frame.sparkSession.sparkContext.broadcast(model)  # 2^18 numbers and a weight per n-gram and language

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grams_of = shared.value, Grams()
        for b in batches:
            grams = [grams_of.of(t) for t in b.column(b.num_columns - 1).to_pylist()]
            if own is None or not grams:
                langs, scores = ["und"] * len(grams), [0.0] * len(grams)
            else:
                values = own.scores(grams)
                best = values.argmax(axis=1)
                langs = [own.langs[k] if len(g) else "und" for k, g in zip(best, grams)]
                top = np.clip(values[np.arange(len(grams)), best], 0.0, 1.0)
                scores = [float(s) if len(g) else 0.0 for s, g in zip(top, grams)]
            schema = pa.schema([*list(b.schema)[:-1], ("lang_pred", pa.string()), ("score", pa.float64())])
            yield batch(schema, *b.columns[:-1], langs, scores)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return map_batches(frame, task, f"{fields}, lang_pred string, score double")
