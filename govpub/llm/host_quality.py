r"""Quality rules judged by host.

Every document is measured once; rule failures are added up by host (the `source`), the failure rates are shrunk
towards the corpus by a beta prior fitted to all hosts, and each host's verdict is joined back to its documents.

* base rules hold everywhere: fewer than 50 words, or more than half of the words in repeated three-word windows;
* strict rules hold on strict hosts only, those whose shrunk rate of failing documents reaches `host_limit`: over one
  symbol per ten words, over 30 % repeated lines, a mean word length outside 3 to 10. On a trusted host a document
  that fails one of these is kept: one odd document is no reason to doubt a host that is otherwise fine. A document
  that fails no rule is kept on every host.

Defined results: a null or empty text has no words and fails the base rules; documents without a source form one host
of their own; repeated rows count and are judged one by one; ill-formed UTF-8 counts as U+FFFD; no documents give no rows. Other columns of the table do not
matter and are not read.

Scale: the measures are taken in one scan. Hosts meet in a partially aggregated group-by (a host with a third of all
rows reaches the reducer as one row per task), the prior is one row, and the host table is joined back as an
ordinary equi join, which AQE splits for a large host. The text itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import batch, map_batches, same, staged, text_hash, valid

#: Shrunk rate of failing documents from which a host is strict.
HOST_LIMIT = 0.1
#: Documents that the prior counts for at least and at most.
PRIOR_MIN, PRIOR_MAX = 1.0, 1_000_000.0

_SPACES, _SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
_MEASURES = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                       ("n_lines", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words covered by windows of `size` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    keys = ids[:n]
    for k in range(1, size):
        width = len(seen)
        if k > 1 and width > 2_000_000:  # the product has to stay below 2^63
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * width + ids[k: n + k]
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(keys, twice))
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[starts + k] = True
    return int(covered.sum())


def measures_of(text: str | None) -> tuple[int, int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # splits bytes at exactly the six ASCII spaces
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACES)]
    return len(words), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = list(zip(*map(measures_of, b.column(b.num_columns - 1).to_pylist()))) or [[]] * 6
        schema = pa.schema([*list(b.schema)[:-1], *_MEASURES])
        yield batch(schema, *b.columns[:-1], *found)


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` and the measures of every document."""
    frame = docs.select(*keep, valid(text).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return map_batches(frame, _measure, f"{fields}, {MEASURES}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def strict_failed() -> Column:
    return ((10 * F.col("n_symbols") > F.col("n_words")) | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
            | (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 10 * F.col("n_words")))


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict (`strict` or `trusted`). Needs host, failed."""
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("k"))
    total = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("all_n"), F.sum("k").alias("all_k"),
                      F.sum(F.col("n") * F.col("n").cast("double")).alias("sq_n"),
                      F.sum(F.col("k") * F.col("k").cast("double") / F.col("n")).alias("sq_k")).first()
    if not total["hosts"]:
        return hosts.withColumns({"rate": F.lit(0.0), "verdict": F.lit("trusted")})
    mean, strength = beta_prior(total["hosts"], total["all_n"], total["all_k"], total["sq_n"], total["sq_k"])
    rate = (F.col("k") + mean * strength) / (F.col("n") + strength)
    return hosts.withColumn("rate", rate).withColumn(
        "verdict", F.when(F.col("rate") >= limit, "strict").otherwise("trusted"))


def beta_prior(hosts: int, n: int, k: int, sq_n: float, sq_k: float) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta prior, by moments: what the rates of hosts spread beyond chance.

    sq_n is the sum of n^2, sq_k the sum of k^2 / n over hosts.
    """
    mean = k / n
    spread = sq_k - n * mean * mean  # sum of n (rate - mean)^2
    room = n - sq_n / n
    between = (spread - (hosts - 1) * mean * (1 - mean)) / room if room > 0 else 0.0
    strength = mean * (1 - mean) / between - 1 if between > 0 else PRIOR_MAX
    return mean, min(max(strength, PRIOR_MIN), PRIOR_MAX)


def judged(docs: DataFrame, keep: list[str], host: str = "source", text: str = "text",
           limit: float = HOST_LIMIT) -> DataFrame:
    """`keep`, the measures, base_failed, host_verdict and kept, one row per document."""
    rows = staged(measured(docs.withColumn("_host", F.col(host)), [*keep, "_host"], text), "quality").withColumnRenamed(
        "_host", "host").withColumns({"base_failed": base_failed(), "strict_failed": strict_failed()})
    hosts = host_verdicts(rows.select("host", (F.col("base_failed") | F.col("strict_failed")).alias("failed")), limit)
    hosts = hosts.select(F.col("host").alias("_of"), F.col("verdict").alias("host_verdict"))
    return rows.join(hosts, same(F.col("host"), F.col("_of"))).withColumn(
        "kept", ~F.col("base_failed") & ~((F.col("host_verdict") == "strict") & F.col("strict_failed"))
    ).drop("_of", "host")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    keyed = docs.select("doc_id", "source", "text", text_hash().alias("_text_hash"))
    bad = judged(keyed, ["doc_id", "_text_hash"]).where("NOT kept").select(
        F.col("doc_id").alias("_bad_id"), F.col("_text_hash").alias("_bad_hash"))
    return docs.join(bad, same(docs["doc_id"], bad["_bad_id"])
                     & same(text_hash(docs["text"]), bad["_bad_hash"]),
                     "left_anti")
