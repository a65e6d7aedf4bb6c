"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govpub.llm import decontam, fst_bpe, host_quality, line_align, probminhash
from govpub.llm.base import staged
from govpub.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return host_quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has are taken out; a document of which only white space is left goes."""
    lines, deleted = (next(n for k in range(len(docs.columns) + 1) if (n := f"{name}_{k}") not in docs.columns)
                      for name in ("lines", "deleted"))  # names that no column has
    found = line_align.dedup_lines(docs, lines=lines, deleted=deleted, every_copy=True)
    changed = F.col(deleted) > 0
    found = found.where(~changed | F.col("text").rlike(r"[^\s]"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return probminhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests, with the digest of what they decode to."""
    return fst_bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("decontamination", decontaminate), ("byte-level BPE", tokenize)]

#: SQL can state neither the alignment nor the classes; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
