"""Checks across channels: the same measure from several places, and answers against expected text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import ColumnLike, as_col, numbers_in


def channel_consistency(channels: dict[str, DataFrame], tolerance: ColumnLike | float,
                        on: tuple[str, ...] = ("measure", "filter")) -> DataFrame:
    """Compare a measure over several channels; each frame holds `on` and `value`.

    The channels are stacked and folded per key, so any number of them costs one shuffle.
    CONSISTENT when every channel has the figure and the spread is within the tolerance,
    MISSING when a channel has none, else DIFFERENT.
    """
    stacked = reduce(DataFrame.unionByName, [
        df.select(*on, F.lit(name).alias("channel"), F.col("value")) for name, df in channels.items()])
    out = stacked.groupBy(*on).agg(
        *[F.max(F.when(F.col("channel") == n, F.col("value"))).alias(f"value_{n}") for n in channels],
        F.count("value").alias("channels"), (F.max("value") - F.min("value")).alias("spread"))
    limit = F.lit(tolerance) if isinstance(tolerance, (int, float)) else as_col(tolerance)
    return out.withColumn("status", F.when(F.col("channels") < len(channels), "MISSING")
                          .when(F.col("spread") <= limit, "CONSISTENT").otherwise("DIFFERENT"))


def tolerance_of(text: ColumnLike) -> Column:
    """'±1 BOE' gives 1, text beginning with 'exact' gives 0, anything else one half."""
    t = as_col(text)
    number = F.coalesce(F.get(numbers_in(t), F.lit(0)), F.lit(0).cast("decimal(38,6)"))
    return (F.when(t.startswith("±"), number).when(t.startswith("exact"), F.lit(0).cast("decimal(38,6)"))
            .otherwise(F.lit("0.5").cast("decimal(38,6)")))


def expected_numbers(text: ColumnLike) -> Column:
    """Numbers above one outside of brackets."""
    plain = F.regexp_replace(as_col(text), r"\(.*?\)", "")
    return F.filter(numbers_in(plain), lambda v: v > 1)


def numbers_match(expected: Column, actual: Column, tolerance: Column) -> Column:
    """Every expected number has an actual one within the tolerance, which is at least one half."""
    limit = F.greatest(tolerance, F.lit("0.5").cast("decimal(38,6)"))
    return F.forall(expected, lambda e: F.exists(actual, lambda a: F.abs(a - e) <= limit))


def score_answers(df: DataFrame, answer: str = "actual_answer", expected: str = "expected_answer",
                  kind: str = "type", tolerance: str = "tolerance", publication: str = "publication_id") -> DataFrame:
    """Add `auto_check`: PASS, REVIEW or FAIL for every answer.

    Numeric and list answers need all expected numbers and the publication id; lookups need every
    code of the expected text; other kinds are left to a person; no answer fails.
    """
    a = F.col(answer)
    codes = F.regexp_extract_all(F.col(expected), F.lit(r"[A-Z][A-Z0-9_-]{3,}"), F.lit(0))
    codes_found = (F.size(codes) > 0) & F.forall(codes, lambda c: F.contains(a, c))
    ok = numbers_match(expected_numbers(expected), numbers_in(a), tolerance_of(tolerance))
    mentions = F.contains(a, F.col(publication))
    result = (F.when(a.isNull() | (a == ""), "FAIL")
              .when(~F.col(kind).isin("NUMERIC", "LIST", "LOOKUP", "LINEAGE"), "REVIEW")
              .when(F.col(kind).isin("LOOKUP", "LINEAGE"), F.when(codes_found, "PASS").otherwise("REVIEW"))
              .when(ok & mentions, "PASS").when(ok, "REVIEW").otherwise("FAIL"))
    return df.withColumn("auto_check", result)
