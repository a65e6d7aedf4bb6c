"""Column expressions shared by every operator. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLUME = "decimal(19,6)"
MONEY = "decimal(19,4)"
FACTOR = "decimal(18,9)"
SHARE = "decimal(9,6)"
DIVISOR = "decimal(9,3)"
HOURS = "decimal(9,3)"

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def project(df: DataFrame, *same: str, **named: ColumnLike) -> DataFrame:
    """Columns kept under their name, then new name = column or expression."""
    return df.select(*same, *[as_col(c).alias(n) for n, c in named.items()])


def key_text(*cols: ColumnLike) -> Column:
    """Readable composite key: the values joined by '|', nulls skipped."""
    return F.concat_ws("|", *[as_col(c).cast("string") for c in cols])


def stable_key(prefix: str, *cols: ColumnLike) -> Column:
    """Surrogate key that is the same for the same business id in every run."""
    return F.xxhash64(F.lit(prefix), *[as_col(c) for c in cols])


def date_key(date: ColumnLike) -> Column:
    """20250920 for 2025-09-20."""
    d = as_col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def json_hash(cols: Iterable[ColumnLike]) -> Column:
    """SHA-256 of the row rendered as JSON; null fields are left out of the rendering."""
    return F.sha2(F.to_json(F.struct(*[as_col(c) for c in cols])), 256)


def text_hash(*cols: ColumnLike) -> Column:
    """SHA-256 of `key_text`, reproducible by any engine that has SHA-256."""
    return F.sha2(key_text(*cols), 256)


def digests(cols: Iterable[ColumnLike]) -> list[Column]:
    """128 bits of row hash as two bigints, cheap to aggregate because they have a fixed width.

    A null is told apart from an absent value by hashing its null flag too.
    """
    parts = [p for c in cols for p in (as_col(c), as_col(c).isNull())]
    return [F.xxhash64(F.lit(seed), *parts) for seed in ("a", "b")]


def total_order(seq: ColumnLike, tie: ColumnLike) -> Column:
    """Sequence number with a hashed tie-breaker as one decimal, ordered like (seq, tie hash)."""
    hashed = F.xxhash64(as_col(tie)).bitwiseAND(F.lit("9223372036854775807").cast("long")).cast("decimal(19,0)")
    return (as_col(seq).cast("decimal(19,0)") * F.lit("9223372036854775808").cast("decimal(19,0)") + hashed).cast("decimal(38,0)")


def half_up(value: ColumnLike, decimal_type: str) -> Column:
    """Round half up to the scale of `decimal_type` and narrow to it."""
    scale = int(decimal_type.rstrip(")").split(",")[1])
    return F.round(as_col(value), scale).cast(decimal_type)


def half_up_ratio(amount: ColumnLike, divisor: ColumnLike, decimal_type: str = VOLUME) -> Column:
    return half_up(as_col(amount) / as_col(divisor), decimal_type)


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Null instead of an error when the denominator is zero or missing."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Decimal hours, three digits. Wall clock timestamps are read in the session zone."""
    seconds = (as_col(end).cast("timestamp").cast("long")
               - as_col(start).cast("timestamp").cast("long")).cast("decimal(18,0)")
    return half_up(seconds / F.lit(3600).cast("decimal(10,0)"), HOURS)


def any_true(*conditions: Column) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def known_true(condition: Column) -> Column:
    """Three valued logic closed to two: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


# Fixed value: digits with thousands separators and an optional fraction.
NUMBER_PATTERN = r"\d[\d,]*(?:\.\d+)?"


def numbers_in(text: ColumnLike) -> Column:
    """Every number in a text as array<decimal(38,6)>; what does not parse is dropped."""
    raw = F.regexp_extract_all(as_col(text), F.lit(NUMBER_PATTERN), F.lit(0))
    parsed = F.transform(raw, lambda t: F.regexp_replace(t, ",", "").try_cast("decimal(38,6)"))
    return F.filter(parsed, lambda v: v.isNotNull())
