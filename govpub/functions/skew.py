"""Key-wise helpers that keep working when one key holds a large part of all rows.

Picking one row per key is written as an aggregate, never as a ranking window: aggregates
combine on the map side, so a hot key reaches the reducer as one row per map task. Where
every row needs a figure of its group, `attach_stats` joins the rows back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import ColumnLike, as_col

def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """One whole row per key, the greatest by `order`; remaining ties fall to the other columns."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [as_col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*ranked, *[F.col(c) for c in rest])).alias("_row"))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in df.columns])


def attach_stats(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key is in the one-per-key `stats` frame, with the figures of its key.

    An inner equi join: rows of other keys are not moved further than the join, a small `stats` is broadcast
    by its measured size, and the partitions of a hot key are split at run time.
    """
    figures = [c for c in stats.columns if c not in keys]
    return rows.join(stats, list(keys)).select(*rows.columns, *figures)


def group_size(df: DataFrame, keys: Sequence[str], name: str = "rows", *more: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name), *more)


#: Rows that one task folds or sorts together.
TASK_ROWS = 250_000


def tasks_for(rows: DataFrame) -> int:
    """Tasks for a table, so many that the rows of one stay the same when the table grows."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))


def spread(df: DataFrame, keys: Sequence[str], tasks: int) -> DataFrame:
    """The rows by keys in so many tasks. For keys of few rows each, where combining on the map side would only hold nearly
    every row of an input file in memory; what is grouped or joined by these keys afterwards is not moved again."""
    return df.repartition(tasks, *keys)
