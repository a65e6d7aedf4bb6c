"""Batch-bounded extraction from a source, driven by an entity table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govpub.operators.ingest import append_new
from govpub.sources.contract import SOURCE_TABLES, Table, check_csv, read_csv
from govpub.sources.store import Store

MAX_PARALLEL = 8


def read_jdbc_batch(spark: SparkSession, options: Mapping[str, str], table: str, batch_id: str,
                    split: Sequence[str] = ()) -> DataFrame:
    """One batch of a relational table; the equality reaches the database as a WHERE clause. With the predicates of
    `split_ranges` each range is a query and a task of its own."""
    if not split:
        reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
        return reader.load().where(F.col("batch_id") == batch_id)
    rest = {k: v for k, v in options.items() if k != "url"}
    own = "batch_id = '" + batch_id.replace("'", "''") + "'"
    return spark.read.jdbc(options["url"], table, predicates=[f"{own} AND ({p})" for p in split], properties=rest)


def split_ranges(df: DataFrame, column: str, ranges: int) -> list[str]:
    """Predicates that cut the rows into ranges of about equal size by a numeric column: every row meets exactly one of
    them. The bounds are percentiles, so a sequence with gaps gives no empty and no overlong range."""
    shares = [k / ranges for k in range(1, ranges)]
    found = df.agg(F.percentile_approx(column, shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    if not bounds:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    return [f"{column} IS NULL OR {column} <= {bounds[0]}",
            *[f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])], f"{column} > {bounds[-1]}"]


def read_files_batch(spark: SparkSession, root: str, table: str, batch_id: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root}/{table}").where(F.col("batch_id") == batch_id)


def read_sequence_range(df: DataFrame, sequence: str, low: int, high: int) -> DataFrame:
    """Incremental pull: rows after `low` up to and including the frozen `high`."""
    return df.where((F.col(sequence) > low) & (F.col(sequence) <= high))


def load_csv(store: Store, path: str, table: Table, batch_id: str, run_id: str = "manual") -> int:
    """Append one batch of a CSV delivery, every value exactly as delivered; returns how many rows were new.

    The same append as a landing: a file that is loaded again, or that was landed before, adds nothing.
    """
    rows = read_csv(store.spark, path, table).where(F.col("batch_id") == batch_id)
    return append_new(store, rows, f"bronze.{table.entity}", batch_id, run_id, path)


REJECTED = "ops.rejected_row"


def load_checked_csv(store: Store, path: str, table: Table, batch_id: str, run_id: str = "manual") -> tuple[int, int]:
    """Append the readable rows of a CSV delivery and keep the others, one row per problem, in `ops.rejected_row`.

    Returns how many rows were new and how many problems were found; loading again replaces the problems.
    """
    checked = check_csv(store.spark, path, table)
    bad = checked.where(F.size("problems") > 0).select(F.explode("problems").alias("p"), "line").select(
        F.col("p.column").alias("ColumnName"), F.col("p.reason").alias("Reason"), F.col("line").alias("Line"),
        F.lit(path).alias("Path"), F.lit(run_id).alias("RunId"))
    problems = store.replace_slice(bad, REJECTED, {"BatchId": batch_id, "EntityName": table.entity})
    good = checked.where((F.size("problems") == 0) & (F.col("batch_id") == batch_id)).select(*table.schema.names)
    return append_new(store, good, f"bronze.{table.entity}", batch_id, run_id, path), problems


ENTITIES = "ops.source_entity"


def save_entities(store: Store, config: DataFrame) -> None:
    """Keep the entity table: which entities are pulled and landed, and in which order."""
    store.write(config.select("ordinal", "entity_name", "source_table", "entity_kind", "enabled"), ENTITIES)


def entities(store: Store) -> DataFrame:
    """The entity table; before one is saved, all delivered entities."""
    return store.table(ENTITIES) if store.exists(ENTITIES) else entity_config(store.spark)


def entity_config(spark: SparkSession) -> DataFrame:
    """The delivered entities as rows (ordinal, entity_name, source_table, entity_kind, enabled)."""
    rows = [(i + 1, t.entity, t.name, t.kind, True) for i, t in enumerate(SOURCE_TABLES)]
    return spark.createDataFrame(
        rows, "ordinal int, entity_name string, source_table string, entity_kind string, enabled boolean")


def copy_batch(config: DataFrame, read: Callable[[str], DataFrame], landing: str, batch_id: str,
               workers: int = MAX_PARALLEL) -> list[str]:
    """Copy every enabled entity to `<landing>/<batch>/<entity>`, at most `workers` at a time.

    Every copy is an ordinary distributed job; the threads only submit them.
    """
    entities = [r for r in config.where("enabled").orderBy("ordinal").collect()]

    def copy(row) -> str:
        frame = read(row["source_table"])
        frame.write.mode("overwrite").parquet(f"{landing}/{batch_id}/{row['entity_name']}")
        return row["entity_name"]

    return in_parallel(copy, entities, workers)


def in_parallel(work: Callable, items: Sequence, workers: int = MAX_PARALLEL) -> list:
    """Submit independent Spark jobs from a few driver threads; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=min(workers, MAX_PARALLEL)) as pool:
        return list(pool.map(work, items))
