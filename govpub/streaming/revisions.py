"""Deliveries of a landing folder followed to the latest revision, as a stateful stream.

The stream keeps one aggregate per revision (first delivery by sequence, number of deliveries, whether they agree) in
Spark's state store; late deliveries, lower sequences and earlier revisions that come last change it like any others.
The state lies in RocksDB on the disks of the executors, which hold a bounded part of it in memory, however many revisions there
are; a checkpoint that an earlier version of this module began in the heap goes on there.
Every micro batch hands out the revisions it changed. They are written as one slice per epoch, so a micro batch that runs
again replaces what it wrote, and in the same epoch the sequence watermark of the feed moves up. Reading takes the newest
row of each revision; `compact` folds old epochs into one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from govpub.functions.columns import ColumnLike
from govpub.operators import ingest, resolve
from govpub.sources.store import Store
from govpub.streaming.bronze import landing_stream

EPOCH, FOLDED = "Epoch", "folded"

#: How the state is kept: on disk, with one bound of memory for all partitions of an executor (500 MB unless the session sets
#: `rocksdb.maxMemoryUsageMB`), and without looking a key up only to count it.
_STATE = "spark.sql.streaming.stateStore"
STATE = {f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         f"{_STATE}.rocksdb.boundedMemoryUsage": "true", f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while a stream starts; it takes a copy of them."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def follow(store: Store, path: str, schema: StructType, conform: Callable[[DataFrame], DataFrame], feed: str,
           obs_key: Sequence[str], revision: str, seq: str, record: str, payload: Sequence[ColumnLike], table: str,
           checkpoint: str, files_per_trigger: int = 1000) -> StreamingQuery:
    """Take in all files that arrived since the last run, and stop. `conform` projects the landed rows."""
    rows = conform(landing_stream(store, path, schema, files_per_trigger))
    groups = resolve.revision_groups(rows, obs_key, revision, seq, record, payload, highest_sequence="_high")

    def save(changed: DataFrame, epoch: int) -> None:
        here = Store(changed.sparkSession, store.prefix, store.root)
        here.replace_slice(changed, table, {EPOCH: f"{epoch:020d}"})
        high = here.table(table, only={EPOCH: [f"{epoch:020d}"]}).agg(F.max("_high")).first()[0]
        if high is not None and high > ingest.watermark(here, feed):
            ingest.commit_window(here, feed, high)

    with _settings(store.spark, STATE):
        return (groups.writeStream.outputMode("update").foreachBatch(save)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _newest(rows: DataFrame, obs_key: Sequence[str], revision: str) -> DataFrame:
    """The newest row of every revision; folded epochs are older than all others. Rows move once, to the others of their
    observation, and are sorted once: what looks at observations afterwards finds them in place."""
    order = F.when(F.col(EPOCH) == FOLDED, "").otherwise(F.col(EPOCH)).desc()
    place = F.row_number().over(Window.partitionBy(*obs_key, revision).orderBy(order))  # an epoch has a revision once
    return rows.repartition(*obs_key).withColumn("_place", place).where("_place = 1").drop("_place")


def groups_now(store: Store, table: str, obs_key: Sequence[str], revision: str) -> DataFrame:
    """The newest row of every revision, by observation."""
    return _newest(store.table(table), obs_key, revision).drop(EPOCH, "_high")


def latest(store: Store, table: str, obs_key: Sequence[str], revision: str, columns: Sequence[str],
           on_conflict: str = "unresolved") -> DataFrame:
    """First delivery of the highest revision of every observation, as a batch over all deliveries gives it."""
    firsts = resolve.with_top(groups_now(store, table, obs_key, revision), obs_key, revision)
    return resolve.latest_of(resolve.Resolved(firsts, firsts.limit(0)), columns, on_conflict)


def compact(store: Store, table: str, rev_key: Sequence[str]) -> None:
    """Fold all epochs into one slice, in one commit. Run it between two runs of the stream. The last of the key is the
    revision."""
    newest = _newest(store.table(table), rev_key[:-1], rev_key[-1])
    store.write(newest.withColumn(EPOCH, F.lit(FOLDED)), table, [EPOCH])
