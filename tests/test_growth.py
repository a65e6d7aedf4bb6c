"""What is shuffled and written, and what one task holds, when tables grow."""

from datetime import date, datetime, timedelta

from govpub.functions import skew
from govpub.operators import derive, graph, quality, resolve
from govpub.plans.supplied import QUERIES
from govpub.sources.store import Store
from govpub.streaming import revisions


def rows(got):
    return sorted(map(tuple, got), key=str)


def rows_of(df):
    return rows(df.collect())


def moves(df, what="Exchange hashpartitioning"):
    return df._jdf.queryExecution().executedPlan().toString().count(what)  # noqa: SLF001


def test_merged_periods_are_not_cut_into_days(spark):
    zero = datetime(2000, 1, 1)
    events = [("x", zero, zero + timedelta(days=4000)), ("x", zero + timedelta(days=3999), zero + timedelta(days=4100)),
              ("x", zero + timedelta(days=70), zero + timedelta(days=80)), ("x", zero + timedelta(days=4100, hours=1),
                                                                            zero + timedelta(days=4100, hours=2))]
    got = derive.merged_intervals(spark.createDataFrame(events, "k string, a timestamp, b timestamp"), ["k"], "a", "b")
    assert moves(got, "Generate") == 0
    assert sorted(map(tuple, got.collect())) == [("x", zero, zero + timedelta(days=4100)),
                                                 ("x", *events[3][1:])]


def test_ended_chains_are_written_once_and_cycles_end_the_rounds(spark, scratch):
    links = [(k, k + 1 if k % 5 else None) for k in range(1, 101)] + [(1000, 1001), (1001, 1002), (1002, 1000)]
    store, saved = Store(spark, root=str(scratch)), []

    def save(df, name):
        saved.append(store.write(df, f"work.r{name}"))
        return store.table(f"work.r{name}")

    got = {r["id"]: (r["end_id"], r["steps"], r["cyclic"]) for r in
           graph.chain_ends(spark.createDataFrame(links, "id long, next long"), save).collect()}
    assert got == {**{k: (-(-k // 5) * 5, -k % 5, False) for k in range(1, 101)},
                   **{k: (None, None, True) for k in (1000, 1001, 1002)}}
    assert saved == [103, 83, 63, 23, 3]


DELIVERED = [("a", 1, 5, "r", "x"), ("a", 1, 5, "r", "x"), ("a", 2, 7, "s", "y"), (None, None, 1, "t", None), ("b", 1, 2, "u", "x"),
             ("b", 1, 3, "v", "z"), (None, None, 1, "t", None)]


def test_deliveries_move_once_to_their_observation(spark):
    df = spark.createDataFrame(DELIVERED, "obs string, rev int, seq long, change string, pay string")
    found = resolve.resolved(df, ["obs"], "rev", "seq", "change", ["pay"])
    assert moves(found.firsts) == moves(found.further) == 1
    assert rows_of(resolve.duplicates_of(found).drop("agree")) == rows([DELIVERED[0], DELIVERED[3]])
    assert rows_of(resolve.conflicts_of(found).select(*df.columns, "deliveries")) == rows([(*DELIVERED[4], 2)])


def test_kept_deliveries_do_not_move_for_a_batch(spark):
    df = spark.createDataFrame(DELIVERED, "obs string, rev int, seq long, change string, pay string")
    state = resolve.resolved(df, ["obs"], "rev", "seq", "change", ["pay"])
    batch = df.where("change = 't'").limit(1).unionByName(df.where("change = 'u'"))
    kept = resolve.rows_of_keys(state.firsts, batch, ["obs"])
    assert moves(kept, "Exchange hashpartitioning(obs") + moves(kept, "ReusedExchange") >= 2
    assert rows_of(kept.select("obs", "rev")) == rows([("b", 1), (None, None)])


def test_followed_revisions_move_once_to_be_read(spark, scratch):
    store, key = Store(spark, root=str(scratch)), (["obs"], "rev")
    df = spark.createDataFrame(DELIVERED, "obs string, rev int, seq long, change string, pay string")
    for epoch, rows_sent in ((revisions.FOLDED, df.limit(3)), ("0" * 20, df.limit(5)), ("0" * 19 + "1", df)):
        groups = resolve.revision_groups(rows_sent, *key, "seq", "change", ["pay"], highest_sequence="_high")
        store.replace_slice(groups, "silver.r", {revisions.EPOCH: epoch})
    got = revisions.latest(store, "silver.r", *key, df.columns)
    assert moves(got) == 1 and moves(got, "Aggregate") == 0
    want = rows_of(resolve.latest_of(resolve.resolved(df, *key, "seq", "change", ["pay"]), df.columns))
    assert rows_of(got) == want
    revisions.compact(store, "silver.r", ["obs", "rev"])
    assert store.table("silver.r").count() == 4
    assert rows_of(revisions.latest(store, "silver.r", *key, df.columns)) == want


def test_followed_revisions_are_kept_on_disk(spark, scratch):
    store, key, path = Store(spark, root=f"{scratch}/lake"), (["obs"], "rev"), f"{scratch}/landing"
    df = spark.createDataFrame(DELIVERED, "obs string, rev int, seq long, change string, pay string")
    before = {k: spark.conf.get(k, None) for k in revisions.STATE}
    for some in (df.limit(3), df.exceptAll(df.limit(3))):
        some.write.mode("append").parquet(path)
        run = revisions.follow(store, path, df.schema, lambda rows: rows, "feed", *key, "seq", "change", ["pay"], "silver.r",
                               f"{scratch}/checkpoint")
        run.awaitTermination()
        (state,) = run.lastProgress["stateOperators"]
        assert "rocksdbPutCount" in state["customMetrics"]
    assert {k: spark.conf.get(k, None) for k in revisions.STATE} == before
    assert rows_of(revisions.latest(store, "silver.r", *key, df.columns)) == rows_of(
        resolve.latest_of(resolve.resolved(df, *key, "seq", "change", ["pay"]), df.columns))


def test_periods_move_once_to_be_compared(spark):
    days = [date(2024, 1, k) for k in range(1, 9)]
    df = spark.createDataFrame([("k", days[0], days[4]), ("k", days[2], days[3]), ("k", days[4], days[5]), (None, days[0], days[7]),
                                (None, days[6], days[6]), ("k", None, days[1])], "k string, a date, b date")
    got = quality.overlaps(skew.spread(df, ["k"], 3), ["k"], "a", "b")
    assert moves(got) == 1
    assert rows_of(got) == rows([("k", days[2], 1, 1), (None, days[6], 1, 1)])


def test_tasks_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 10)
    few = spark.sparkContext.defaultParallelism
    assert skew.tasks_for(spark.range(5)) == few and skew.tasks_for(spark.range(1005)) == max(few, 101)
    table = spark.range(1005).selectExpr("id % 1000 AS k")
    found = quality.duplicate_keys(skew.spread(table, ["k"], skew.tasks_for(table)), ["k"])
    assert moves(found) == 1 and rows_of(found) == rows([(k, 2) for k in range(5)])


def supplied(spark, folder):
    """Tables of one order and one line per number."""
    n, day = spark.range(60), "DATE '2024-01-01' AS {}"
    for name, columns in {
            "region": ["0 AS r_regionkey", "'R' AS r_name"], "nation": ["0 AS n_nationkey", "'N' AS n_name", "0 AS n_regionkey"],
            "customer": ["id AS c_custkey", "0 AS c_nationkey"], "events": ["id AS user_id", "'e' AS event_type"],
            "orders": ["id AS o_orderkey", "id % 20 AS o_custkey", "'F' AS o_orderstatus", "'1' AS o_orderpriority",
                       "date_add(DATE '2024-01-01', int(id)) AS o_orderdate", "1e5 AS o_totalprice"],
            "lineitem": ["id % 30 AS l_orderkey", "id % 7 AS l_partkey", "id % 3 AS l_suppkey", "1 AS l_linenumber",
                         "'N' AS l_returnflag", "'F' AS l_linestatus", day.format("l_shipdate"), "1.0 AS l_quantity",
                         "1.0 AS l_extendedprice", "0.0 AS l_discount", "0.0 AS l_tax"]}.items():
        (n.limit(1) if name in ("region", "nation") else n).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_queries_spread_their_rows_over_tasks_that_grow(spark, scratch, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 3)
    folder = supplied(spark, scratch)
    found = {name: QUERIES[name](spark, folder) for name in ("duplicate_keys", "distinct_matrix", "interval_overlaps")}
    for name, df in found.items():
        assert moves(df, ", 20), REPARTITION_BY_NUM") >= 1, name
    assert found["duplicate_keys"].count() == 30
    assert rows_of(found["distinct_matrix"].where("level = 3").select("customers", "suppliers", "parts")) == [(20, 3, 7)]
    assert found["interval_overlaps"].count() == 40
