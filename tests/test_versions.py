"""Commits, past versions, several writers, period index, merged periods, chains, exact distinct counts, the followed feed."""

import random
import threading
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from govpub.operators import derive, graph, ingest, measures, publish, registry, resolve
from govpub.sources.store import Store
from govpub.sources.versions import CommitConflict, CommitLog, VersionedTable
from govpub.streaming import revisions


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


# --- versions --------------------------------------------------------------------------

def test_every_version_stays_readable(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    days = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3, 4)]
    assert t.write(frame(spark, ("a", 1), ("b", 2)), "append", ["k"], at=days[0]) == 2
    files = {f for f, _ in t.log.files.files(t.data)}
    assert t.write(frame(spark, ("c", 3)), "append", at=days[1]) == 1
    t.write(frame(spark, ("b", 9), ("b", 8)), "replace slices", [], lambda p: p["slice"]["k"] == "b", at=days[2])
    assert t.write(frame(spark).limit(0), "replace slices", [], lambda p: p["slice"]["k"] == "a", at=days[3]) == 0
    want = {1: [(1, "a"), (2, "b")], 2: [(1, "a"), (2, "b"), (3, "c")], 3: [(1, "a"), (3, "c"), (8, "b"), (9, "b")],
            4: [(3, "c"), (8, "b"), (9, "b")]}
    for version, rows in want.items():
        assert rows_of(t.read(version)) == sorted(rows, key=str)
        assert rows_of(t.read(at=days[version - 1] + timedelta(hours=1))) == sorted(rows, key=str)
    assert files <= {f for f, _ in t.log.files.files(t.data)}  # old files untouched
    assert rows_of(t.read(only={"k": ["b"]})) == [(8, "b"), (9, "b")] and t.read(only={"k": ["x"]}).isEmpty()
    with pytest.raises(LookupError):
        t.read(at=datetime(2023, 1, 1, tzinfo=timezone.utc))
    with pytest.raises(LookupError):
        t.read(version=7)
    with pytest.raises(CommitConflict):
        t.write(frame(spark, ("z", 0)), "append", at=days[0])  # not after the last commit
    old, new = t.changed(2, 3)
    assert rows_of(old) == [(2, "b")] and rows_of(new) == [(8, "b"), (9, "b")]  # slices a and c are not read
    t.restore(1)
    assert rows_of(t.read()) == want[1] and rows_of(t.read(4)) == sorted(want[4], key=str)
    t.restore(1)
    assert t.history().count() == 5  # nothing to restore, nothing committed
    assert t.expire(datetime.now(timezone.utc)) > 0 and rows_of(t.read()) == want[1]
    assert t.log.numbers() == [5]


def test_types_and_columns_are_those_of_the_table(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.write(spark.sql("SELECT 1 AS id, CAST(2.5 AS DECIMAL(9,3)) AS x, DATE '2024-01-01' AS d"), "append", ["d"])
    t.write(spark.sql("SELECT DATE '2024-01-02' AS d, 3L AS id, 'left out' AS more, CAST(1 AS DECIMAL(5,1)) AS x"), "append")
    assert rows_of(t.read()) == [(1, D("2.500"), date(2024, 1, 1)), (3, D("1.000"), date(2024, 1, 2))]
    assert t.read().dtypes == [("id", "int"), ("x", "decimal(9,3)"), ("d", "date")]


def test_a_number_is_given_once(spark, scratch):
    log = CommitLog(spark, f"{scratch}/log")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: log.add(lambda last: {"by": [*(last["by"] if last else []), k]})["version"], range(20)))
    assert sorted(made) == list(range(1, 21)) and sorted(log.last()["by"]) == list(range(20))
    assert not log.files.put_if_absent(log.folder, f"{20:020d}.json", "{}") and log.last()["version"] == 20
    log.files.is_local = False  # the way of other file systems
    assert log.files.put_if_absent(log.folder, "x", "1") and not log.files.put_if_absent(log.folder, "x", "2")
    assert log.files.read(f"{log.folder}/x") == "1" and not [n for n in log.files.names(log.folder) if n.startswith(".")]


def test_writers_of_the_same_rows(spark, scratch):
    """Appends and other slices go side by side; of two writers of one slice the second is refused."""
    store = Store(spark, root=str(scratch))
    store.append(frame(spark, ("a", 1), ("b", 1)), "ops.t", ["k"])
    t = store.versioned("ops.t")
    base = t.commit_of()
    store.append(frame(spark, ("c", 1)), "ops.t")
    part = t._parts  # noqa: SLF001
    t._commit("replace slice", base, [], lambda p: p["slice"]["k"] == "a", 0, t.read().schema, ["k"])  # noqa: SLF001
    assert part and {r[0] for r in store.table("ops.t").select("k").collect()} == {"b", "c"}
    with pytest.raises(CommitConflict):
        t._commit("replace slice", base, [], lambda p: p["slice"]["k"] == "a", 0, t.read().schema, ["k"])  # noqa: SLF001
    assert {r[0] for r in store.table("ops.t").select("k").collect()} == {"b", "c"}


# --- ledger ----------------------------------------------------------------------------

def approved(store, *ids):
    """Publications that wait for publishing, with the checks that read their rows left out."""
    for p in ids:
        publish._commit(store, lambda open_, p=p: [publish._entry(  # noqa: SLF001
            {"PublicationId": p, "ControlTotalsJson": "{}"}, "APPROVED", "owner", None, ingest.utc_now(), Status="APPROVED")])


@pytest.fixture
def unchecked(monkeypatch):
    barrier = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(publish, "wrong_counts", lambda *a: False)
    monkeypatch.setattr(publish, "verified", lambda *a: True)

    def totals(store, publication):  # both have read the ledger before either commits
        barrier.wait()
        return {}

    monkeypatch.setattr(publish, "control_totals", totals)


def at_once(*calls):
    def run(call):
        try:
            return call()["Status"]
        except publish.LifecycleError as error:
            return error.code
    with ThreadPoolExecutor(len(calls)) as pool:
        return sorted(pool.map(run, calls), key=str)


def test_two_sessions_publish_at_once(spark, scratch, unchecked):
    one, two = Store(spark, root=str(scratch)), Store(spark.newSession(), root=str(scratch))
    approved(one, "PUB-A", "PUB-B")
    assert at_once(lambda: publish.publish(one, "PUB-A"), lambda: publish.publish(two, "PUB-B")) == [50033, "PUBLISHED"]
    states = {r["PublicationId"]: r["Status"] for r in publish.publications(one).collect()}
    assert sorted(states.values()) == ["APPROVED", "PUBLISHED"]
    rows = publish.ledger(two).orderBy("Seq").collect()
    assert [r["Seq"] for r in rows] == [1, 2, 3] and rows[2]["EventType"] == "PUBLISHED"


def test_the_same_publication_twice_at_once(spark, scratch, unchecked):
    store = Store(spark, root=str(scratch))
    approved(store, "PUB-A")
    assert at_once(*[lambda: publish.publish(store, "PUB-A")] * 2) == ["PUBLISHED", "PUBLISHED"]
    assert publish.ledger(store).where("EventType = 'PUBLISHED'").count() == 1


def test_one_decision_of_two(spark, scratch):
    store = Store(spark, root=str(scratch))
    publish.save_approvers(store, [("a", "owner", "PRODUCTION", True), ("b", "owner", "PRODUCTION", True)])
    publish._commit(store, lambda open_: [publish._entry(  # noqa: SLF001
        {"PublicationId": "PUB-A"}, "STAGED", "x", None, ingest.utc_now(), Status="APPROVAL_PENDING")])
    got = at_once(lambda: publish.decide(store, "PUB-A", "a"), lambda: publish.decide(store, "PUB-A", "b", "REJECT"))
    assert got[0] == 50022 and got[1] in ("APPROVED", "REJECTED") and publish.ledger(store).count() == 2


# --- periods ---------------------------------------------------------------------------

def test_period_index_against_pairs(spark):
    rng, day = random.Random(2), date(2020, 1, 1)
    at = lambda n: day + timedelta(n)
    facts = [(rng.choice("abc"), at(rng.randrange(400)) if rng.random() < 0.95 else None, k) for k in range(300)]
    periods = [(rng.choice("abd"), at(a), at(a + rng.choice([0, 1, 5, 40, 200])) if rng.random() < 0.9 else date(9999, 12, 31), k)
               for k in range(120) if (a := rng.randrange(-50, 420)) is not None]
    periods += [("a", None, at(5), -1), ("a", at(5), None, -2)]
    df = spark.createDataFrame(facts, "k string, d date, id int")
    reg = spark.createDataFrame(periods, "rk string, a date, b date, s int")
    want = []
    for k, d, i in facts:
        hits = [s for rk, a, b, s in periods if d and a and b and rk == k and a <= d < b]
        want += [(k, d, i, s) for s in hits] or [(k, d, i, None)]
    for width in (1, 32, 1000):
        for span in (None, (at(0), at(399))):
            got = registry.join_effective(df, reg, {"k": "rk"}, "d", "a", "b", ["s"], span=span, width=width)
            assert Counter(map(tuple, got.collect())) == Counter(want)
    assert registry.join_effective(df.where("false"), reg, {"k": "rk"}, "d", "a", "b", ["s"]).isEmpty()


def test_period_index_has_no_fan_out(spark):
    """A key with 5,000 one-day periods: a row meets the periods of its bucket, not of its key."""
    reg = spark.range(5000).selectExpr("'a' AS rk", "date_add(DATE '2000-01-01', CAST(id AS INT)) AS a",
                                       "date_add(DATE '2000-01-01', CAST(id AS INT) + 1) AS b", "id AS s")
    df = spark.range(5000).selectExpr("'a' AS k", "date_add(DATE '2000-01-01', CAST(id AS INT)) AS d")
    index = registry.period_index(reg, "a", "b", F.lit("2000-01-01").cast("date"), F.lit("2030-01-01").cast("date"), "n")
    assert index.groupBy("rk", "n").count().agg(F.max("count")).first()[0] <= registry.BUCKET_DAYS
    got = registry.join_effective(df, reg, {"k": "rk"}, "d", "a", "b", ["s"])
    assert got.count() == 5000 and got.where("s IS NULL").isEmpty()
    assert "_bucket" in got._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


def test_merged_periods_against_minutes(spark):
    rng, zero = random.Random(9), datetime(2024, 1, 1)
    events = []
    for k in range(200):
        a = rng.randrange(6 * 1440)
        events.append((rng.choice("xyz"), zero + timedelta(minutes=a),
                       zero + timedelta(minutes=a + rng.choice([-5, 0, 1, 30, 60, 1440, 2000]))))
    events += [("w", zero, zero + timedelta(days=1)), ("w", zero + timedelta(days=1), zero + timedelta(days=2)),
               ("w", zero + timedelta(days=3), None), ("w", None, zero)]
    got = Counter(map(tuple, derive.merged_intervals(spark.createDataFrame(events, "k string, a timestamp, b timestamp"),
                                                     ["k"], "a", "b").collect()))
    want = []
    for key in "wxyz":
        on = sorted((a, b) for k, a, b in events if k == key and a and b and a < b)
        merged = []
        for a, b in on:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want += [(key, a, b) for a, b in merged]
    assert got == Counter(want)


# --- chains and distinct counts --------------------------------------------------------

def test_chains_of_unknown_length(spark, scratch):
    links = [(k, k + 1 if k < 300 else None) for k in range(301)]
    links += [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1001), (1004, 1004), (2000, 9999), (3000, None)]
    store = Store(spark, root=str(scratch))

    def save(df, name):
        store.write(df, f"work.r{name}")
        return store.table(f"work.r{name}")

    got = {r["id"]: (r["end_id"], r["steps"], r["cyclic"]) for r in
           graph.chain_ends(spark.createDataFrame(links, "id long, next long"), save).collect()}
    assert all(got[k] == (300, 300 - k, False) for k in range(301))
    assert {k: got[k] for k in (1000, 1001, 1002, 1003, 1004)} == {k: (None, None, True) for k in range(1000, 1005)}
    assert got[2000] == (9999, 1, False) and got[3000] == (3000, 0, False) and len(got) == len(links)


def test_distinct_counts_at_all_levels(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("cde"), rng.choice([rng.randrange(50), 100_000 + rng.randrange(5), None]),
             rng.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "x string, y string, n long, m int")
    got = {(r["level"], r["x"], r["y"]): (r["n"], r["m"]) for r in
           measures.distinct_rollup(df, ["x", "y"], {"n": "n", "m": "m"}).collect()}
    want = {}
    for level, keep in ((0, (True, True)), (1, (True, False)), (3, (False, False))):
        groups = {}
        for x, y, n, m in rows:
            ns, ms = groups.setdefault((level, x if keep[0] else None, y if keep[1] else None), (set(), set()))
            ns.update(() if n is None else (n,))
            ms.add(m)
        want |= {k: (len(a), len(b)) for k, (a, b) in groups.items()}
    assert got == want


# --- followed feed ---------------------------------------------------------------------

SENT = "source string, obs string, revision int, seq long, record string, pay string"


def test_followed_feed_equals_the_batch(spark, scratch, monkeypatch):
    rng = random.Random(7)
    sent = [(rng.choice("AB"), f"o{rng.randrange(12)}", rng.choice([1, 2, 3, None]), rng.randrange(1, 90),
             f"c{rng.randrange(40)}", rng.choice(["x", "y", None])) for _ in range(150)]
    df = spark.createDataFrame(sent, SENT)
    store, path = Store(spark, root=f"{scratch}/lake"), f"{scratch}/landing"
    key, args = (["source", "obs"], "revision"), ("seq", "record", ["pay"], "silver.r", f"{scratch}/checkpoint")
    want = {rule: rows_of(resolve.latest_of(resolve.resolved(df, *key, "seq", "record", ["pay"]), df.columns, rule))
            for rule in ("unresolved", "older")}

    def run():
        revisions.follow(store, path, df.schema, lambda rows: rows, "feed", *key, *args, files_per_trigger=1).awaitTermination()

    for k in range(3):  # three runs, each of several micro batches
        spark.createDataFrame(sent[k * 50:(k + 1) * 50], SENT).repartition(3).write.mode("append").parquet(path)
        run()
        if k == 1:
            revisions.compact(store, "silver.r", ["source", "obs", "revision"])
    run()  # nothing new
    for rule, rows in want.items():
        assert rows_of(revisions.latest(store, "silver.r", *key, df.columns, rule)) == rows
    assert ingest.watermark(store, "feed") == max(r[3] for r in sent)
    # an epoch that is written again replaces what it wrote
    epochs = [r[0] for r in store.table("silver.r").select("Epoch").distinct().collect()]
    last = max(e for e in epochs if e != revisions.FOLDED)
    again = store.table("silver.r", only={"Epoch": [last]}).drop("Epoch")
    store.replace_slice(again, "silver.r", {"Epoch": last})
    assert rows_of(revisions.latest(store, "silver.r", *key, df.columns)) == want["unresolved"]
