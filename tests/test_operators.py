"""Single operators on small frames, and every rule the packs do not trigger."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from govpub.functions.columns import (date_key, hours_between, json_hash, numbers_in, safe_ratio, stable_key)
from govpub.functions.skew import attach_stats, group_size, latest_by
from govpub.operators import derive, ingest, measures, quality, recon, registry, resolve
from govpub.sources import contract
from govpub.sources.extract import (REJECTED, copy_batch, entities, entity_config, load_checked_csv, load_csv,
                                    read_sequence_range, save_entities, split_ranges)
from govpub.sources.registers import REGISTERS, save_contracts
from govpub.sources.store import Store, read_landed
from govpub.streaming.bronze import append_stream

DAY = date(2025, 1, 10)
OPEN = date(9999, 12, 31)


# --- functions -------------------------------------------------------------------------

def test_columns(spark):
    row = spark.createDataFrame([("a", DAY, "12,345.5 and 7 or 1.2.3", D("10"), D("0"))],
                                "k string, d date, t string, x decimal(9,2), z decimal(9,2)").select(
        date_key("d").alias("dk"), numbers_in("t").alias("n"), safe_ratio("x", "z").alias("r"),
        (stable_key("A", "k") == stable_key("A", "k")).alias("same"),
        (stable_key("A", "k") == stable_key("B", "k")).alias("other"),
        hours_between(F.lit("2025-01-01 00:00:00"), F.lit("2025-01-01 00:50:00")).alias("h")).first()
    assert row["dk"] == 20250110 and row["r"] is None and row["same"] and not row["other"]
    assert row["n"] == [D("12345.5"), D(7), D("1.2"), D(3)] and row["h"] == D("0.833")


def test_attach_stats_with_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50).alias("k"))
    out = attach_stats(rows, group_size(rows, ["k"]), ["k"])
    sizes = defaultdict(int)
    for r in rows.collect():
        sizes[r["k"]] += 1
    got = out.collect()
    assert len(got) == 3000 and all(r["rows"] == sizes[r["k"]] for r in got)


def test_extremes_are_total(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, None)], "k string, s int, v string")
    assert {tuple(r) for r in latest_by(df, ["k"], ["s"]).collect()} == {("a", 2, "z"), ("b", 5, None)}


# --- contract and store ----------------------------------------------------------------

def test_csv_against_contract(spark, scratch):
    table = contract.SOURCE_BY_NAME["ref.uom_conversion"]
    header = ",".join(table.schema.names)
    good, wrong, empty = scratch / "good.csv", scratch / "wrong.csv", scratch / "empty.csv"
    good.write_text(f"{header}\nB0,Oil,bbl,,1.5,,U1\n")
    row = contract.read_csv(spark, str(good), table).first()
    assert row["standard_uom"] == "" and row["boe_divisor"] is None and row["to_standard_factor"] == D("1.5")
    wrong.write_text(f"{header.replace('uom,', 'unit,', 1)}\nB0,Oil,bbl,bbl,1,,U1\n")
    with pytest.raises(Exception):
        contract.read_csv(spark, str(wrong), table).collect()
    empty.write_text(f"{header}\nB0,Oil,bbl,bbl,,,U1\n")
    with pytest.raises(Exception, match="empty but required"):
        contract.read_csv(spark, str(empty), table).collect()


def test_csv_load_loses_nothing(spark, scratch):
    table = contract.SOURCE_BY_NAME["ref.fx_rate"]
    header = ",".join(table.schema.names)
    store = Store(spark, "csv_")
    (scratch / "a.csv").write_text(f"{header}\nB0,2025-01-01,USD,1.123456789\nB0,2025-01-02,USD,2\n")
    assert load_csv(store, str(scratch / "a.csv"), table, "B0") == 2
    assert load_csv(store, str(scratch / "a.csv"), table, "B0") == 0  # loaded again, nothing is added
    assert sorted(r["usd_per_unit"] for r in store.table("bronze.ref__fx_rate").collect()) == [D("1.123456789"), D(2)]
    (scratch / "b.csv").write_text(f"{header}\nB0,2025-01-01,USD,1.1234567891\n")
    with pytest.raises(Exception, match="more digits than its type"):
        contract.read_csv(spark, str(scratch / "b.csv"), table).collect()


def test_bad_csv_rows_are_kept_by_reason(spark, scratch):
    table = contract.SOURCE_BY_NAME["ref.uom_conversion"]
    names, store = table.schema.names, Store(spark, root=f"{scratch}/lake")
    good = dict(zip(names, ("B0", "Oil", "bbl", "bbl", "1.5", "", "U1")))
    rows = [good, {**good, "uom": "m3", "to_standard_factor": "1,5"}, {**good, "uom": "x", "to_standard_factor": "abc"},
            {**good, "uom": "y", "to_standard_factor": "1.12345678901"}, {**good, "uom": "z", "to_standard_factor": ""}, good,
            {**good, "batch_id": "B1"}]
    (scratch / "u.csv").write_text("\n".join([",".join(names), *[",".join(r.values()) for r in rows], "B0,Oil"]) + "\n")
    assert load_checked_csv(store, str(scratch / "u.csv"), table, "B0") == (1, 5)
    assert load_checked_csv(store, str(scratch / "u.csv"), table, "B0") == (0, 5)
    found = sorted((r["ColumnName"] or "", r["Reason"], r["Line"]) for r in store.table(REJECTED).collect())
    line = lambda uom, factor: f"B0,Oil,{uom},bbl,{factor},,U1"
    assert found == sorted([("", contract.MALFORMED, line("m3", "1,5")), ("", contract.MALFORMED, "B0,Oil"),
                            ("to_standard_factor", contract.UNREADABLE, line("x", "abc")),
                            ("to_standard_factor", contract.DIGITS, line("y", "1.12345678901")),
                            ("to_standard_factor", contract.REQUIRED, line("z", ""))])
    (scratch / "w.csv").write_text(",".join(names).replace("uom,", "unit,", 1) + "\nB0,Oil,bbl,bbl,1,,U1\n")
    with pytest.raises(Exception):
        contract.check_csv(spark, str(scratch / "w.csv"), table).collect()


def test_registers_are_kept_per_version(spark):
    store = Store(spark, "reg_")
    registers = {name: spark.createDataFrame([tuple(f"{c} {k}" for c in columns) for k in range(3)], columns)
                 for name, (_, _, columns) in REGISTERS.items()}
    for version in ("1.0", "1.0", "2.0"):
        save_contracts(store, registers, dict.fromkeys(registers, version), version)
    sizes = {t: store.table(f"ops.{t}").count() for t in ("kpi_contract", "data_product", "dq_rule",
                                                          "source_authority_policy")}
    assert sizes == {"kpi_contract": 6, "data_product": 6, "dq_rule": 36, "source_authority_policy": 6}


def test_alias_rows(spark):
    rows = [("w", "A", "2"), ("w", "A", "1"), ("w", "A", "1"), *[("big", "C", str(k)) for k in range(1500)]]
    df = spark.createDataFrame(rows, "well string, s string, r string")
    got = registry.alias_rows(df, "well", "s", "r").groupBy("well").count().collect()
    assert {r["well"]: r["count"] for r in got} == {"w": 2, "big": 1500}


def test_schema_and_decimal_checks(spark):
    table = contract.SOURCE_BY_NAME["ref.country"]
    df = spark.createDataFrame([("B0", "X", None), ("B0", "Y", None)], "batch_id string, country_id string, "
                               "country_name string").withColumn("extra", F.lit(1))
    problems = {(r["column_name"], r["problem"]) for r in contract.schema_violations(df, table).collect()}
    assert problems == {("extra", "UNEXPECTED_COLUMN"), ("country_name", "NULLS 2")}
    values = spark.createDataFrame([(D("1.25"),), (D("999.5"),), (D("1000"),), (None,)], "v decimal(19,6)")
    assert contract.decimal_misfits(values, {"v": "decimal(4,1)"}).first()["misfits"] == 2


def test_slices(spark):
    store = Store(spark, "slice_")
    frame = lambda *rows: spark.createDataFrame(list(rows), "v int")
    store.replace_slice(frame((1,), (2,)), "ops.t", {"BatchId": "B'0", "Stage": "R"})
    store.replace_slice(frame((3,)), "ops.t", {"BatchId": "B'0", "Stage": "M"})
    store.replace_slice(frame((9,)), "ops.t", {"BatchId": "B'0", "Stage": "R"})
    rows = lambda: sorted((r["Stage"], r["v"]) for r in store.table("ops.t").collect())
    assert rows() == [("M", 3), ("R", 9)]
    store.replace_slice(frame(), "ops.t", {"BatchId": "B'0", "Stage": "R"})
    assert rows() == [("M", 3)]


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    def of(frame):
        return ingest.content_digests({"a": frame}).first()

    assert of(df) == of(df.orderBy(F.desc("id")).repartition(3)) == of(df.select("v", "id"))
    assert of(df) != of(df.withColumn("v", F.col("v") + F.when(F.col("id") == 7, 1).otherwise(0)))
    left, right = (spark.createDataFrame([row], "x string, y string, z string") for row in (("a", None, "b"), ("a", "b", None)))
    assert of(left) != of(right) and of(df.where("false"))["content"] == "0"
    changed = ingest.check_resend(ingest.content_digests({"a": df}), ingest.content_digests({"a": df.where("id < 99")}))
    assert [r[0] for r in changed.collect()] == ["a"]


def test_read_landed(spark, scratch):
    assert read_landed(spark, str(scratch / "absent")) is None
    (scratch / "empty").mkdir()
    assert read_landed(spark, str(scratch / "empty")) is None


def test_ranges_cut_every_row_once(spark):
    rng = random.Random(1)
    values = [rng.choice([None, 5, 5, 5, rng.randrange(10_000), 10**9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "s long")
    for n in (1, 2, 8):
        parts = split_ranges(df, "s", n)
        assert sum(df.where(p).count() for p in parts) == len(values) and len(parts) <= n
    assert split_ranges(df.where("false"), "s", 4) == ["s IS NULL OR s IS NOT NULL"]


def test_entities_are_a_table(spark, scratch):
    store = Store(spark, root=str(scratch))
    assert entities(store).where("enabled").count() == entity_config(spark).count()
    save_entities(store, entity_config(spark).withColumn("enabled", F.col("entity_name") == "ref__well"))
    source = spark.range(3).selectExpr("'B0' AS batch_id", "id")
    assert copy_batch(entities(store), lambda table: source, f"{scratch}/landing", "B0") == ["ref__well"]


def test_copy_batch_and_sequence_range(spark, scratch):
    config = entity_config(spark).where("entity_name IN ('ref__country', 'ref__well')")
    source = spark.createDataFrame([("B0", 1), ("B0", 2), ("B1", 3)], "batch_id string, seq int")
    done = copy_batch(config, lambda table: source.where("batch_id = 'B0'"), str(scratch), "B0")
    assert sorted(done) == ["ref__country", "ref__well"]
    assert read_landed(spark, f"{scratch}/B0/ref__well").count() == 2
    assert [r["seq"] for r in read_sequence_range(source, "seq", 1, 2).collect()] == [2]


def test_watermark_is_frozen_until_committed(spark):
    store = Store(spark, "wm_")
    assert ingest.pull_window(store, "feed", 100) == (0, 100)
    assert ingest.pull_window(store, "feed", 170) == (0, 100)
    ingest.commit_window(store, "feed", 100)
    assert ingest.pull_window(store, "feed", 170) == (100, 170)


def test_admission(spark):
    batches = spark.createDataFrame([("B0", "SEALED"), ("B1", "OPEN"), ("B2", "SEALED"), ("B2", "SEALED")],
                                    "batch_id string, state string")
    assert ingest.admit_sealed(batches, "B0")["batch_id"] == "B0"
    for bad in ("B1", "B2", "B3"):
        with pytest.raises(ingest.PipelineError):
            ingest.admit_sealed(batches, bad)


def test_stream_appends_once(spark, scratch):
    store = Store(spark, "stream_")
    schema = spark.createDataFrame([], "batch_id string, v int").schema
    landing = str(scratch / "landing")
    spark.createDataFrame([("B0", 1), ("B0", 1), ("B0", 2)], schema).write.parquet(landing)

    def run(checkpoint):
        append_stream(store, landing, schema, "bronze.feed", str(scratch / checkpoint), "r").awaitTermination()
        return sorted(r["v"] for r in store.table("bronze.feed").collect())

    assert run("c1") == [1, 2]
    spark.createDataFrame([("B0", 2), ("B1", 3)], schema).write.mode("append").parquet(landing)
    assert run("c1") == [1, 2, 3]
    assert run("fresh") == [1, 2, 3]


# --- master rules ----------------------------------------------------------------------

def test_m01_m02(spark):
    field = spark.createDataFrame([("F1", "A"), ("F1", "B"), ("F2", "A")], "field_id string, country_id string")
    country = spark.createDataFrame([("A",)], "country_id string")
    found = quality.master_issues({"field": field, "country": country}, {"field": ["field_id"]},
                                  [("field", "country_id", "country", "country_id")])
    rows = [(r["RuleId"], r["RecordKey"], r["Severity"]) for f in found for r in f.collect()]
    assert sorted(rows) == [("M01", "F1", "BLOCKER"), ("M02", "B", "BLOCKER")]


def test_m03_m04(spark):
    reg = spark.createDataFrame([
        ("A", date(2025, 1, 1), date(2025, 6, 1), D("0.5")), ("A", date(2025, 3, 1), OPEN, D("0.5")),
        ("A", date(2025, 4, 1), date(2025, 5, 1), D("1.5")), ("B", date(2025, 1, 1), date(2025, 1, 1), D("0.4")),
        ("B", date(2024, 1, 1), date(2025, 1, 1), D("0.4")), ("C", date(2025, 1, 1), OPEN, D(0))],
        "field_id string, valid_from date, valid_to date, wi_share decimal(9,6)")
    bad = quality.invalid_shares(reg, "wi_share", "valid_from", "valid_to").select("field_id", "valid_from").collect()
    assert sorted(r["field_id"] for r in bad) == ["A", "B", "C"]
    over = {(r["field_id"], r["valid_from"]): r["overlapped_by"]
            for r in quality.overlaps(reg, ["field_id"], "valid_from", "valid_to").collect()}
    assert over == {("A", date(2025, 3, 1)): 1, ("A", date(2025, 4, 1)): 2}


def test_overlaps_against_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randrange(60), rng.randrange(15)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, s int, n int").select(
        "k", F.date_add(F.lit(DAY), F.col("s")).alias("a"), F.date_add(F.lit(DAY), F.col("s") + F.col("n")).alias("b"))
    want = defaultdict(int)
    for k, s in {(k, s) for k, s, _ in rows}:
        n = sum(1 for k2, s2, n2 in rows if k2 == k and s2 < s < s2 + n2)
        if n:
            want[(k, s)] = n
    got = {(r["k"], (r["a"] - DAY).days): r["overlapped_by"] for r in quality.overlaps(df, ["k"], "a", "b").collect()}
    assert got == dict(want)


# --- revisions and authority -----------------------------------------------------------

EVENTS = "source_system string, observation_id string, revision int, change_seq long, change_id string, v string"


def revisions(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    return resolve.resolved(df, ["source_system", "observation_id"], "revision", "change_seq", "change_id", ["v"])


ROWS = [("S", "clean", 1, 1, "c1", "x"), ("S", "clean", 2, 2, "c2", "y"), ("S", "clean", 2, 3, "c3", "y"),
        ("S", "clean", 2, 4, "c4", "y"), ("S", "clash", 1, 5, "c5", "x"), ("S", "clash", 2, 6, "c6", "y"),
        ("S", "clash", 2, 7, "c7", "z"), ("S", "nulls", 1, 8, "c8", None), ("S", "nulls", 1, 9, "c9", "n")]


def test_r06_r10_latest(spark):
    out = revisions(spark, ROWS)
    columns = ["observation_id", "change_id"]
    assert [tuple(r) for r in resolve.latest_of(out, columns).collect()] == [("clean", "c2")]
    assert {(r["observation_id"], r["revision"], r["deliveries"]) for r in resolve.conflicts_of(out).collect()} == {
        ("clash", 2, 2), ("nulls", 1, 2)}
    assert sorted(r["change_id"] for r in resolve.duplicates_of(out).collect()) == ["c3", "c4"]
    assert {r["change_id"] for r in resolve.latest_of(out, columns, "older").collect()} == {"c2", "c5"}


def test_a_missing_revision_is_the_lowest(spark):
    out = revisions(spark, [("S", "o", None, 1, "c1", "x"), ("S", "o", 2, 2, "c2", "y"), ("S", "p", None, 3, "c3", "z")])
    assert {tuple(r) for r in resolve.latest_of(out, ["observation_id", "change_id"]).collect()} == {("o", "c2"), ("p", "c3")}


def test_observation_rules(spark):
    rows = [("ok", "w1", "Oil", D(1), "bbl", "I"), ("noalias", "zz", "Oil", D(1), "bbl", "I"),
            ("unit", "w1", "Oil", D(1), "gal", "I"), ("missing", "w1", "Gas", None, "Mscf", "I"),
            ("negative", "w1", "Oil", D(-1), "bbl", "I"), ("other", "w1", "Sand", D(1), "bbl", "I"),
            ("deleted", "w1", "Oil", None, "bbl", "D"), ("two", "zz", "Oil", D(-1), "gal", "I"),
            ("nostream", "w2", "Oil", D(1), "bbl", "I")]
    df = spark.createDataFrame([("S", *r) for r in rows], "source_system string, observation_id string, well_ref string, "
                               "commodity string, quantity decimal(19,6), unit string, operation string")
    alias = spark.createDataFrame([("S", "w1", "W1"), ("S", "w2", "W2")],
                                  "source_system string, source_well_id string, well_id string")
    stream = spark.createDataFrame([("S1", "W1")], "stream_id string, well_id string")
    well = spark.createDataFrame([("W1", "F"), ("W2", "F")], "well_id string, field_id string")
    field = spark.createDataFrame([("F", "C")], "field_id string, country_id string")
    units = spark.createDataFrame([("Oil", "bbl", "bbl", D(1)), ("Gas", "Mscf", "Mscf", D(1))],
                                  "commodity string, uom string, standard_uom string, to_standard_factor decimal(18,9)")
    flagged = resolve.standardise(df, registry.crosswalk(alias, stream, well, field), units)
    got = {r["observation_id"]: r["failed_rules"] for r in flagged.collect()}
    assert got == {"ok": [], "noalias": ["R01"], "unit": ["R02"], "missing": ["R03"], "negative": ["R04"],
                   "other": ["R05"], "deleted": [], "two": ["R01", "R02", "R04"], "nostream": ["R01"]}
    issues = quality.rule_issues(flagged, "x", "observation_id", "source_system")
    assert issues.count() == 9 and issues.where("RuleId = 'R04'").count() == 2
    assert quality.quarantine(flagged, "B0").where("failed_rules = 'R01,R02,R04'").count() == 1
    values = {r["observation_id"]: (r["observation_status"], r["value_std"])
              for r in resolve.standard_values(quality.passed(flagged)).collect()}
    assert values == {"ok": ("CURRENT", D(1)), "deleted": ("RETRACTED", None)}


POLICY = [("P", "A", "C", 1, "FINAL"), ("P", "B", "ALL", 1, "FINAL"), ("P", "B", "C", 1, "FINAL"),
          ("P", "L", "ALL", 9, "NONE"), ("P", "N", "ALL", None, "FINAL")]


def authority(spark, rows):
    df = spark.createDataFrame([(k, s, o, st, D(v) if v else None, "CURRENT" if v else "RETRACTED", "C", DAY)
                                for k, s, o, st, v in rows],
                               "k string, source_system string, observation_id string, report_status string, "
                               "value_std decimal(19,6), observation_status string, country string, d date")
    policy = spark.createDataFrame([(*p, date(2025, 1, 1), OPEN) for p in POLICY] + [
        ("P", "A", "C", 0, "FINAL", date(2024, 1, 1), date(2025, 1, 1))],
        "policy_version string, source_system string, scope string, priority int, eligible_status string, "
        "valid_from date, valid_to date")
    scored = resolve.match_policy(df, policy, "source_system", "country", "d", "report_status")
    out = resolve.select_authoritative(scored, ["k"], ["observation_status", "value_std"],
                                       ["source_system", "observation_id"])
    evidence = resolve.decision_evidence(out, ["k"], ["source_system", "observation_id", "eligible", "priority"], "P",
                                         {"selected": "observation_id"})
    return out, evidence


CANDIDATES = [("one", "A", "o1", "FINAL", "5"), ("agree", "A", "o3", "FINAL", "5"), ("agree", "B", "o2", "FINAL", "5"),
              ("differ", "A", "o4", "FINAL", "5"), ("differ", "B", "o5", "FINAL", "6"),
              ("late", "A", "o6", "FINAL", "5"), ("late", "L", "o7", "NONE", "9"),
              ("none", "A", "o8", "DRAFT", "5"), ("unknown", "X", "o9", "FINAL", "5"),
              ("gone", "A", "o10", "FINAL", None), ("gone", "L", "o11", "FINAL", "3"),
              ("nopriority", "N", "o12", "FINAL", "1"), ("nopriority", "A", "o13", "FINAL", "2")]


def test_authority(spark):
    out, evidence = authority(spark, CANDIDATES)
    status = {r["k"]: (r["decision_status"], r["candidate_count"]) for r in out.key_status.collect()}
    assert status == {"one": ("SELECTED", 1), "agree": ("SELECTED", 2), "differ": ("REVIEW_REQUIRED", 2),
                      "late": ("SELECTED", 2), "none": ("NO_AUTHORITATIVE_SOURCE", 1),
                      "unknown": ("NO_AUTHORITATIVE_SOURCE", 1), "gone": ("SELECTED", 2), "nopriority": ("SELECTED", 2)}
    chosen = {r["k"]: (r["observation_id"], r["value_std"]) for r in out.selected.collect()}
    assert chosen == {"one": ("o1", D(5)), "agree": ("o3", D(5)), "late": ("o6", D(5)), "gone": ("o10", None),
                      "nopriority": ("o13", D(2))}
    decisions = {r["k"]: r for r in evidence.decisions.collect()}
    assert set(decisions) == set(status) - {"one"}
    assert decisions["late"]["reason"].startswith("Selected A (priority 1, FINAL) under P.")
    assert decisions["differ"]["selected"] is None
    assert {r["source_system"] for r in evidence.candidates.where("k = 'differ'").collect()} == {"A", "B"}
    assert decisions["late"]["authority_policy_version"] == "P"
    assert evidence.candidates.count() == len(CANDIDATES) - 1


def test_large_evidence_is_whole(spark):
    rows = [("big", "A", f"o{i}", "FINAL", "5") for i in range(1200)] + [("small", "A", "p", "FINAL", "1"),
                                                                        ("small", "B", "q", "FINAL", "1")]
    _, evidence = authority(spark, rows)
    counts = {r["k"]: r["candidate_count"] for r in evidence.decisions.collect()}
    assert counts == {"big": 1200, "small": 2}
    assert evidence.candidates.where("k = 'big'").count() == 1200


def test_repeats_of_a_revision_are_counted(spark):
    rows = [("o", 1, 7, "c1", "B0", "x"), ("o", 1, 7, "c1", "B1", "x"), ("o", 1, 7, "c1", "B1", "x"), ("o", 1, 9, "c2", "B1", "x"),
            ("p", 1, 1, "c3", "B0", "x"), ("q", 1, 1, "c4", "B0", "x"), ("q", 1, 2, "c5", "B0", "y")]
    df = spark.createDataFrame(rows, "obs string, rev int, seq long, change string, batch string, v string")
    found = resolve.resolved(df, ["obs"], "rev", "seq", "change", ["v"])
    assert sorted(r["change"] for r in resolve.duplicates_of(found).collect()) == ["c1", "c1", "c2"]  # four deliveries
    assert [(r["obs"], r["deliveries"]) for r in resolve.conflicts_of(found).collect()] == [("q", 2)]


def test_a_missing_end_or_date_is_an_issue_not_a_loss(spark):
    events = spark.createDataFrame([("e1", "q", 1, "2025-01-01 00:00:00", None), ("e2", "q", 1, None, "2025-01-01 02:00:00"),
                                    ("e3", "q", 1, "2025-01-01 00:00:00", "2025-01-01 02:00:00")],
                                   "event_id string, equipment_id string, change_seq int, start_utc string, end_utc string")
    equipment = spark.createDataFrame([("q", "f")], "equipment_id string, facility_id string")
    facility = spark.createDataFrame([("f", "a")], "facility_id string, field_id string")
    got = {r["event_id"]: (r["invalid"], r["duration_hours"]) for r in
           derive.downtime_events(events, equipment, facility).collect()}
    assert got == {"e1": (True, None), "e2": (True, None), "e3": (False, D(2))}


def test_rates_given_twice_do_not_double_an_amount(spark):
    cost = spark.createDataFrame([("c1", "2025-01-01", "USD", D(10)), ("c2", "2025-01-01", "EUR", D(10)),
                                  ("c3", "2025-01-01", "XXX", D(10))], "id string, m string, cur string, a decimal(19,4)")
    fx = spark.createDataFrame([("2025-01-01", "USD", D(2)), ("2025-01-01", "USD", D(2)), ("2025-01-01", "EUR", D(2)),
                                ("2025-01-01", "EUR", D(3))], "d string, cur string, r decimal(18,9)")
    got = {r["id"]: (r["amount_usd"], r["dq_status"]) for r in
           derive.convert_currency(cost, fx, {"m": "d", "cur": "cur"}, "a", "r").collect()}
    assert got == {"c1": (D(20), "VALID"), "c2": (None, "AMBIGUOUS_FX"), "c3": (None, "MISSING_FX")}


def test_measures_of_facts_without_a_shared_dimension_are_refused(spark):
    star = {"f1": spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), "f2": spark.createDataFrame([(1, 1)], "k int, v int"),
            "d1": spark.createDataFrame([(1, "a"), (2, "b")], "k int, n1 string"),
            "d2": spark.createDataFrame([(1, "x")], "k int, n2 string")}
    own = {"A": measures.Base("f1", lambda: F.sum("v")), "B": measures.Base("f2", lambda: F.sum("v"))}
    relations = [("f1", "k", "d1", "k"), ("f2", "k", "d2", "k")]
    ask = lambda by: measures.measure_query(star, ["A", "B"], by, measures=own, relations=relations)
    with pytest.raises(ValueError, match="two queries"):
        ask(["d1.n1", "d2.n2"])
    assert {tuple(r) for r in ask(["d1.n1"]).collect()} == {("a", 1, 1), ("b", 2, 1)}


# --- business rules --------------------------------------------------------------------

def test_b01_b02_b03(spark):
    stage = spark.createDataFrame([("B0", 1), ("B0", 2)], "batch_id string, v int")
    assert quality.staging_issues(stage, "t", "B1").count() == 3
    assert quality.staging_issues(stage, "t", "B0").count() == 0
    wide = spark.createDataFrame([("F", 2025, D(-1), None, D(3))], "field_id string, y int, m01 decimal(19,6), "
                                 "m02 decimal(19,6), m03 decimal(19,6)")
    months = derive.unpivot_months(wide, ["field_id"], "y", {"m01": 1, "m02": 2, "m03": 3})
    assert {(r["month_start"].month, r["dq_status"]) for r in months.collect()} == {
        (1, "INVALID"), (2, "INVALID"), (3, "VALID")}
    cost = spark.createDataFrame([("EUR", D(2)), ("USD", D(-1)), ("USD", D(3))], "c string, a decimal(19,4)")
    rates = spark.createDataFrame([("USD", D("1.5"))], "code string, r decimal(18,9)")
    out = derive.convert_currency(cost, rates, {"c": "code"}, "a", "r").collect()
    assert {(r["a"], r["amount_usd"], r["dq_status"]) for r in out} == {
        (D(2), None, "MISSING_FX"), (D(-1), D("-1.5"), "NEGATIVE_AMOUNT"), (D(3), D("4.5"), "VALID")}


def test_b04_b05(spark):
    at = lambda h: datetime(2025, 1, 10, h, tzinfo=timezone.utc)
    events = spark.createDataFrame([
        ("e1", "I", "q1", at(1), at(3), 1), ("e1", "I", "q1", at(1), at(4), 2), ("e2", "I", "zz", at(1), at(3), 3),
        ("e3", "I", "q1", at(3), at(3), 4)],
        "event_id string, incident_id string, equipment_id string, start_utc timestamp, end_utc timestamp, change_seq long")
    equipment = spark.createDataFrame([("q1", "f1")], "equipment_id string, facility_id string")
    facility = spark.createDataFrame([("f1", "F")], "facility_id string, field_id string")
    down = derive.downtime_events(events, equipment, facility)
    assert {(r["event_id"], r["invalid"], r["duration_hours"]) for r in down.collect()} == {
        ("e1", False, D(3)), ("e2", True, None), ("e3", True, None)}
    losses = spark.createDataFrame([
        ("l1", "e1", "w", DAY, 1), ("l2", "e1", "zz", DAY, 2), ("l3", "e9", "w", DAY, 3),
        ("l4", "e1", "w", date(2025, 1, 11), 4), ("l5", "e2", "w", DAY, 5)],
        "loss_id string, event_id string, well_ref string, business_date date, change_seq long")
    wells = spark.createDataFrame([("w", "F")], "well_id string, field_id string")
    checked = derive.loss_candidates(losses, wells, down.where("NOT invalid")).collect()
    assert {r["loss_id"] for r in checked if r["invalid"]} == {"l2", "l3", "l4", "l5"}


def test_allocation_is_exact(spark):
    rng = random.Random(3)
    rows = [(i, date(2024, rng.randrange(1, 13), 1), D(rng.randrange(10**10)) / 10**6) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, m date, a decimal(19,6)")
    out = derive.allocate_daily(df, "m", "a").groupBy("i").agg(F.sum("daily_amount").alias("s"), F.count("*").alias("n"))
    got = {r["i"]: r["s"] for r in out.collect()}
    assert got == {i: a for i, _, a in rows}


def test_divisor_keeps_its_fraction(spark):
    one = spark.range(1).select(derive.boe(F.lit(None).cast("decimal(19,6)"), F.lit("58").cast("decimal(19,6)"),
                                           F.lit("5.8").cast("decimal(9,3)")).alias("b")).first()
    assert one["b"] == D(10)


def test_dense_grid_keeps_gaps(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    grid = derive.key_day_grid(keys, F.lit(date(2025, 1, 1)), F.lit(date(2025, 1, 3)))
    daily = spark.createDataFrame([("a", date(2025, 1, 2), D(0), 1)], "k string, d date, v decimal(9,2), n int")
    out = derive.dense_daily(grid, daily, {"k": "k", "BusinessDate": "d"}, ["n"], 1, "n").collect()
    assert len(out) == 6 and sum(r["IsComplete"] for r in out) == 1
    assert sum(r["v"] is None for r in out) == 5


def test_effective_join_bounds(spark):
    reg = spark.createDataFrame([("k", date(2025, 1, 1), date(2025, 2, 1), 1), ("k", date(2025, 2, 1), OPEN, 2)],
                                "rk string, a date, b date, s int")
    days = spark.createDataFrame([("k", date(2024, 12, 31)), ("k", date(2025, 1, 31)), ("k", date(2025, 2, 1)),
                                  ("x", date(2025, 2, 1))], "k string, d date")
    out = registry.join_effective(days, reg, {"k": "rk"}, "d", "a", "b", ["s"]).collect()
    assert {(r["k"], r["d"], r["s"]) for r in out} == {
        ("k", date(2024, 12, 31), None), ("k", date(2025, 1, 31), 1), ("k", date(2025, 2, 1), 2),
        ("x", date(2025, 2, 1), None)}


# --- channels and answers --------------------------------------------------------------

def test_channels(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "measure string, filter string, value decimal(19,6)")
    out = recon.channel_consistency({
        "sql": frame(("gross", "MY", D("6364617.03")), ("gross", "DZ", D(1)), ("net", "DZ", D(4))),
        "report": frame(("gross", "MY", D("6364617")), ("gross", "DZ", D(3)))}, 1).collect()
    assert {(r["measure"], r["filter"]): r["status"] for r in out} == {
        ("gross", "MY"): "CONSISTENT", ("gross", "DZ"): "DIFFERENT", ("net", "DZ"): "MISSING"}


def test_answer_scores(spark):
    cases = [("NUMERIC", "23,901,265 BOE", "±1 BOE", "Total is 23,901,264 (PUB-S2)", "PASS"),
             ("NUMERIC", "23,901,265 BOE", "±1 BOE", "Total is 23,901,264", "REVIEW"),
             ("NUMERIC", "23,901,265 BOE", "±1 BOE", "Total is 23,901,200 PUB-S2", "FAIL"),
             ("NUMERIC", "100.0% (43,917 of 43,920)", "±0.1 pp", "100% in PUB-S2", "PASS"),
             ("LIST", "10 wells, 4,000 BOE", "exact", "10 wells lost 4000 BOE, PUB-S2", "PASS"),
             ("LOOKUP", "Equipment EQ_MY_A_01", "exact", "It was EQ_MY_A_01", "PASS"),
             ("LOOKUP", "Equipment EQ_MY_A_01", "exact", "unknown", "REVIEW"),
             ("REFUSAL", "declines", "", "I cannot", "REVIEW"), ("NUMERIC", "5", "exact", "", "FAIL")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, type string, expected_answer string, "
                               "tolerance string, actual_answer string, want string").withColumn(
        "publication_id", F.lit("PUB-S2"))
    for r in recon.score_answers(df).collect():
        assert r["auto_check"] == r["want"], cases[r["i"]]


def test_gate(spark):
    store = Store(spark, "gate_")
    ingest.record_status(store, "B0", "S1", "DONE")
    with pytest.raises(ingest.PipelineError) as error:
        quality.gate(store, "B0", {"S1": "DONE", "S2": "DONE"}, "PUB-B0")
    assert error.value.status == "NOT_READY"
    row = spark.createDataFrame([("k",)], "k string")
    assert quality.save_issues(store, [quality.issues(row, "W01", "e", "k"), quality.issues(row, "R07", "e", "k")],
                               "B0", "S1") == {"WARNING": 1, "BLOCKER": 1}
    with pytest.raises(ingest.PipelineError) as error:
        quality.gate(store, "B0", {"S1": "DONE"}, "PUB-B0")
    assert error.value.status == "QUALITY_FAILED" and "R07=1" in str(error.value)
    assert quality.save_issues(store, [quality.issues(row, "W01", "e", "k")], "B0", "S1") == {"WARNING": 1}
    assert quality.gate(store, "B0", {"S1": "DONE"}, "PUB-B0") == {"WARNING": 1}
    status = store.table("ops.batch_status").where("Stage = 'VALIDATE'").collect()
    assert [r["Status"] for r in status] == ["QUALITY_PASSED"]


def test_payload_hash_ignores_nothing_but_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert df.select(json_hash(["x", "y"]).alias("h")).distinct().count() == 2


def test_revisions_resolved_batch_by_batch(spark):
    """Repeats, conflicts that a later batch brings, earlier sequences that come later, null keys and equal rows."""
    draw = random.Random(3)
    rows = [(draw.choice(["A", "B", None]), draw.choice(["o1", "o2", "o3", None]), draw.choice([1, 2, 3, None]),
             draw.randint(1, 6), draw.choice(["c1", "c2", None]), draw.choice(["x", "y", None]), f"b{i % 3}")
            for i in range(160)]
    df = spark.createDataFrame(rows, "source string, obs string, revision int, seq int, record string, pay string, batch string")
    key, obs = (["source", "obs"], "revision", "seq", "record", ["pay"]), ["source", "obs"]
    whole = resolve.resolved(df, *key)
    state = resolve.resolved(df.where("batch = 'b0'"), *key)
    for batch in ("b1", "b2", "none"):
        state = resolve.extended(state, resolve.touched(state, df.where(F.col("batch") == batch), obs), *key)
        parts = [spark.createDataFrame(x.collect(), x.schema) for x in (state.firsts, state.further)]
        state = resolve.Resolved(*parts)
    for a, b in ((state.firsts, whole.firsts), (state.further, whole.further)):
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    assert whole.firsts.count() + whole.further.count() == len(rows)
    nulls_first = lambda values: tuple((v is not None, v) for v in values)
    for rule in ("unresolved", "older"):
        want = []
        for observation in {r[:2] for r in rows}:
            of = [r for r in rows if r[:2] == observation]
            for revision in sorted({r[2] for r in of}, key=lambda v: nulls_first([v]), reverse=True):
                sent = [r for r in of if r[2] == revision]
                if len({r[5] for r in sent}) == 1:
                    want.append(min(sent, key=lambda r: nulls_first(r[3:])))
                if rule == "unresolved" or len({r[5] for r in sent}) == 1:
                    break
        assert Counter(map(tuple, resolve.latest_of(whole, df.columns, rule).collect())) == Counter(want)
