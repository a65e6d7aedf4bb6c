"""Six chained batches through every stage, against figures computed in plain Python."""

from __future__ import annotations

from datetime import timedelta
from decimal import Decimal as D
from pathlib import Path

import packs as P
import pytest
from pyspark.sql import functions as F

from govpub.operators import graph, ingest, measures, publish, resolve
from govpub.operators.ingest import PipelineError
from govpub.plans import pipeline, reports
from govpub.sources.contract import STAR_TABLES, schema_violations
from govpub.sources.store import Store

APPROVER = "owner@example.org"


@pytest.fixture(scope="module")
def feed():
    return P.build()


@pytest.fixture(scope="module")
def chain(spark, feed, tmp_path_factory):
    """Run every batch; stage, approve and publish what passes, and keep the outcome of each."""
    store = Store(spark, "e2e_")
    concepts = tmp_path_factory.mktemp("registers") / "alignment.csv"
    concepts.write_text("SilverTable,SourceTable,Concept,AlignmentStatus\nsilver.well,ref.well,Well,ALIGNED\n")
    settings = pipeline.Settings(landing=str(tmp_path_factory.mktemp("landing")), alignment=str(concepts),
                                 slice_format="yyyy-MM-dd")
    publish.save_approvers(store, [(APPROVER, "Data owner", "PRODUCTION", True),
                                   ("old@example.org", "Former owner", "PRODUCTION", False)])
    outcome = {}
    for pack in P.PACKS:
        P.write_landing(spark, feed, pack, settings.landing)
        try:
            totals = pipeline.run_batch(store, settings, pack)
            pending = publish.publications(store).where(F.col("PublicationId") == f"PUB-{pack}").first()["Status"]
            shown = [r["PublicationId"] for r in publish.current_publication(store).collect()]
            publish.decide(store, f"PUB-{pack}", APPROVER.upper(), "APPROVE", "checked")
            publish.publish(store, f"PUB-{pack}")
            outcome[pack] = {"status": "PUBLISHED", "totals": totals, "pending": pending, "shown_before": shown}
        except PipelineError as error:
            outcome[pack] = {"status": error.status}
    rerun = pipeline.land(store, settings, "S2")
    assert pipeline.serve(store, settings, "S2") == outcome["S2"]["totals"]
    return {"store": store, "settings": settings, "outcome": outcome, "rerun": rerun}


def fact(chain, pack):
    return chain["store"].publication_slice("serve.fact_production_daily", f"PUB-{pack}")


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


@pytest.mark.parametrize("pack", P.PACKS)
def test_issues_and_status(chain, feed, pack):
    expected = P.expected(feed, pack)["issues"]
    found = (chain["store"].table("ops.dq_issue").where(F.col("BatchId") == pack)
             .groupBy("RuleId").count().collect())
    assert {r["RuleId"]: r["count"] for r in found} == expected
    blocked = any(r in expected for r in ("R01", "R02", "R03"))
    assert chain["outcome"][pack]["status"] == ("QUALITY_FAILED" if blocked else "PUBLISHED")


def test_bad_batch_counts(chain):
    rows = chain["store"].table("ops.dq_issue").where("BatchId = 'Q1'").groupBy("RuleId").count().collect()
    counts = {r["RuleId"]: r["count"] for r in rows}
    assert (counts["R01"], counts["R02"], counts["R03"]) == (10, 20, 5)
    assert fact(chain, "Q1").isEmpty()


@pytest.mark.parametrize("pack", [p for p in P.PACKS if p != "Q1"])
def test_totals(chain, feed, pack):
    want = P.expected(feed, pack)["totals"]
    f = fact(chain, pack)
    got = f.agg(F.count("*").alias("rows"), F.sum("IsComplete").alias("complete"), F.sum("OilBbl").alias("Oil"),
                F.sum("GasMscf").alias("Gas"), F.sum("WaterBbl").alias("Water"), F.sum("GrossBoe").alias("gross"),
                F.sum("NetWiBoe").alias("net")).first()
    for name in ("rows", "complete", "Oil", "Gas", "Water", "gross", "net"):
        assert got[name] == want[name], name
    totals = chain["outcome"][pack]["totals"]
    assert D(totals["TargetBoe"]) == want["target"] and D(totals["OpexUsd"]) == want["opex"]


def test_repeats_change_nothing_but_are_recorded(chain):
    issues = chain["store"].table("ops.dq_issue").where("BatchId = 'CD1' AND RuleId = 'R10'")
    assert issues.count() == 100 and issues.where("Severity = 'INFO'").count() == 100


def test_retractions(chain):
    f = fact(chain, "HX1")
    assert total(f, "RetractedCount") == 3 and f.where("IsComplete = 0").count() == 3
    assert f.where("RetractedCount = 1 AND OilBbl IS NULL AND GasMscf IS NOT NULL").count() == 3


def oil(chain, pack):
    well = chain["store"].publication_slice("serve.dim_well", f"PUB-{pack}").where("WellId = 'MY_B_W001'").first()
    day = int(P.S_DAY.strftime("%Y%m%d"))
    return fact(chain, pack).where((F.col("WellKey") == well["WellKey"]) & (F.col("DateKey") == day)).first()["OilBbl"]


def test_provisional_loses_and_is_recorded(chain):
    assert oil(chain, "QS1") == oil(chain, "HX1")
    decision = chain["store"].publication_slice("serve.source_decision", "PUB-QS1").collect()
    assert len(decision) == 1 and decision[0]["CandidateCount"] == 2
    assert decision[0]["SelectedSourceSystem"] == "SRC_MY_PROD"
    rows = chain["store"].publication_slice("serve.source_decision_candidate", "PUB-QS1").collect()
    assert {(r["DecisionId"], r["SourceSystem"]) for r in rows} == {(decision[0]["DecisionId"], "SRC_MY_PROD"),
                                                                    (decision[0]["DecisionId"], "SRC_MY_OPS")}


def test_final_correction(chain):
    assert oil(chain, "S2") - oil(chain, "QS1") == 5
    assert total(fact(chain, "S2"), "GrossBoe") - total(fact(chain, "QS1"), "GrossBoe") == 5
    assert total(fact(chain, "S2"), "NetWiBoe") - total(fact(chain, "QS1"), "NetWiBoe") == 2
    old, new = "PUB-QS1", "PUB-S2"
    changed = publish.publication_delta(chain["store"], "fact_production_daily", ["StreamId", "DateKey"], ["OilBbl"],
                                        old, new).collect()
    assert len(changed) == 1


def test_share_change_moves_net_only(chain, feed):
    before, after = P.expected(feed, "CD1")["totals"], P.expected(feed, "HX1")["totals"]
    assert after["net"] < before["net"]
    dz = chain["store"].publication_slice("serve.dim_asset", "PUB-HX1").where("AssetId = 'DZ_A'").first()["AssetKey"]
    shares = fact(chain, "HX1").where(F.col("AssetKey") == dz).groupBy("DateKey").agg(F.max("WiShare").alias("s"))
    assert shares.where("s = 0.35").count() == (P.END + timedelta(1) - P.SHARE_CHANGE).days + 1


def test_incident(chain):
    star = publish.gold(chain["store"])
    row = reports.incident_impact(star, "INC-1").first()
    assert (row["Affected Wells"], row["Lost BOE Gross"], row["Lost BOE Net WI"]) == (10, D(4000), D(1600))
    assert (row["Loss Value USD Gross"], row["Loss Value USD Net WI"]) == (D(177080), D(70832))
    assert row["Downtime Hours"] == 48 and row["Downtime Events"] == 4
    assert star["dim_incident"].where("IncidentCategory = 'MAINTENANCE_NO_LOSS'").count() == 1


def test_star_fits_its_contract(chain):
    for name, table in STAR_TABLES.items():
        assert schema_violations(publish.gold(chain["store"])[name], table).collect() == [], name


def test_lifecycle(chain):
    store, outcome = chain["store"], chain["outcome"]
    assert outcome["S2"]["pending"] == "APPROVAL_PENDING" and outcome["S2"]["shown_before"] == ["PUB-QS1"]
    states = {r["PublicationId"]: (r["Status"], r["SupersededBy"]) for r in publish.publications(store).collect()}
    assert states == {"PUB-B0": ("SUPERSEDED", "PUB-CD1"), "PUB-CD1": ("SUPERSEDED", "PUB-HX1"),
                      "PUB-HX1": ("SUPERSEDED", "PUB-QS1"), "PUB-Q1": ("QUALITY_FAILED", None),
                      "PUB-QS1": ("SUPERSEDED", "PUB-S2"), "PUB-S2": ("PUBLISHED", None)}
    assert publish.manifest_check(store).where("NOT ok").isEmpty()
    assert publish.single_publication(publish.gold(store)).where("Publications <> 1").isEmpty()
    assert publish.stage(store, "PUB-S2") == "ALREADY_PUBLISHED"
    assert publish.publish(store, "PUB-S2")["Status"] == "PUBLISHED"
    spans = publish.validity_intervals(publish.publications(store), "PublicationId", "PublishedAtUtc", "SupersededBy")
    rows = {r["PublicationId"]: r for r in spans.collect()}
    assert set(rows) == set(states) - {"PUB-Q1"}
    seen = publish.gold_as_of(store, rows["PUB-QS1"]["PublishedAtUtc"])["dim_well"].first()["PublicationId"]
    assert seen == "PUB-QS1"


def test_refused_transitions(chain):
    store = chain["store"]
    for code, call in [(50010, lambda: publish.stage(store, "PUB-none")),
                       (50020, lambda: publish.decide(store, "PUB-S2", APPROVER, "MAYBE")),
                       (50021, lambda: publish.decide(store, "PUB-S2", "old@example.org")),
                       (50022, lambda: publish.decide(store, "PUB-S2", APPROVER)),
                       (50030, lambda: publish.publish(store, "PUB-Q1"))]:
        with pytest.raises(publish.LifecycleError) as error:
            call()
        assert error.value.code == code


def test_alignment_is_input(chain):
    rows = chain["store"].table("ops.concept_alignment").collect()
    assert [(r["Concept"], r["MappingVersion"], r["MasterSnapshotBatchId"]) for r in rows] == [("Well", "ALIGN-1.0", "S2")]


def test_rerun_adds_nothing_and_order_is_kept(chain):
    assert set(chain["rerun"].values()) == {0}
    log = chain["store"].table("ops.ingestion_log").where("BatchId = 'S2'")
    assert total(log, "NewBronzeRows") == 0
    with pytest.raises(PipelineError) as error:
        ingest.require_latest(chain["store"], "B0")
    assert error.value.status == "NOT_LATEST"


def test_wrong_landing_changes_nothing(chain, spark, feed):
    store, settings = chain["store"], chain["settings"]
    path = f"{settings.landing}/ZZ"
    batch = spark.read.parquet(f"{settings.landing}/S2/ctl__source_batch").withColumns(
        {"batch_id": F.lit("ZZ"), "parent_batch_id": F.lit("S2")})
    batch.write.parquet(f"{path}/ctl__source_batch")
    spark.createDataFrame([("ZZ", "ref__country", 5, "x")], "batch_id string, entity_name string, row_count long, "
                          "content_sha256 string").write.parquet(f"{path}/ctl__batch_entity")
    spark.read.parquet(f"{settings.landing}/S2/ref__country").write.parquet(f"{path}/ref__country")
    before = store.table("bronze.ref__country").count()
    with pytest.raises(PipelineError) as error:
        pipeline.land(store, settings, "ZZ")
    assert error.value.status == "LANDING_MISMATCH" and "foreign 3" in str(error.value)
    assert store.table("bronze.ref__country").count() == before
    assert ingest.last_commit(store)["BatchId"] == "S2"


def test_projection_and_graph(chain, feed):
    store = chain["store"]
    counts = pipeline.project_publication(store, chain["settings"])
    assert counts["well"] == 19 and counts["wellbore"] == 23 and counts["facility"] == 4 and counts["publication"] == 1
    gross = total(store.table("ai.reporting_stream_daily"), "gross_boe")
    assert gross == P.expected(feed, "S2")["totals"]["gross"]
    assert store.table("ai.publication").first()["gross_boe_total"] == str(gross)
    stamps = store.table("ai.well").select("business_publication_id").distinct().collect()
    assert [r[0] for r in stamps] == ["PUB-S2"]
    edges, nodes = pipeline.entity_edges(store), pipeline.entity_nodes(store)
    assert edges.select("rel").distinct().count() == len(graph.RELATIONSHIPS)
    assert graph.node_violations(nodes).isEmpty() and graph.dangling_edges(edges, nodes).isEmpty()
    path = ["causedBy", "occurredOn", "installedAt", "partOf", "locatedIn"]
    ends = graph.traverse(edges, path).groupBy("end_id").count().collect()
    assert [(r["end_id"], r["count"]) for r in ends] == [("MY", 40)]
    weights = store.table("ai.loss_allocation").select(F.col("loss_id").alias("id"),
                                                       F.col("lost_boe_gross").alias("weight"))
    reached = graph.reach_totals(edges, ["affects", "belongsTo"], weights).collect()
    assert [(r["end_id"], r["weight"], r["starts"]) for r in reached] == [("MY_A", D(4000), 40)]
    publish.record_consumer(store, "PUB-S2", "AI_SERVING", "READY")
    publish.record_consumer(store, "PUB-S2", "AI_SERVING", "READY", "again")
    assert store.table("ops.consumer_status").count() == 1


def test_measures_and_reports(chain, feed):
    store = chain["store"]
    star, want = publish.gold(store), P.expected(feed, "S2")["totals"]
    rows = {r["CountryName"]: r for r in measures.measure_query(
        star, ["Gross BOE", "Target BOE", "Target Achievement %", "Opex per BOE USD", "Water Cut %", "Affected Wells"],
        ["dim_asset.CountryName"]).collect()}
    assert {c: rows[f"Country {c}"]["Gross BOE"] for c in ("DZ", "MY", "IQ")} == {
        c: want[f"gross_{c}"] for c in ("DZ", "MY", "IQ")}
    assert rows["Country MY"]["Affected Wells"] == 10 and rows["Country DZ"]["Affected Wells"] is None
    one = measures.measure_query(star, ["Gross BOE", "Stream Days", "Data Completeness %", "Target BOE"]).collect()
    assert len(one) == 1 and one[0]["Gross BOE"] == want["gross"] and one[0]["Stream Days"] == want["rows"]
    everything = measures.measure_query(star, list(measures.MEASURES)).first()
    assert everything["Downtime Events"] == 5 and everything["Source Decisions"] == 1
    trust = measures.trust(publish.publications(store), star["fact_production_daily"]).first()
    assert trust["Current Publication"] == "PUB-S2" and trust["Gold Matches Publication"] == "Consistent"
    assert trust["Trust Banner"].startswith("SSOT PUB-S2 | approved by OWNER@EXAMPLE.ORG | published ")
    view = measures.entitled(star, ["IQ"])
    assert measures.measure_query(view, ["Gross BOE"]).first()[0] == want["gross_IQ"]
    assert measures.measure_query(view, ["Lost BOE Gross"]).isEmpty()


def test_report_queries(chain):
    store = chain["store"]
    star = publish.gold(store)
    country = {r["CountryName"]: r for r in reports.by_country(star).collect()}
    assert country["Country MY"]["CompletenessPct"] == D("100.00")
    matrix = reports.asset_matrix(star).collect()
    assert {r["level"] for r in matrix} == {0, 1, 3} and len(matrix) == 4 + 3 + 1
    assert reports.top_wells(star).count() == 10
    assert reports.daily_actual_target(star).where("`Gross BOE` IS NOT NULL").count() == 9
    assert reports.opex_by_month_category(star).count() == 4
    assert reports.opex_per_boe(star).count() == 3
    assert reports.explain_decision(star, "MY_B_W001", P.S_DAY, "Oil").count() == 1
    assert reports.quality_evidence(store).where("Status = 'QUALITY_FAILED'").count() == 1
    assert reports.issue_rollup(store).where("RuleId = 'R02'").first()["Issues"] == 20
    assert reports.source_profile(store, chain["settings"], "B0").count() == 9
    assert reports.policy_in_force(store, "S2").count() == 5
    assert reports.source_incident_check(store, "B0", "INC-1").first()["affected_wells"] == 10
    assert reports.landing_log(store).count() > 0 and reports.commit_log(store).count() == 6
    assert reports.staging_totals(store).count() >= 2
    assert reports.well_aliases(store).where("well_id = 'MY_B_W001'").count() == 2
    assert reports.multi_bore_wells(store).count() == 4
    assert reports.golden_totals(store).count() == 3
    assert reports.loss_by_well(star, "INC-1").count() == 10
    assert reports.incident_equipment(star, "INC-1").first()["EquipmentDowntimeHours"] == 48
    assert reports.well_passport(star, "MY_B_W001").first()["WellboreCount"] == 2
    assert reports.one_day(star, "MY_B_W001", P.S_DAY).first()["OilBbl"] == oil(chain, "S2")
    assert reports.well_series(star, "MY_B_W001").count() == 9
    versions = reports.value_in_versions(store, ["PUB-QS1", "PUB-S2"], "MY_B_W001", P.S_DAY).collect()
    assert sorted(r["OilBbl"] for r in versions) == [oil(chain, "QS1"), oil(chain, "S2")]
    page = reports.trust_page(store)
    assert page["publications"].count() == 6 and page["decisions"].count() == 1
    assert reports.current(store).first()["PublicationId"] == "PUB-S2"
    assert reports.event_trail(store).first()["EventType"] == "STAGED"


def test_failed_rerun_of_a_pending_candidate_is_refused(chain):
    """Runs after the chain: S2's candidate is built once more under another id, staged, spoilt, and built again."""
    store = chain["store"]
    publication = "PUB-T"
    for name in (*STAR_TABLES, "publication_row_count", "publication_candidate"):
        rows = store.publication_slice(f"serve.{name}", "PUB-S2").withColumn("PublicationId", F.lit(publication))
        store.append(rows, f"serve.{name}")
    with pytest.raises(publish.LifecycleError) as error:
        publish.stage(store, publication)  # its rows were never checked
    assert error.value.code == 50012
    checks = store.publication_slice(publish.CHECKS, "PUB-S2").drop("PublicationId")
    checks = store.spark.createDataFrame(checks.collect(), checks.schema)  # not read from the table it is written to
    assert publish.record_reconciliation(store, publication, checks) == []
    publish.stage(store, publication)
    publish.withdraw(store, publication, "built again")
    spoilt = checks.withColumns({"ok": F.col("check_name") != "water"})
    assert [r["check_name"] for r in publish.record_reconciliation(store, publication, spoilt)] == ["water"]
    for code, call in ((50022, lambda: publish.decide(store, publication, APPROVER)),
                       (50012, lambda: publish.stage(store, publication)), (50030, lambda: publish.publish(store, publication))):
        with pytest.raises(publish.LifecycleError) as error:
            call()
        assert error.value.code == code
    publish.record_reconciliation(store, publication, checks)
    publish.stage(store, publication)
    publish.decide(store, publication, APPROVER)
    publish.record_reconciliation(store, publication, spoilt)
    with pytest.raises(publish.LifecycleError) as error:
        publish.publish(store, publication)
    assert error.value.code == 50032
    assert [r["PublicationId"] for r in publish.current_publication(store).collect()] == ["PUB-S2"]


def kept_state(store):
    """Every kept table without the stamp of the batch that wrote a row."""
    return {t: pipeline.kept_rows(store, t).drop("decided_in_batch", "quarantined_in_batch")
            for t in pipeline.KEPT}


def test_kept_revisions_equal_all_deliveries_at_once(chain):
    store, settings = chain["store"], chain["settings"]
    whole = resolve.resolved(pipeline.canonical_events(store, settings), *pipeline.REVISION_KEY, pipeline.payload_columns())
    for table, b in ((pipeline.REVISION, whole.firsts), (pipeline.REDELIVERY, whole.further)):
        a = pipeline.kept_rows(store, table)
        assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_batch_reads_its_own_feed_partitions_only(chain):
    new = pipeline.canonical_events(chain["store"], chain["settings"], ["S2"])
    feeds = [f for f in new.inputFiles() if "/batch_id=" in f]
    assert feeds and all("/batch_id=S2/" in f for f in feeds)
    # earlier deliveries of the touched observations come out of the kept state, a small part of all
    touched = chain["store"].table(pipeline.TOUCHED).count()
    assert new.count() <= touched < pipeline.canonical_events(chain["store"], chain["settings"]).count()


def test_changed_slices_equal_a_full_run(chain):
    """The last batch once more from the state before it, then all slices anew: the same rows in every kept table."""
    store, settings = chain["store"], chain["settings"]
    state = {r["BatchId"]: r for r in store.table(pipeline.STATE).collect()}
    assert state["B0"]["Slices"] is None and state["S2"]["Slices"] == [str(P.S_DAY)]
    first = kept_state(store)
    counts = pipeline.conform_production(store, settings, "S2")
    again = kept_state(store)
    store.write(store.table(pipeline.STATE).where("false"), pipeline.STATE)
    assert pipeline.conform_production(store, settings, "S2") == counts
    whole = kept_state(store)
    for t in pipeline.KEPT:
        for a, b in ((first[t], whole[t]), (again[t], whole[t])):
            assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), t


def test_a_died_run_is_put_aside(chain, monkeypatch):
    """A run that dies between two tables leaves some of them new; the next run starts from the versions of the batch before."""
    store, settings = chain["store"], chain["settings"]
    pipeline.conform_production(store, settings, "S2")
    want = {t: rows.count() for t, rows in kept_state(store).items()}
    known, calls, keep = store.table(pipeline.STATE).collect(), [], pipeline.keep

    def dies(store_, df, table, slices):
        if len(calls) == 4:
            raise RuntimeError("executor lost")
        calls.append(table)
        keep(store_, df.limit(1), table, slices)  # what it wrote so far is wrong, too

    monkeypatch.setattr(pipeline, "keep", dies)
    with pytest.raises(RuntimeError):
        pipeline.conform_production(store, settings, "S2")
    monkeypatch.undo()
    assert store.table(pipeline.STATE).collect() == known
    pipeline.conform_production(store, settings, "S2")
    assert {t: rows.count() for t, rows in kept_state(store).items()} == want


def test_only_changed_slices_are_read_and_written(chain):
    store = chain["store"]
    slices = ["2025-09-17"]
    files = pipeline.kept_rows(store, pipeline.LATEST, slices).inputFiles()
    assert all(f"/{pipeline.SLICE}=2025-09-17/" in f for f in files)
    before = store.versioned(pipeline.LATEST).commit_of()["live"]
    store.replace_slices(store.table(pipeline.LATEST, only={pipeline.SLICE: slices}), pipeline.LATEST, pipeline.SLICE, slices)
    after = store.versioned(pipeline.LATEST).commit_of()["live"]
    moved = [p["path"] for p in before if p not in after]
    assert moved and len(after) == len(before) > len(moved) and all(f"{pipeline.SLICE}=2025-09-17" in path for path in moved)
    assert store.table(pipeline.LATEST, store.version(pipeline.LATEST) - 1).count() == store.table(pipeline.LATEST).count()


def test_inputs_of_a_publication_are_read_as_they_were(chain):
    store = chain["store"]
    for pack in ("CD1", "HX1"):
        share = pipeline.published_input(store, f"PUB-{pack}", "silver_ext.working_interest")
        assert share.select("master_snapshot_batch_id").distinct().collect()[0][0] == pack
    assert store.table("silver_ext.working_interest").first()["master_snapshot_batch_id"] == "S2"


def test_changed_replay_is_refused(chain, spark):
    store, settings = chain["store"], chain["settings"]
    other = pipeline.Settings(landing=f"{settings.landing}-changed")
    for path in Path(f"{settings.landing}/S2").iterdir():
        df = spark.read.parquet(str(path))
        if path.name == "ref__country":
            df = df.withColumn("country_name", F.concat("country_name", F.lit("!")))
        df.write.parquet(f"{other.landing}/S2/{path.name}")
    before = store.table("bronze.ref__country").count()
    with pytest.raises(PipelineError) as error:
        pipeline.land(store, other, "S2")
    assert error.value.status == "RESEND_CHANGED" and "ref__country" in str(error.value)
    assert store.table("bronze.ref__country").count() == before
