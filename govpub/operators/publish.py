"""Publication lifecycle over write-once slices and one append-only ledger.

A publication's rows are one partition of every published table and never change after the
candidate is written. Approval, publication and supersession only append to the ledger. A transition is
one numbered commit with all its rows, so it becomes visible as a whole or not at all, and readers
resolve the current publication from the ledger first.

Any number of writers may work at once. Each decides on the ledger as it stands and tries to add the next number; who
comes second decides again on the ledger with the other's commit, and is refused if its transition is no longer
allowed. A publication is also refused if another one became current since it was compared.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from govpub.functions.skew import latest_by
from govpub.operators.ingest import utc_now
from govpub.operators.quality import issue_summary
from govpub.sources.contract import STAR_TABLES
from govpub.sources.extract import in_parallel
from govpub.sources.store import Store
from govpub.sources.versions import CommitLog, instant

LEDGER = "ops.publication_ledger"
STATE_DDL = ("BatchId string, ParentBatchId string, DatasetVersion string, AuthorityPolicyVersion string, "
             "MappingVersion string, KpiContractVersion string, UomFactorVersion string, PeriodStart date, "
             "PeriodEnd date, ControlTotalsJson string, BlockerCount int, WarningCount int, InfoCount int, "
             "Status string, StagedAtUtc timestamp, DecidedBy string, DecidedAtUtc timestamp, "
             "DecisionComment string, PublishedAtUtc timestamp, SupersededBy string, RunId string")
EVENT_DDL = "EventType string, Actor string, Detail string, EventAtUtc timestamp"
LEDGER_DDL = f"Seq long, PublicationId string, {EVENT_DDL}, {STATE_DDL}"
STATE_COLUMNS = [part.split()[0] for part in STATE_DDL.split(", ")]

# Control total -> (table, column, decimal type).
CONTROL_TOTALS = {
    "GrossBoe": ("fact_production_daily", "GrossBoe", "decimal(38,6)"),
    "NetWiBoe": ("fact_production_daily", "NetWiBoe", "decimal(38,6)"),
    "TargetBoe": ("fact_target_daily", "TargetBoe", "decimal(38,6)"),
    "OpexUsd": ("fact_operating_cost_monthly", "AmountUsd", "decimal(38,4)"),
    "LostBoeGross": ("fact_loss_allocation", "LostBoeGross", "decimal(38,6)"),
    "ValueUsdGross": ("fact_loss_allocation", "ValueUsdGross", "decimal(38,4)"),
}


class LifecycleError(RuntimeError):
    """A transition was refused; `code` is the stable number of the reason."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


# --- reconciliation --------------------------------------------------------------------

def reconcile(sides: Sequence[tuple[str, tuple[DataFrame, Column], tuple[DataFrame, Column]]]) -> DataFrame:
    """Compare figures of frames: (check_name, left_value, right_value, ok). Names are plain identifiers.

    Each side is a frame and an aggregate over it. All figures of one frame come out of one aggregate, so a
    frame is read once however many checks use it; all checks run as one job. A missing total is zero.
    """
    figures: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, left, right in sides:
        for end, (frame, figure) in (("left", left), ("right", right)):
            value = F.coalesce(figure.cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))
            figures.setdefault(id(frame), (frame, []))[1].append(value.alias(f"{end}_{name}"))
    rows = []
    for frame, values in figures.values():
        found = frame.agg(*values)
        rows.append(found.unpivot([], found.columns, "figure", "value"))

    def of(end: str) -> Column:
        return F.max(F.when(F.col("figure").startswith(f"{end}_"), F.col("value"))).alias(f"{end}_value")

    both = reduce(DataFrame.unionByName, rows).groupBy(
        F.regexp_replace("figure", "^(left|right)_", "").alias("check_name")).agg(of("left"), of("right"))
    return both.withColumn("ok", F.col("left_value") == F.col("right_value"))


CHECKS = "serve.publication_reconciliation"


def record_reconciliation(store: Store, publication_id: str, checks: DataFrame, broken: Sequence[Row] = ()) -> list[Row]:
    """Store every check of a slice, contract violations as checks that failed; returns the failed ones."""
    found = store.spark.createDataFrame(
        [(f"{r['table_name']}.{r['column_name']} {r['problem']}", None, None, False) for r in broken],
        "check_name string, left_value decimal(38,6), right_value decimal(38,6), ok boolean")
    store.replace_slice(checks.unionByName(found).coalesce(1), CHECKS, {"PublicationId": publication_id})
    return store.publication_slice(CHECKS, publication_id).where("NOT ok").orderBy("check_name").collect()


def verified(store: Store, publication_id: str) -> bool:
    """Whether the rows now in the slice were checked and no check failed."""
    if not store.exists(CHECKS):
        return False
    row = store.publication_slice(CHECKS, publication_id).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad")).first()
    return row["n"] > 0 and row["bad"] == 0


# --- candidate -------------------------------------------------------------------------

def write_candidate(store: Store, tables: Mapping[str, DataFrame], publication_id: str) -> None:
    """Write the slice of this publication in every table; a rerun replaces it."""
    in_parallel(lambda item: store.replace_slice(item[1], f"serve.{item[0]}", {"PublicationId": publication_id}),
                list(tables.items()))


def withdraw(store: Store, publication_id: str, reason: str) -> None:
    """Take back a registration that waits for approval; it has to be staged again."""
    def entries(open_: dict) -> list[dict]:
        state = open_.get(publication_id)
        if not state or state["Status"] != "APPROVAL_PENDING":
            return []
        return [_entry(state, "WITHDRAWN", "pipeline", reason, utc_now(), Status="WITHDRAWN")]

    _commit(store, entries)


def wrong_counts(store: Store, publication_id: str) -> bool:
    """Whether the stored rows of any table differ from the counts registered for the candidate."""
    expected = store.publication_slice("serve.publication_row_count", publication_id)
    wrong = (expected.join(table_counts(store, publication_id), "TableName", "full")
             .where(~F.col("ExpectedRows").eqNullSafe(F.col("ActualRows"))))
    return not wrong.isEmpty() or expected.count() != len(STAR_TABLES)


def table_counts(store: Store, publication_id: str, tables: Sequence[str] = tuple(STAR_TABLES),
                 namespace: str = "serve") -> DataFrame:
    parts = [store.table(f"{namespace}.{t}", only={"PublicationId": [publication_id]})
             .agg(F.count(F.lit(1)).alias("ActualRows")).select(F.lit(t).alias("TableName"), "ActualRows")
             for t in tables if store.exists(f"{namespace}.{t}")]
    return reduce(DataFrame.unionByName, parts)


def is_frozen(store: Store, publication_id: str) -> bool:
    """Approved and ever published slices are never rewritten: consumers and history read them."""
    state = _state(store, publication_id)
    return bool(state) and (state["PublishedAtUtc"] is not None or state["Status"] == "APPROVED")


def control_totals(store: Store, publication_id: str) -> dict[str, str]:
    """The six control totals of one publication as exact decimal text, one pass per table."""
    by_table: dict[str, list[str]] = {}
    for name, (table, _, _) in CONTROL_TOTALS.items():
        by_table.setdefault(table, []).append(name)
    out: dict[str, str] = {}
    for table, names in by_table.items():
        sums = [F.coalesce(F.sum(CONTROL_TOTALS[n][1]), F.lit(0)).cast(CONTROL_TOTALS[n][2]).cast("string").alias(n)
                for n in names]
        out |= store.publication_slice(f"serve.{table}", publication_id).agg(*sums).first().asDict()
    return {n: out[n] for n in CONTROL_TOTALS}


def register_candidate(store: Store, publication_id: str, manifest: Mapping[str, object],
                       input_versions: Mapping[str, object]) -> dict[str, str]:
    """Row counts, control totals, input versions and the manifest row of a written candidate."""
    counts = table_counts(store, publication_id).select("TableName", F.col("ActualRows").alias("ExpectedRows"))
    store.replace_slice(counts.coalesce(1), "serve.publication_row_count", {"PublicationId": publication_id})
    totals = control_totals(store, publication_id)
    row = {**manifest, "SilverVersionsJson": json.dumps(input_versions, default=str, sort_keys=True),
           "ControlTotalsJson": json.dumps(totals), "CreatedAtUtc": utc_now()}
    ddl = ("BatchId string, ParentBatchId string, DatasetVersion string, AuthorityPolicyVersion string, "
           "MappingVersion string, KpiContractVersion string, UomFactorVersion string, "
           "MasterSnapshotBatchId string, PeriodStart date, PeriodEnd date, SilverVersionsJson string, "
           "ControlTotalsJson string, BlockerCount int, WarningCount int, InfoCount int, RunId string, "
           "CreatedAtUtc timestamp")
    names = [part.split()[0] for part in ddl.split(", ")]
    frame = store.spark.createDataFrame([tuple(row.get(n) for n in names)], ddl)
    store.replace_slice(frame, "serve.publication_candidate", {"PublicationId": publication_id})
    return totals


# --- ledger ----------------------------------------------------------------------------

def ledger_log(store: Store) -> CommitLog:
    return CommitLog(store.spark, f"{store.folder(LEDGER)}/log")


def ledger(store: Store) -> DataFrame:
    """Every row of the ledger; Seq orders them."""
    log = ledger_log(store)
    if not log.numbers():
        return store.spark.createDataFrame([], LEDGER_DDL)
    commits = store.spark.read.schema(f"entries array<struct<{LEDGER_DDL.replace(' ', ': ').replace(',: ', ', ')}>>").json(
        log.folder)
    return commits.select(F.inline("entries"))


def publications(store: Store) -> DataFrame:
    """Present state of every publication: its last ledger row."""
    return latest_by(ledger(store), ["PublicationId"], ["Seq"]).select("PublicationId", *STATE_COLUMNS)


def publication_events(store: Store) -> DataFrame:
    return ledger(store).select("PublicationId", "EventType", "Actor", "Detail", "EventAtUtc", "Seq")


def current_publication(store: Store) -> DataFrame:
    return publications(store).where("Status = 'PUBLISHED'")


def publication_history(store: Store) -> DataFrame:
    return publications(store).withColumn("LastChangeUtc", F.coalesce("PublishedAtUtc", "DecidedAtUtc", "StagedAtUtc"))


def _state(store: Store, publication_id: str) -> Row | None:
    return publications(store).where(F.col("PublicationId") == publication_id).first()


def _current_ids(store: Store) -> list[str]:
    return sorted(r["PublicationId"] for r in current_publication(store).collect())


# States that a transition can start from; a commit carries the rows of these publications along.
OPEN = ("APPROVAL_PENDING", "APPROVED", "PUBLISHED")


def _commit(store: Store, entries: Callable[[dict[str, dict]], Sequence[dict]]) -> None:
    """Add the ledger rows of one transition as one commit.

    `entries` gets the open publications as of the last commit and raises if the transition is not allowed; it is asked
    again whenever another commit took the number. No rows means there is nothing left to do.
    """
    names = [part.split()[0] for part in LEDGER_DDL.split(", ")]

    def plain(value):
        return instant(value) if isinstance(value, datetime) else value.isoformat() if isinstance(value, date) else value

    def build(last: dict | None) -> dict | None:
        open_ = last["open"] if last else {}
        seq = last["entries"][-1]["Seq"] if last else 0
        rows = [{n: plain({**e, "Seq": seq + i}.get(n)) for n in names} for i, e in enumerate(entries(open_), 1)]
        after = {**open_, **{r["PublicationId"]: r for r in rows}}
        return {"entries": rows, "open": {k: r for k, r in after.items() if r["Status"] in OPEN}} if rows else None

    ledger_log(store).add(build)


def _of(open_: Mapping[str, dict], *statuses: str, but: str | None = None) -> list[dict]:
    return [r for k, r in sorted(open_.items()) if r["Status"] in statuses and k != but]


def _entry(state: Mapping, event: str, actor: str, detail: str | None, at: datetime, **changes) -> dict:
    return {**state, **changes, "EventType": event, "Actor": actor, "Detail": detail, "EventAtUtc": at}


def _superseded(rows: Sequence[dict], event: str, publication_id: str, now: datetime) -> list[dict]:
    return [_entry(r, event, "system", f"Superseded by {publication_id}", now, Status="SUPERSEDED",
                   SupersededBy=publication_id) for r in rows]


def stage(store: Store, publication_id: str, run_id: str = "manual") -> Row | str:
    """Verify a candidate and put it up for approval; another pending candidate is superseded."""
    state = _state(store, publication_id)
    if state and state["Status"] == "PUBLISHED":
        return "ALREADY_PUBLISHED"
    candidates = (store.publication_slice("serve.publication_candidate", publication_id).limit(2).collect()
                  if store.exists("serve.publication_candidate") else [])
    if len(candidates) != 1:
        raise LifecycleError(50010, f"{publication_id} has no single publication candidate")
    if wrong_counts(store, publication_id):
        raise LifecycleError(50011, f"{publication_id}: stored rows differ from the candidate's row counts")
    if not verified(store, publication_id):
        raise LifecycleError(50012, f"{publication_id}: its rows did not pass the reconciliation")
    c = candidates[0].asDict()
    fresh = {k: c.get(k) for k in STATE_COLUMNS if k in c}

    def entries(open_: dict) -> list[dict]:
        if publication_id in open_ and open_[publication_id]["Status"] == "PUBLISHED":
            return []
        now, pending = utc_now(), _of(open_, "APPROVAL_PENDING", but=publication_id)
        return [*_superseded(pending, "SUPERSEDED_BEFORE_APPROVAL", publication_id, now),
                _entry({"PublicationId": publication_id, **fresh}, "STAGED", "pipeline", f"Run {run_id}", now,
                       Status="APPROVAL_PENDING", StagedAtUtc=now, RunId=run_id or c["RunId"])]

    _commit(store, entries)
    return _state(store, publication_id)


def decide(store: Store, publication_id: str, actor: str, decision: str = "APPROVE", comment: str | None = None,
           domain: str = "PRODUCTION") -> Row:
    """Approve or reject a pending publication; only an active approver of the domain may."""
    if decision not in ("APPROVE", "REJECT"):
        raise LifecycleError(50020, "The decision is APPROVE or REJECT")
    approver = (store.table("ops.authorized_approver")
                .where((F.lower("ApproverUpn") == actor.lower()) & F.col("IsActive") & (F.col("DataDomain") == domain)))
    if approver.isEmpty():
        raise LifecycleError(50021, f"{actor} is no active approver for {domain}")
    status = "APPROVED" if decision == "APPROVE" else "REJECTED"

    def entries(open_: dict) -> list[dict]:
        state, now = open_.get(publication_id), utc_now()
        if not state or state["Status"] != "APPROVAL_PENDING":
            raise LifecycleError(50022, f"{publication_id} is not waiting for approval")
        return [_entry(state, status, actor, comment, now, Status=status, DecidedBy=actor, DecidedAtUtc=now,
                       DecisionComment=comment)]

    _commit(store, entries)
    return _state(store, publication_id)


def publish(store: Store, publication_id: str, run_id: str = "manual") -> Row:
    """Make an approved publication the current one, after its reconciliation, row counts and all six control
    totals were compared once more. Refused if another publication became the current one meanwhile."""
    before = _current_ids(store)
    state = _state(store, publication_id)
    if state and state["Status"] == "PUBLISHED":
        return state
    if not state or state["Status"] != "APPROVED":
        raise LifecycleError(50030, f"{publication_id} is not approved")
    stored, manifest = control_totals(store, publication_id), json.loads(state["ControlTotalsJson"] or "{}")
    if stored != manifest:
        raise LifecycleError(50031, f"{publication_id}: control totals {stored} differ from the manifest {manifest}")
    if wrong_counts(store, publication_id) or not verified(store, publication_id):
        raise LifecycleError(50032, f"{publication_id}: its rows are not those that were checked")
    def entries(open_: dict) -> list[dict]:
        present, current, now = open_.get(publication_id), _of(open_, "PUBLISHED"), utc_now()
        if present and present["Status"] == "PUBLISHED":
            return []
        if not present or present["Status"] != "APPROVED":
            raise LifecycleError(50030, f"{publication_id} is not approved any more")
        if [r["PublicationId"] for r in current] != before:
            raise LifecycleError(50033, f"{publication_id} was compared with {before}, but another one is current now")
        return [*_superseded(current, "SUPERSEDED", publication_id, now),
                _entry(present, "PUBLISHED", "pipeline", f"Run {run_id}", now, Status="PUBLISHED", PublishedAtUtc=now)]

    _commit(store, entries)
    return _state(store, publication_id)


def announce(store: Store, publication_id: str, totals: Mapping[str, str], actor: str = "pipeline") -> None:
    """Stage and publish a version whose rows another system keeps: it supersedes whatever is current when it is its turn."""
    def staged(open_: dict) -> list[dict]:
        if publication_id in open_:
            return []
        now = utc_now()
        return [_entry({"PublicationId": publication_id, "ControlTotalsJson": json.dumps(dict(totals))}, "STAGED", actor,
                       None, now, Status="APPROVED", StagedAtUtc=now)]

    def published(open_: dict) -> list[dict]:
        state, now = open_.get(publication_id), utc_now()
        if not state or state["Status"] != "APPROVED":
            return []
        return [*_superseded(_of(open_, "PUBLISHED"), "SUPERSEDED", publication_id, now),
                _entry(state, "PUBLISHED", actor, None, now, Status="PUBLISHED", PublishedAtUtc=now)]

    _commit(store, staged)
    _commit(store, published)


def sync_evidence(store: Store, batch_id: str, run_id: str = "manual") -> DataFrame:
    """Copy stage statuses and issue counts of a batch, and register a failed batch in the ledger."""
    now = utc_now()
    slice_ = {"BatchId": batch_id}
    synced = F.lit(now).cast("timestamp").alias("SyncedAtUtc")
    status = store.table("ops.batch_status").where(F.col("BatchId") == batch_id)
    store.replace_slice(status.select("Stage", "Status", "PublicationId", "BlockerCount", "WarningCount", "InfoCount",
                                      "Message", "RunId", "UpdatedAtUtc",
                                      synced), "ops.quality_evidence", slice_)
    if store.exists("ops.dq_issue"):
        found = issue_summary(store.table("ops.dq_issue").where(F.col("BatchId") == batch_id))
        store.replace_slice(found.select("Stage", "RuleId", "Severity", "IssueCount", synced),
                            "ops.dq_issue_summary", slice_)
    evidence = store.table("ops.quality_evidence").where(F.col("BatchId") == batch_id)
    publication_id = f"PUB-{batch_id}"
    bad = evidence.where("Status = 'QUALITY_FAILED'").first()

    def entries(open_: dict) -> list[dict]:
        if not bad or _state(store, publication_id) is not None:
            return []
        state = {"PublicationId": publication_id, "BatchId": batch_id, "RunId": run_id,
                 **{c: bad[c] for c in ("BlockerCount", "WarningCount", "InfoCount")}}
        return [_entry(state, "QUALITY_FAILED", "pipeline", "The previous publication stays current", now,
                       Status="QUALITY_FAILED")]

    _commit(store, entries)
    return evidence.orderBy("UpdatedAtUtc")


def record_consumer(store: Store, publication_id: str, consumer: str, status: str, detail: str | None = None) -> None:
    row = [(status, detail, utc_now())]
    store.replace_slice(store.spark.createDataFrame(row, "Status string, Detail string, UpdatedAtUtc timestamp"),
                        "ops.consumer_status", {"PublicationId": publication_id, "Consumer": consumer})


# --- registers -------------------------------------------------------------------------

def save_register(store: Store, df: DataFrame, table: str, version_column: str, version: str) -> None:
    """Keep a contract register as versioned rows; one version is replaced as a whole."""
    store.replace_slice(df, table, {version_column: version})


def save_approvers(store: Store, rows: Sequence[tuple[str, str, str, bool]]) -> None:
    store.write(store.spark.createDataFrame(
        list(rows), "ApproverUpn string, ApproverRole string, DataDomain string, IsActive boolean"),
        "ops.authorized_approver")


# --- reading published data ------------------------------------------------------------

def gold(store: Store, publication_id: str | None = None) -> dict[str, DataFrame]:
    """The fifteen tables of one publication, by default of the current one."""
    if publication_id is None:
        rows = current_publication(store).select("PublicationId").collect()
        if len(rows) != 1:
            raise LifecycleError(50040, "There is no single current publication")
        publication_id = rows[0]["PublicationId"]
    return {t: store.table(f"serve.{t}", only={"PublicationId": [publication_id]}) for t in STAR_TABLES}


def validity_intervals(log: DataFrame, id_: str, at: str, successor: str, open_end: datetime | None = None) -> DataFrame:
    """When each publication was the current one: from its time to one second before its successor's.

    The successor is found by its id, a plain equality join; the current one ends at `open_end`.
    """
    following = log.select(F.col(id_).alias(successor), F.col(at).alias("_next"))
    end = F.coalesce(F.col("_next"), F.lit(open_end or utc_now()).cast(log.schema[at].dataType))
    return (log.where(F.col(at).isNotNull()).join(following, successor, "left")
            .select(*[F.col(c) for c in log.columns],
                    (end - F.expr("INTERVAL 1 SECOND")).alias("valid_until")))


def gold_as_of(store: Store, at: datetime) -> dict[str, DataFrame]:
    """The tables as consumers saw them at a past instant."""
    published = publications(store).where(F.col("PublishedAtUtc") <= F.lit(at).cast("timestamp"))
    row = published.orderBy(F.desc("PublishedAtUtc")).first()
    if row is None:
        raise LifecycleError(50041, f"Nothing was published at {at}")
    return gold(store, row["PublicationId"])


def manifest_check(store: Store) -> DataFrame:
    """Control totals of the manifest against the published rows of the current publication."""
    pub = current_publication(store).first()
    manifest, stored = json.loads(pub["ControlTotalsJson"]), control_totals(store, pub["PublicationId"])
    rows = [(pub["PublicationId"], n, manifest.get(n), stored[n], manifest.get(n) == stored[n]) for n in stored]
    return store.spark.createDataFrame(
        rows, "PublicationId string, total string, manifest string, stored string, ok boolean")


def single_publication(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table the number of publications and rows it shows; there has to be one publication."""
    parts = [df.agg(F.countDistinct("PublicationId").alias("Publications"), F.count(F.lit(1)).alias("Rows"))
             .select(F.lit(n).alias("TableName"), "Publications", "Rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def delta(old: DataFrame, new: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Rows of two versions whose measures differ, including rows only one of them has."""
    a = old.select(*key, *[F.col(m).alias(f"{m}_old") for m in measures])
    b = new.select(*key, *[F.col(m).alias(f"{m}_new") for m in measures])
    changed = reduce(lambda x, y: x | y, [~F.col(f"{m}_old").eqNullSafe(F.col(f"{m}_new")) for m in measures])
    return a.join(b, list(key), "full").where(changed)


def publication_delta(store: Store, table: str, key: Sequence[str], measures: Sequence[str], old: str,
                      new: str) -> DataFrame:
    return delta(store.publication_slice(f"serve.{table}", old), store.publication_slice(f"serve.{table}", new),
                 key, measures)


def side_by_side(versions: Mapping[str, DataFrame]) -> DataFrame:
    """The same figures of several versions below each other, tagged with the version."""
    return reduce(DataFrame.unionByName, [df.withColumn("version", F.lit(v)) for v, df in versions.items()])
