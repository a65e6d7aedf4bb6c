"""Rule registry, one-pass rule evaluation, issues, quarantine and the publication gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govpub.functions.columns import ColumnLike, as_col, key_text, known_true
from govpub.operators.ingest import PipelineError, record_status, utc_now
from govpub.sources.store import Store

BLOCKER, WARNING, INFO = "BLOCKER", "WARNING", "INFO"

# Rule id -> severity, stage, meaning.
RULES = {
    "M01": (BLOCKER, "SILVER_MASTER", "Key occurs more than once in the registry"),
    "M02": (BLOCKER, "SILVER_MASTER", "Parent record does not exist"),
    "M03": (BLOCKER, "SILVER_MASTER", "Share outside (0,1], empty period or overlapping periods"),
    "M04": (BLOCKER, "SILVER_MASTER", "Conversion factor is not positive"),
    "R01": (BLOCKER, "SILVER_PRODUCTION", "No approved alias for the local reference"),
    "R02": (BLOCKER, "SILVER_PRODUCTION", "Unit is not registered for the commodity"),
    "R03": (BLOCKER, "SILVER_PRODUCTION", "Quantity is missing and the row is no retraction"),
    "R04": (BLOCKER, "SILVER_PRODUCTION", "Quantity is negative"),
    "R05": (BLOCKER, "SILVER_PRODUCTION", "Commodity is unknown"),
    "R06": (BLOCKER, "SILVER_PRODUCTION", "One revision was delivered with different payloads"),
    "R07": (BLOCKER, "SILVER_PRODUCTION", "Sources of equal priority disagree"),
    "R10": (INFO, "SILVER_PRODUCTION", "Repeated delivery of the same payload was ignored"),
    "W01": (WARNING, "SILVER_PRODUCTION", "No candidate is eligible under the authority policy"),
    "B01": (BLOCKER, "SILVER_BUSINESS", "Staging rows are missing or belong to another batch"),
    "B02": (BLOCKER, "SILVER_BUSINESS", "Target staging row is not valid"),
    "B03": (BLOCKER, "SILVER_BUSINESS", "Cost staging row is not valid"),
    "B04": (BLOCKER, "SILVER_BUSINESS", "Downtime has no known equipment or no positive duration"),
    "B05": (BLOCKER, "SILVER_BUSINESS", "Loss has no known well or event, or another date than the event"),
}

ISSUE_DDL = ("BatchId string, Stage string, RuleId string, Severity string, SourceSystem string, "
             "EntityName string, RecordKey string, Message string, RunId string, DetectedAtUtc timestamp")


def rule_register(spark) -> DataFrame:
    effect = {BLOCKER: "Blocks publication", WARNING: "Evidence only", INFO: "Evidence only"}
    return spark.createDataFrame([(r, s, stage, text, effect[s]) for r, (s, stage, text) in RULES.items()],
                                 "rule_id string, severity string, stage string, description string, "
                                 "gate_effect string")


# --- issues ----------------------------------------------------------------------------

def issues(df: DataFrame, rule: str, entity: str, key: ColumnLike, source: ColumnLike | None = None,
           message: str | Column | None = None, also: Sequence[Column] = ()) -> DataFrame:
    """Every row of `df` as one issue of `rule`, with further columns of the row."""
    severity, _, text = RULES[rule]
    return df.select(
        F.lit(rule).alias("RuleId"), F.lit(severity).alias("Severity"),
        (as_col(source) if source is not None else F.lit(None)).cast("string").alias("SourceSystem"),
        F.lit(entity).alias("EntityName"), as_col(key).cast("string").alias("RecordKey"),
        (message if isinstance(message, Column) else F.lit(message or text)).alias("Message"), *also)


def evaluate_rules(df: DataFrame, rules: Mapping[str, Column], into: str = "failed_rules") -> DataFrame:
    """All rules in one pass: adds the array of failed rule ids. Unknown counts as passed."""
    hits = F.array(*[F.when(known_true(cond), F.lit(rule)) for rule, cond in rules.items()])
    return df.withColumn(into, F.array_compact(hits))


def failed(df: DataFrame, array: str = "failed_rules") -> DataFrame:
    return df.where(F.size(array) > 0)


def passed(df: DataFrame, array: str = "failed_rules") -> DataFrame:
    return df.where(F.size(array) == 0).drop(array)


def rule_issues(flagged: DataFrame, entity: str, key: ColumnLike, source: ColumnLike | None = None,
                array: str = "failed_rules", also: Sequence[Column] = ()) -> DataFrame:
    """One issue per (row, failed rule) of an evaluated frame."""
    severity = F.create_map(*[F.lit(x) for r, (s, _, _) in RULES.items() for x in (r, s)])
    text = F.create_map(*[F.lit(x) for r, (_, _, t) in RULES.items() for x in (r, t)])
    return (failed(flagged, array).withColumn("_rule", F.explode(array)).select(
        F.col("_rule").alias("RuleId"), severity[F.col("_rule")].alias("Severity"),
        (as_col(source) if source is not None else F.lit(None)).cast("string").alias("SourceSystem"),
        F.lit(entity).alias("EntityName"), as_col(key).cast("string").alias("RecordKey"),
        text[F.col("_rule")].alias("Message"), *also))


def quarantine(flagged: DataFrame, batch_id: str, array: str = "failed_rules") -> DataFrame:
    """The failing rows with their rule ids as one comma separated text."""
    return (failed(flagged, array).withColumn(array, F.concat_ws(",", array))
            .withColumn("quarantined_in_batch", F.lit(batch_id)))


def save_issues(store: Store, frames: Sequence[DataFrame], batch_id: str, stage: str,
                run_id: str = "manual") -> dict[str, int]:
    """Replace the issues of (batch, stage) and return the count per severity.

    The issue rows stay distributed: they are written as one slice and counted from there.
    """
    union = reduce(DataFrame.unionByName, frames)
    stamped = union.select("RuleId", "Severity", "SourceSystem", "EntityName", "RecordKey", "Message",
                           F.lit(run_id).alias("RunId"), F.lit(utc_now()).cast("timestamp").alias("DetectedAtUtc"))
    store.replace_slice(stamped, "ops.dq_issue", {"BatchId": batch_id, "Stage": stage})
    saved = store.table("ops.dq_issue").where((F.col("BatchId") == batch_id) & (F.col("Stage") == stage))
    return {r["Severity"]: r["n"] for r in saved.groupBy("Severity").agg(F.count(F.lit(1)).alias("n")).collect()}


def issue_summary(issue_rows: DataFrame) -> DataFrame:
    return (issue_rows.groupBy("BatchId", "Stage", "RuleId", "Severity")
            .agg(F.count(F.lit(1)).cast("int").alias("IssueCount")))


# --- master data rules -----------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose reference has no parent; a missing reference is an orphan too.

    The distinct references are compared first, which combines on the map side, so child rows are
    not shuffled by a reference that very many of them share. Only the few missing references
    then meet the child rows.
    """
    missing = (child.select(F.col(child_col).alias("_missing")).distinct()
               .join(parent.select(F.col(parent_col).alias("_missing")), "_missing", "left_anti"))
    return child.join(missing, F.col(child_col).eqNullSafe(F.col("_missing")), "left_semi")


def overlaps(register: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key and start the number of earlier periods that still run at that start.

    The earlier periods still open at a start are those begun before it minus those ended by
    then. Begins and ends are counted per day first, so the running sums go over the days of a
    key, never over pairs of its rows. Empty periods (start >= end) cover nothing.
    """
    zero, one, full = F.lit(0).cast("long"), F.lit(1).cast("long"), F.col(start) < F.col(end)

    def point(at: str, begun: Column, ended: Column, periods: Column) -> Column:
        return F.struct(F.col(at).alias("_at"), begun.alias("_begun"), ended.alias("_ended"), periods.alias("periods"))

    points = register.select(*keys, F.explode(F.array_compact(F.array(
        point(start, known_true(full).cast("long"), zero, one), F.when(full, point(end, zero, one, zero))))).alias("_point"))
    points = points.select(*keys, "_point.*").groupBy(*keys, "_at").agg(
        F.sum("_begun").alias("_begun"), F.sum("_ended").alias("_ended"), F.sum("periods").alias("periods"))
    upto = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # Strictly earlier begins: the running sum without the begins of the day itself.
    open_ = F.sum("_begun").over(upto) - F.col("_begun") - F.sum("_ended").over(upto)
    return (points.withColumn("overlapped_by", open_).where((F.col("periods") > 0) & (F.col("overlapped_by") > 0))
            .select(*keys, F.col("_at").alias(start), "periods", "overlapped_by"))


def invalid_shares(register: DataFrame, share: str, start: str, end: str) -> DataFrame:
    return register.where((F.col(share) <= 0) | (F.col(share) > 1) | (F.col(start) >= F.col(end)))


def master_issues(registries: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]],
                  relations: Sequence[tuple[str, str, str, str]]) -> list[DataFrame]:
    """Duplicate keys of every registry and orphans of every relation (child, col, parent, col)."""
    out = [issues(duplicate_keys(registries[n], k), "M01", n, key_text(*k)) for n, k in keys.items()]
    for child, child_col, parent, parent_col in relations:
        out.append(issues(orphans(registries[child], child_col, registries[parent], parent_col), "M02", child,
                          child_col, message=f"{child}.{child_col} has no parent in {parent}"))
    return out


# --- staging status --------------------------------------------------------------------

def amount_status(amount: ColumnLike) -> Column:
    """INVALID for a missing or negative amount."""
    a = as_col(amount)
    return F.when(a.isNull() | (a < 0), "INVALID").otherwise("VALID")


def conversion_status(amount: ColumnLike, rate: ColumnLike) -> Column:
    return (F.when(as_col(rate).isNull(), "MISSING_FX")
            .when(as_col(amount) < 0, "NEGATIVE_AMOUNT").otherwise("VALID"))


def staging_issues(stage: DataFrame, name: str, batch_id: str) -> DataFrame:
    """B01: rows of another batch, and one issue when this batch has no row at all."""
    other = issues(stage.where(F.col("batch_id") != batch_id), "B01", name, "batch_id",
                   message=f"Staging rows belong to another batch than {batch_id}")
    own = stage.agg(F.count_if(F.col("batch_id") == batch_id).alias("n")).where("n = 0")
    return other.unionByName(issues(own, "B01", name, F.lit(batch_id), message=f"No staging rows for {batch_id}"))


# --- gate ------------------------------------------------------------------------------

def gate(store: Store, batch_id: str, required: Mapping[str, str], publication_id: str,
         run_id: str = "manual") -> dict[str, int]:
    """Let the batch pass only when all stages are done and no blocker exists; returns issue counts."""
    done = {r["Stage"]: r["Status"] for r in
            store.table("ops.batch_status").where(F.col("BatchId") == batch_id).select("Stage", "Status").collect()}
    open_ = sorted(s for s, status in required.items() if done.get(s) != status)
    if open_:
        text = "Stages not completed: " + ", ".join(open_)
        record_status(store, batch_id, "VALIDATE", "NOT_READY", text, run_id=run_id)
        raise PipelineError("NOT_READY", text)
    by_rule = (store.table("ops.dq_issue").where(F.col("BatchId") == batch_id)
               .groupBy("Severity", "RuleId").agg(F.count(F.lit(1)).alias("n")).collect())
    counts: dict[str, int] = {}
    for r in by_rule:
        counts[r["Severity"]] = counts.get(r["Severity"], 0) + r["n"]
    blockers = sorted((r["RuleId"], r["n"]) for r in by_rule if r["Severity"] == BLOCKER)
    if blockers:
        text = "Blocking issues: " + ", ".join(f"{rule}={n}" for rule, n in blockers)
        record_status(store, batch_id, "VALIDATE", "QUALITY_FAILED", text, publication_id, counts, run_id)
        raise PipelineError("QUALITY_FAILED", text)
    record_status(store, batch_id, "VALIDATE", "QUALITY_PASSED", "No blocking issues", publication_id, counts, run_id)
    return counts
