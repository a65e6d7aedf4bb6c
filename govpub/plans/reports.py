"""Report and validation queries over the published star and the operational tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import date_key, hours_between, safe_ratio
from govpub.operators import publish
from govpub.operators.measures import measure_query, trust
from govpub.plans.pipeline import Settings, canonical_events
from govpub.sources.store import Store

Star = dict[str, DataFrame]


# --- publications ----------------------------------------------------------------------

def current(store: Store) -> DataFrame:
    return publish.current_publication(store)


def history(store: Store) -> DataFrame:
    return publish.publication_history(store).orderBy("LastChangeUtc")


def event_trail(store: Store) -> DataFrame:
    return publish.publication_events(store).orderBy("EventAtUtc", "Seq")


def value_in_versions(store: Store, publication_ids: Sequence[str], well_id: str, day: date) -> DataFrame:
    """One well and day in several publications, below each other."""
    return publish.side_by_side({p: one_day(publish.gold(store, p), well_id, day) for p in publication_ids})


# --- production ------------------------------------------------------------------------

def by_country(star: Star) -> DataFrame:
    """Gross, net and completeness percentage by country."""
    figures = star["fact_production_daily"].join(star["dim_asset"].select("AssetKey", "CountryName"), "AssetKey")
    share = F.lit(100).cast("decimal(10,0)") * F.sum("IsComplete") / F.count(F.lit(1))
    return figures.groupBy("CountryName").agg(
        F.sum("GrossBoe").alias("GrossBoe"), F.sum("NetWiBoe").alias("NetWiBoe"),
        share.cast("decimal(5,2)").alias("CompletenessPct")).orderBy("CountryName")


def daily_actual_target(star: Star) -> DataFrame:
    return measure_query(star, ["Gross BOE", "Target BOE"], ["dim_date.Date"]).orderBy("Date")


def asset_matrix(star: Star, year_month: str | None = None) -> DataFrame:
    """Country over asset with subtotals (level 1) and the total (level 3): gross, target, variance, achievement.

    The measures are taken at the lowest level first, so the rollup adds up one row per asset
    and both facts are already side by side.
    """
    where = {"dim_date": F.col("YearMonth") == year_month} if year_month else None
    base = measure_query(star, ["Gross BOE", "Target BOE"], ["dim_asset.CountryName", "dim_asset.AssetName"], where)
    out = base.rollup("CountryName", "AssetName").agg(
        F.grouping_id().alias("level"), F.sum("Gross BOE").alias("Gross BOE"), F.sum("Target BOE").alias("Target BOE"))
    zero = F.lit(0)
    variance = F.coalesce("Gross BOE", zero) - F.coalesce("Target BOE", zero)
    return (out.withColumn("Variance to Target BOE", variance)
            .withColumn("Target Achievement %", safe_ratio("Gross BOE", "Target BOE"))
            .orderBy(F.asc_nulls_last("CountryName"), F.asc_nulls_last("AssetName")))


def top_wells(star: Star, n: int = 10) -> DataFrame:
    """The n wells of the largest gross volume; ties by name."""
    sums = measure_query(star, ["Gross BOE"], ["dim_well.WellName"])
    return sums.orderBy(F.desc("Gross BOE"), "WellName").limit(n)


def one_day(star: Star, well_id: str, day: date | Column) -> DataFrame:
    """One day of a well; the day may be a scalar sub-query."""
    well = star["dim_well"].where(F.col("WellId") == well_id).select("WellKey", "WellId")
    key = date_key(day if isinstance(day, Column) else F.lit(day))
    return (star["fact_production_daily"].where(F.col("DateKey") == key).join(well, "WellKey")
            .select("PublicationId", "WellId", "DateKey", "OilBbl", "GasMscf", "WaterBbl", "GrossBoe", "NetWiBoe",
                    "IsComplete", "SelectedSources", "MaxRevision"))


def well_passport(star: Star, well_id: str) -> DataFrame:
    return star["dim_well"].where(F.col("WellId") == well_id).select(
        "WellId", "WellName", "AssetId", "WellboreCount", "CompletionCount", "AliasCount", "WellStatus")


def well_series(star: Star, well_id: str) -> DataFrame:
    return measure_query(star, ["Oil bbl", "Gas Mscf", "Water bbl"], ["dim_date.Date"],
                         {"dim_well": F.col("WellId") == well_id}).orderBy("Date")


def explain_decision(star: Star, well_id: str, day: date | None = None, commodity: str | None = None) -> DataFrame:
    out = star["source_decision"].where(F.col("WellId") == well_id)
    if day is not None:
        out = out.where(F.col("BusinessDate") == F.lit(day))
    return out if commodity is None else out.where(F.col("Commodity") == commodity)


# --- incidents -------------------------------------------------------------------------

def incident_impact(star: Star, incident_id: str) -> DataFrame:
    return measure_query(star, ["Affected Wells", "Lost BOE Gross", "Lost BOE Net WI", "Loss Value USD Gross",
                                "Loss Value USD Net WI", "Downtime Hours", "Downtime Events"],
                         ["dim_incident.IncidentId"], {"dim_incident": F.col("IncidentId") == incident_id})


def loss_by_well(star: Star, incident_id: str) -> DataFrame:
    return measure_query(star, ["Lost BOE Gross", "Lost BOE Net WI"], ["dim_well.WellId"],
                         {"dim_incident": F.col("IncidentId") == incident_id}).orderBy("WellId")


def incident_equipment(star: Star, incident_id: str) -> DataFrame:
    events = (star["fact_downtime_event"].drop("PublicationId")
              .join(star["dim_incident"].where(F.col("IncidentId") == incident_id).select("IncidentKey", "IncidentId",
                                                                                       "IncidentCategory"), "IncidentKey")
              .join(star["dim_equipment"].select("EquipmentKey", "EquipmentId"), "EquipmentKey"))
    return events.groupBy("IncidentId", "IncidentCategory", "EquipmentId").agg(
        F.count(F.lit(1)).alias("EventCount"), F.sum("DurationHours").alias("EquipmentDowntimeHours"))


# --- cost ------------------------------------------------------------------------------

def opex_by_month_category(star: Star) -> DataFrame:
    return measure_query(star, ["Opex USD"], ["dim_date.YearMonth", "dim_cost_category.CostCategory"])


def opex_per_boe(star: Star) -> DataFrame:
    return measure_query(star, ["Opex USD", "Gross BOE", "Opex per BOE USD"], ["dim_asset.CountryName"])


# --- trust -----------------------------------------------------------------------------

def trust_page(store: Store) -> dict[str, DataFrame]:
    star = publish.gold(store)
    return {"banner": trust(publish.publications(store), star["fact_production_daily"]),
            "completeness": measure_query(star, ["Data Completeness %"], ["dim_asset.CountryName"]),
            "decisions": star["source_decision"].select("WellId", "BusinessDate", "Commodity", "DecisionStatus",
                                                        "SelectedSourceSystem", "Reason"),
            "publications": publish.publications(store).select("PublicationId", "Status", "DecidedBy",
                                                               "PublishedAtUtc")}


def quality_evidence(store: Store) -> DataFrame:
    return store.table("ops.quality_evidence").orderBy("BatchId", "UpdatedAtUtc")


def issue_rollup(store: Store) -> DataFrame:
    return (store.table("ops.dq_issue_summary").groupBy("BatchId", "RuleId", "Severity")
            .agg(F.sum("IssueCount").alias("Issues")).orderBy("BatchId", "RuleId"))


# --- sources and stages ----------------------------------------------------------------

def source_profile(store: Store, settings: Settings, batch_id: str) -> DataFrame:
    """Rows of a batch per source, commodity and unit."""
    events = canonical_events(store, settings).where(F.col("batch_id") == batch_id)
    return events.groupBy("source_system", "commodity", "unit").agg(F.count(F.lit(1)).alias("rows_in_batch"))


def policy_in_force(store: Store, batch_id: str) -> DataFrame:
    return store.snapshot("bronze.ref__source_authority", batch_id).orderBy("domain", "scope", "priority")


def source_incident_check(store: Store, batch_id: str, incident_id: str) -> DataFrame:
    """Events, hours and affected wells of an incident in the delivered feeds."""
    events = store.snapshot("bronze.src_my__downtime_event", batch_id).where(F.col("incident_id") == incident_id)
    losses = store.snapshot("bronze.src_my__loss_allocation", batch_id).join(events.select("event_id"), "event_id",
                                                                             "left_semi")
    wells = losses.agg(F.countDistinct("well_ref")).scalar()
    return events.groupBy("incident_id").agg(
        F.countDistinct("event_id").alias("downtime_events"),
        F.sum(hours_between("start_utc", "end_utc")).alias("equipment_downtime_hours")
    ).withColumn("affected_wells", wells)


def landing_log(store: Store) -> DataFrame:
    return store.table("ops.ingestion_log").orderBy("BatchId", "EntityName")


def commit_log(store: Store) -> DataFrame:
    return store.table("ops.ingestion_batch").orderBy("CommitOrder")


def staging_totals(store: Store) -> DataFrame:
    parts = [store.table(f"stg_df.{t}").groupBy("batch_id", "dq_status").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(v).cast("decimal(38,6)").alias("amount"))
        .select(F.lit(t).alias("stage"), "batch_id", "dq_status", "rows", "amount")
        for t, v in (("target_monthly", "target_value"), ("cost_monthly", "amount_usd"))]
    return reduce(DataFrame.unionByName, parts)


def well_aliases(store: Store) -> DataFrame:
    return store.table("silver.well").select("well_id", "well_name").join(
        store.table("silver.well_alias").select("well_id", "source_system", "source_well_id"), "well_id")


def multi_bore_wells(store: Store) -> DataFrame:
    return (store.table("silver.wellbore").groupBy("well_id").agg(F.count(F.lit(1)).alias("bores"))
            .where("bores > 1"))


def golden_totals(store: Store) -> DataFrame:
    return store.table("silver.production_observation").groupBy("commodity", "standard_uom").agg(
        F.count(F.lit(1)).alias("observations"), F.sum("value_std").alias("volume"))
