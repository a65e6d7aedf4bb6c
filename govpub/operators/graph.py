"""Entity projection of one publication, typed edges, integrity and bounded traversal."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import key_text, project

# Entity type -> (projected table, key, display name).
ENTITY_TYPES = {
    "Country": ("country", "country_id", "country_name"),
    "Asset": ("asset", "asset_id", "asset_name"),
    "Facility": ("facility", "facility_id", "facility_id"),
    "Equipment": ("equipment", "equipment_id", "equipment_name"),
    "Well": ("well", "well_id", "well_name"),
    "Wellbore": ("wellbore", "wellbore_id", "wellbore_name"),
    "Completion": ("completion", "completion_id", "completion_name"),
    "ReportingStream": ("reporting_stream", "stream_id", "stream_id"),
    "ProductionDay": ("reporting_stream_daily", "stream_daily_id", "stream_daily_id"),
    "Incident": ("incident", "incident_id", "incident_id"),
    "LossAllocation": ("loss_allocation", "loss_id", "loss_id"),
    "SourceDecision": ("source_decision", "decision_id", "decision_id"),
    "Publication": ("publication", "publication_id", "publication_id"),
}

# Relationship -> (origin type, origin column, target type, target column).
RELATIONSHIPS = {
    "locatedIn": ("Asset", "country_id", "Country", "country_id"),
    "partOf": ("Facility", "asset_id", "Asset", "asset_id"),
    "installedAt": ("Equipment", "facility_id", "Facility", "facility_id"),
    "belongsTo": ("Well", "asset_id", "Asset", "asset_id"),
    "drilledFrom": ("Wellbore", "well_id", "Well", "well_id"),
    "completes": ("Completion", "wellbore_id", "Wellbore", "wellbore_id"),
    "reportsFor": ("ReportingStream", "well_id", "Well", "well_id"),
    "measures": ("ProductionDay", "stream_id", "ReportingStream", "stream_id"),
    "occurredOn": ("Incident", "equipment_id", "Equipment", "equipment_id"),
    "causedBy": ("LossAllocation", "incident_id", "Incident", "incident_id"),
    "affects": ("LossAllocation", "well_id", "Well", "well_id"),
    "decides": ("SourceDecision", "stream_id", "ReportingStream", "stream_id"),
}


def project_entities(star: Mapping[str, DataFrame], facility: DataFrame, candidate: DataFrame) -> dict[str, DataFrame]:
    """The thirteen entity tables: natural string keys and snake_case columns, no surrogate keys.

    Facilities come from their registry, so a field with several keeps all of them.
    """
    natural = {"dim_well": ("WellKey", "WellId", "well_id"), "dim_equipment": ("EquipmentKey", "EquipmentId", "equipment_id"),
               "dim_incident": ("IncidentKey", "IncidentId", "incident_id"), "dim_date": ("DateKey", "Date", "business_date")}

    def with_natural(fact: str, *dims: str) -> DataFrame:
        """A fact with the natural ids of its dimensions in place of their surrogate keys."""
        out = star[fact]
        for dim in dims:
            key, id_, name = natural[dim]
            out = out.join(star[dim].select(key, F.col(id_).alias(name)), key)
        return out

    asset, well, equipment = star["dim_asset"], star["dim_well"], star["dim_equipment"]
    daily = with_natural("fact_production_daily", "dim_date", "dim_well")
    outages = with_natural("fact_downtime_event", "dim_incident", "dim_equipment").groupBy("incident_id").agg(
        F.min("equipment_id").alias("equipment_id"), F.count(F.lit(1)).cast("int").alias("event_count"),
        F.sum("DurationHours").alias("equipment_downtime_hours"), F.min("StartUtc").alias("first_start_utc"))
    category = project(star["dim_incident"], incident_id="IncidentId", incident_category="IncidentCategory")
    gross, net = (F.get_json_object("ControlTotalsJson", f"$.{n}") for n in ("GrossBoe", "NetWiBoe"))
    return {
        "country": project(asset, country_id="CountryCode", country_name="CountryName").distinct(),
        "asset": project(asset, asset_id="AssetId", asset_name="AssetName", country_id="CountryCode",
                         facility_id="FacilityId"),
        "facility": project(facility, "facility_id", asset_id="field_id"),
        "equipment": project(equipment, equipment_id="EquipmentId", equipment_name="EquipmentName",
                             equipment_type="EquipmentType", facility_id="FacilityId", asset_id="AssetId",
                             country_id="CountryCode"),
        "well": project(well, well_id="WellId", well_name="WellName", asset_id="AssetId", country_id="CountryCode",
                        stream_id="StreamId", wellbore_count="WellboreCount", completion_count="CompletionCount",
                        alias_count="AliasCount", well_status="WellStatus"),
        "wellbore": project(star["master_wellbore"], wellbore_id="WellboreId", well_id="WellId",
                            wellbore_name="WellboreName"),
        "completion": project(star["master_completion"], completion_id="CompletionId", wellbore_id="WellboreId",
                              stream_id="StreamId", completion_name="CompletionName"),
        "reporting_stream": project(well, stream_id="StreamId", well_id="WellId", asset_id="AssetId"),
        "reporting_stream_daily": project(
            daily, "well_id", "business_date", stream_daily_id=key_text("StreamId", "business_date"),
            stream_id="StreamId", oil_bbl="OilBbl", gas_mscf="GasMscf", water_bbl="WaterBbl", gross_boe="GrossBoe",
            net_wi_boe="NetWiBoe", is_complete="IsComplete"),
        "incident": outages.join(category, "incident_id"),
        "loss_allocation": project(
            with_natural("fact_loss_allocation", *natural), "incident_id", "well_id", "equipment_id", "business_date",
            loss_id="LossId", event_id="EventId", lost_oil_bbl="LostOilBbl", lost_gas_mscf="LostGasMscf",
            lost_boe_gross="LostBoeGross", lost_boe_net_wi="LostBoeNetWi", value_usd_gross="ValueUsdGross",
            value_usd_net_wi="ValueUsdNetWi"),
        "source_decision": project(
            star["source_decision"], decision_id="DecisionId", stream_id="StreamId", well_id="WellId",
            business_date="BusinessDate", commodity="Commodity", decision_status="DecisionStatus",
            selected_source_system="SelectedSourceSystem", selected_value_std="SelectedValueStd",
            candidate_count="CandidateCount", reason="Reason", authority_policy_version="AuthorityPolicyVersion"),
        "publication": project(
            candidate, publication_id="PublicationId", batch_id="BatchId", dataset_version="DatasetVersion",
            authority_policy_version="AuthorityPolicyVersion", mapping_version="MappingVersion",
            period_start="PeriodStart", period_end="PeriodEnd", gross_boe_total=gross, net_wi_boe_total=net),
    }


def stamp(df: DataFrame, publication_id: str, kpi_version: str, as_of) -> DataFrame:
    return df.withColumns({"business_publication_id": F.lit(publication_id),
                           "kpi_contract_version": F.lit(kpi_version),
                           "as_of_utc": F.lit(as_of).cast("timestamp")})


# --- edges -----------------------------------------------------------------------------

def node_table(nodes: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """All nodes as (type, id) from type -> (frame, key column)."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(t).alias("type"), F.col(k).cast("string").alias("id"))
                                          for t, (df, k) in nodes.items()])


def edge_table(nodes: Mapping[str, tuple[DataFrame, str]],
               relationships: Mapping[str, tuple[str, str, str, str]]) -> DataFrame:
    """All edges as (rel, src_type, src_id, dst_type, dst_id); a missing reference gives no edge."""
    parts = []
    for rel, (src, column, dst, _) in relationships.items():
        df, key = nodes[src]
        parts.append(df.where(F.col(column).isNotNull()).select(
            F.lit(rel).alias("rel"), F.lit(src).alias("src_type"), F.col(key).cast("string").alias("src_id"),
            F.lit(dst).alias("dst_type"), F.col(column).cast("string").alias("dst_id")))
    return reduce(DataFrame.unionByName, parts)


def node_violations(nodes: DataFrame) -> DataFrame:
    """Node ids that are missing or not unique within their type."""
    return (nodes.groupBy("type", "id").agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("id").isNull() | (F.col("copies") > 1)))


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target does not exist, folded to one row per missing target with its edge count.

    Folding first sends a target with very many edges through the shuffle as one row per task.
    """
    targets = edges.groupBy("rel", "dst_type", "dst_id").agg(F.count(F.lit(1)).alias("edges"))
    known = nodes.select(F.col("type").alias("dst_type"), F.col("id").alias("dst_id")).distinct()
    return targets.join(known, ["dst_type", "dst_id"], "left_anti")


# --- traversal -------------------------------------------------------------------------

def _hop(edges: DataFrame, rel: str) -> DataFrame:
    return edges.where(F.col("rel") == rel).select(F.col("src_id").alias("_at"), F.col("dst_id").alias("_next"))


def traverse(edges: DataFrame, path: Sequence[str], start: DataFrame | None = None) -> DataFrame:
    """Follow relationships in order; rows (start_id, end_id). Every hop is one join on the node id."""
    first = edges.where(F.col("rel") == path[0]).select(F.col("src_id").alias("start_id"),
                                                        F.col("dst_id").alias("end_id"))
    out = first if start is None else first.join(start.select(F.col("id").alias("start_id")), "start_id", "left_semi")
    for rel in path[1:]:
        out = (out.join(_hop(edges, rel), F.col("end_id") == F.col("_at"))
               .select("start_id", F.col("_next").alias("end_id")))
    return out


def chain_ends(links: DataFrame, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Where chains of unknown length end: (id, end_id, steps, cyclic) for every id of links (id, next; next null at an end).

    Pointer doubling: every round an id jumps to where its target points, so a chain of n links takes log2(n) rounds, each
    one equi join. An id whose target is no id ends there. Every round ends the ids that are nearest to an end, so after one
    that ended none what still moves runs in a cycle; it has no end. `save` writes a frame and reads it back; rounds meet only
    there, and an id that ended is not written again.
    """
    at = save(links.select(F.col("id"), F.coalesce("next", "id").alias("end_id"),
                           F.col("next").isNotNull().cast("long").alias("steps"), F.col("next").isNull().alias("ended")), "0")
    rounds, done = at.count().bit_length() + 1, at.where("ended")
    at = at.where("NOT ended")
    for k in range(1, rounds + 1):
        if at.isEmpty():
            break
        ahead = done.unionByName(at).select(F.col("id").alias("_at"), F.col("end_id").alias("_end"),
                                            F.col("steps").alias("_steps"), F.col("ended").alias("_ended"))
        moved = save(at.join(ahead, F.col("end_id") == F.col("_at"), "left").select(
            "id", F.coalesce("_end", "end_id").alias("end_id"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.coalesce("_ended", F.lit(True)).alias("ended")), str(k))
        at, ended = moved.where("NOT ended"), moved.where("ended")
        if ended.isEmpty():
            break
        done = done.unionByName(ended)
    return done.unionByName(at).select(
        "id", F.when(F.col("ended"), F.col("end_id")).alias("end_id"),
        F.when(F.col("ended"), F.col("steps")).alias("steps"), (~F.col("ended")).alias("cyclic"))


def reach_totals(edges: DataFrame, path: Sequence[str], weights: DataFrame) -> DataFrame:
    """Carry weights (id, weight) along a path and sum them at its end: rows (end_id, weight, starts).

    The weights are summed at every node before the next hop, so each hop joins one row per
    node instead of one row per start.
    """
    at = weights.groupBy("id").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("starts"))
    for rel in path:
        at = (at.join(_hop(edges, rel), F.col("id") == F.col("_at"))
              .groupBy(F.col("_next").alias("id")).agg(F.sum("weight").alias("weight"),
                                                       F.sum("starts").alias("starts")))
    return at.withColumnRenamed("id", "end_id")
