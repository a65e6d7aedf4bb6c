"""Contracts of the delivered entities and of the published star, and checks against them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT, EVENT, CONTROL = "SNAPSHOT", "EVENT", "CONTROL"
OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class Table:
    """A named table: Spark DDL for its columns and the key that has to be unique."""

    name: str
    kind: str
    ddl: str
    key: tuple[str, ...]

    @property
    def entity(self) -> str:
        """Folder and table name of the landed copy: ref.country -> ref__country."""
        return self.name.replace(".", "__")

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def nullable_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema])

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _columns(spec: str) -> str:
    return ", ".join(part.strip()[:-1] if part.strip().endswith("?") else f"{part.strip()} NOT NULL"
                     for part in spec.split(";"))


def _delivered(name: str, kind: str, spec: str, *key: str) -> Table:
    return Table(name, kind, _columns("batch_id string; " + spec), ("batch_id", *key))


# Entities, columns, types and keys of the delivered feeds ('?' = nullable).
_PRODUCTION = ("change_id string; change_seq bigint; observation_id string; well_ref string; report_date date; "
               "commodity string; quantity decimal(19,6)?; unit string; revision int; operation string; "
               "report_status string")
_MONTHS = "; ".join(f"m{m:02d} decimal(19,6)?" for m in range(1, 13))

SOURCE_TABLES = [
    _delivered("ref.country", SNAPSHOT, "country_id string; country_name string", "country_id"),
    _delivered("ref.business_associate", SNAPSHOT, "ba_id string; ba_name string; ba_role string", "ba_id"),
    _delivered("ref.field", SNAPSHOT, "field_id string; country_id string; field_name string", "field_id"),
    _delivered("ref.facility", SNAPSHOT, "facility_id string; field_id string; facility_name string", "facility_id"),
    _delivered("ref.equipment", SNAPSHOT,
               "equipment_id string; facility_id string; equipment_name string; equipment_type string",
               "equipment_id"),
    _delivered("ref.well", SNAPSHOT, "well_id string; field_id string; well_name string; well_status string",
               "well_id"),
    _delivered("ref.wellbore", SNAPSHOT, "wellbore_id string; well_id string; wellbore_name string", "wellbore_id"),
    _delivered("ref.well_completion", SNAPSHOT,
               "completion_id string; wellbore_id string; stream_id string; completion_name string",
               "completion_id"),
    _delivered("ref.reporting_stream", SNAPSHOT, "stream_id string; well_id string; stream_name string",
               "stream_id"),
    _delivered("ref.well_alias", SNAPSHOT, "source_system string; source_well_id string; well_id string",
               "source_system", "source_well_id"),
    _delivered("ref.uom_conversion", SNAPSHOT,
               "commodity string; uom string; standard_uom string; to_standard_factor decimal(18,9); "
               "boe_divisor decimal(9,3)?; factor_version string", "commodity", "uom"),
    _delivered("ref.working_interest", SNAPSHOT,
               "field_id string; valid_from date; valid_to date; operator_ba_id string; wi_share decimal(9,6); "
               "agreement_ref string", "field_id", "valid_from"),
    _delivered("ref.target_monthly", SNAPSHOT,
               f"field_id string; commodity string; scenario_id string; target_year int; {_MONTHS}; "
               "target_uom string", "field_id", "commodity", "scenario_id", "target_year"),
    _delivered("ref.operating_cost", SNAPSHOT,
               "cost_id string; field_id string; month_start date; cost_category string; currency_code string; "
               "amount_local decimal(19,4); closing_status string", "cost_id"),
    _delivered("ref.fx_rate", SNAPSHOT, "valid_on date; currency_code string; usd_per_unit decimal(18,9)",
               "valid_on", "currency_code"),
    _delivered("ref.price", SNAPSHOT,
               "business_date date; commodity string; price_usd decimal(19,6); price_unit string; "
               "energy_factor decimal(9,6)", "business_date", "commodity"),
    _delivered("ref.source_authority", SNAPSHOT,
               "policy_version string; domain string; source_system string; scope string; priority int; "
               "eligible_status string; valid_from date; valid_to date; owner_role string",
               "policy_version", "domain", "source_system", "scope"),
    _delivered("src_dz.production_report", EVENT, _PRODUCTION, "change_id"),
    _delivered("src_my.production_report", EVENT, _PRODUCTION, "change_id"),
    _delivered("src_my.production_provisional", EVENT, _PRODUCTION, "change_id"),
    _delivered("src_iq.daily_volumes", EVENT,
               "chg_id string; seq_no bigint; obs_key string; well_code string; obs_date date; product string; "
               "qty decimal(19,6)?; qty_unit string; rev_no int; op_code string; approval_flag string", "chg_id"),
    _delivered("src_my.downtime_event", EVENT,
               "event_id string; incident_id string; equipment_id string; start_utc timestamp; end_utc timestamp; "
               "reason string; change_seq bigint", "event_id"),
    _delivered("src_my.loss_allocation", EVENT,
               "loss_id string; event_id string; well_ref string; business_date date; lost_oil_bbl decimal(19,6); "
               "lost_gas_mscf decimal(19,6); allocation_status string; change_seq bigint", "loss_id"),
    Table("ctl.source_batch", CONTROL, _columns(
        "batch_id string; parent_batch_id string?; dataset_version string; description string; period_start date; "
        "period_end date; state string; content_sha256 string; sealed_at_utc timestamp?"), ("batch_id",)),
    Table("ctl.batch_entity", CONTROL, _columns(
        "batch_id string; entity_name string; row_count bigint; content_sha256 string"),
        ("batch_id", "entity_name")),
]
SOURCE_BY_NAME = {t.name: t for t in SOURCE_TABLES}
SOURCE_BY_ENTITY = {t.entity: t for t in SOURCE_TABLES}

# The published tables ('?' = nullable); each also carries PublicationId.
_STAR = {
    "dim_date": ("DateKey int; Date date; Year int; MonthNumber int; MonthName string; YearMonth string; "
                 "MonthStart date; DayOfMonth int; DaysInMonth int", ("DateKey",)),
    "dim_asset": ("AssetKey bigint; AssetId string; AssetName string; CountryCode string; CountryName string; "
                  "FacilityId string?", ("AssetKey",)),
    "dim_well": ("WellKey bigint; WellId string; WellName string; AssetKey bigint; AssetId string; "
                 "CountryCode string; StreamId string; WellboreCount int; CompletionCount int; AliasCount int; "
                 "WellStatus string", ("WellKey",)),
    "dim_equipment": ("EquipmentKey bigint; EquipmentId string; EquipmentName string; EquipmentType string; "
                      "FacilityId string; AssetKey bigint; AssetId string; CountryCode string", ("EquipmentKey",)),
    "dim_incident": ("IncidentKey bigint; IncidentId string; IncidentCategory string; EventCount int",
                     ("IncidentKey",)),
    "dim_scenario": ("ScenarioKey bigint; ScenarioId string; ScenarioName string", ("ScenarioKey",)),
    "dim_cost_category": ("CostCategoryKey bigint; CostCategory string", ("CostCategoryKey",)),
    "fact_production_daily": (
        "DateKey int; WellKey bigint; AssetKey bigint; StreamId string; OilBbl decimal(19,6)?; "
        "GasMscf decimal(19,6)?; WaterBbl decimal(19,6)?; GrossBoe decimal(19,6)?; WiShare decimal(9,6)?; "
        "NetWiBoe decimal(19,6)?; ObservationCount int; ExpectedObservationCount int; IsComplete int; "
        "RetractedCount int; SelectedSources string?; MaxRevision int?", ("DateKey", "StreamId")),
    "fact_target_daily": (
        "DateKey int; AssetKey bigint; ScenarioKey bigint; TargetOilBbl decimal(19,6)?; "
        "TargetGasMscf decimal(19,6)?; TargetBoe decimal(19,6)?", ("DateKey", "AssetKey", "ScenarioKey")),
    "fact_operating_cost_monthly": (
        "MonthDateKey int; AssetKey bigint; CostCategoryKey bigint; CurrencyCode string; AmountLocal decimal(19,4); "
        "UsdPerUnit decimal(18,9); AmountUsd decimal(19,4); ClosingStatus string; CostId string", ("CostId",)),
    "fact_downtime_event": (
        "EventId string; IncidentKey bigint; EquipmentKey bigint; AssetKey bigint; StartDateKey int; "
        "StartUtc timestamp; EndUtc timestamp; DurationHours decimal(9,3); Reason string", ("EventId",)),
    "fact_loss_allocation": (
        "LossId string; DateKey int; WellKey bigint; AssetKey bigint; IncidentKey bigint; EquipmentKey bigint; "
        "EventId string; LostOilBbl decimal(19,6); LostGasMscf decimal(19,6); LostBoeGross decimal(19,6); "
        "WiShare decimal(9,6); LostBoeNetWi decimal(19,6); ValueUsdGross decimal(19,4); "
        "ValueUsdNetWi decimal(19,4)", ("LossId",)),
    "master_wellbore": ("WellboreId string; WellId string; WellboreName string", ("WellboreId",)),
    "master_alias": ("SourceSystem string; SourceWellId string; WellId string", ("SourceSystem", "SourceWellId")),
    "master_completion": ("CompletionId string; WellboreId string; StreamId string; CompletionName string",
                          ("CompletionId",)),
    "source_decision": (
        "DecisionId string; CanonicalKey string; StreamId string; WellId string; BusinessDate date; "
        "Commodity string; CandidateCount int; DecisionStatus string; SelectedSourceSystem string?; "
        "SelectedObservationId string?; SelectedRevision int?; SelectedValueStd decimal(19,6)?; Reason string?; "
        "AuthorityPolicyVersion string", ("DecisionId",)),
    "source_decision_candidate": (
        "DecisionId string; SourceSystem string; ObservationId string; Revision int; ReportStatus string?; "
        "Eligible boolean; Priority int?; ObservationStatus string; ValueStd decimal(19,6)?",
        ("DecisionId", "SourceSystem", "ObservationId")),
}
STAR_TABLES = {name: Table(f"serve.{name}", "STAR", _columns(spec), key) for name, (spec, key) in _STAR.items()}


class ContractError(ValueError):
    """Data does not fit its contract."""


def read_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """Typed CSV read. The header has to equal the contract and every value has to parse.

    Empty text becomes null where the contract allows null and stays '' in required text
    columns; an empty value in any other required column is an error, raised while reading. A
    decimal with more digits than its type is an error too, nothing is rounded away.
    """
    is_decimal = {f.name for f in table.schema if isinstance(f.dataType, T.DecimalType)}
    landed = T.StructType([T.StructField(f.name, T.StringType() if f.name in is_decimal else f.dataType, True)
                           for f in table.schema])
    raw = (spark.read.schema(landed).option("header", True).option("enforceSchema", False)
           .option("mode", "FAILFAST").csv(path))

    def fail(field: T.StructField, text: str) -> Column:
        return F.raise_error(F.lit(f"{table.name}.{field.name} {text}")).cast(field.dataType)

    def value(field: T.StructField) -> Column:
        col = F.col(field.name)
        if field.name in is_decimal:
            whole = field.dataType.precision - field.dataType.scale
            wide = col.cast(T.DecimalType(38, 38 - whole))
            fitted = wide.cast(field.dataType)
            col = F.when(col.isNull(), F.lit(None)).when(fitted == wide, fitted).otherwise(
                fail(field, "has more digits than its type"))
        if field.nullable:
            return col.alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(col, F.lit("")).alias(field.name)
        return F.coalesce(col, fail(field, "is empty but required")).alias(field.name)

    return raw.select(*[value(f) for f in table.schema])


#: Reasons for which a row of a CSV delivery is rejected.
MALFORMED, UNREADABLE, DIGITS, REQUIRED = "WRONG_NUMBER_OF_FIELDS", "UNREADABLE", "TOO_MANY_DIGITS", "EMPTY_BUT_REQUIRED"


def check_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """Every row of a CSV delivery: the typed columns, `problems` (column, reason) and the line as it came in `line`.

    Nothing fails: values that cannot be read are null and named. Rows without problems are those that `read_csv` gives.
    The header has to equal the contract, as otherwise no value is where it belongs.
    """
    names = table.schema.names
    text = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("line", T.StringType())])
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "line").csv(path))

    def value(field: T.StructField) -> tuple[Column, Column]:
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.StringType):
            return (col if field.nullable else F.coalesce(col, F.lit(""))), F.lit(None).cast("string")
        typed, problem = col.try_cast(kind), F.when(col.isNotNull() & col.try_cast(kind).isNull(), UNREADABLE)
        if isinstance(kind, T.DecimalType):
            wide = col.try_cast(T.DecimalType(38, 38 - kind.precision + kind.scale))
            fits = wide.try_cast(kind)
            typed = F.when(fits == wide, fits)
            problem = F.when(col.isNotNull() & col.try_cast("double").isNull(), UNREADABLE).when(
                col.isNotNull() & typed.isNull(), DIGITS)
        if not field.nullable:
            problem = F.when(col.isNull(), REQUIRED).otherwise(problem)
        return typed, problem

    whole = F.col("line").isNull()
    found = [(f.name, *value(f)) for f in table.schema]
    problems = F.when(~whole, F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(MALFORMED).alias("reason")))
                      ).otherwise(F.filter(F.array(*[F.struct(F.lit(n).alias("column"), p.alias("reason")) for n, _, p in found]),
                                           lambda x: x["reason"].isNotNull()))
    line = F.coalesce("line", F.concat_ws(",", *[F.coalesce(n, F.lit("")) for n in names]))
    return raw.select(*[v.alias(n) for n, v, _ in found], problems.alias("problems"), line.alias("line"))


def schema_violations(df: DataFrame, table: Table, ignore: tuple[str, ...] = ("PublicationId",)) -> DataFrame:
    """Rows (table_name, column_name, problem): columns missing, unexpected, of another type or null.

    Names and types are compared on the schema; nulls of all required columns are counted in
    one aggregate.
    """
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema if f.name not in ignore}
    wanted = {f.name: f.dataType for f in table.schema}
    found = [(table.name, c, "MISSING_COLUMN") for c in wanted if c not in actual]
    found += [(table.name, c, "UNEXPECTED_COLUMN") for c in actual if c not in wanted]
    found += [(table.name, c, f"TYPE {actual[c].simpleString()} <> {t.simpleString()}")
              for c, t in wanted.items() if c in actual and actual[c] != t]
    out = spark.createDataFrame(found, "table_name string, column_name string, problem string")
    required = [c for c in table.required if c in actual]
    if required:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        nulls = (counts.unpivot([], required, "column_name", "nulls").where("nulls > 0")
                 .select(F.lit(table.name).alias("table_name"), "column_name",
                         F.concat(F.lit("NULLS "), F.col("nulls")).alias("problem")))
        out = out.unionByName(nulls)
    return out


def decimal_misfits(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column the number of values that do not fit the decimal type without loss.

    Written as arithmetic (no digit beyond the scale, magnitude below the limit), because a
    failing cast is costly when many values fail.
    """
    def misfit(name: str, decimal_type: str):
        precision, scale = (int(x) for x in decimal_type[8:-1].split(","))
        whole = precision - scale
        limit = F.lit("1" + "0" * whole).cast(f"decimal({whole + 1},0)")
        return (F.round(F.col(name), scale) != F.col(name)) | (F.abs(F.col(name)) >= limit)

    counts = df.agg(*[F.count_if(misfit(n, t)).alias(n) for n, t in types.items()])
    return counts.unpivot([], list(types), "column_name", "misfits")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
