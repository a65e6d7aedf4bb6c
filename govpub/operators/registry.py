"""Registries: conforming, crosswalk, effective-dated joins, dimensions with stable keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import ColumnLike, as_col, project, stable_key


def conform_registry(df: DataFrame, columns: Sequence[str], batch_id: str, mapping_version: str) -> DataFrame:
    """Project, fold exact copies, stamp the snapshot and the mapping version."""
    return df.select(*columns).dropDuplicates().withColumns({
        "master_snapshot_batch_id": F.lit(batch_id), "mapping_version": F.lit(mapping_version)})


def crosswalk(alias: DataFrame, stream: DataFrame, well: DataFrame, field: DataFrame) -> DataFrame:
    """(source_system, well_ref) -> golden well, stream, field and country.

    Joined once among the registries, so a fact needs one join instead of four. An alias of a
    well without a stream or field keeps nulls and is caught as unresolved.
    """
    place = (well.select("well_id", "field_id").join(field.select("field_id", "country_id"), "field_id"))
    return (alias.select("source_system", F.col("source_well_id").alias("well_ref"), "well_id")
            .join(stream.select("well_id", "stream_id"), "well_id", "left")
            .join(place, "well_id", "left")
            .select("source_system", "well_ref", "well_id", "stream_id", "field_id", "country_id"))


#: Days of a bucket of the period index.
BUCKET_DAYS = 32


def period_index(register: DataFrame, start: str, end: str, first_day: Column, last_day: Column, bucket: str,
                 width: int = BUCKET_DAYS) -> DataFrame:
    """The register, every period once for each bucket of days it covers between two days; empty periods are left out.

    An open period is cut at the last day that is asked for, so it takes as many rows as the asked days have buckets.
    """
    def number(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / width).cast("int")

    low, high = F.greatest(F.col(start).cast("date"), first_day), F.least(F.date_sub(F.col(end).cast("date"), 1), last_day)
    covered = register.where(F.col(start) < F.col(end)).where(low <= high)
    return covered.withColumn(bucket, F.explode(F.sequence(number(low), number(high))))


def join_effective(df: DataFrame, register: DataFrame, on: Mapping[str, str], date: ColumnLike,
                   start: str, end: str, take: Sequence[str], how: str = "left",
                   span: tuple[object, object] | None = None, width: int = BUCKET_DAYS) -> DataFrame:
    """Join the register row valid on `date` (start <= date < end) for equal keys.

    `on` maps columns of `df` to columns of the register. Key and bucket of days are equality keys, so a row meets
    the periods of its bucket only, however many its key has, and a hot key spreads over its buckets. The period
    itself is the residual predicate. `span` is the first and last day of `df`; without it one pass over the date
    finds them. Spark broadcasts the register when it is below the configured threshold and otherwise sort-merges with
    skewed partitions split at run time.
    """
    d = as_col(date)
    day = d.cast("date")
    if span is None:
        ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
        first, last = ends.select("first").scalar(), ends.select("last").scalar()
    else:
        first, last = (F.lit(x).cast("date") for x in span)
    indexed = period_index(register, start, end, first, last, "_bucket", width)
    reg = indexed.select(*[F.col(r).alias(f"_k_{r}") for r in on.values()], "_bucket",
                         F.col(start).alias("_from"), F.col(end).alias("_to"),
                         *[F.col(t).alias(f"_t_{t}") for t in take])
    bucket = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / width).cast("int")
    condition: Column = (bucket == F.col("_bucket")) & (d >= F.col("_from")) & (d < F.col("_to"))
    for left, right in on.items():
        condition = condition & (F.col(left) == F.col(f"_k_{right}"))
    return df.join(reg, condition, how).select(*[F.col(c) for c in df.columns],
                                               *[F.col(f"_t_{t}").alias(t) for t in take])


def child_counts(child: DataFrame, parent_key: str, name: str) -> DataFrame:
    return child.groupBy(parent_key).agg(F.count(F.lit(1)).cast("int").alias(name))


def alias_rows(alias: DataFrame, key: str, *parts: str) -> DataFrame:
    """The aliases of every key, one row each: a key may have any number of them."""
    return alias.select(key, *parts).distinct()


# --- dimensions ------------------------------------------------------------------------

def asset_key(field: ColumnLike = "field_id") -> Column:
    return stable_key("FIELD", field)


def dim_asset(field: DataFrame, country: DataFrame, facility: DataFrame) -> DataFrame:
    """Fields with their country and, as a plain attribute, the first of their facilities."""
    facilities = facility.groupBy("field_id").agg(F.min("facility_id").alias("first_facility"))
    placed = field.join(country, field["country_id"] == country["country_id"]).select(
        field["*"], country["country_name"]).join(facilities, "field_id", "left")
    return project(placed, AssetKey=asset_key(), AssetId="field_id", AssetName="field_name", CountryCode="country_id",
                   CountryName="country_name", FacilityId="first_facility")


def dim_well(well: DataFrame, stream: DataFrame, field: DataFrame, wellbore: DataFrame,
             completion: DataFrame, alias: DataFrame) -> DataFrame:
    """One row per well and stream. Children are folded to one row per well before they are joined."""
    bore_of = wellbore.select("wellbore_id", "well_id")
    completions = completion.join(bore_of, "wellbore_id").select("well_id")
    children = [child_counts(bore_of, "well_id", "bores"), child_counts(completions, "well_id", "completions"),
                child_counts(alias_rows(alias, "well_id", "source_system", "source_well_id"), "well_id", "aliases")]
    out = well.join(field.select("field_id", "country_id"), "field_id").join(
        stream.select("well_id", "stream_id"), "well_id")
    for child in children:
        out = out.join(child, "well_id", "left")
    return project(out, WellKey=stable_key("WELL", "well_id"), WellId="well_id", WellName="well_name",
                   AssetKey=asset_key(), AssetId="field_id", CountryCode="country_id", StreamId="stream_id",
                   WellboreCount=F.coalesce("bores", F.lit(0)), CompletionCount=F.coalesce("completions", F.lit(0)),
                   AliasCount=F.coalesce("aliases", F.lit(0)), WellStatus="well_status")


def dim_equipment(equipment: DataFrame, facility: DataFrame, field: DataFrame) -> DataFrame:
    places = facility.join(field, "field_id").select("facility_id", "field_id", "country_id")
    return project(equipment.join(places, "facility_id"), EquipmentKey=stable_key("EQUIPMENT", "equipment_id"),
                   EquipmentId="equipment_id", EquipmentName="equipment_name", EquipmentType="equipment_type",
                   FacilityId="facility_id", AssetKey=asset_key(), AssetId="field_id", CountryCode="country_id")


def dim_incident(downtime: DataFrame, loss: DataFrame) -> DataFrame:
    """Incidents of the downtime events; the category tells whether any loss was allocated."""
    both = (downtime.select("incident_id", F.lit(1).alias("event"), F.lit(0).alias("loss"))
            .unionByName(loss.select("incident_id", F.lit(0).alias("event"), F.lit(1).alias("loss"))))
    folded = both.groupBy("incident_id").agg(F.sum("event").alias("events"), F.max("loss").alias("loss"))
    return project(folded.where("events > 0"), IncidentKey=stable_key("INCIDENT", "incident_id"),
                   IncidentId="incident_id", EventCount=F.col("events").cast("int"),
                   IncidentCategory=F.when(F.col("loss") == 1, "PRODUCTION_LOSS").otherwise("MAINTENANCE_NO_LOSS"))


def dim_distinct(df: DataFrame, column: str, prefix: str, key: str, name: str, **extra: str) -> DataFrame:
    """Dimension of the distinct values of one column, with constant extra columns."""
    return project(df.select(column).distinct(), **{key: stable_key(prefix, column), name: column},
                   **{n: F.lit(v) for n, v in extra.items()})
