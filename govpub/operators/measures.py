"""Measures over the published star.

A measure is a plain aggregate of one fact, or a combination of such aggregates. Facts are
never joined to each other: each is filtered, grouped and aggregated by itself and the results
meet on the grouping columns. Ratios divide sums, they are never averages of ratios.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import ColumnLike, as_col, safe_ratio


@dataclass(frozen=True)
class Base:
    """An aggregate over one fact."""

    fact: str
    expr: Callable[[], Column]


@dataclass(frozen=True)
class Derived:
    """A figure computed from other measures."""

    parts: tuple[str, ...]
    combine: Callable[..., Column]


def distinct_rollup(df: DataFrame, levels: Sequence[str], ids: Mapping[str, ColumnLike]) -> DataFrame:
    """Exact distinct counts of numbered things at every level of a rollup, in one pass over the rows.

    `ids` maps output names to columns of numbers from 0 up, such as places in a dimension. The rows are folded once into
    bitmaps of 32,768 numbers per lowest group; the levels above unite these bitmaps, so a number that several groups
    share counts once at each level. `level` is the grouping id: 0 the groups, then the subtotals, all bits the total.
    """
    things = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), as_col(c).cast("long").alias("number"))
                                 for n, c in ids.items()]))
    spread = df.select(*levels, things.alias("_t")).select(*levels, "_t.name", "_t.number").where("number IS NOT NULL")
    folded = spread.groupBy(*levels, "name", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    sets = [[*levels[:k], "name", "bucket"] for k in range(len(levels), -1, -1)]
    united = folded.groupingSets([[F.col(c) for c in s] for s in sets], *levels, "name", "bucket").agg(
        F.grouping_id().alias("_id"), F.bitmap_or_agg("bits").alias("bits"))
    counted = united.withColumn("level", F.shiftright("_id", 2)).groupBy("level", *levels, "name").agg(
        F.sum(F.bitmap_count("bits")).alias("n"))
    return counted.groupBy("level", *levels).agg(*[
        F.coalesce(F.sum(F.when(F.col("name") == n, F.col("n"))), F.lit(0)).alias(n) for n in ids])


def total(fact: str, column: str) -> Base:
    return Base(fact, lambda: F.sum(column))


def rows(fact: str) -> Base:
    return Base(fact, lambda: F.count(F.lit(1)))


def distinct(fact: str, column: str) -> Base:
    return Base(fact, lambda: F.countDistinct(column))


def ratio(numerator: str, denominator: str) -> Derived:
    return Derived((numerator, denominator), safe_ratio)


PRODUCTION, TARGET, LOSS = "fact_production_daily", "fact_target_daily", "fact_loss_allocation"
COST, DOWNTIME, DECISION = "fact_operating_cost_monthly", "fact_downtime_event", "source_decision"


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


# Measure names and what they sum.
MEASURES: dict[str, Base | Derived] = {
    "Gross BOE": total(PRODUCTION, "GrossBoe"),
    "Net WI BOE": total(PRODUCTION, "NetWiBoe"),
    "Oil bbl": total(PRODUCTION, "OilBbl"),
    "Gas Mscf": total(PRODUCTION, "GasMscf"),
    "Water bbl": total(PRODUCTION, "WaterBbl"),
    "Production Days": distinct(PRODUCTION, "DateKey"),
    "Avg Gross BOE per Day": ratio("Gross BOE", "Production Days"),
    "Liquid bbl": Derived(("Oil bbl", "Water bbl"),
                          lambda o, w: F.when(o.isNotNull() | w.isNotNull(), _zero_if_null(o) + _zero_if_null(w))),
    "Water Cut %": ratio("Water bbl", "Liquid bbl"),
    "Target BOE": total(TARGET, "TargetBoe"),
    "Target Achievement %": ratio("Gross BOE", "Target BOE"),
    "Variance to Target BOE": Derived(
        ("Gross BOE", "Target BOE"),
        lambda g, t: F.when(g.isNotNull() | t.isNotNull(), _zero_if_null(g) - _zero_if_null(t))),
    "Stream Days": rows(PRODUCTION),
    "Complete Stream Days": total(PRODUCTION, "IsComplete"),
    "Data Completeness %": ratio("Complete Stream Days", "Stream Days"),
    "Retracted Observations": total(PRODUCTION, "RetractedCount"),
    "Lost BOE Gross": total(LOSS, "LostBoeGross"),
    "Lost BOE Net WI": total(LOSS, "LostBoeNetWi"),
    "Loss Value USD Gross": total(LOSS, "ValueUsdGross"),
    "Loss Value USD Net WI": total(LOSS, "ValueUsdNetWi"),
    "Affected Wells": distinct(LOSS, "WellKey"),
    "Downtime Hours": total(DOWNTIME, "DurationHours"),
    "Downtime Events": rows(DOWNTIME),
    "Opex USD": total(COST, "AmountUsd"),
    "Opex per BOE USD": ratio("Opex USD", "Gross BOE"),
    "Source Decisions": rows(DECISION),
    "Decisions Needing Review": Base(DECISION, lambda: F.count_if(F.col("DecisionStatus") != "SELECTED")),
}

# Fixed values: (fact, fact key, dimension, dimension key); many facts rows to one dimension row.
RELATIONS = [
    (PRODUCTION, "DateKey", "dim_date", "DateKey"),
    (PRODUCTION, "WellKey", "dim_well", "WellKey"),
    (PRODUCTION, "AssetKey", "dim_asset", "AssetKey"),
    (TARGET, "DateKey", "dim_date", "DateKey"),
    (TARGET, "AssetKey", "dim_asset", "AssetKey"),
    (TARGET, "ScenarioKey", "dim_scenario", "ScenarioKey"),
    (COST, "MonthDateKey", "dim_date", "DateKey"),
    (COST, "AssetKey", "dim_asset", "AssetKey"),
    (COST, "CostCategoryKey", "dim_cost_category", "CostCategoryKey"),
    (DOWNTIME, "StartDateKey", "dim_date", "DateKey"),
    (DOWNTIME, "IncidentKey", "dim_incident", "IncidentKey"),
    (DOWNTIME, "EquipmentKey", "dim_equipment", "EquipmentKey"),
    (DOWNTIME, "AssetKey", "dim_asset", "AssetKey"),
    (LOSS, "DateKey", "dim_date", "DateKey"),
    (LOSS, "WellKey", "dim_well", "WellKey"),
    (LOSS, "AssetKey", "dim_asset", "AssetKey"),
    (LOSS, "IncidentKey", "dim_incident", "IncidentKey"),
    (LOSS, "EquipmentKey", "dim_equipment", "EquipmentKey"),
    (DECISION, "WellId", "dim_well", "WellId"),
    (DECISION, "BusinessDate", "dim_date", "Date"),
]


def measure_query(star: Mapping[str, DataFrame], names: Sequence[str], by: Sequence[str] = (),
                  where: Mapping[str, Column] | None = None,
                  measures: Mapping[str, Base | Derived] | None = None,
                  relations: Sequence[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Evaluate measures grouped by `by` ("dim_asset.CountryName") under the filters `where`
    (dimension -> condition on its columns).

    A filter or grouping on a dimension reaches a fact through their relation; a fact without
    that relation is not affected, and its figure is then repeated for every group. Groups in
    which all requested measures are blank do not appear.
    """
    measures = measures or MEASURES
    relations = RELATIONS if relations is None else relations
    needed: list[str] = []

    def collect(name: str) -> None:
        m = measures[name]
        if isinstance(m, Derived):
            for part in m.parts:
                collect(part)
        if name not in needed:
            needed.append(name)

    for n in names:
        collect(n)
    by_fact: dict[str, list[str]] = {}
    for n in needed:
        if isinstance(measures[n], Base):
            by_fact.setdefault(measures[n].fact, []).append(n)

    groups = [c.split(".")[1] for c in by]
    if len(set(groups)) < len(groups):
        raise ValueError(f"grouping columns of two dimensions have the same name: {sorted(groups)}")
    results = [_aggregate_fact(star, fact, {n: measures[n].expr() for n in ms}, by, where or {}, relations)
               for fact, ms in by_fact.items()]
    results.sort(key=lambda r: -len(r[1]))
    frame, present = results[0]
    for other, cols in results[1:]:
        frame = _meet(frame, other, [c for c in cols if c in present], cols, groups)
        present = present + [c for c in cols if c not in present]
    for n in needed:
        m = measures[n]
        if isinstance(m, Derived):
            frame = frame.withColumn(n, m.combine(*[F.col(f"`{p}`") for p in m.parts]))
    shown = reduce(lambda a, b: a | b, [F.col(f"`{n}`").isNotNull() for n in names])
    return frame.where(shown).select(*groups, *[F.col(f"`{n}`") for n in names])


def _aggregate_fact(star, fact, exprs, by, where, relations) -> tuple[DataFrame, list[str]]:
    related = {d: (fk, dk) for f, fk, d, dk in relations if f == fact}
    wanted: dict[str, list[str]] = {}
    for ref in by:
        dim, column = ref.split(".")
        if dim in related:
            wanted.setdefault(dim, []).append(column)
    df = star[fact].drop("PublicationId")
    for dim in {**wanted, **{d: [] for d in where if d in related and d not in wanted}}:
        fk, dk = related[dim]
        side = star[dim] if dim not in where else star[dim].where(where[dim])
        side = side.select(F.col(dk).alias("_dk"), *[F.col(c).alias(f"_by_{c}") for c in wanted.get(dim, [])])
        df = df.join(side, df[fk] == side["_dk"], "inner" if wanted.get(dim) else "left_semi").drop("_dk")
    groups = [c for cols in wanted.values() for c in cols]
    out = df.groupBy(*[F.col(f"_by_{c}").alias(c) for c in groups]).agg(*[e.alias(n) for n, e in exprs.items()])
    return out, groups


def _meet(left: DataFrame, right: DataFrame, on: list[str], grouped: list[str], by: list[str]) -> DataFrame:
    """Full join on the shared grouping columns; a side without grouping columns is one row and is repeated."""
    if not on and grouped:
        raise ValueError(f"no fact of these measures has both {[c for c in left.columns if c in by]} and {grouped}: "
                         "ask for them in two queries")
    if not on:
        values = right.select(F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("s")).scalar()
        return left.withColumn("_one", values).select(
            *[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_one.`{c}`").alias(c) for c in right.columns])
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    joined = left.join(r, cond, "full")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in on else F.col(f"`{c}`")
                           for c in left.columns],
                         *[F.col(f"`{c}`") for c in right.columns if c not in on])


# --- trust -----------------------------------------------------------------------------

def trust(publications: DataFrame, production: DataFrame | None = None) -> DataFrame:
    """Current publication, its approver and time, the banner text and whether the data match it."""
    out = publications.where("Status = 'PUBLISHED'").agg(
        F.max("PublicationId").alias("Current Publication"), F.max("DecidedBy").alias("Approved By"),
        F.max("PublishedAtUtc").alias("Published At UTC"))
    banner = F.format_string("SSOT %s | approved by %s | published %s UTC", F.col("`Current Publication`"),
                             F.col("`Approved By`"), F.date_format("`Published At UTC`", "yyyy-MM-dd HH:mm"))
    out = out.withColumn("Trust Banner", banner)
    if production is not None:
        shown = production.agg(F.max("PublicationId")).scalar()
        out = out.withColumn("Gold Matches Publication", F.when(
            shown == F.col("`Current Publication`"), "Consistent").otherwise("Check refresh"))
    return out


# --- entitlement -----------------------------------------------------------------------

def entitled(star: Mapping[str, DataFrame], countries: Sequence[str]) -> dict[str, DataFrame]:
    """The star as a reader of some countries sees it: asset, well and every fact tied to them."""
    allowed = F.col("CountryCode").isin(*countries)
    out = dict(star)
    out["dim_asset"], out["dim_well"] = star["dim_asset"].where(allowed), star["dim_well"].where(allowed)
    for fact in {f for f, _, d, _ in RELATIONS if d in ("dim_asset", "dim_well")}:
        for f, fk, dim, dk in RELATIONS:
            if f == fact and dim in ("dim_asset", "dim_well"):
                keys = out[dim].select(F.col(dk).alias(fk))
                out[fact] = out[fact].join(keys, fk, "left_semi")
    return out
