"""The named measures and the reports on a star of the supplied tables.

Suppliers are the wells, nations the assets, regions the countries. Lines are production (quantity as oil, gas or
water by return flag), open lines the losses of the incident of their customer, orders targets and costs,
events downtimes, and every line is a decision too.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import DIVISOR, HOURS, MONEY, VOLUME, date_key, half_up, project
from govpub.operators import derive, measures
from govpub.plans import reports
from govpub.plans.supplied.base import Tables, count, out_int, out_num, out_text, query, volume

WELL, INCIDENT, DAY = "W-1", "I-7", date(1999, 6, 1)


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), out_text(column))


def _wells(t: Tables) -> DataFrame:
    return project(t.raw("supplier"), l_suppkey="s_suppkey", AssetKey="s_nationkey")


def _lines(t: Tables) -> DataFrame:
    return t.lineitem().withColumn("kept", F.lit(1).cast("decimal(5,4)") - F.col("l_discount"))


def production(t: Tables) -> DataFrame:
    def of(flag: str) -> Column:
        return F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))

    lines = _lines(t).withColumns({"OilBbl": of("N"), "GasMscf": of("A"), "WaterBbl": of("R")})
    lines = lines.withColumn("GrossBoe", derive.boe("OilBbl", "GasMscf", F.lit(6).cast(DIVISOR))).join(
        _wells(t), "l_suppkey")
    return project(lines, "AssetKey", "OilBbl", "GasMscf", "WaterBbl", "GrossBoe", WellKey="l_suppkey",
                   DateKey=date_key("l_shipdate"), NetWiBoe=half_up(F.col("GrossBoe") * F.col("kept"), VOLUME),
                   IsComplete=(F.col("l_linestatus") == "F").cast("int"),
                   RetractedCount=(F.col("l_linenumber") > 5).cast("int"), SelectedSources="l_returnflag",
                   MaxRevision="l_linenumber", PublicationId=_id("PUB-", "l_orderkey"))


def losses(t: Tables) -> DataFrame:
    lines = _lines(t).where("l_linestatus = 'O'").join(_wells(t), "l_suppkey").join(
        t.orders().select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("IncidentKey")), "l_orderkey")
    return project(lines, "AssetKey", "IncidentKey", WellKey="l_suppkey", DateKey=date_key("l_shipdate"),
                   LostBoeGross="l_quantity", LostBoeNetWi=half_up(F.col("l_quantity") * F.col("kept"), VOLUME),
                   ValueUsdGross="l_extendedprice",
                   ValueUsdNetWi=half_up(F.col("l_extendedprice") * F.col("kept"), MONEY))


def gold(t: Tables) -> dict[str, DataFrame]:
    customer = t.raw("customer").select("c_custkey", F.col("c_nationkey").alias("AssetKey"), "c_mktsegment")
    asset = project(t.nations(), AssetKey="n_nationkey", AssetId=_id("A-", "n_nationkey"), AssetName="n_name",
                    CountryCode=_id("R", "n_regionkey"), CountryName="r_name")
    supplier = t.raw("supplier").withColumnRenamed("s_nationkey", "AssetKey").join(
        asset.select("AssetKey", "AssetId", "CountryCode"), "AssetKey")
    orders = t.orders().join(customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    days = t.orders().select(F.col("o_orderdate").alias("d")).unionByName(t.lineitem().select(F.col("l_shipdate").alias("d")))
    month, priority = date_key(F.trunc("o_orderdate", "month")), F.col("o_orderpriority")
    costs = orders.groupBy("AssetKey", month.alias("MonthDateKey"), priority.alias("CostCategoryKey")).agg(
        F.sum("o_totalprice").alias("AmountUsd"))
    outages = t.raw("events").withColumnRenamed("user_id", "c_custkey").join(customer, "c_custkey")
    return {
        "dim_asset": asset,
        "dim_well": project(supplier, "AssetId", "CountryCode", WellKey="s_suppkey", WellId=_id("W-", "s_suppkey"),
                            WellName="s_name", WellStatus=F.when(F.col("s_acctbal") < 0, "SHUT").otherwise("ACTIVE")),
        "dim_date": derive.calendar(days.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))),
        "dim_cost_category": project(t.orders().select("o_orderpriority").distinct(), CostCategoryKey="o_orderpriority",
                                     CostCategory=F.substring_index("o_orderpriority", "-", -1)),
        "dim_incident": project(customer, IncidentKey="c_custkey", IncidentId=_id("I-", "c_custkey"),
                                IncidentCategory="c_mktsegment"),
        "dim_equipment": project(t.raw("events").select("event_type").distinct(), EquipmentKey="event_type",
                                 EquipmentId=_id("E-", "event_type")),
        "fact_production_daily": production(t),
        "fact_target_daily": project(orders, "AssetKey", DateKey=date_key("o_orderdate"), TargetBoe=volume("o_totalprice")),
        "fact_operating_cost_monthly": costs,
        "fact_downtime_event": project(outages, "AssetKey", IncidentKey="c_custkey", EquipmentKey="event_type",
                                       StartDateKey=date_key("ts"), DurationHours=F.col("value").cast(HOURS)),
        "fact_loss_allocation": losses(t),
        "source_decision": project(t.lineitem(), WellId=_id("W-", "l_suppkey"), BusinessDate="l_shipdate",
                                   Commodity="l_returnflag", SelectedSourceSystem=_id("SRC_", "l_linenumber"),
                                   DecisionStatus=F.when(F.col("l_linestatus") == "F", "SELECTED").otherwise("AMBIGUOUS"))}


_GOLD = """
asset AS (SELECT n_nationkey AS k, n_name AS asset, r_name AS country, r_regionkey FROM nation
  JOIN region ON r_regionkey = n_regionkey),
lines AS (SELECT *, CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS DECIMAL(19,6)) AS q,
  CAST(l_extendedprice AS DECIMAL(19,4)) AS price, 1 - CAST(l_discount AS DECIMAL(5,4)) AS kept
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN asset ON k = s_nationkey),
volumes AS (SELECT *, CASE WHEN l_returnflag = 'N' THEN q END AS oil, CASE WHEN l_returnflag = 'A' THEN q END AS gas,
  CASE WHEN l_returnflag = 'R' THEN q END AS water, CASE l_returnflag WHEN 'N' THEN q WHEN 'A' THEN CAST(
    CAST((CAST(q * 1000000 AS HUGEINT) * 2 + 6) // 12 AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(19,6))
    END AS gross FROM lines),
prod AS (SELECT *, CAST(round(gross * kept, 6) AS DECIMAL(19,6)) AS net FROM volumes),
plan AS (SELECT asset, country, r_regionkey, CAST(o_orderdate AS DATE) AS d, o_orderpriority,
  CAST(o_totalprice AS DECIMAL(19,4)) AS amount
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN asset ON k = c_nationkey),
lost AS (SELECT lines.*, o_custkey, CAST(round(q * kept, 6) AS DECIMAL(19,6)) AS net,
  CAST(round(price * kept, 4) AS DECIMAL(19,4)) AS net_value FROM lines JOIN orders ON o_orderkey = l_orderkey
  WHERE l_linestatus = 'O'),
outages AS (SELECT *, CAST(value AS DECIMAL(9,3)) AS hours FROM events JOIN customer ON c_custkey = user_id
  JOIN asset ON k = c_nationkey)"""


def shown(df: DataFrame) -> DataFrame:
    """Measure names as plain column names; volumes as double, counts as bigint, ratios with four digits."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        name = f.name.lower().replace("%", "pct").replace(" ", "_")
        ratio = name.endswith("_pct") or "_per_" in name
        value = F.round(out_num(c), 4) if ratio else out_num(c) if kind.startswith("decimal") else (
            out_int(c) if kind in ("int", "bigint", "tinyint") else out_text(c))
        out.append(value.alias(name))
    return df.select(*out)


# --- measures --------------------------------------------------------------------------

_PRODUCTION = """CAST(sum(gross) AS DOUBLE) AS gross_boe, CAST(sum(net) AS DOUBLE) AS net_wi_boe, CAST(sum(oil) AS DOUBLE) AS oil_bbl,
  CAST(sum(gas) AS DOUBLE) AS gas_mscf, CAST(sum(water) AS DOUBLE) AS water_bbl, count(DISTINCT d) AS production_days,
  round(CAST(sum(gross) AS DOUBLE) / count(DISTINCT d), 4) AS avg_gross_boe_per_day,
  CAST(coalesce(sum(oil), 0) + coalesce(sum(water), 0) AS DOUBLE) AS liquid_bbl,
  round(CAST(sum(water) AS DOUBLE) / CAST(coalesce(sum(oil), 0) + coalesce(sum(water), 0) AS DOUBLE), 4) AS water_cut_pct,
  count(*) AS stream_days, CAST(count(*) FILTER (l_linestatus = 'F') AS BIGINT) AS complete_stream_days,
  round(CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) / count(*), 4) AS data_completeness_pct,
  CAST(count(*) FILTER (l_linenumber > 5) AS BIGINT) AS retracted_observations"""


@query(f"WITH {_GOLD} SELECT country AS countryname, {_PRODUCTION} FROM prod GROUP BY 1")
def measures_production(t: Tables) -> DataFrame:
    """Every production measure by country: volumes, averages, water cut, completeness, retractions."""
    return shown(measures.measure_query(gold(t), [
        "Gross BOE", "Net WI BOE", "Oil bbl", "Gas Mscf", "Water bbl", "Production Days", "Avg Gross BOE per Day",
        "Liquid bbl", "Water Cut %", "Stream Days", "Complete Stream Days", "Data Completeness %",
        "Retracted Observations"], ["dim_asset.CountryName"]))


@query(f"""
WITH {_GOLD}, a AS (SELECT asset, strftime(d, '%Y-%m') AS m, sum(gross) AS g FROM prod GROUP BY 1, 2),
b AS (SELECT asset, strftime(d, '%Y-%m') AS m, sum(amount) AS t FROM plan GROUP BY 1, 2)
SELECT asset AS assetname, m AS yearmonth, CAST(g AS DOUBLE) AS gross_boe, CAST(t AS DOUBLE) AS target_boe,
  round(CAST(g AS DOUBLE) / CAST(t AS DOUBLE), 4) AS target_achievement_pct,
  CAST(CAST(coalesce(g, 0) AS DECIMAL(38,6)) - CAST(coalesce(t, 0) AS DECIMAL(38,6)) AS DOUBLE) AS variance_to_target_boe
FROM a FULL JOIN b USING (asset, m) WHERE g IS NOT NULL OR t IS NOT NULL
""")
def measures_target(t: Tables) -> DataFrame:
    """Production against target by asset and month, from two facts."""
    return shown(measures.measure_query(gold(t), ["Gross BOE", "Target BOE", "Target Achievement %",
                                                  "Variance to Target BOE"],
                                        ["dim_asset.AssetName", "dim_date.YearMonth"]))


_LOST = """CAST(sum(q) AS DOUBLE) AS lost_boe_gross, CAST(sum(net) AS DOUBLE) AS lost_boe_net_wi,
  CAST(sum(price) AS DOUBLE) AS loss_value_usd_gross, CAST(sum(net_value) AS DOUBLE) AS loss_value_usd_net_wi,
  count(DISTINCT l_suppkey) AS affected_wells"""
_IMPACT = ["Lost BOE Gross", "Lost BOE Net WI", "Loss Value USD Gross", "Loss Value USD Net WI", "Affected Wells",
           "Downtime Hours", "Downtime Events"]


@query(f"""
WITH {_GOLD}, a AS (SELECT country, {_LOST} FROM lost GROUP BY 1),
b AS (SELECT country, CAST(sum(hours) AS DOUBLE) AS downtime_hours, count(*) AS downtime_events FROM outages GROUP BY 1)
SELECT country AS countryname, a.* EXCLUDE (country), b.* EXCLUDE (country) FROM a FULL JOIN b USING (country)
""")
def measures_loss(t: Tables) -> DataFrame:
    """Losses, their value, affected wells and downtime by country."""
    return shown(measures.measure_query(gold(t), _IMPACT, ["dim_asset.CountryName"]))


@query("""
SELECT s_name AS wellname, count(*) AS source_decisions,
  CAST(count(*) FILTER (l_linestatus <> 'F') AS BIGINT) AS decisions_needing_review
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1
""")
def measures_decisions(t: Tables) -> DataFrame:
    """Decisions, and those that need a review, by well."""
    return shown(measures.measure_query(gold(t), ["Source Decisions", "Decisions Needing Review"], ["dim_well.WellName"]))


@query("""
WITH p AS (SELECT max('PUB-' || o_orderkey) AS id, max(o_orderpriority) AS who, max(o_orderdate) AS t FROM orders
  WHERE o_orderstatus = 'F'), g AS (SELECT max('PUB-' || l_orderkey) AS id FROM lineitem SEMI JOIN supplier ON s_suppkey = l_suppkey)
SELECT p.id AS current_publication, who AS approved_by, strftime(t, '%Y-%m-%d %H:%M:%S') AS published_at_utc,
  'SSOT ' || p.id || ' | approved by ' || who || ' | published ' || strftime(t, '%Y-%m-%d %H:%M') || ' UTC' AS trust_banner,
  CASE WHEN g.id = p.id THEN 'Consistent' ELSE 'Check refresh' END AS gold_matches_publication FROM p, g
""")
def trust_banner(t: Tables) -> DataFrame:
    """Current publication, who approved it, the banner, and whether the rows are of it; every finished order is one."""
    publications = t.orders().select(
        _id("PUB-", "o_orderkey").alias("PublicationId"), F.col("o_orderpriority").alias("DecidedBy"),
        F.when(F.col("o_orderstatus") == "F", "PUBLISHED").otherwise("STAGED").alias("Status"),
        F.col("o_orderdate").cast("timestamp").alias("PublishedAtUtc"))
    return shown(measures.trust(publications, production(t)))


# --- reports ---------------------------------------------------------------------------

@query(f"""
WITH {_GOLD}
SELECT country AS countryname, CAST(sum(gross) AS DOUBLE) AS grossboe, CAST(sum(net) AS DOUBLE) AS netwiboe,
  CAST(round(CAST(100 * count(*) FILTER (l_linestatus = 'F') AS DECIMAL(18,8)) / count(*), 2) AS DOUBLE) AS completenesspct
FROM prod GROUP BY 1
""")
def report_by_country(t: Tables) -> DataFrame:
    """Gross, net and completeness by country."""
    return shown(reports.by_country(gold(t)))


@query(f"""
WITH {_GOLD}, a AS (SELECT d, sum(gross) AS g FROM prod GROUP BY 1), b AS (SELECT d, sum(amount) AS t FROM plan GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS date, CAST(g AS DOUBLE) AS gross_boe, CAST(t AS DOUBLE) AS target_boe
FROM a FULL JOIN b USING (d) WHERE g IS NOT NULL OR t IS NOT NULL
""")
def report_daily_target(t: Tables) -> DataFrame:
    """Production and target of every day."""
    return shown(reports.daily_actual_target(gold(t)))


@query(f"""
WITH {_GOLD}, a AS (SELECT country, asset, sum(gross) AS g FROM prod GROUP BY 1, 2),
b AS (SELECT country, asset, sum(amount) AS t FROM plan GROUP BY 1, 2),
r AS (SELECT country, asset, grouping(country) * 2 + grouping(asset) AS level, CAST(sum(g) AS DECIMAL(38,6)) AS g,
  CAST(sum(t) AS DECIMAL(38,6)) AS t FROM a FULL JOIN b USING (country, asset) GROUP BY ROLLUP (country, asset))
SELECT country AS countryname, asset AS assetname, CAST(level AS BIGINT) AS level, CAST(g AS DOUBLE) AS gross_boe,
  CAST(t AS DOUBLE) AS target_boe, CAST(coalesce(g, 0) - coalesce(t, 0) AS DOUBLE) AS variance_to_target_boe,
  round(CAST(g AS DOUBLE) / CAST(t AS DOUBLE), 4) AS target_achievement_pct FROM r
""")
def report_asset_matrix(t: Tables) -> DataFrame:
    """Country over asset with subtotals and the total."""
    return shown(reports.asset_matrix(gold(t)))


@query(f"""
WITH {_GOLD} SELECT s_name AS wellname, CAST(sum(gross) AS DOUBLE) AS gross_boe FROM prod GROUP BY 1
HAVING sum(gross) IS NOT NULL ORDER BY sum(gross) DESC, 1 LIMIT 10
""")
def report_top_wells(t: Tables) -> DataFrame:
    """Ten wells of the largest gross volume."""
    return shown(reports.top_wells(gold(t)))


@query(f"""
WITH {_GOLD}, a AS (SELECT o_custkey, {_LOST} FROM lost WHERE o_custkey = 7 GROUP BY 1),
b AS (SELECT user_id, CAST(sum(hours) AS DOUBLE) AS downtime_hours, count(*) AS downtime_events FROM outages WHERE user_id = 7 GROUP BY 1)
SELECT '{INCIDENT}' AS incidentid, a.* EXCLUDE (o_custkey), b.* EXCLUDE (user_id) FROM a FULL JOIN b ON o_custkey = user_id
""")
def report_incident_impact(t: Tables) -> DataFrame:
    """What one incident cost: wells, losses, their value and downtime."""
    return shown(reports.incident_impact(gold(t), INCIDENT))


@query(f"""
WITH {_GOLD} SELECT 'W-' || l_suppkey AS wellid, CAST(sum(q) AS DOUBLE) AS lost_boe_gross, CAST(sum(net) AS DOUBLE) AS lost_boe_net_wi
FROM lost WHERE o_custkey = 7 GROUP BY 1
""")
def report_loss_by_well(t: Tables) -> DataFrame:
    """Losses of one incident by well."""
    return shown(reports.loss_by_well(gold(t), INCIDENT))


@query(f"""
WITH {_GOLD} SELECT '{INCIDENT}' AS incidentid, c_mktsegment AS incidentcategory, 'E-' || event_type AS equipmentid,
  count(*) AS eventcount, CAST(sum(hours) AS DOUBLE) AS equipmentdowntimehours FROM outages WHERE user_id = 7 GROUP BY 1, 2, 3
""")
def report_incident_equipment(t: Tables) -> DataFrame:
    """Equipment of one incident: events and hours."""
    return shown(reports.incident_equipment(gold(t), INCIDENT))


@query(f"""
WITH {_GOLD} SELECT strftime(d, '%Y-%m') AS yearmonth, regexp_replace(o_orderpriority, '^.*-', '') AS costcategory,
  CAST(sum(amount) AS DOUBLE) AS opex_usd FROM plan GROUP BY 1, 2
""")
def report_opex_month(t: Tables) -> DataFrame:
    """Cost by month and category."""
    return shown(reports.opex_by_month_category(gold(t)))


@query(f"""
WITH {_GOLD}, a AS (SELECT country, sum(amount) AS c FROM plan GROUP BY 1), b AS (SELECT country, sum(gross) AS g FROM prod GROUP BY 1)
SELECT country AS countryname, CAST(c AS DOUBLE) AS opex_usd, CAST(g AS DOUBLE) AS gross_boe,
  round(CAST(c AS DOUBLE) / CAST(g AS DOUBLE), 4) AS opex_per_boe_usd FROM a FULL JOIN b USING (country)
""")
def report_opex_per_boe(t: Tables) -> DataFrame:
    """Cost per BOE by country, from two facts."""
    return shown(reports.opex_per_boe(gold(t)))


@query(f"""
WITH {_GOLD} SELECT CAST(d AS VARCHAR) AS date, CAST(sum(oil) AS DOUBLE) AS oil_bbl, CAST(sum(gas) AS DOUBLE) AS gas_mscf,
  CAST(sum(water) AS DOUBLE) AS water_bbl FROM prod WHERE l_suppkey = 1 GROUP BY d
""")
def report_well_series(t: Tables) -> DataFrame:
    """Oil, gas and water of one well by day."""
    return shown(reports.well_series(gold(t), WELL))


@query(f"""
SELECT '{WELL}' AS wellid, s_name AS wellname, 'A-' || s_nationkey AS assetid, CASE WHEN s_acctbal < 0 THEN 'SHUT' ELSE 'ACTIVE' END
  AS wellstatus, count(DISTINCT l_partkey) AS wellborecount, count(DISTINCT l_orderkey) AS completioncount,
  count(DISTINCT l_linenumber) AS aliascount
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE s_suppkey = 1 GROUP BY ALL
""")
def report_well_passport(t: Tables) -> DataFrame:
    """One well with its counts; parts, orders and line numbers stand for bores, completions and aliases."""
    star = gold(t)
    counts = t.lineitem().groupBy(F.col("l_suppkey").alias("WellKey")).agg(
        F.countDistinct("l_partkey").alias("WellboreCount"), F.countDistinct("l_orderkey").alias("CompletionCount"),
        F.countDistinct("l_linenumber").alias("AliasCount"))
    return shown(reports.well_passport(star | {"dim_well": star["dim_well"].join(counts, "WellKey")}, WELL))


@query(f"""
WITH {_GOLD} SELECT 'PUB-' || l_orderkey AS publicationid, '{WELL}' AS wellid, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS datekey,
  CAST(oil AS DOUBLE) AS oilbbl, CAST(gas AS DOUBLE) AS gasmscf, CAST(water AS DOUBLE) AS waterbbl, CAST(gross AS DOUBLE) AS grossboe,
  CAST(net AS DOUBLE) AS netwiboe, CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS iscomplete,
  l_returnflag AS selectedsources, CAST(l_linenumber AS BIGINT) AS maxrevision
FROM prod WHERE l_suppkey = 1 AND d = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_suppkey = 1)
""")
def report_one_day(t: Tables) -> DataFrame:
    """The last day of one well as it is published."""
    last = t.lineitem().where("l_suppkey = 1").agg(F.max("l_shipdate").alias("day")).scalar()
    return shown(reports.one_day(gold(t), WELL, F.coalesce(last, F.lit(DAY))))


@query(f"""
SELECT '{WELL}' AS wellid, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS businessdate, l_returnflag AS commodity,
  'SRC_' || l_linenumber AS selectedsourcesystem, CASE WHEN l_linestatus = 'F' THEN 'SELECTED' ELSE 'AMBIGUOUS' END AS decisionstatus
FROM lineitem WHERE l_suppkey = 1 AND l_returnflag = 'N'
""")
def report_decisions(t: Tables) -> DataFrame:
    """Decisions on one commodity of a well."""
    return shown(reports.explain_decision(gold(t), WELL, commodity="N"))


@query(f"""
WITH {_GOLD}, a AS (SELECT asset, sum(gross) AS g FROM prod WHERE r_regionkey IN (1, 3) GROUP BY 1),
b AS (SELECT asset, sum(amount) AS c FROM plan WHERE r_regionkey IN (1, 3) GROUP BY 1),
l AS (SELECT asset, count(DISTINCT l_suppkey) AS n FROM lost WHERE r_regionkey IN (1, 3) GROUP BY 1)
SELECT asset AS assetname, CAST(g AS DOUBLE) AS gross_boe, CAST(c AS DOUBLE) AS opex_usd, n AS affected_wells
FROM a FULL JOIN b USING (asset) FULL JOIN l USING (asset)
""")
def report_entitled(t: Tables) -> DataFrame:
    """Production, cost and affected wells as a reader of two countries sees them."""
    seen = measures.entitled(gold(t), ["R1", "R3"])
    return shown(measures.measure_query(seen, ["Gross BOE", "Opex USD", "Affected Wells"], ["dim_asset.AssetName"]))


@query(f"""
WITH {_GOLD} SELECT country AS countryname, count(*) AS wells FROM asset JOIN supplier ON s_nationkey = k
WHERE r_regionkey IN (1, 3) GROUP BY 1
""")
def report_entitled_wells(t: Tables) -> DataFrame:
    """Wells a reader of two countries sees, by country."""
    seen = measures.entitled(gold(t), ["R1", "R3"])
    return seen["dim_well"].join(seen["dim_asset"].select("AssetId", "CountryName"), "AssetId").groupBy(
        F.col("CountryName").alias("countryname")).agg(out_int(count()).alias("wells"))
