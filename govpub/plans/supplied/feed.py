"""The supplied tables as a landed batch of all entities, to run the whole pipeline on them.

Regions are countries, nations fields, suppliers wells. Line quantities per source, supplier, day
and commodity are the production reports; the return flag and status name the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import VOLUME, half_up, key_text, text_hash
from govpub.operators.ingest import entity_counts
from govpub.plans.supplied.base import Tables, money
from govpub.sources.contract import SOURCE_BY_ENTITY, SOURCE_BY_NAME, SOURCE_TABLES, union_all
from govpub.sources.extract import in_parallel
from govpub.sources.store import read_landed

PRODUCTION_COLUMNS = ["change_id", "change_seq", "observation_id", "well_ref", "report_date", "commodity", "quantity",
                      "unit", "revision", "operation", "report_status"]
IQ_COLUMNS = ["chg_id", "seq_no", "obs_key", "well_code", "obs_date", "product", "qty", "qty_unit", "rev_no", "op_code",
              "approval_flag"]
SOURCES = {"A": ("src_dz.production_report", "SRC_DZ_PROD", 1), "N": ("src_my.production_report", "SRC_MY_PROD", 2),
           "RF": ("src_iq.daily_volumes", "SRC_IQ_PROD", 3), "RO": ("src_my.production_provisional", "SRC_MY_OPS", 99)}


def _text(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column))


def reports(t: Tables) -> DataFrame:
    """One report per source, well, day and commodity; the first source reports oil and water in m3."""
    n = F.col("l_linenumber")
    lines = t.lineitem().select(
        F.when(F.col("l_returnflag") == "R", F.concat("l_returnflag", "l_linestatus"))
        .otherwise(F.col("l_returnflag")).alias("feed"), _text("X", "l_suppkey").alias("well_ref"),
        F.col("l_shipdate").alias("report_date"),
        F.when(n <= 3, "Oil").when(n <= 5, "Gas").otherwise("Water").alias("commodity"), "l_quantity")
    sums = lines.groupBy("feed", "well_ref", "report_date", "commodity").agg(F.sum("l_quantity").alias("quantity"))
    metric = (F.col("feed") == "A") & (F.col("commodity") != "Gas")
    factor = F.lit("6.289810770").cast("decimal(18,9)")
    quantity = F.when(metric, half_up(F.col("quantity").cast("decimal(19,6)") / factor, VOLUME)).otherwise(
        F.col("quantity").cast(VOLUME))
    unit = F.when(metric, "m3").when(F.col("commodity") == "Gas", "Mscf").otherwise("bbl")
    return sums.select(
        "feed", key_text("feed", "well_ref", "report_date", "commodity").alias("change_id"),
        F.xxhash64("feed", "well_ref", "report_date", "commodity").alias("change_seq"),
        text_hash("feed", "well_ref", "report_date", "commodity").alias("observation_id"), "well_ref", "report_date",
        "commodity", quantity.alias("quantity"), unit.alias("unit"), F.lit(1).alias("revision"),
        F.lit("I").alias("operation"),
        F.when(F.col("feed") == "RO", "PROVISIONAL").otherwise("FINAL").alias("report_status"))


def entities(t: Tables) -> dict[str, DataFrame]:
    region, nation, supplier = t.raw("region"), t.raw("nation"), t.raw("supplier")
    field, well = _text("F", "n_nationkey"), _text("W", "s_suppkey")
    out = {
        "ref.country": region.select(_text("R", "r_regionkey").alias("country_id"), F.col("r_name").alias("country_name")),
        "ref.business_associate": region.where("r_regionkey = 0").select(
            F.lit("BA").alias("ba_id"), F.lit("Operator").alias("ba_name"), F.lit("OPERATOR").alias("ba_role")),
        "ref.field": nation.select(field.alias("field_id"), _text("R", "n_regionkey").alias("country_id"),
                                   F.col("n_name").alias("field_name")),
        "ref.facility": nation.select(_text("FAC", "n_nationkey").alias("facility_id"), field.alias("field_id"),
                                      F.col("n_name").alias("facility_name")),
        "ref.equipment": nation.select(_text("EQ", "n_nationkey").alias("equipment_id"),
                                       _text("FAC", "n_nationkey").alias("facility_id"),
                                       F.col("n_name").alias("equipment_name"), F.lit("PUMP").alias("equipment_type")),
        "ref.well": supplier.select(well.alias("well_id"), _text("F", "s_nationkey").alias("field_id"),
                                    F.col("s_name").alias("well_name"), F.lit("ACTIVE").alias("well_status")),
        "ref.wellbore": supplier.select(_text("B", "s_suppkey").alias("wellbore_id"), well.alias("well_id"),
                                        F.col("s_name").alias("wellbore_name")),
        "ref.well_completion": supplier.select(
            _text("C", "s_suppkey").alias("completion_id"), _text("B", "s_suppkey").alias("wellbore_id"),
            _text("S", "s_suppkey").alias("stream_id"), F.col("s_name").alias("completion_name")),
        "ref.reporting_stream": supplier.select(_text("S", "s_suppkey").alias("stream_id"), well.alias("well_id"),
                                                F.col("s_name").alias("stream_name")),
        "ref.well_alias": supplier.select(
            F.explode(F.array(*[F.lit(s) for _, s, _ in SOURCES.values()])).alias("source_system"),
            _text("X", "s_suppkey").alias("source_well_id"), well.alias("well_id")),
    }
    units = [("Oil", "bbl", "bbl", "1", "1"), ("Oil", "m3", "bbl", "6.289810770", "1"), ("Gas", "Mscf", "Mscf", "1", "6"),
             ("Gas", "scf", "Mscf", "0.001", "6"), ("Water", "bbl", "bbl", "1", None),
             ("Water", "m3", "bbl", "6.289810770", None)]
    out["ref.uom_conversion"] = t.spark.createDataFrame(
        units, "commodity string, uom string, standard_uom string, f string, d string").select(
        "commodity", "uom", "standard_uom", F.col("f").cast("decimal(18,9)").alias("to_standard_factor"),
        F.col("d").cast("decimal(9,3)").alias("boe_divisor"), F.lit("UOM-1").alias("factor_version"))
    out["ref.source_authority"] = t.spark.createDataFrame(
        [(s, p, "NONE" if p == 99 else "FINAL") for _, s, p in SOURCES.values()],
        "source_system string, priority int, eligible_status string").select(
        F.lit("SA-1").alias("policy_version"), F.lit("PRODUCTION").alias("domain"), "source_system",
        F.lit("ALL").alias("scope"), "priority", "eligible_status", F.lit("1990-01-01").cast("date").alias("valid_from"),
        F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit("owner").alias("owner_role"))
    share = (F.lit("0.3").cast("decimal(9,6)") + F.col("n_nationkey").cast("decimal(9,6)") / 100)
    turn = [("1990-01-01", "1998-07-01", "0"), ("1998-07-01", "9999-12-31", "0.05")]
    out["ref.working_interest"] = union_all([nation.select(
        field.alias("field_id"), F.lit(a).cast("date").alias("valid_from"), F.lit(b).cast("date").alias("valid_to"),
        F.lit("BA").alias("operator_ba_id"), (share + F.lit(x).cast("decimal(9,6)")).cast("decimal(9,6)").alias("wi_share"),
        F.lit("JOA").alias("agreement_ref")) for a, b, x in turn])
    out["ref.target_monthly"] = nation.select(
        field.alias("field_id"), F.explode(F.array(F.lit("Oil"), F.lit("Gas"))).alias("commodity"),
        F.lit("PLAN").alias("scenario_id"), F.col("n_nationkey"), F.lit("x").alias("target_uom")).select(
        "*", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("target_year")).select(
        "field_id", "commodity", "scenario_id", "target_year",
        *[(F.col("n_nationkey") * 37 + 1000 + m).cast(VOLUME).alias(f"m{m:02d}") for m in range(1, 13)], "target_uom")
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    orders = t.orders().join(customer, "o_custkey")
    month = F.trunc("o_orderdate", "month")
    currency = F.when(F.col("c_nationkey") < 8, "USD").when(F.col("c_nationkey") < 16, "MYR").otherwise("DZD")
    out["ref.operating_cost"] = orders.groupBy("c_nationkey", month.alias("month_start"), "c_mktsegment").agg(
        money(F.sum("o_totalprice")).alias("amount_local")).select(
        key_text(F.lit("OPEX"), "c_nationkey", "month_start", "c_mktsegment").alias("cost_id"),
        _text("F", "c_nationkey").alias("field_id"), "month_start", F.col("c_mktsegment").alias("cost_category"),
        currency.alias("currency_code"), "amount_local", F.lit("CLOSED").alias("closing_status"))
    out["ref.fx_rate"] = t.orders().select(month.alias("valid_on")).distinct().select(
        "valid_on", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).cast("decimal(18,9)").alias("r"))
                                        for c, r in (("USD", "1"), ("MYR", "0.219"), ("DZD", "0.0073"))])).alias("x")
    ).select("valid_on", F.col("x.c").alias("currency_code"), F.col("x.r").alias("usd_per_unit"))
    out["ref.price"] = t.orders().select(F.col("o_orderdate").alias("business_date")).distinct().select(
        "business_date", F.explode(F.array(*[F.struct(F.lit(c).alias("commodity"), F.lit(p).cast(VOLUME).alias("price_usd"),
                                                      F.lit(u).alias("price_unit"), F.lit(e).cast("decimal(9,6)").alias("energy_factor"))
                                             for c, p, u, e in (("Oil", "70", "USD/bbl", "1"),
                                                                ("Gas", "3", "USD/MMBtu", "1.03"))])).alias("x")).select(
        "business_date", "x.*")
    for feed, (name, _, _) in SOURCES.items():
        own = reports(t).where(F.col("feed") == feed).select(*PRODUCTION_COLUMNS)
        if name == "src_iq.daily_volumes":
            code = F.upper(F.when(F.col("commodity") == "Water", "WTR").otherwise(F.col("commodity")))
            own = own.withColumns({"commodity": code, "report_status": F.lit("Y")}).toDF(*IQ_COLUMNS)
        out[name] = own
    open_orders = orders.where("o_orderstatus = 'P'")
    start = F.col("o_orderdate").cast("timestamp")
    out["src_my.downtime_event"] = open_orders.select(
        _text("DT", "o_orderkey").alias("event_id"), _text("INC", "c_nationkey").alias("incident_id"),
        _text("EQ", "c_nationkey").alias("equipment_id"), start.alias("start_utc"),
        (start + F.expr("INTERVAL 12 HOURS")).alias("end_utc"), F.lit("outage").alias("reason"),
        F.col("o_orderkey").alias("change_seq"))
    lost = t.lineitem().select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_quantity", "l_linenumber",
                               "l_partkey").join(t.orders().where("o_orderstatus = 'P'"), "o_orderkey")
    out["src_my.loss_allocation"] = lost.select(
        key_text(F.lit("LA"), "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("loss_id"),
        _text("DT", "o_orderkey").alias("event_id"), _text("W", "l_suppkey").alias("well_ref"),
        F.col("o_orderdate").alias("business_date"), F.col("l_quantity").alias("lost_oil_bbl"),
        (F.col("l_quantity") * 6).cast(VOLUME).alias("lost_gas_mscf"), F.lit("APPROVED").alias("allocation_status"),
        F.col("o_orderkey").alias("change_seq"))
    return out


def land_supplied(t: Tables, landing: str, batch_id: str = "B0", parent: str | None = None) -> None:
    """Write the batch as it would be landed, with its control files."""
    root = f"{landing}/{batch_id}"

    def write(item) -> None:
        name, df = item
        table = SOURCE_BY_NAME[name]
        df.withColumn("batch_id", F.lit(batch_id)).select(
            *[F.col(f.name).cast(f.dataType) for f in table.schema]).write.mode("overwrite").parquet(
            f"{root}/{table.entity}")

    in_parallel(write, list(entities(t).items()))
    landed = {x.entity: read_landed(t.spark, f"{root}/{x.entity}") for x in SOURCE_TABLES if x.entity in SOURCE_BY_ENTITY
              and not x.name.startswith("ctl.")}
    counts = entity_counts(landed).select(
        F.lit(batch_id).alias("batch_id"), "entity_name", F.col("actual_rows").alias("row_count"),
        F.lit("").alias("content_sha256"))
    counts.write.mode("overwrite").parquet(f"{root}/ctl__batch_entity")
    days = t.lineitem().agg(F.min("l_shipdate").alias("period_start"), F.max("l_shipdate").alias("period_end"))
    days.select(F.lit(batch_id).alias("batch_id"), F.lit(parent).cast("string").alias("parent_batch_id"),
                F.lit("supplied").alias("dataset_version"), F.lit("supplied tables").alias("description"),
                "period_start", "period_end", F.lit("SEALED").alias("state"), F.lit("").alias("content_sha256"),
                F.current_timestamp().alias("sealed_at_utc")).write.mode("overwrite").parquet(f"{root}/ctl__source_batch")
