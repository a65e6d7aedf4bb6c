"""Reconciliation, measures, publications, graph and channel checks on the supplied tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govpub.functions.columns import MONEY, VOLUME, half_up, key_text, safe_ratio
from govpub.functions.skew import spread, tasks_for
from govpub.operators import derive, graph, measures, publish, recon, registry, resolve
from govpub.operators.quality import passed
from govpub.plans.supplied.base import Tables, count, money, out_int, out_num, out_text, query
from govpub.plans.supplied.derivations import _SHARES, share_register
from govpub.plans.supplied.governance import _CHECKED, _FEEDS, approved_places, two_feeds, unit_register
from govpub.sources.extract import in_parallel
from govpub.sources.store import Store
from govpub.sources.versions import VersionedTable

# --- the whole chain -------------------------------------------------------------------

FEED_POLICY = [("SRC_1", "ALL", 1, "FINAL", "1995-01-01", "9999-12-31"),
               ("SRC_2", "EUROPE", 1, "FINAL", "1995-01-01", "9999-12-31"),
               ("SRC_2", "ALL", 2, "FINAL", "1995-01-01", "2000-01-01")]
_FEED_POLICY_SQL = ", ".join(f"('{s}', '{c}', {p}, '{e}', DATE '{a}', DATE '{b}')" for s, c, p, e, a, b in FEED_POLICY)


def feed_policy(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([("P-1", *r) for r in FEED_POLICY],
                                   "policy_version string, source_system string, scope string, priority int, "
                                   "eligible_status string, valid_from string, valid_to string")
    return rows.withColumns({"valid_from": F.col("valid_from").cast("date"), "valid_to": F.col("valid_to").cast("date")})


@query(f"""
WITH {_FEEDS}, {_CHECKED}, {_SHARES},
policy(source, scope, priority, eligible_status, a, b) AS (VALUES {_FEED_POLICY_SQL}),
valid AS (SELECT row_number() OVER () AS id, stream_id, field_id, country_id, report_date, commodity, source_system,
  report_status, CASE WHEN operation = 'D' THEN 'RETRACTED' ELSE 'CURRENT' END AS status,
  CASE WHEN operation <> 'D' THEN CAST(round(quantity * factor, 6) AS DECIMAL(19,6)) END AS value
  FROM checked WHERE failed_rules = ''),
matched AS (SELECT v.*, p.priority, coalesce(p.eligible_status = v.report_status, false) AS eligible,
  row_number() OVER (PARTITION BY id ORDER BY p.priority NULLS LAST, p.scope = 'ALL') AS pr
 FROM valid v LEFT JOIN policy p ON p.source = v.source_system AND p.scope IN (v.country_id, 'ALL')
  AND report_date >= p.a AND report_date < p.b),
best AS (SELECT stream_id, report_date, commodity, min(priority) AS priority FROM matched WHERE pr = 1 AND eligible GROUP BY ALL),
decided AS (SELECT stream_id, report_date, commodity, any_value(status) AS status, any_value(value) AS value
  FROM matched JOIN best USING (stream_id, report_date, commodity, priority) WHERE pr = 1 AND eligible
  GROUP BY ALL HAVING count(DISTINCT concat_ws('|', status, value)) = 1),
daily AS (SELECT stream_id, report_date, sum(value) FILTER (commodity = 'Oil') AS oil,
  sum(value) FILTER (commodity = 'Gas') AS gas, count(*) FILTER (status = 'CURRENT') AS n,
  count(*) FILTER (status = 'RETRACTED') AS r FROM decided GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem),
dense AS (SELECT p.country_id, p.field_id, p.stream_id, d, oil, gas, coalesce(n, 0) AS n, coalesce(r, 0) AS r,
  CASE WHEN oil IS NOT NULL OR gas IS NOT NULL THEN CAST(coalesce(oil, 0) + CAST(
    (CAST(coalesce(gas, 0) * 1000000 AS HUGEINT) * 2 + 6) // 12 AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(6,6))
    AS DECIMAL(19,6)) END AS gross
  FROM places p CROSS JOIN days LEFT JOIN daily y ON y.stream_id = p.stream_id AND y.report_date = d)
SELECT country_id, count(*) AS stream_days, count(*) FILTER (n = 3) AS complete_days,
  CAST(count(*) FILTER (n > 0) AS BIGINT) AS reported_days, CAST(sum(r) AS BIGINT) AS retracted,
  CAST(sum(gross) AS DOUBLE) AS gross_boe,
  CAST(sum(CAST(round(gross * share, 6) AS DECIMAL(19,6))) AS DOUBLE) AS net_boe
FROM dense x LEFT JOIN shares s ON s.n_nationkey = x.field_id AND d >= s.a AND d < s.b GROUP BY 1
""")
def governed_totals(t: Tables) -> DataFrame:
    """Two feeds conformed, checked and decided by policy, then gross, net and completeness per region."""
    flagged = resolve.standardise(two_feeds(t), approved_places(t), unit_register(t))
    valued = resolve.standard_values(passed(flagged))
    scored = resolve.match_policy(valued, feed_policy(t), "source_system", "country_id", "report_date",
                                  "report_status")
    chosen = resolve.select_authoritative(
        scored.select("stream_id", "report_date", "commodity", "source_system", "observation_id", "priority",
                      "eligible", "observation_status", "value_std"),
        ["stream_id", "report_date", "commodity"], ["observation_status", "value_std"],
        ["source_system", "observation_id"]).selected
    current = F.col("observation_status") == "CURRENT"
    daily = derive.pivot_sum(chosen, ["stream_id", "report_date"], "commodity", "value_std",
                             {"Oil": "OilBbl", "Gas": "GasMscf"}, where=current,
                             extra=[F.count_if(current).cast("int").alias("ObservationCount"),
                                    F.count_if(~current).cast("int").alias("RetractedCount")])
    bounds = t.lineitem().agg(F.struct(F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e")))
    keys = (approved_places(t).where("source_system = 'SRC_1'")
            .select("stream_id", "field_id", "country_id").withColumn("_b", bounds.scalar()))
    grid = derive.key_day_grid(keys, "_b.s", "_b.e").drop("_b")
    dense = derive.dense_daily(grid, daily, {"stream_id": "stream_id", "BusinessDate": "report_date"},
                               ["ObservationCount", "RetractedCount"], 3)
    dense = dense.withColumn("gross", derive.boe("OilBbl", "GasMscf", F.lit(6).cast("decimal(9,3)")))
    shared = registry.join_effective(dense, share_register(t), {"field_id": "n_nationkey"}, "BusinessDate",
                                     "valid_from", "valid_to", ["share"])
    return shared.groupBy("country_id").agg(
        out_int(count()).alias("stream_days"), out_int(F.sum("IsComplete")).alias("complete_days"),
        out_int(F.count_if(F.col("ObservationCount") > 0)).alias("reported_days"),
        out_int(F.sum("RetractedCount")).alias("retracted"), out_num(F.sum("gross")).alias("gross_boe"),
        out_num(F.sum(half_up(F.col("gross") * F.col("share"), VOLUME))).alias("net_boe"))


# --- reconciliation --------------------------------------------------------------------

@query("""
WITH l AS (SELECT sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS price, sum(CAST(l_quantity AS DECIMAL(19,6))) AS qty,
   count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS keys FROM lineitem),
s AS (SELECT sum(p) AS price, sum(q) AS qty FROM (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS p,
   sum(CAST(l_quantity AS DECIMAL(19,6))) AS q FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)),
o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders),
v AS (SELECT sum(CAST(l_quantity AS DECIMAL(19,6))) AS qty FROM lineitem SEMI JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0),
checks AS (SELECT 'price' AS check_name, l.price AS a, s.price AS b FROM l, s
 UNION ALL SELECT 'quantity', l.qty, s.qty FROM l, s UNION ALL SELECT 'quantity_approved', l.qty, v.qty FROM l, v
 UNION ALL SELECT 'order_keys_unique', n, keys FROM o UNION ALL SELECT 'line_keys_unique', n, keys FROM l)
SELECT check_name, CAST(a AS DOUBLE) AS left_value, CAST(b AS DOUBLE) AS right_value, a = b AS ok FROM checks
""")
def reconciliation_totals(t: Tables) -> DataFrame:
    """Totals of the lines against totals by supplier, and key uniqueness."""
    lines, orders = t.lineitem(), t.orders()
    supplier = t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    price, quantity = F.sum("l_extendedprice"), F.sum("l_quantity")
    by_supplier = (lines.groupBy("l_suppkey").agg(price.alias("p"), quantity.alias("q"))
                   .join(supplier, "l_suppkey"))
    approved = F.sum(F.when(F.col("s_acctbal") >= 0, F.col("q")))
    sides = [("price", (lines, price), (by_supplier, F.sum("p"))),
             ("quantity", (lines, quantity), (by_supplier, F.sum("q"))),
             ("quantity_approved", (lines, quantity), (by_supplier, approved)),
             ("order_keys_unique", (orders, count()), (orders, F.countDistinct("o_orderkey"))),
             ("line_keys_unique", (lines, count()), (lines, F.countDistinct("l_orderkey", "l_linenumber")))]
    return publish.reconcile(sides).select("check_name", out_num("left_value").alias("left_value"),
                                           out_num("right_value").alias("right_value"), "ok")


# --- star and measures -----------------------------------------------------------------

RELATIONS = [("fact_orders", "nation_key", "dim_nation", "nation_key"),
             ("fact_orders", "cust_key", "dim_customer", "cust_key"),
             ("fact_supply", "nation_key", "dim_nation", "nation_key"),
             ("fact_supply", "supp_key", "dim_supplier", "supp_key")]
MEASURES = {
    "revenue": measures.total("fact_orders", "amount"),
    "orders": measures.rows("fact_orders"),
    "order_days": measures.distinct("fact_orders", "day"),
    "buyers": measures.distinct("fact_orders", "cust_key"),
    "revenue_per_day": measures.ratio("revenue", "order_days"),
    "supply": measures.total("fact_supply", "amount"),
    "complete_lines": measures.Base("fact_supply", lambda: F.count_if(F.col("status") == "F")),
    "lines": measures.rows("fact_supply"),
    "completeness": measures.ratio("complete_lines", "lines"),
    "achievement": measures.ratio("revenue", "supply"),
    "variance": measures.Derived(("revenue", "supply"),
                                 lambda a, b: F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))),
    "suppliers": measures.distinct("fact_supply", "supp_key"),
}


def star(t: Tables) -> dict[str, DataFrame]:
    """Orders by the nation of the customer and lines by the nation of the supplier."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("cust_key"), F.col("c_nationkey").alias("nation_key"),
                                        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("customer"))
    supplier = t.raw("supplier").select(F.col("s_suppkey").alias("supp_key"), F.col("s_nationkey").alias("nation_key"),
                                        F.col("s_name").alias("supplier"))
    orders = t.orders().select(F.col("o_custkey").alias("cust_key"), F.col("o_orderdate").alias("day"),
                               F.col("o_totalprice").alias("amount"))
    lines = t.lineitem().select(F.col("l_suppkey").alias("supp_key"), F.col("l_linestatus").alias("status"),
                                F.col("l_shipdate").alias("day"), F.col("l_extendedprice").alias("amount"))
    return {"dim_nation": t.nations().select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation"),
                                             F.col("r_name").alias("region")),
            "dim_customer": customer, "dim_supplier": supplier,
            "fact_orders": orders.join(customer.select("cust_key", "nation_key"), "cust_key"),
            "fact_supply": lines.join(supplier.select("supp_key", "nation_key"), "supp_key")}


def ask(t: Tables, names: list[str], by: list[str], where=None) -> DataFrame:
    return measures.measure_query(star(t), names, by, where, MEASURES, RELATIONS)


_STAR = """
fo AS (SELECT n_name AS nation, r_name AS region, c_custkey, c_name, c_mktsegment, CAST(o_orderdate AS DATE) AS day,
  CAST(o_totalprice AS DECIMAL(19,4)) AS amount FROM orders JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
fs AS (SELECT n_name AS nation, r_name AS region, s_suppkey, l_linestatus AS status, CAST(l_shipdate AS DATE) AS day,
  CAST(l_extendedprice AS DECIMAL(19,4)) AS amount FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""


@query(f"""
WITH {_STAR},
a AS (SELECT region, CAST(sum(amount) AS DOUBLE) AS revenue, count(*) AS orders, count(DISTINCT day) AS order_days,
  count(DISTINCT c_custkey) AS buyers FROM fo GROUP BY 1),
b AS (SELECT region, count(*) FILTER (status = 'F') AS complete_lines, count(*) AS lines FROM fs GROUP BY 1)
SELECT region, revenue, orders, order_days, buyers, round(revenue / order_days, 4) AS revenue_per_day,
       complete_lines, round(CAST(complete_lines AS DOUBLE) / lines, 10) AS completeness
FROM a FULL JOIN b USING (region)
""")
def kpi_by_region(t: Tables) -> DataFrame:
    """Sums, distinct counts and ratios of sums of two facts per region."""
    out = ask(t, ["revenue", "orders", "order_days", "buyers", "complete_lines", "lines"], ["dim_nation.region"])
    return out.select("region", out_num("revenue").alias("revenue"), out_int("orders").alias("orders"),
                      out_int("order_days").alias("order_days"), out_int("buyers").alias("buyers"),
                      F.round(out_num("revenue") / F.col("order_days"), 4).alias("revenue_per_day"),
                      out_int("complete_lines").alias("complete_lines"),
                      F.round(F.col("complete_lines").cast("double") / F.col("lines"), 10).alias("completeness"))


@query(f"""
WITH {_STAR},
a AS (SELECT nation, sum(amount) AS revenue FROM fo WHERE region IN ('ASIA', 'EUROPE') GROUP BY 1),
b AS (SELECT nation, sum(amount) AS supply, count(DISTINCT s_suppkey) AS suppliers FROM fs
      WHERE region IN ('ASIA', 'EUROPE') GROUP BY 1)
SELECT nation, CAST(revenue AS DOUBLE) AS revenue, CAST(supply AS DOUBLE) AS supply, suppliers,
  CAST(coalesce(revenue, 0) - coalesce(supply, 0) AS DOUBLE) AS variance,
  round(CAST(revenue AS DOUBLE) / CAST(supply AS DOUBLE), 6) AS achievement
FROM a FULL JOIN b USING (nation)
""")
def kpi_achievement(t: Tables) -> DataFrame:
    """Two facts aggregated apart and met on the shared dimension, under a filter."""
    out = ask(t, ["revenue", "supply", "suppliers", "variance", "achievement"], ["dim_nation.nation"],
              {"dim_nation": F.col("region").isin("ASIA", "EUROPE")})
    return out.select("nation", out_num("revenue").alias("revenue"), out_num("supply").alias("supply"),
                      out_int("suppliers").alias("suppliers"), out_num("variance").alias("variance"),
                      F.round(safe_ratio(out_num("revenue"), out_num("supply")), 6).alias("achievement"))


@query(f"""
WITH {_STAR}
SELECT region, nation, CAST(grouping(region) * 2 + grouping(nation) AS BIGINT) AS level, count(*) AS orders,
       CAST(sum(amount) AS DOUBLE) AS revenue
FROM fo GROUP BY ROLLUP (region, nation)
""")
def kpi_matrix_rollup(t: Tables) -> DataFrame:
    """Region over nation with subtotals and the grand total."""
    s = star(t)
    joined = s["fact_orders"].join(s["dim_nation"], "nation_key")
    return joined.rollup("region", "nation").agg(
        out_int(F.grouping_id()).alias("level"), out_int(count()).alias("orders"), out_num(F.sum("amount")).alias("revenue"))


@query(f"""
WITH {_STAR}
SELECT c_custkey AS cust_key, c_name AS customer, CAST(sum(amount) AS DOUBLE) AS revenue
FROM fo GROUP BY 1, 2 ORDER BY sum(amount) DESC, c_custkey LIMIT 10
""")
def top10_customers(t: Tables) -> DataFrame:
    """Ten customers by revenue; ties by key."""
    s = star(t)
    top = (s["fact_orders"].groupBy("cust_key").agg(F.sum("amount").alias("total"))
           .orderBy(F.desc("total"), "cust_key").limit(10))
    return top.join(s["dim_customer"], "cust_key").select("cust_key", "customer", out_num("total").alias("revenue"))


@query(f"""
WITH {_STAR}
SELECT strftime(day, '%Y-%m') AS year_month, c_mktsegment AS segment, CAST(sum(amount) AS DOUBLE) AS amount
FROM fo GROUP BY 1, 2
""")
def monthly_category(t: Tables) -> DataFrame:
    """Amount by month and category."""
    s = star(t)
    s["fact_orders"] = s["fact_orders"].withColumn("month", F.date_format("day", "yyyy-MM"))
    joined = s["fact_orders"].join(s["dim_customer"].select("cust_key", "segment"), "cust_key")
    return joined.groupBy(F.col("month").alias("year_month"), "segment").agg(out_num(F.sum("amount")).alias("amount"))


@query(f"""
WITH {_STAR},
late AS (SELECT nation, s_suppkey, amount, day FROM fs WHERE status = 'O'),
causes AS (SELECT DISTINCT nation FROM late)
SELECT nation, count(DISTINCT s_suppkey) AS affected, count(*) AS rows_affected, CAST(sum(amount) AS DOUBLE) AS lost,
       CAST(min(day) AS VARCHAR) AS first_day
FROM late SEMI JOIN causes USING (nation) GROUP BY 1
""")
def incident_impact(t: Tables) -> DataFrame:
    """Open lines per nation: affected suppliers, rows and amount."""
    s = star(t)
    late = s["fact_supply"].where("status = 'O'")
    return late.join(s["dim_nation"], "nation_key").groupBy("nation").agg(
        out_int(F.countDistinct("supp_key")).alias("affected"), out_int(count()).alias("rows_affected"),
        out_num(F.sum("amount")).alias("lost"), out_text(F.min("day")).alias("first_day"))


@query(f"""
WITH {_STAR},
a AS (SELECT region, sum(amount) AS revenue FROM fo WHERE region IN ('ASIA', 'AFRICA') GROUP BY 1),
b AS (SELECT region, sum(amount) AS supply FROM fs WHERE region IN ('ASIA', 'AFRICA') GROUP BY 1)
SELECT region, CAST(revenue AS DOUBLE) AS revenue, CAST(supply AS DOUBLE) AS supply FROM a FULL JOIN b USING (region)
""")
def entitlement_filter(t: Tables) -> DataFrame:
    """Totals as a reader entitled to two regions sees them: dimension and facts are cut by semi joins."""
    s = star(t)
    allowed = s["dim_nation"].where(F.col("region").isin("ASIA", "AFRICA"))
    cut = dict(s, dim_nation=allowed)
    for fact in ("fact_orders", "fact_supply"):
        cut[fact] = s[fact].join(allowed.select("nation_key"), "nation_key", "left_semi")
    out = measures.measure_query(cut, ["revenue", "supply"], ["dim_nation.region"], None, MEASURES, RELATIONS)
    return out.select("region", out_num("revenue").alias("revenue"), out_num("supply").alias("supply"))


# --- publications ----------------------------------------------------------------------

AS_OF = datetime(1999, 6, 1, tzinfo=timezone.utc)


def publication_log(t: Tables) -> DataFrame:
    """Every order as a chain of versions: line n is superseded by line n + 1 of the order."""
    lines = t.lineitem().groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").cast("timestamp").alias("published_at"), F.sum("l_quantity").alias("quantity"))
    return lines.select("l_orderkey", key_text("l_orderkey", "l_linenumber").alias("publication_id"), "published_at",
                        key_text("l_orderkey", F.col("l_linenumber") + 1).alias("superseded_by"), "quantity")


def intervals(t: Tables) -> DataFrame:
    return publish.validity_intervals(publication_log(t), "publication_id", "published_at", "superseded_by",
                                      datetime(2100, 1, 1, tzinfo=timezone.utc))


_INTERVALS = """
log AS (SELECT l_orderkey, l_linenumber, max(CAST(l_shipdate AS DATE)) AS pub_at, sum(CAST(l_quantity AS DECIMAL(19,6))) AS q
  FROM lineitem GROUP BY ALL),
iv AS (SELECT a.l_orderkey, concat_ws('|', a.l_orderkey, a.l_linenumber) AS publication_id, a.q, CAST(a.pub_at AS TIMESTAMP) AS pub_at,
  coalesce(CAST(b.pub_at AS TIMESTAMP), TIMESTAMP '2100-01-01') - INTERVAL 1 SECOND AS valid_until
  FROM log a LEFT JOIN log b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"""


@query(f"""
WITH {_INTERVALS}
SELECT publication_id, strftime(pub_at, '%Y-%m-%d %H:%M:%S') AS published_at,
       strftime(valid_until, '%Y-%m-%d %H:%M:%S') AS valid_until FROM iv
""")
def publication_intervals(t: Tables) -> DataFrame:
    """From when to when each version was the current one."""
    pattern = "yyyy-MM-dd HH:mm:ss"
    return intervals(t).select("publication_id", F.date_format("published_at", pattern).alias("published_at"),
                               F.date_format("valid_until", pattern).alias("valid_until"))


@query(f"""
WITH {_INTERVALS}
SELECT CAST(year(pub_at) AS BIGINT) AS published_year, count(*) AS versions, count(DISTINCT l_orderkey) AS orders,
       CAST(sum(q) AS DOUBLE) AS quantity
FROM iv WHERE pub_at <= TIMESTAMP '1999-06-01' AND valid_until >= TIMESTAMP '1999-06-01' GROUP BY 1
""")
def as_of_lookup(t: Tables) -> DataFrame:
    """What was current at one past instant, read from the version that the log had then.

    The log of versions is loaded in three commits dated 1995, 1999 and 2100; each adds what was published since.
    """
    log, table = publication_log(t), VersionedTable(t.spark, t.scratch("as-of"))
    since = None
    for until in (datetime(1995, 1, 1, tzinfo=timezone.utc), AS_OF, datetime(2100, 1, 1, tzinfo=timezone.utc)):
        part = log.where(F.col("published_at") <= F.lit(until))
        table.write(part if since is None else part.where(F.col("published_at") > F.lit(since)), "append", at=until)
        since = until
    seen = publish.validity_intervals(table.read(at=AS_OF + timedelta(hours=1)), "publication_id", "published_at",
                                      "superseded_by", since)
    seen = seen.where(F.col("valid_until") >= F.lit(AS_OF))
    return seen.groupBy(out_int(F.year("published_at")).alias("published_year")).agg(
        out_int(count()).alias("versions"), out_int(F.countDistinct("l_orderkey")).alias("orders"),
        out_num(F.sum("quantity")).alias("quantity"))


WRITERS = 4


@query("""
WITH p AS (SELECT c_nationkey AS n, sum(CAST(o_totalprice AS DECIMAL(19,4))) AS total
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT count(*) AS publications, CAST(sum(total) AS DOUBLE) AS amount, CAST(3 * count(*) - 1 AS BIGINT) AS ledger_rows,
       CAST(3 * count(*) - 1 AS BIGINT) AS last_number, CAST(count(*) - 1 AS BIGINT) AS superseded,
       CAST(least(count(*), 1) AS BIGINT) AS current_ones FROM p
""")
def ledger_of_many_writers(t: Tables) -> DataFrame:
    """Publications of all nations staged and published by several writers at once: every transition counts once, none is
    lost, and exactly one publication is the current one."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    totals = t.orders().join(customer, "o_custkey").groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("total"))
    store = Store(t.spark, root=t.scratch("ledger"))

    def transitions(row) -> None:
        publish.announce(store, f"PUB-{row['c_nationkey']}", {"GrossBoe": str(row["total"])})

    in_parallel(transitions, totals.collect(), WRITERS)  # one row per nation
    rows = publish.ledger(store)
    total = F.get_json_object("ControlTotalsJson", "$.GrossBoe").cast(MONEY)
    last = publish.publications(store).agg(
        out_int(count()).alias("publications"), out_num(F.sum(total)).alias("amount"),
        out_int(F.count_if(F.col("Status") == "SUPERSEDED")).alias("superseded"),
        out_int(F.count_if(F.col("Status") == "PUBLISHED")).alias("current_ones"))
    return rows.agg(out_int(F.countDistinct("Seq")).alias("ledger_rows"), out_int(F.max("Seq")).alias("last_number")
                    ).join(last)


@query("""
WITH a AS (SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(19,4))) AS v FROM orders
           WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
b AS (SELECT o_custkey AS k, sum(CAST(o_totalprice AS DECIMAL(19,4))) AS v FROM orders GROUP BY 1)
SELECT k AS o_custkey, CAST(a.v AS DOUBLE) AS amount_old, CAST(b.v AS DOUBLE) AS amount_new
FROM a FULL JOIN b USING (k) WHERE a.v IS DISTINCT FROM b.v
""")
def version_delta(t: Tables) -> DataFrame:
    """Customers whose total differs between two versions of the orders."""
    table = VersionedTable(t.spark, t.scratch("delta"))
    bucket = (F.col("o_custkey") % 16).cast("string").alias("bucket")
    late = t.orders().where("o_orderdate >= '2000-01-01'").select("o_custkey").distinct()

    def version(df):
        return df.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("amount")).withColumn("bucket", bucket)
    table.write(version(t.orders().where("o_orderdate < '2000-01-01'")), "replace", ["bucket"])
    moved = {r[0] for r in late.select(bucket).distinct().collect()}  # only the slices of customers with later orders
    table.write(version(t.orders()).where(F.col("bucket").isin(list(moved))), "replace slices", ["bucket"],
                lambda part: part["slice"]["bucket"] in moved)
    old, new = table.changed(1, 2)
    return publish.delta(old, new, ["o_custkey"], ["amount"]).select(
        "o_custkey", out_num("amount_old").alias("amount_old"), out_num("amount_new").alias("amount_new"))


@query("""
SELECT 'CURRENT' AS version, o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(19,4))) AS DOUBLE)
  AS amount FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 2
UNION ALL SELECT 'CANDIDATE', o_orderstatus, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(19,4))) AS DOUBLE)
  FROM orders GROUP BY 2
""")
def candidate_vs_current(t: Tables) -> DataFrame:
    """The same figures of the candidate and of the current version, below each other."""
    def version(df):
        return df.groupBy("o_orderstatus").agg(out_int(count()).alias("orders"),
                                               out_num(F.sum("o_totalprice")).alias("amount"))
    return publish.side_by_side({"CURRENT": version(t.orders().where("o_orderdate < '2000-01-01'")),
                                 "CANDIDATE": version(t.orders())})


# --- chains ----------------------------------------------------------------------------

@query("""
WITH o AS (SELECT o_custkey AS c, o_orderkey AS id, count(*) OVER w - row_number() OVER v AS after, last_value(o_orderkey) OVER w AS last
           FROM orders WINDOW v AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
           w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT id AS o_orderkey, CASE WHEN c % 10 <> 0 THEN last END AS end_id, CAST(CASE WHEN c % 10 <> 0 THEN after END AS BIGINT) AS steps,
       c % 10 = 0 AS cyclic FROM o
""")
def supersession_chains(t: Tables) -> DataFrame:
    """Where the chain of every order ends: an order is superseded by the customer's next one. The last order of a tenth of
    the customers points back at the first, so their chains are cycles."""
    turn = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    back = F.when(F.col("o_custkey") % 10 == 0, F.first("o_orderkey").over(turn))
    links = t.orders().select(F.col("o_orderkey").alias("id"), F.coalesce(F.lead("o_orderkey").over(turn), back).alias("next"))
    store = Store(t.spark, root=t.scratch("chains"))

    def save(df: DataFrame, name: str) -> DataFrame:
        store.write(df, f"work.round_{name}")
        return store.table(f"work.round_{name}")

    return graph.chain_ends(links, save).withColumnRenamed("id", "o_orderkey")


@query("""
WITH r AS (SELECT r_name, n_name, o_custkey, l_suppkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT CAST(grouping(r_name, n_name) AS BIGINT) AS level, r_name, n_name, count(DISTINCT o_custkey) AS customers,
       count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts
FROM r GROUP BY ROLLUP (r_name, n_name)
""")
def distinct_matrix(t: Tables) -> DataFrame:
    """Distinct customers, suppliers and parts by region, nation and in all, from one pass over the lines."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    tasks = tasks_for(t.raw("lineitem"))
    orders = spread(t.orders().select("o_orderkey", "o_custkey"), ["o_custkey"], tasks)
    places = orders.join(spread(customer, ["o_custkey"], tasks), "o_custkey").join(t.nations(), "n_nationkey").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "r_name", "n_name")
    lines = t.lineitem().select("l_orderkey", "l_suppkey", "l_partkey")
    rows = spread(lines, ["l_orderkey"], tasks).join(spread(places, ["l_orderkey"], tasks), "l_orderkey")
    found = measures.distinct_rollup(rows, ["r_name", "n_name"],
                                     {"customers": "o_custkey", "suppliers": "l_suppkey", "parts": "l_partkey"})
    return found.select(out_int("level").alias("level"), "r_name", "n_name",
                        *[out_int(c).alias(c) for c in ("customers", "suppliers", "parts")])


# --- graph -----------------------------------------------------------------------------

NODE_KEYS = {"Line": "line_id", "Order": "o_orderkey", "Customer": "c_custkey", "Nation": "n_nationkey",
             "Region": "r_regionkey", "Supplier": "s_suppkey", "Document": "doc_id", "Label": "doc_id"}
LINKS = {"partOf": ("Line", "l_orderkey", "Order", "o_orderkey"),
         "suppliedBy": ("Line", "l_suppkey", "Supplier", "s_suppkey"),
         "orderedBy": ("Order", "o_custkey", "Customer", "c_custkey"),
         "locatedIn": ("Customer", "c_nationkey", "Nation", "n_nationkey"),
         "belongsTo": ("Nation", "n_regionkey", "Region", "r_regionkey"),
         "labels": ("Document", "doc_id", "Label", "doc_id")}


def nodes(t: Tables) -> dict[str, tuple[DataFrame, str]]:
    lines = t.lineitem().withColumn("line_id", key_text("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    frames = {"Line": lines, "Order": t.orders(), "Customer": t.raw("customer"), "Nation": t.raw("nation"),
              "Region": t.raw("region"), "Supplier": t.raw("supplier").where("s_acctbal >= 0"),
              "Document": t.raw("documents").select("doc_id"), "Label": t.raw("labels").select("doc_id")}
    return {n: (frames[n], NODE_KEYS[n]) for n in frames}


@query("""
WITH dangling AS (
 SELECT 'partOf' AS rel, l_orderkey AS id FROM lineitem ANTI JOIN orders ON o_orderkey = l_orderkey
 UNION ALL SELECT 'suppliedBy', l_suppkey FROM lineitem ANTI JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON s_suppkey = l_suppkey
 UNION ALL SELECT 'orderedBy', o_custkey FROM orders ANTI JOIN customer ON c_custkey = o_custkey
 UNION ALL SELECT 'locatedIn', c_nationkey FROM customer ANTI JOIN nation ON n_nationkey = c_nationkey
 UNION ALL SELECT 'belongsTo', n_regionkey FROM nation ANTI JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT 'labels', d.doc_id FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id)
SELECT rel, CAST(id AS VARCHAR) AS dst_id, count(*) AS edges FROM dangling GROUP BY 1, 2
""")
def edge_integrity(t: Tables) -> DataFrame:
    """Edge targets that do not exist, with the number of edges that point there."""
    n = nodes(t)
    found = graph.dangling_edges(graph.edge_table(n, LINKS), graph.node_table(n))
    return found.select("rel", "dst_id", out_int("edges").alias("edges"))


@query("""
WITH ids AS (
 SELECT 'Line' AS type, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem
 UNION ALL SELECT 'Order', CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL SELECT 'Customer', CAST(c_custkey AS VARCHAR) FROM customer
 UNION ALL SELECT 'Document', CAST(doc_id AS VARCHAR) FROM documents UNION ALL SELECT 'Label', CAST(doc_id AS VARCHAR) FROM labels
 UNION ALL SELECT 'Nation', CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT 'Region', CAST(r_regionkey AS VARCHAR) FROM region
 UNION ALL SELECT 'Supplier', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal >= 0)
SELECT type, id, count(*) AS copies FROM ids GROUP BY 1, 2 HAVING count(*) > 1 OR id IS NULL
""")
def node_integrity(t: Tables) -> DataFrame:
    """Node ids that are not unique within their type."""
    return graph.node_violations(graph.node_table(nodes(t))).select("type", "id", out_int("copies").alias("copies"))


@query("""
SELECT r_name AS region, CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DOUBLE) AS weight, count(*) AS starts
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1
""")
def multi_hop(t: Tables) -> DataFrame:
    """Line amounts carried over order, customer and nation to the region, summed at every hop."""
    n = nodes(t)
    edges = graph.edge_table({k: v for k, v in n.items() if k != "Line"},
                             {r: e for r, e in LINKS.items() if r in ("orderedBy", "locatedIn", "belongsTo")})
    weights = t.lineitem().select(out_text("l_orderkey").alias("id"), F.col("l_extendedprice").alias("weight"))
    totals = graph.reach_totals(edges, ["orderedBy", "locatedIn", "belongsTo"], weights)
    region = t.raw("region").select(out_text("r_regionkey").alias("end_id"), F.col("r_name").alias("region"))
    return totals.join(region, "end_id").select("region", out_num("weight").alias("weight"),
                                                out_int("starts").alias("starts"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS start_id, CAST(n_regionkey AS VARCHAR) AS end_id
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE o_orderstatus = 'F'
""")
def traversal_pairs(t: Tables) -> DataFrame:
    """Start and end of the path order, customer, nation, region for the finished orders."""
    n = nodes(t)
    path = ["orderedBy", "locatedIn", "belongsTo"]
    edges = graph.edge_table(n, {r: LINKS[r] for r in path})
    start = t.orders().where("o_orderstatus = 'F'").select(out_text("o_orderkey").alias("id"))
    return graph.traverse(edges, path, start)


# --- channels and answers --------------------------------------------------------------

@query("""
WITH a AS (SELECT n_name AS f, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
   JOIN nation ON n_nationkey = s_nationkey GROUP BY 1),
b AS (SELECT n_name AS f, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
   JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal >= 1000 GROUP BY 1),
c AS (SELECT n_name AS f, sum(round(CAST(l_extendedprice AS DECIMAL(19,4)), 0)) AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
   JOIN nation ON n_nationkey = s_nationkey GROUP BY 1),
j AS (SELECT f, a.v AS a, b.v AS b, c.v AS c FROM a FULL JOIN b USING (f) FULL JOIN c USING (f))
SELECT 'supply' AS measure, f AS "filter", CAST(a AS DOUBLE) AS value_sql, CAST(b AS DOUBLE) AS value_report,
  CAST(c AS DOUBLE) AS value_answer,
  CASE WHEN a IS NULL OR b IS NULL OR c IS NULL THEN 'MISSING'
       WHEN greatest(a, b, c) - least(a, b, c) <= 1000 THEN 'CONSISTENT' ELSE 'DIFFERENT' END AS status
FROM j
""")
def channel_consistency(t: Tables) -> DataFrame:
    """The same measure per nation from three channels, within a tolerance of 1000."""
    supplier = t.raw("supplier").join(t.nations(), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), "s_acctbal", "n_name")

    def channel(approved, value):
        joined = t.lineitem().join(supplier.where(approved), "l_suppkey")
        return joined.groupBy(F.lit("supply").alias("measure"), F.col("n_name").alias("filter")).agg(
            F.sum(value).cast("decimal(38,4)").alias("value"))

    price = F.col("l_extendedprice")
    out = recon.channel_consistency({"sql": channel(F.lit(True), price), "report": channel("s_acctbal >= 1000", price),
                                     "answer": channel(F.lit(True), money(F.round(price, 0)))}, 1000)
    return out.select("measure", "filter", *[out_num(f"value_{c}").alias(f"value_{c}") for c in
                                             ("sql", "report", "answer")], "status")


@query(r"""
WITH cases AS (
 SELECT 'doc' AS kind, doc_id AS id, 'NUMERIC' AS type, text AS answer, n_chars || ' characters (' || doc_id || ')' AS expected,
   CASE lang WHEN 'en' THEN '±2000 characters' WHEN 'de' THEN 'exact' ELSE 'free' END AS tolerance, 'the' AS pub FROM documents
 UNION ALL SELECT 'page', page_id, CASE WHEN url LIKE 'https%' THEN 'NUMERIC' WHEN url LIKE '%page=%' THEN 'LIST'
   WHEN url LIKE '%fr%' THEN 'LOOKUP' ELSE 'EXPLANATION' END, html, 'DOCTYPE ' || url, 'exact', 'article' FROM pages),
parsed AS (SELECT *,
  list_filter(list_transform(regexp_extract_all(regexp_replace(expected, '\(.*?\)', '', 'g'), '\d[\d,]*(?:\.\d+)?'),
    lambda x: TRY_CAST(replace(x, ',', '') AS DECIMAL(38,6))), lambda x: x IS NOT NULL AND x > 1) AS e,
  list_filter(list_transform(regexp_extract_all(answer, '\d[\d,]*(?:\.\d+)?'),
    lambda x: TRY_CAST(replace(x, ',', '') AS DECIMAL(38,6))), lambda x: x IS NOT NULL) AS a,
  regexp_extract_all(expected, '[A-Z][A-Z0-9_-]{3,}') AS codes,
  CASE WHEN tolerance LIKE '±%' THEN 2000 ELSE 0.5 END AS tol FROM cases),
judged AS (SELECT *,
  len(list_filter(e, lambda x: len(list_filter(a, lambda y: y - x <= tol AND x - y <= tol)) = 0)) = 0 AS ok,
  len(codes) > 0 AND len(list_filter(codes, lambda x: NOT contains(answer, x))) = 0 AS found FROM parsed)
SELECT kind, id, type, CASE WHEN answer IS NULL OR answer = '' THEN 'FAIL'
  WHEN type NOT IN ('NUMERIC', 'LIST', 'LOOKUP', 'LINEAGE') THEN 'REVIEW'
  WHEN type = 'LOOKUP' THEN CASE WHEN found THEN 'PASS' ELSE 'REVIEW' END
  WHEN ok AND contains(answer, pub) THEN 'PASS' WHEN ok THEN 'REVIEW' ELSE 'FAIL' END AS auto_check
FROM judged
""")
def answer_scoring(t: Tables) -> DataFrame:
    """Whole document and page texts as answers, scored against expected numbers and codes."""
    docs, url = t.raw("documents"), F.col("url")
    tolerance = F.when(F.col("lang") == "en", "±2000 characters").when(F.col("lang") == "de", "exact").otherwise("free")
    a = docs.select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), F.lit("NUMERIC").alias("type"),
                    F.col("text").alias("actual_answer"),
                    F.concat("n_chars", F.lit(" characters ("), "doc_id", F.lit(")")).alias("expected_answer"),
                    tolerance.alias("tolerance"), F.lit("the").alias("publication_id"))
    kind = (F.when(url.startswith("https"), "NUMERIC").when(url.contains("page="), "LIST")
            .when(url.contains("fr"), "LOOKUP").otherwise("EXPLANATION"))
    b = t.raw("pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), kind.alias("type"),
                              F.col("html").alias("actual_answer"),
                              F.concat(F.lit("DOCTYPE "), "url").alias("expected_answer"),
                              F.lit("exact").alias("tolerance"), F.lit("article").alias("publication_id"))
    return recon.score_answers(a.unionByName(b)).select("kind", "id", "type", "auto_check")
