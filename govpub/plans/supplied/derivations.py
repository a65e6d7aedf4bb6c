"""Effective dating, allocation, conversion, valuation and dense facts on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govpub.functions.columns import MONEY, half_up, hours_between
from govpub.operators import derive, registry
from govpub.plans.supplied.base import Tables, count, money, out_int, out_num, out_text, query, volume

# --- effective dating ------------------------------------------------------------------


def share_register(t: Tables) -> DataFrame:
    """Three dated shares per nation; the first ends before the data do and leaves a gap."""
    n = F.col("n_nationkey")
    periods = F.array(*[F.struct(F.lit(a).cast("date").alias("valid_from"), F.lit(b).cast("date").alias("valid_to"),
                                 F.lit(base).cast("decimal(9,6)").alias("base"))
                        for a, b, base in (("1995-03-01", "1997-01-01", "0.300000"),
                                           ("1997-01-01", "2000-07-01", "0.250000"),
                                           ("2000-08-01", "9999-12-31", "0.350000"))])
    return (t.raw("nation").select("n_nationkey", F.explode(periods).alias("p")).select(
        "n_nationkey", "p.valid_from", "p.valid_to",
        (F.col("p.base") + n.cast("decimal(9,6)") / 100).cast("decimal(9,6)").alias("share")))


_SHARES = """
shares AS (
 SELECT n_nationkey, a, b, CAST(CAST(base AS DECIMAL(9,6)) + n_nationkey * CAST(0.01 AS DECIMAL(9,6)) AS DECIMAL(9,6)) AS share
 FROM nation, (VALUES (DATE '1995-03-01', DATE '1997-01-01', 0.30), (DATE '1997-01-01', DATE '2000-07-01', 0.25),
                      (DATE '2000-08-01', DATE '9999-12-31', 0.35)) p(a, b, base))"""


@query(f"""
WITH {_SHARES},
dated AS (SELECT c_nationkey, CAST(o_totalprice AS DECIMAL(19,4)) AS gross, share
 FROM orders JOIN customer ON c_custkey = o_custkey
 LEFT JOIN shares ON n_nationkey = c_nationkey AND CAST(o_orderdate AS DATE) >= a AND CAST(o_orderdate AS DATE) < b)
SELECT CAST(c_nationkey AS BIGINT) AS nation, count(*) AS orders, count(*) FILTER (share IS NULL) AS without_share,
       CAST(sum(gross) AS DOUBLE) AS gross, CAST(sum(round(gross * share, 4)) AS DOUBLE) AS net
FROM dated GROUP BY 1
""")
def effective_dated_share(t: Tables) -> DataFrame:
    """Gross and net by the share valid on the order date; days without a share have no net."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    dated = registry.join_effective(t.orders().join(customer, "o_custkey"), share_register(t),
                                    {"c_nationkey": "n_nationkey"}, "o_orderdate", "valid_from", "valid_to", ["share"])
    return dated.groupBy(out_int("c_nationkey").alias("nation")).agg(
        out_int(count()).alias("orders"), out_int(F.count_if(F.col("share").isNull())).alias("without_share"),
        out_num(F.sum("o_totalprice")).alias("gross"),
        out_num(F.sum(half_up(F.col("o_totalprice") * F.col("share"), MONEY))).alias("net"))


def stock_register(t: Tables) -> DataFrame:
    """What a supplier had shipped up to each of its shipping days: one period per supplier and day, the last one open."""
    daily = t.lineitem().groupBy("l_suppkey", "l_shipdate").agg(F.sum("l_quantity").alias("quantity"))
    days = Window.partitionBy("l_suppkey").orderBy("l_shipdate")
    return daily.select(F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("valid_from"),
                        F.coalesce(F.lead("l_shipdate").over(days), F.lit("9999-12-31").cast("date")).alias("valid_to"),
                        F.sum("quantity").over(days).alias("shipped"))


@query("""
WITH daily AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS a, sum(CAST(l_quantity AS DECIMAL(19,6))) AS q
               FROM lineitem GROUP BY ALL),
reg AS (SELECT k, a, coalesce(lead(a) OVER w, DATE '9999-12-31') AS b, sum(q) OVER w AS shipped FROM daily
        WINDOW w AS (PARTITION BY k ORDER BY a)),
asked AS (SELECT l_suppkey AS k, CAST(o_orderdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CAST(asked.k AS BIGINT) AS supplier, count(*) AS lines, count(*) FILTER (shipped IS NULL) AS before_first,
       CAST(sum(shipped) AS DOUBLE) AS shipped_at_order
FROM asked LEFT JOIN reg ON asked.k = reg.k AND d >= a AND d < b GROUP BY 1
""")
def effective_dated_stock(t: Tables) -> DataFrame:
    """What the supplier of every line had shipped on the order's day, from a register with very many periods per key."""
    order_day = t.orders().select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    asked = t.lineitem().select("l_orderkey", "l_suppkey").join(order_day, "l_orderkey")
    dated = registry.join_effective(asked, stock_register(t), {"l_suppkey": "supplier"}, "o_orderdate", "valid_from",
                                    "valid_to", ["shipped"])
    return dated.groupBy(out_int("l_suppkey").alias("supplier")).agg(
        out_int(count()).alias("lines"), out_int(F.count_if(F.col("shipped").isNull())).alias("before_first"),
        out_num(F.sum("shipped")).alias("shipped_at_order"))


@query("""
WITH e AS (SELECT l_suppkey AS k, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS a,
                  CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_partkey % 24 + l_quantity AS INTEGER)) AS b FROM lineitem),
m AS (SELECT *, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM e WHERE b > a),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY a, b) AS no FROM m),
u AS (SELECT k, no, min(a) AS a, max(b) AS b FROM g GROUP BY ALL)
SELECT CAST(k AS BIGINT) AS supplier, count(*) AS outages, CAST(sum(date_diff('hour', a, b)) AS BIGINT) AS hours,
       CAST(max(date_diff('hour', a, b)) AS BIGINT) AS longest FROM u GROUP BY k
""")
def merged_outages(t: Tables) -> DataFrame:
    """Outages of a supplier (one per line, as many hours as its quantity) that overlap or touch, as one."""
    hour = (F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")) * 24 + F.col("l_partkey") % 24).cast("long")
    events = t.lineitem().select("l_suppkey", F.timestamp_seconds(hour * 3600).alias("start_utc"),
                                 F.timestamp_seconds((hour + F.col("l_quantity").cast("int")) * 3600).alias("end_utc"))
    merged = derive.merged_intervals(events, ["l_suppkey"], "start_utc", "end_utc")
    hours = hours_between("start_utc", "end_utc")
    return merged.groupBy(out_int("l_suppkey").alias("supplier")).agg(
        out_int(count()).alias("outages"), out_int(F.sum(hours)).alias("hours"), out_int(F.max(hours)).alias("longest"))


# --- months and days -------------------------------------------------------------------

def nation_months(t: Tables) -> DataFrame:
    """Twelve month columns per nation and year; the sum of order totals, negative in one nation."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    sign = F.when(F.col("c_nationkey") == 7, -1).otherwise(1)
    sales = t.orders().join(customer, "o_custkey").select(
        F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "'m'MM").alias("month"), volume(F.col("o_totalprice") * sign).alias("amount"))
    return derive.pivot_sum(sales, ["nation", "year"], "month", "amount", {f"m{m:02d}": f"m{m:02d}" for m in range(1, 13)})


_MONTHS = """
sales AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS BIGINT) AS year, month(o_orderdate) AS month,
  sum(CAST(o_totalprice AS DECIMAL(19,6)) * CASE WHEN c_nationkey = 7 THEN -1 ELSE 1 END) AS amount
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
months AS (SELECT k.nation, make_date(k.year, m.month, 1) AS month_start, s.amount
  FROM (SELECT DISTINCT nation, year FROM sales) k CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
  LEFT JOIN sales s ON s.nation = k.nation AND s.year = k.year AND s.month = m.month)"""


@query(f"""
WITH {_MONTHS}
SELECT CAST(nation AS BIGINT) AS nation, CAST(month_start AS VARCHAR) AS month_start, CAST(amount AS DOUBLE) AS amount,
       CASE WHEN amount IS NULL OR amount < 0 THEN 'INVALID' ELSE 'VALID' END AS dq_status
FROM months
""")
def months_unpivot(t: Tables) -> DataFrame:
    """Month columns to rows; a month without sales stays as an invalid row."""
    rows = derive.unpivot_months(nation_months(t), ["nation"], "year", value="amount")
    return rows.select(out_int("nation").alias("nation"), out_text("month_start").alias("month_start"),
                       out_num("amount").alias("amount"), "dq_status")


@query(f"""
WITH {_MONTHS},
parts AS (SELECT nation, month_start, CAST(amount * 1000000 AS HUGEINT) AS n,
  CAST(date_diff('day', month_start, CAST(month_start + INTERVAL 1 MONTH AS DATE)) AS HUGEINT) AS d
  FROM months WHERE amount >= 0),
based AS (SELECT *, (n * 2 + d) // (2 * d) AS base FROM parts)
SELECT CAST(nation AS BIGINT) AS nation, CAST(month_start AS VARCHAR) AS month_start, CAST(d AS BIGINT) AS days,
       CAST(CAST(base AS DECIMAL(38,0)) AS DOUBLE) / 1000000 AS first_day,
       CAST(CAST(n - base * (d - 1) AS DECIMAL(38,0)) AS DOUBLE) / 1000000 AS last_day,
       CAST(CAST(n AS DECIMAL(38,0)) AS DOUBLE) / 1000000 AS total
FROM based
""")
def daily_allocation(t: Tables) -> DataFrame:
    """Monthly amounts over their days; the days of a month add up to it exactly."""
    monthly = derive.unpivot_months(nation_months(t), ["nation"], "year", value="amount").where("dq_status = 'VALID'")
    daily = derive.allocate_daily(monthly, "month_start", "amount")
    first = F.col("business_date") == F.col("month_start")
    last = F.col("business_date") == F.last_day("month_start")
    return daily.groupBy(out_int("nation").alias("nation"), out_text("month_start").alias("month_start")).agg(
        out_int(count()).alias("days"), out_num(F.sum(F.when(first, F.col("daily_amount")))).alias("first_day"),
        out_num(F.sum(F.when(last, F.col("daily_amount")))).alias("last_day"),
        out_num(F.sum("daily_amount")).alias("total"))


@query("""
WITH daily AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS m,
  sum(CAST(l_quantity AS DECIMAL(19,6))) FILTER (l_returnflag = 'A') AS oil,
  sum(CAST(l_quantity AS DECIMAL(19,6))) FILTER (l_returnflag = 'N') AS gas,
  sum(CAST(l_quantity AS DECIMAL(19,6))) FILTER (l_returnflag = 'R') AS water FROM lineitem GROUP BY ALL)
SELECT l_suppkey, CAST(m AS VARCHAR) AS month_start, CAST(oil AS DOUBLE) AS oil, CAST(gas AS DOUBLE) AS gas,
  CAST(water AS DOUBLE) AS water, CASE WHEN oil IS NOT NULL OR gas IS NOT NULL THEN
   CAST(CAST(CAST(coalesce(oil, 0) * 1000000 AS HUGEINT)
     + (CAST(coalesce(gas, 0) * 1000000 AS HUGEINT) * 10 * 2 + 58) // (2 * 58) AS DECIMAL(38,0)) AS DOUBLE) / 1000000 END AS boe
FROM daily
""")
def commodity_pivot(t: Tables) -> DataFrame:
    """Commodity rows to columns per supplier and month, and oil equivalent with a divisor of 5.8."""
    names = {"A": "oil", "N": "gas", "R": "water"}
    wide = derive.pivot_sum(t.lineitem().withColumn("m", F.trunc("l_shipdate", "month")), ["l_suppkey", "m"],
                            "l_returnflag", "l_quantity", names)
    boe = derive.boe("oil", "gas", F.lit("5.8").cast("decimal(9,3)"))
    return wide.select("l_suppkey", out_text("m").alias("month_start"), *[out_num(c).alias(c) for c in names.values()],
                       out_num(boe).alias("boe"))


# --- money -----------------------------------------------------------------------------

def rate_register(t: Tables) -> DataFrame:
    """Monthly rates of four of the five segments, for the months of the orders before 2001."""
    months = t.orders().select(F.trunc("o_orderdate", "month").alias("valid_on")).distinct()
    codes = t.raw("customer").select("c_mktsegment").distinct().where("c_mktsegment <> 'FURNITURE'")
    step = F.length("c_mktsegment") * F.lit("0.013000000").cast("decimal(18,9)")
    rate = (F.lit("0.5").cast("decimal(18,9)") + step
            + F.month("valid_on") * F.lit("0.001000000").cast("decimal(18,9)")).cast("decimal(18,9)")
    return (months.where("valid_on < '2001-01-01'")
            .withColumn("c_mktsegment", F.explode(F.array(*[F.lit(c) for c in (
                "AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")])))
            .join(codes, "c_mktsegment", "left_semi").withColumn("usd_per_unit", rate))


@query("""
WITH rates AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, c.seg,
  CAST(0.5 + length(c.seg) * CAST(0.013 AS DECIMAL(18,9)) + month(o_orderdate) * CAST(0.001 AS DECIMAL(18,9))
    AS DECIMAL(18,9)) AS rate
  FROM orders, (SELECT DISTINCT c_mktsegment AS seg FROM customer WHERE c_mktsegment <> 'FURNITURE') c
  WHERE o_orderdate < TIMESTAMP '2001-01-01'),
amounts AS (SELECT c_mktsegment AS seg, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
  CAST(CAST(o_totalprice AS DECIMAL(19,4)) - 50000 AS DECIMAL(19,4)) AS a FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT seg AS currency_code, CASE WHEN rate IS NULL THEN 'MISSING_FX' WHEN a < 0 THEN 'NEGATIVE_AMOUNT' ELSE 'VALID' END
   AS dq_status, count(*) AS amounts, CAST(sum(a) AS DOUBLE) AS amount_local,
   CAST(sum(round(a * CAST(rate AS DECIMAL(12,9)), 4)) AS DOUBLE) AS amount_usd
FROM amounts LEFT JOIN rates USING (seg, m) GROUP BY 1, 2
""")
def fx_conversion(t: Tables) -> DataFrame:
    """Order amounts in their segment's currency to USD with the rate of the month."""
    customer = t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    amounts = t.orders().join(customer, "o_custkey").select(
        "c_mktsegment", F.trunc("o_orderdate", "month").alias("month_start"),
        money(F.col("o_totalprice") - F.lit(50000)).alias("amount_local"))
    valued = derive.convert_currency(amounts, rate_register(t),
                                     {"month_start": "valid_on", "c_mktsegment": "c_mktsegment"}, "amount_local",
                                     "usd_per_unit")
    return valued.groupBy(F.col("c_mktsegment").alias("currency_code"), "dq_status").agg(
        out_int(count()).alias("amounts"), out_num(F.sum("amount_local")).alias("amount_local"),
        out_num(F.sum("amount_usd")).alias("amount_usd"))


# --- events and losses -----------------------------------------------------------------

@query("""
WITH spans AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, o_orderdate AS s, l_shipdate AS e
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT CAST(y AS BIGINT) AS year, p AS o_orderpriority, count(*) FILTER (e > s) AS valid,
       count(*) FILTER (e <= s) AS invalid,
       CAST(CAST(sum(date_diff('hour', s, e)) FILTER (e > s) AS DECIMAL(38,3)) AS DOUBLE) AS duration_hours
FROM spans GROUP BY 1, 2
""")
def event_durations(t: Tables) -> DataFrame:
    """Hours from order to shipment; a line shipped before or on its order is invalid."""
    lines = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    spans = lines.join(t.raw("orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), "o_orderkey")
    valid = F.col("l_shipdate") > F.col("o_orderdate")
    hours = F.when(valid, hours_between("o_orderdate", "l_shipdate"))
    return spans.groupBy(out_int(F.year("o_orderdate")).alias("year"), "o_orderpriority").agg(
        out_int(F.count_if(valid)).alias("valid"), out_int(F.count_if(~valid)).alias("invalid"),
        out_num(F.sum(hours)).alias("duration_hours"))


def daily_prices(t: Tables) -> DataFrame:
    """Two commodity prices per ship date, as rows of a price register."""
    days = t.lineitem().select(F.col("l_shipdate").alias("business_date")).distinct()
    return days.select("business_date", F.explode(F.array(
        F.struct(F.lit("Oil").alias("commodity"), volume(F.lit(70) + F.month("business_date")).alias("price_usd"),
                 F.lit(1).cast("decimal(9,6)").alias("energy_factor")),
        F.struct(F.lit("Gas").alias("commodity"), volume(F.lit("3.25")).alias("price_usd"),
                 F.lit("1.037").cast("decimal(9,6)").alias("energy_factor")))).alias("p")).select("business_date", "p.*")


@query(f"""
WITH {_SHARES},
losses AS (SELECT s_nationkey, CAST(l_quantity AS DECIMAL(19,6)) AS oil,
  CAST(l_extendedprice AS DECIMAL(19,6)) AS gas, 70 + month(l_shipdate) AS oil_price, share
 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
 LEFT JOIN shares ON n_nationkey = s_nationkey AND CAST(l_shipdate AS DATE) >= a AND CAST(l_shipdate AS DATE) < b),
valued AS (SELECT *, CAST(CAST(CAST(oil * 1000000 AS HUGEINT) + (CAST(gas * 1000000 AS HUGEINT) * 2 + 6) // 12
             AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(19,6)) AS boe,
  round(CAST(oil AS DECIMAL(15,6)) * oil_price
        + CAST(gas AS DECIMAL(15,6)) * CAST(1.037 AS DECIMAL(5,4)) * CAST(3.25 AS DECIMAL(4,2)), 4) AS usd FROM losses)
SELECT CAST(s_nationkey AS BIGINT) AS nation, count(*) AS losses, CAST(sum(boe) AS DOUBLE) AS lost_boe_gross,
  CAST(sum(CAST(round(boe * share, 6) AS DECIMAL(19,6))) AS DOUBLE) AS lost_boe_net_wi,
  CAST(sum(CAST(usd AS DECIMAL(19,4))) AS DOUBLE) AS value_usd_gross,
  CAST(sum(CAST(round(CAST(usd AS DECIMAL(19,4)) * share, 4) AS DECIMAL(19,4))) AS DOUBLE) AS value_usd_net_wi
FROM valued GROUP BY 1
""")
def loss_valuation(t: Tables) -> DataFrame:
    """Lines as losses: oil equivalent and value, gross and net of the dated share."""
    supplier = t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    losses = t.lineitem().join(supplier, "l_suppkey").select(
        "s_nationkey", F.col("l_shipdate").alias("business_date"), F.col("l_quantity").alias("oil"),
        volume("l_extendedprice").alias("gas"))
    dated = registry.join_effective(losses, share_register(t), {"s_nationkey": "n_nationkey"}, "business_date",
                                    "valid_from", "valid_to", ["share"])
    priced = dated.join(derive.price_deck(daily_prices(t)), "business_date", "left")
    valued = derive.value_loss(priced, "oil", "gas", "oil_price", "gas_price", "share",
                               F.lit(6).cast("decimal(9,3)"))
    figures = ["lost_boe_gross", "lost_boe_net_wi", "value_usd_gross", "value_usd_net_wi"]
    return valued.groupBy(out_int("s_nationkey").alias("nation")).agg(
        out_int(count()).alias("losses"), *[out_num(F.sum(c)).alias(c) for c in figures])


# --- calendar and dense facts ----------------------------------------------------------

@query("""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS "DateKey", CAST(d AS VARCHAR) AS "Date",
  CAST(year(d) AS BIGINT) AS "Year", CAST(month(d) AS BIGINT) AS "MonthNumber", strftime(d, '%b') AS "MonthName",
  strftime(d, '%Y-%m') AS "YearMonth", CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS "MonthStart",
  CAST(day(d) AS BIGINT) AS "DayOfMonth", CAST(day(last_day(d)) AS BIGINT) AS "DaysInMonth"
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
""")
def calendar_dim(t: Tables) -> DataFrame:
    """Every day from the first to the last order."""
    bounds = t.orders().agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    days = derive.calendar_columns(bounds.select(F.explode(F.sequence("s", "e")).alias("Date")))
    whole = ["DateKey", "Year", "MonthNumber", "DayOfMonth", "DaysInMonth"]
    return days.select(*[out_int(c).alias(c) for c in whole], out_text("Date").alias("Date"), "MonthName", "YearMonth",
                       out_text("MonthStart").alias("MonthStart"))


EVENT_TYPES = {"click": "Click", "view": "View", "signup": "Signup", "purchase": "Purchase", "error": "Error"}


@query("""
WITH obs AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, sum(CAST(value AS DECIMAL(19,6))) AS v, count(*) AS n
   FROM events GROUP BY ALL),
daily AS (SELECT user_id, d, count(*) AS kinds, sum(v) FILTER (event_type = 'click') AS click,
   sum(v) FILTER (event_type = 'purchase') AS purchase FROM obs GROUP BY ALL),
grid AS (SELECT u.user_id, CAST(g.d AS DATE) AS d FROM (SELECT DISTINCT user_id FROM events) u
   CROSS JOIN (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM events) g)
SELECT g.user_id, count(*) AS stream_days, count(*) FILTER (kinds = 5) AS complete_days,
  count(*) FILTER (kinds IS NULL) AS silent_days, CAST(sum(click) AS DOUBLE) AS click,
  CAST(sum(purchase) AS DOUBLE) AS purchase
FROM grid g LEFT JOIN daily y USING (user_id, d) GROUP BY 1
""")
def dense_completeness(t: Tables) -> DataFrame:
    """Every user on every day; a day is complete with all five event types, and missing is not zero."""
    events = t.raw("events").select("user_id", F.to_date("ts").alias("day"), "event_type",
                                    volume("value").alias("value"))
    kinds = events.groupBy("user_id", "day", "event_type").agg(F.sum("value").alias("value"))
    daily = derive.pivot_sum(kinds, ["user_id", "day"], "event_type", "value", EVENT_TYPES,
                             extra=[count().cast("int").alias("ObservationCount")])
    bounds = events.agg(F.min("day").alias("_s"), F.max("day").alias("_e"))
    keys = events.select("user_id").distinct().withColumn("_b", bounds.select(F.struct("_s", "_e")).scalar())
    grid = derive.key_day_grid(keys, "_b._s", "_b._e").select("user_id", "BusinessDate")
    dense = derive.dense_daily(grid, daily, {"user_id": "user_id", "BusinessDate": "day"}, ["ObservationCount"], 5)
    return dense.groupBy("user_id").agg(
        out_int(count()).alias("stream_days"), out_int(F.sum("IsComplete")).alias("complete_days"),
        out_int(F.count_if(F.col("ObservationCount") == 0)).alias("silent_days"),
        out_num(F.sum("Click")).alias("click"), out_num(F.sum("Purchase")).alias("purchase"))


@query("""
WITH suppliers AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
customers AS (SELECT c_nationkey AS k, count(*) AS n, count(DISTINCT c_mktsegment) AS aliases FROM customer GROUP BY 1)
SELECT n_name, r_name, coalesce(s.n, 0) AS suppliers, coalesce(c.n, 0) AS customers, coalesce(c.aliases, 0) AS aliases
FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN suppliers s ON s.k = n_nationkey
LEFT JOIN customers c ON c.k = n_nationkey
""")
def dims_with_counts(t: Tables) -> DataFrame:
    """Nations with child and alias counts; children are counted before the join."""
    nations = t.nations()
    suppliers = registry.child_counts(t.raw("supplier").withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey",
                                      "suppliers")
    customer = t.raw("customer").withColumnRenamed("c_nationkey", "n_nationkey")
    customers = registry.child_counts(customer, "n_nationkey", "customers")
    aliases = registry.child_counts(registry.alias_rows(customer, "n_nationkey", "c_mktsegment"), "n_nationkey",
                                    "aliases")
    out = nations.join(suppliers, "n_nationkey", "left").join(customers, "n_nationkey", "left").join(
        aliases, "n_nationkey", "left")
    return out.select("n_name", "r_name", out_int(F.coalesce("suppliers", F.lit(0))).alias("suppliers"),
                      out_int(F.coalesce("customers", F.lit(0))).alias("customers"),
                      out_int(F.coalesce("aliases", F.lit(0))).alias("aliases"))


@query("SELECT DISTINCT p_brand, ps.l_suppkey AS supplier FROM part JOIN lineitem ps ON ps.l_partkey = p_partkey")
def alias_rows(t: Tables) -> DataFrame:
    """Every supplier a brand is known by, one row each; at larger sizes a brand has thousands."""
    known = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand").join(
        t.lineitem().select("l_partkey", F.col("l_suppkey").alias("supplier")), "l_partkey")
    return registry.alias_rows(known, "p_brand", "supplier")


@query("""
WITH e AS (SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS s,
                  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN CAST(ts AS TIMESTAMP)
                       ELSE CAST(ts AS TIMESTAMP) + INTERVAL 30 MINUTE END AS e FROM events),
k AS (SELECT *, NOT (user_id % 10 < 8 AND coalesce(e > s, false)) AS invalid FROM e)
SELECT invalid, count(*) AS events, CAST(sum(CASE WHEN NOT invalid THEN 0.5 END) AS DOUBLE) AS hours FROM k GROUP BY invalid
""")
def downtime_events(t: Tables) -> DataFrame:
    """Events as downtimes; every fifth has no end, every seventh no duration, a fifth of the users no equipment."""
    users = t.raw("events").select("user_id").distinct().where("user_id % 10 < 8")
    equipment = users.select(F.col("user_id").alias("equipment_id"), F.lit("F").alias("facility_id"))
    facility = t.spark.createDataFrame([("F", "A")], "facility_id string, field_id string")
    start = F.col("ts").cast("timestamp")
    end = F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 7 == 0, start).otherwise(
        start + F.expr("INTERVAL 30 MINUTES"))
    events = t.raw("events").select("event_id", F.col("user_id").alias("equipment_id"), F.lit(1).alias("change_seq"),
                                    start.alias("start_utc"), end.alias("end_utc"))
    return derive.downtime_events(events, equipment, facility).groupBy("invalid").agg(
        out_int(count()).alias("events"), out_num(F.sum("duration_hours")).alias("hours"))


@query("""
SELECT CASE WHEN o_custkey % 3 = 0 OR l_linenumber % 4 = 0 OR l_linenumber % 5 = 0 OR CAST(o_orderdate AS DATE) IS NULL
            OR CAST(o_orderdate AS DATE) <> CAST(o_orderdate AS DATE) + CAST(l_linenumber = 3 AS INT) THEN true ELSE false END
       AS invalid, count(*) AS losses
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
""")
def loss_events(t: Tables) -> DataFrame:
    """Lines as losses of their order's outage: unknown wells, missing dates and dates a day off are invalid."""
    orders = t.orders()
    wells = orders.where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("well_id"), F.lit("A").alias("field_id")).distinct()
    downtime = orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_orderkey").alias("incident_id"),
                             F.lit("E").alias("equipment_id"), F.col("o_orderdate").alias("start_utc"))
    line = F.col("l_linenumber")
    day = F.when((line % 4 == 0) | (line % 5 == 0), None).otherwise(F.date_add("o_orderdate", (line == 3).cast("int")))
    losses = t.lineitem().join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias("loss_id"),
        F.monotonically_increasing_id().alias("change_seq"), F.col("o_custkey").alias("well_ref"),
        F.col("o_orderkey").alias("event_id"), day.alias("business_date"))
    return derive.loss_candidates(losses, wells, downtime).groupBy("invalid").agg(out_int(count()).alias("losses"))
