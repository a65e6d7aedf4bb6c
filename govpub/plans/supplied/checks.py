"""Checks of contracts, registers and staging rows on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import key_text
from govpub.operators import quality
from govpub.plans.supplied.base import Tables, count, out_int, out_text, query
from govpub.sources.contract import SNAPSHOT, Table, schema_violations
from govpub.sources.extract import REJECTED, load_checked_csv
from govpub.sources.store import Store

LINES = Table("lineitem", SNAPSHOT, "l_orderkey bigint NOT NULL, l_partkey bigint NOT NULL, l_suppkey bigint NOT NULL, "
              "l_linenumber bigint NOT NULL, l_linestatus string NOT NULL, l_shipdate date NOT NULL, "
              "l_quantity decimal(19,6), l_extendedprice decimal(19,4), l_discount decimal(19,4), l_tax decimal(19,4), "
              "l_comment string", ("l_orderkey", "l_linenumber"))
DOCUMENTS = Table("documents", SNAPSHOT, "doc_id bigint NOT NULL, text string NOT NULL, lang string NOT NULL", ("doc_id",))
ORDERS = Table("orders", SNAPSHOT, "o_orderkey bigint NOT NULL, done string NOT NULL", ("o_orderkey",))


@query("""
SELECT * FROM (VALUES ('lineitem', 'l_comment', 'MISSING_COLUMN'), ('lineitem', 'l_returnflag', 'UNEXPECTED_COLUMN'),
  ('lineitem', 'l_linenumber', 'TYPE int <> bigint')) v(table_name, column_name, problem)
UNION ALL SELECT 'documents', c, 'NULLS ' || n FROM (
  SELECT 'doc_id' AS c, count(*) - count(doc_id) AS n FROM documents
  UNION ALL SELECT 'text', count(*) - count(text) FROM documents UNION ALL SELECT 'lang', count(*) - count(lang) FROM documents)
  WHERE n > 0
UNION ALL SELECT 'orders', 'done', 'NULLS ' || n FROM (
  SELECT count(*) AS n FROM orders ANTI JOIN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') ON l_orderkey = o_orderkey)
  WHERE n > 0
""")
def schema_check(t: Tables) -> DataFrame:
    """Lines, documents and orders against a contract: columns, types, and nulls in required columns."""
    done = t.lineitem().where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linestatus").alias("done"))
    orders = t.orders().select("o_orderkey").join(done, "o_orderkey", "left")
    documents = t.raw("documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    return (schema_violations(t.lineitem(), LINES).unionByName(schema_violations(documents, DOCUMENTS))
            .unionByName(schema_violations(orders, ORDERS)))


@query("""
WITH found AS (
 SELECT 'M01' AS rule, 'fx_rate' AS entity, concat_ws('|', CAST(o_orderdate AS DATE), o_orderpriority) AS key,
   'Key occurs more than once in the registry' AS message FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority HAVING count(*) > 1
 UNION ALL SELECT 'M02', 'lineitem', CAST(l_suppkey AS VARCHAR), 'lineitem.l_suppkey has no parent in approved' FROM lineitem
   ANTI JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON s_suppkey = l_suppkey
 UNION ALL SELECT 'M02', 'documents', CAST(doc_id AS VARCHAR), 'documents.doc_id has no parent in labels' FROM documents
   ANTI JOIN labels USING (doc_id))
SELECT rule, 'BLOCKER' AS severity, entity, key AS record_key, message, count(*) AS found FROM found GROUP BY ALL
""")
def master_check(t: Tables) -> DataFrame:
    """Rates given twice for a day and currency, lines of unknown suppliers and documents without a label, as issues."""
    rates = t.orders().select(F.col("o_orderdate").alias("rate_date"), F.col("o_orderpriority").alias("currency"))
    found = quality.master_issues(
        {"fx_rate": rates, "lineitem": t.lineitem(), "documents": t.raw("documents").select("doc_id"),
         "approved": t.raw("supplier").where("s_acctbal >= 0"), "labels": t.raw("labels")},
        {"fx_rate": ["rate_date", "currency"]},
        [("lineitem", "l_suppkey", "approved", "s_suppkey"), ("documents", "doc_id", "labels", "doc_id")])
    union = found[0]
    for other in found[1:]:
        union = union.unionByName(other)
    return union.groupBy(F.col("RuleId").alias("rule"), F.col("Severity").alias("severity"),
                         F.col("EntityName").alias("entity"), F.col("RecordKey").alias("record_key"),
                         F.col("Message").alias("message")).agg(out_int(count()).alias("found"))


@query("""
SELECT o_orderpriority AS priority, l_linenumber::BIGINT AS line, count(*) AS found,
  count(*) FILTER (CAST(l_shipdate AS DATE) <= CAST(o_orderdate AS DATE)) AS empty_periods,
  CAST(min(concat_ws('|', l_orderkey, l_linenumber)) AS VARCHAR) AS first_key
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_discount <= 0 OR l_discount > 1 OR CAST(l_shipdate AS DATE) <= CAST(o_orderdate AS DATE) GROUP BY 1, 2
""")
def share_check(t: Tables) -> DataFrame:
    """Shares outside (0, 1] and empty periods: discounts valid from the order to the shipment."""
    orders = t.orders().select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    register = t.lineitem().join(orders, "l_orderkey")
    found = quality.invalid_shares(register, "l_discount", "o_orderdate", "l_shipdate")
    empty = F.col("l_shipdate") <= F.col("o_orderdate")
    return found.groupBy(F.col("o_orderpriority").alias("priority"), out_int("l_linenumber").alias("line")).agg(
        out_int(count()).alias("found"), out_int(F.count_if(empty)).alias("empty_periods"),
        F.min(key_text("l_orderkey", "l_linenumber")).alias("first_key"))


@query("""
WITH rows_of(stage, batch) AS (SELECT 'target_monthly', o_orderstatus FROM orders UNION ALL SELECT 'cost_monthly', 'B' FROM orders
  WHERE o_orderstatus = 'none')
SELECT 'target_monthly' AS entity, batch AS record_key, 'Staging rows belong to another batch than F' AS message, count(*) AS found
FROM rows_of WHERE stage = 'target_monthly' AND batch <> 'F' GROUP BY 2
UNION ALL SELECT 'cost_monthly', 'F', 'No staging rows for F', 1
WHERE NOT EXISTS (SELECT 1 FROM rows_of WHERE stage = 'cost_monthly' AND batch = 'F')
""")
def staging_check(t: Tables) -> DataFrame:
    """Staging rows of another batch, and a stage without any row of this one."""
    stage = t.orders().withColumn("batch_id", out_text("o_orderstatus"))
    found = quality.staging_issues(stage, "target_monthly", "F").unionByName(
        quality.staging_issues(stage.where("o_orderstatus = 'none'"), "cost_monthly", "F"))
    return found.groupBy(F.col("EntityName").alias("entity"), F.col("RecordKey").alias("record_key"),
                         F.col("Message").alias("message")).agg(out_int(count()).alias("found"))


DELIVERED = Table("orders", SNAPSHOT, "batch_id string NOT NULL, o_orderkey bigint NOT NULL, o_orderdate date NOT NULL, "
                  "o_totalprice decimal(19,4) NOT NULL", ("o_orderkey",))


@query("""
WITH o AS (SELECT o_orderkey AS k FROM orders),
p AS (SELECT CASE WHEN k % 11 = 0 THEN 'WRONG_NUMBER_OF_FIELDS' END AS whole, k,
             CASE WHEN k % 13 = 0 THEN 'UNREADABLE' END AS day,
             CASE WHEN k % 17 = 0 THEN 'TOO_MANY_DIGITS' WHEN k % 19 = 0 THEN 'EMPTY_BUT_REQUIRED' END AS price FROM o),
r AS (SELECT NULL AS column_name, whole AS reason FROM p WHERE whole IS NOT NULL
      UNION ALL SELECT 'o_orderdate', day FROM p WHERE whole IS NULL AND day IS NOT NULL
      UNION ALL SELECT 'o_totalprice', price FROM p WHERE whole IS NULL AND price IS NOT NULL)
SELECT coalesce(column_name, '-') AS column_name, reason, count(*) AS problems FROM r GROUP BY ALL
UNION ALL SELECT '-', 'LOADED', count(*) FROM p WHERE whole IS NULL AND day IS NULL AND price IS NULL
""")
def rejected_rows(t: Tables) -> DataFrame:
    """Orders delivered as CSV with broken lines: the readable ones are loaded, the others kept by column and reason."""
    k = F.col("o_orderkey")
    price = F.when(k % 17 == 0, "1.23456").when(k % 19 == 0, "").otherwise(F.col("o_totalprice").cast("string"))
    lines = t.orders().select(
        F.lit("B0").alias("batch_id"), k.cast("string").alias("o_orderkey"),
        F.when(k % 13 == 0, "someday").otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"),
        F.when(k % 11 == 0, F.concat(price, F.lit(",more"))).otherwise(price).alias("o_totalprice"))
    path, store = t.scratch("csv"), Store(t.spark, root=t.scratch("rejected"))
    # without quotes the comma in a value makes one field too many
    lines.write.option("header", True).option("quote", "\u0000").option("escapeQuotes", False).csv(path)
    load_checked_csv(store, path, DELIVERED, "B0")
    bad = store.table(REJECTED).groupBy(F.coalesce("ColumnName", F.lit("-")).alias("column_name"),
                                        F.col("Reason").alias("reason")).agg(out_int(count()).alias("problems"))
    loaded = store.table("bronze.orders").agg(out_int(count()).alias("problems"))
    return bad.unionByName(loaded.select(F.lit("-").alias("column_name"), F.lit("LOADED").alias("reason"), "problems"))
