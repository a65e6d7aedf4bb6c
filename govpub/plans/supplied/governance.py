"""Landing, quality and resolution on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.functions.columns import key_text, known_true
from govpub.functions.skew import latest_by, spread, tasks_for
from govpub.operators import ingest, quality, registry, resolve
from govpub.plans.supplied.base import ORACLES, Tables, count, out_int, out_num, out_text, query
from govpub.sources import extract
from govpub.sources.contract import decimal_misfits, union_all
from govpub.sources.store import Store, read_landed
from govpub.streaming import revisions

# --- landing ---------------------------------------------------------------------------

ENTITIES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
            "pages", "benchmark", "labels", "conversations"]
# What the manifest says beyond the rows that are there: one label too many, and a table that never came.
PLANTED = {"labels": 1, "returns": 7, "refunds": 0}
_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{e}' AS entity_name, count(*) AS n FROM {e}" for e in ENTITIES)


@query(f"""
WITH counts AS ({_COUNTS_SQL}),
manifest AS (SELECT entity_name, n + CASE entity_name WHEN 'labels' THEN 1 ELSE 0 END AS expected_rows FROM counts
             UNION ALL VALUES ('returns', 7), ('refunds', 0)),
foreign_rows AS (SELECT 'orders' AS entity_name, count(*) FILTER (o_orderdate >= TIMESTAMP '2001-08-01') AS f FROM orders
 UNION ALL SELECT 'lineitem', count(*) FILTER (l_shipdate >= TIMESTAMP '2001-11-01') FROM lineitem)
SELECT entity_name, CAST(expected_rows AS BIGINT) AS expected_rows, CAST(coalesce(n, 0) AS BIGINT) AS actual_rows,
       CAST(coalesce(f, 0) AS BIGINT) AS foreign_rows,
       CASE WHEN coalesce(n, 0) = expected_rows AND coalesce(f, 0) = 0 THEN 'OK' ELSE 'MISMATCH' END AS status
FROM manifest LEFT JOIN counts USING (entity_name) LEFT JOIN foreign_rows USING (entity_name)
""")
def landing_reconciliation(t: Tables) -> DataFrame:
    """Row counts of every entity and rows of a foreign batch against the manifest."""
    frames: dict[str, DataFrame | None] = {e: t.raw(e) for e in ENTITIES}
    frames["orders"] = t.orders().select(
        F.when(F.col("o_orderdate") < "2001-08-01", "B0").otherwise("B1").alias("batch_id"))
    frames["lineitem"] = t.lineitem().select(
        F.when(F.col("l_shipdate") < "2001-11-01", "B0").otherwise("B1").alias("batch_id"))
    planted = t.spark.createDataFrame(list(PLANTED.items()), "entity_name string, more long")
    delivered = ingest.entity_counts({e: t.raw(e) for e in ENTITIES}).select("entity_name", "actual_rows")
    manifest = delivered.join(planted, "entity_name", "full").select(
        "entity_name", (F.coalesce("actual_rows", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("row_count"))
    return ingest.reconcile_landing(manifest, ingest.entity_counts(frames, "B0"))


@query("""
SELECT 'orders' AS entity_name, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(8 AS BIGINT) AS ranges
FROM orders UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT), 8 FROM lineitem
""")
def partitioned_pull(t: Tables) -> DataFrame:
    """Two enabled entities of three pulled into a landing folder, each in eight planned ranges of its sequence."""
    root, store = t.scratch("pull"), Store(t.spark, root=t.scratch("entities"))
    config = [(1, "orders", "orders", "EVENT", True), (2, "customer", "customer", "REF", False),
              (3, "lineitem", "lineitem", "EVENT", True)]
    extract.save_entities(store, t.spark.createDataFrame(
        config, "ordinal int, entity_name string, source_table string, entity_kind string, enabled boolean"))
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_orderkey"}

    def read(table: str) -> DataFrame:
        rows, key = t.raw(table), keys[table]
        parts = extract.split_ranges(rows, key, 8)
        return union_all([rows.where(p).select(F.col(key).alias("sequence"), F.lit(k).alias("range"))
                          for k, p in enumerate(parts)])

    done = extract.copy_batch(extract.entities(store), read, root, "B0")
    return union_all([read_landed(t.spark, f"{root}/B0/{e}").agg(
        out_int(count()).alias("row_count"), out_int(F.sum("sequence")).alias("keys"),
        out_int(F.countDistinct("range")).alias("ranges")).select(F.lit(e).alias("entity_name"), "row_count", "keys", "ranges")
        for e in done])


@query("""
WITH delivery AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem),
fresh AS (SELECT * FROM (SELECT DISTINCT * FROM delivery)
          EXCEPT SELECT * FROM lineitem WHERE l_linestatus = 'F')
SELECT l_returnflag, count(*) AS new_rows, CAST(sum(CAST(l_quantity AS DECIMAL(19,6))) AS DOUBLE) AS quantity
FROM fresh GROUP BY l_returnflag
""")
def idempotent_append(t: Tables) -> DataFrame:
    """A delivery sent twice, of which the finished lines are already stored: only new rows remain."""
    lines = t.lineitem()
    delivery = ingest.with_row_hash(lines.unionByName(lines))
    stored = ingest.with_row_hash(lines.where("l_linestatus = 'F'"))
    fresh = ingest.new_rows(delivery, stored)
    return fresh.groupBy("l_returnflag").agg(out_int(count()).alias("new_rows"),
                                             out_num(F.sum("l_quantity")).alias("quantity"))


_CONTENT = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_orderdate AS DATE)",
               "CAST(o_totalprice AS DECIMAL(19,4))"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "CAST(l_quantity AS DECIMAL(19,6))",
                 "CAST(l_extendedprice AS DECIMAL(19,4))", "l_returnflag", "l_linestatus", "CAST(l_shipdate AS DATE)"],
    "documents": ["doc_id", "text", "lang", "source"], "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
_FOLD_SQL = " UNION ALL ".join(
    f"SELECT '{e}' AS entity_name, sha256(concat_ws('|', " + ", ".join(rf"coalesce(CAST({x} AS VARCHAR), '\N')" for x in c)
    + f")) AS h FROM {e}" for e, c in _CONTENT.items())


@query(f"""
SELECT entity_name, count(*) AS row_count, CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR) AS content
FROM ({_FOLD_SQL}) GROUP BY entity_name
""")
def content_fingerprint(t: Tables) -> DataFrame:
    """Order-free content fingerprint of typed and text tables, reproducible by any engine that has SHA-256."""
    frames = {e: t.raw(e).selectExpr(*[f"{c} AS c{k:02d}" for k, c in enumerate(cols)]) for e, cols in _CONTENT.items()}
    return ingest.content_digests(frames).select("entity_name", out_int("row_count").alias("row_count"),
                                                 out_text("content").alias("content"))


@query("""
SELECT 'l_extendedprice' AS column_name, count(*) FILTER (
         l_extendedprice IS NOT NULL AND coalesce(TRY_CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DECIMAL(6,2))
         <> CAST(l_extendedprice AS DECIMAL(19,4)), true)) AS misfits FROM lineitem
UNION ALL SELECT 'l_discount', count(*) FILTER (
         l_discount IS NOT NULL AND coalesce(TRY_CAST(CAST(l_discount AS DECIMAL(19,4)) AS DECIMAL(3,1))
         <> CAST(l_discount AS DECIMAL(19,4)), true)) FROM lineitem
UNION ALL SELECT 'l_quantity', count(*) FILTER (
         l_quantity IS NOT NULL AND coalesce(TRY_CAST(CAST(l_quantity AS DECIMAL(19,6)) AS DECIMAL(4,0))
         <> CAST(l_quantity AS DECIMAL(19,6)), true)) FROM lineitem
""")
def decimal_fit(t: Tables) -> DataFrame:
    """Values that do not fit a narrower decimal type without loss."""
    found = decimal_misfits(t.lineitem(), {"l_extendedprice": "decimal(6,2)", "l_discount": "decimal(3,1)",
                                           "l_quantity": "decimal(4,0)"})
    return found.select("column_name", out_int("misfits").alias("misfits"))


# --- revisions -------------------------------------------------------------------------

def deliveries(t: Tables) -> DataFrame:
    """Lines as revisioned deliveries: observation (order, line), revision = ship year."""
    return t.lineitem().select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("revision"),
        (F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).cast("long") * 1_000_000_000
         + F.col("l_partkey")).alias("seq"),
        key_text("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus").alias("record"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")


OBSERVATION = ["l_orderkey", "l_linenumber"]
PAYLOAD = ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def resolved_lines(sent: DataFrame) -> resolve.Resolved:
    return resolve.resolved(sent, OBSERVATION, "revision", "seq", "record", PAYLOAD)


_DELIVERIES = """
deliveries AS (
 SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS revision,
  date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) * 1000000000 + l_partkey AS seq,
  concat_ws('|', l_suppkey, CAST(l_quantity AS DECIMAL(19,6)), CAST(l_extendedprice AS DECIMAL(19,4)),
   CAST(l_discount AS DECIMAL(19,4)), CAST(l_tax AS DECIMAL(19,4)), l_returnflag, l_linestatus) AS record,
  l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(19,6)) AS qty, l_returnflag,
  CAST(l_extendedprice AS DECIMAL(19,4)) AS price, CAST(l_shipdate AS DATE) AS shipdate,
  concat_ws('|', l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(19,6)), CAST(l_shipdate AS DATE)) AS payload
 FROM lineitem)"""


@query(f"""
WITH {_DELIVERIES}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, revision, count(*) AS deliveries
FROM deliveries GROUP BY 1, 2, 3 HAVING count(DISTINCT payload) > 1
""")
def revision_conflicts(t: Tables) -> DataFrame:
    """Revisions delivered with different payloads."""
    found = resolve.conflicts_of(resolved_lines(deliveries(t)))
    return found.select("l_orderkey", out_int("l_linenumber").alias("l_linenumber"),
                        out_int("revision").alias("revision"), out_int("deliveries").alias("deliveries"))


@query(f"""
WITH {_DELIVERIES},
sent AS (SELECT *, 0 AS again FROM deliveries UNION ALL SELECT *, 1 FROM deliveries),  -- the same changes again
clean AS (SELECT l_orderkey, l_linenumber, revision FROM sent GROUP BY ALL HAVING count(DISTINCT payload) = 1),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, revision
                                          ORDER BY again, seq, record) AS delivery_rank
           FROM sent s SEMI JOIN clean USING (l_orderkey, l_linenumber, revision))
SELECT revision, l_returnflag, count(*) AS duplicates, CAST(sum(qty) AS DOUBLE) AS quantity
FROM ranked WHERE delivery_rank > 1 GROUP BY 1, 2
""")
def duplicate_deliveries(t: Tables) -> DataFrame:
    """Every line is sent twice, unchanged; the deliveries after the first of each clean revision."""
    first = deliveries(t)
    found = resolve.duplicates_of(resolved_lines(first.unionByName(first)))
    return found.groupBy("revision", "l_returnflag").agg(
        out_int(count()).alias("duplicates"), out_num(F.sum("l_quantity")).alias("quantity")).withColumn(
        "revision", out_int("revision"))


def _latest_columns(df: DataFrame, *more) -> DataFrame:
    return df.select("l_orderkey", out_int("l_linenumber").alias("l_linenumber"), out_int("revision").alias("revision"),
                     "seq", "l_partkey", out_num("l_quantity").alias("quantity"), *more)


@query(f"""
WITH {_DELIVERIES},
groups AS (SELECT l_orderkey, l_linenumber, revision, count(DISTINCT payload) AS payloads FROM deliveries GROUP BY ALL),
top AS (SELECT l_orderkey, l_linenumber, max(revision) AS revision FROM deliveries GROUP BY ALL),
clean AS (SELECT l_orderkey, l_linenumber, revision FROM top JOIN groups USING (l_orderkey, l_linenumber, revision)
          WHERE payloads = 1),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq, record) AS r
           FROM deliveries d SEMI JOIN clean USING (l_orderkey, l_linenumber, revision))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, revision, seq, l_partkey,
       CAST(qty AS DOUBLE) AS quantity FROM ranked WHERE r = 1
""")
def latest_revision(t: Tables) -> DataFrame:
    """First delivery of the highest revision; an observation in conflict stays unresolved."""
    sent = deliveries(t)
    return _latest_columns(resolve.latest_of(resolved_lines(sent), sent.columns))


@query(f"""
WITH {_DELIVERIES},
clean AS (SELECT l_orderkey, l_linenumber, revision FROM deliveries GROUP BY ALL HAVING count(DISTINCT payload) = 1),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                          ORDER BY revision DESC, seq, record) AS r
           FROM deliveries d SEMI JOIN clean USING (l_orderkey, l_linenumber, revision))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, revision, seq, l_partkey,
       CAST(qty AS DOUBLE) AS quantity FROM ranked WHERE r = 1
""")
def latest_clean_revision(t: Tables) -> DataFrame:
    """The same with conflicts skipped: the highest revision that is clean."""
    sent = deliveries(t)
    return _latest_columns(resolve.latest_of(resolved_lines(sent), sent.columns, on_conflict="older"))


@query(f"""
WITH {_DELIVERIES},
groups AS (SELECT l_orderkey, l_linenumber, revision, count(*) AS deliveries, count(DISTINCT payload) AS payloads
           FROM deliveries GROUP BY ALL),
top AS (SELECT l_orderkey, l_linenumber, max(revision) AS revision FROM deliveries GROUP BY ALL),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, revision ORDER BY seq, record) AS r
           FROM deliveries d)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, revision, seq, l_partkey, CAST(qty AS DOUBLE) AS quantity,
       deliveries
FROM ranked JOIN groups USING (l_orderkey, l_linenumber, revision) SEMI JOIN top USING (l_orderkey, l_linenumber, revision)
WHERE r = 1 AND payloads = 1
""")
def incremental_latest(t: Tables) -> DataFrame:
    """Latest revisions after two batches (returned lines come later), the second resolved on top of the kept state of the
    first: the same as all at once."""
    sent, key = deliveries(t), (OBSERVATION, "revision", "seq", "record")
    late = known_true(F.col("l_returnflag") == "R")
    before = resolve.resolved(sent.where(~late), *key, PAYLOAD)
    state = resolve.extended(before, resolve.touched(before, sent.where(late), OBSERVATION), *key, PAYLOAD)
    return _latest_columns(resolve.latest_of(state, [*sent.columns, "deliveries"]), out_int("deliveries").alias("deliveries"))


@query(ORACLES["latest_revision"])
def streamed_latest(t: Tables) -> DataFrame:
    """Latest revisions by a stateful stream over files that arrive in three runs; the second run ends with a compaction,
    and every run continues from the checkpoint of the one before."""
    sent, folder = deliveries(t), t.scratch("stream")
    store, landing = Store(t.spark, root=folder), f"{folder}/landing"
    args = (OBSERVATION, "revision", "seq", "record", PAYLOAD, "silver.line_revision", f"{folder}/checkpoint")
    for k, flag in enumerate(("R", "N", "A")):
        sent.where(F.col("l_returnflag") == flag).write.mode("append").parquet(landing)
        revisions.follow(store, landing, sent.schema, lambda rows: rows, "lines", *args).awaitTermination()
        if k == 1:
            revisions.compact(store, "silver.line_revision", [*OBSERVATION, "revision"])
    return _latest_columns(revisions.latest(store, "silver.line_revision", OBSERVATION, "revision", sent.columns))


@query("""
WITH ranked AS (SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(19,6)) AS v,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
SELECT user_id, event_type, event_id, CAST(v AS DOUBLE) AS value FROM ranked WHERE r = 1
""")
def latest_event(t: Tables) -> DataFrame:
    """Last event per user and type, ties by event id."""
    events = t.raw("events").select("user_id", "event_type", "event_id", "ts",
                                    F.col("value").cast("decimal(19,6)").alias("value"))
    return latest_by(events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", out_num("value").alias("value"))


# --- conforming and rules --------------------------------------------------------------

_CODES = {"commodity": ({"A": "Oil", "N": "Gas", "R": "Water"}, None), "report_status": ({"F": "FINAL"}, "PROVISIONAL")}
_FEED_COLUMNS = ["observation_id", "well_ref", "report_date", "commodity", "quantity", "unit", "operation",
                 "report_status"]


def two_feeds(t: Tables) -> DataFrame:
    """Lines as two feeds of different column names and codes, brought to one shape."""
    lines = t.lineitem()
    local = ["obs_key", "well_code", "obs_date", "product", "qty", "qty_unit", "op_code", "approval_flag"]
    small = lines.where("l_discount < 0.05").select(
        key_text("l_orderkey", "l_linenumber").alias("observation_id"), out_text("l_suppkey").alias("well_ref"),
        F.col("l_shipdate").alias("report_date"),
        F.when(F.col("l_returnflag") == "A", "Oil").when(F.col("l_returnflag") == "N", "Gas").otherwise("Water")
        .alias("commodity"), F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_tax") > 0, "bbl").otherwise("m3").alias("unit"), F.lit("I").alias("operation"),
        F.lit("FINAL").alias("report_status"))
    other = lines.where("l_discount >= 0.05").select(
        key_text("l_orderkey", "l_linenumber").alias("obs_key"), out_text("l_suppkey").alias("well_code"),
        F.col("l_shipdate").alias("obs_date"), F.col("l_returnflag").alias("product"),
        F.col("l_quantity").alias("qty"), F.when(F.col("l_tax") > 0, "Mscf").otherwise("scf").alias("qty_unit"),
        F.when(F.col("l_quantity") > 48, "D").otherwise("U").alias("op_code"),
        F.col("l_linestatus").alias("approval_flag"))
    return (resolve.conform_source(small, {c: c for c in _FEED_COLUMNS}, "SRC_1")
            .unionByName(resolve.conform_source(other, dict(zip(_FEED_COLUMNS, local)), "SRC_2", _CODES)))


_FEEDS = """
feeds AS (
 SELECT CASE WHEN l_discount < 0.05 THEN 'SRC_1' ELSE 'SRC_2' END AS source_system,
  CAST(l_suppkey AS VARCHAR) AS well_ref, CAST(l_shipdate AS DATE) AS report_date,
  CASE l_returnflag WHEN 'A' THEN 'Oil' WHEN 'N' THEN 'Gas' ELSE 'Water' END AS commodity,
  CAST(l_quantity AS DECIMAL(19,6)) AS quantity,
  CASE WHEN l_discount < 0.05 THEN CASE WHEN l_tax > 0 THEN 'bbl' ELSE 'm3' END
       ELSE CASE WHEN l_tax > 0 THEN 'Mscf' ELSE 'scf' END END AS unit,
  CASE WHEN l_discount < 0.05 THEN 'I' WHEN l_quantity > 48 THEN 'D' ELSE 'U' END AS operation,
  CASE WHEN l_discount < 0.05 OR l_linestatus = 'F' THEN 'FINAL' ELSE 'PROVISIONAL' END AS report_status
 FROM lineitem)"""


@query(f"""
WITH {_FEEDS}
SELECT source_system, commodity, unit, report_status, operation, count(*) AS rows_in_feed,
       CAST(sum(quantity) AS DOUBLE) AS quantity
FROM feeds GROUP BY ALL
""")
def source_profile(t: Tables) -> DataFrame:
    """Rows per source, commodity and unit after bringing the feeds to one shape."""
    return two_feeds(t).groupBy("source_system", "commodity", "unit", "report_status", "operation").agg(
        out_int(count()).alias("rows_in_feed"), out_num(F.sum("quantity")).alias("quantity"))


UNITS = [("Oil", "bbl", "bbl", "1"), ("Oil", "m3", "bbl", "6.289810770"), ("Gas", "Mscf", "Mscf", "1"),
         ("Gas", "scf", "Mscf", "0.001"), ("Water", "bbl", "bbl", "1"), ("Water", "m3", "bbl", "6.289810770")]
_UNITS_SQL = ", ".join(f"('{c}', '{u}', CAST({f} AS DECIMAL(18,9)))" for c, u, _, f in UNITS)


def unit_register(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(UNITS, "commodity string, uom string, standard_uom string, f string").select(
        "commodity", "uom", "standard_uom", F.col("f").cast("decimal(18,9)").alias("to_standard_factor"))


def approved_places(t: Tables) -> DataFrame:
    """Suppliers with a positive balance are approved references of both feeds; nation is their field."""
    supplier = t.raw("supplier").where("s_acctbal >= 0").select(
        out_text("s_suppkey").alias("source_well_id"), F.concat(F.lit("W"), "s_suppkey").alias("well_id"),
        "s_nationkey")
    alias = supplier.select(F.explode(F.array(F.lit("SRC_1"), F.lit("SRC_2"))).alias("source_system"),
                            "source_well_id", "well_id")
    nations = t.nations()
    return registry.crosswalk(
        alias, supplier.select("well_id", F.concat(F.lit("S"), "source_well_id").alias("stream_id")),
        supplier.select("well_id", F.col("s_nationkey").alias("field_id")),
        nations.select(F.col("n_nationkey").alias("field_id"), F.col("r_name").alias("country_id")))


def checked_feeds(t: Tables) -> DataFrame:
    return resolve.standardise(two_feeds(t), approved_places(t), unit_register(t))


_CHECKED = f"""
units(commodity, unit, factor) AS (VALUES {_UNITS_SQL}),
places AS (SELECT CAST(s_suppkey AS VARCHAR) AS well_ref, 'W' || s_suppkey AS well_id, 'S' || s_suppkey AS stream_id,
            s_nationkey AS field_id, r_name AS country_id
           FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
           WHERE s_acctbal >= 0),
checked AS (
 SELECT f.*, p.well_id, p.stream_id, p.field_id, p.country_id, u.factor,
  concat_ws(',', CASE WHEN p.well_id IS NULL THEN 'R01' END, CASE WHEN u.factor IS NULL THEN 'R02' END,
   CASE WHEN f.quantity IS NULL AND operation <> 'D' THEN 'R03' END, CASE WHEN f.quantity < 0 THEN 'R04' END
   ) AS failed_rules
 FROM feeds f LEFT JOIN places p USING (well_ref) LEFT JOIN units u USING (commodity, unit))"""


@query(f"""
WITH {_FEEDS}, {_CHECKED}
SELECT coalesce(CAST(field_id AS VARCHAR), 'UNRESOLVED') AS field_id, source_system, count(*) AS observations,
       CAST(sum(quantity) AS DOUBLE) AS quantity
FROM checked GROUP BY 1, 2
""")
def alias_crosswalk_orphans(t: Tables) -> DataFrame:
    """Local references to golden ids and their field; references without approval stay unresolved."""
    joined = two_feeds(t).join(approved_places(t), ["source_system", "well_ref"], "left")
    return joined.groupBy(F.coalesce(out_text("field_id"), F.lit("UNRESOLVED")).alias("field_id"),
                          "source_system").agg(out_int(count()).alias("observations"),
                                               out_num(F.sum("quantity")).alias("quantity"))


@query(f"""
WITH {_FEEDS}, {_CHECKED}
SELECT commodity, unit, CASE WHEN operation = 'D' THEN 'RETRACTED' ELSE 'CURRENT' END AS observation_status,
       count(*) AS observations, count(*) FILTER (factor IS NULL) AS unregistered,
       CAST(sum(CASE WHEN operation <> 'D' THEN CAST(round(quantity * factor, 6) AS DECIMAL(19,6)) END) AS DOUBLE)
         AS value_std
FROM checked GROUP BY 1, 2, 3
""")
def unit_standardisation(t: Tables) -> DataFrame:
    """Quantities in standard units; an unregistered unit has no value and a retraction none either."""
    valued = resolve.standard_values(checked_feeds(t))
    return valued.groupBy("commodity", "unit", "observation_status").agg(
        out_int(count()).alias("observations"),
        out_int(F.count_if(F.col("to_standard_factor").isNull())).alias("unregistered"),
        out_num(F.sum("value_std")).alias("value_std"))


@query(f"""
WITH {_FEEDS}, {_CHECKED}
SELECT failed_rules, source_system, count(*) AS observations, CAST(sum(quantity) AS DOUBLE) AS quantity
FROM checked WHERE failed_rules <> '' GROUP BY 1, 2
""")
def quarantine_rules(t: Tables) -> DataFrame:
    """Quarantined rows by the list of rules they fail."""
    return quality.quarantine(checked_feeds(t), "B0").groupBy("failed_rules", "source_system").agg(
        out_int(count()).alias("observations"), out_num(F.sum("quantity")).alias("quantity"))


@query(f"""
WITH {_FEEDS}, {_CHECKED},
issues AS (SELECT source_system, unnest(string_split(failed_rules, ',')) AS rule FROM checked WHERE failed_rules <> '')
SELECT rule AS "RuleId", 'BLOCKER' AS "Severity", source_system AS "SourceSystem", count(*) AS "IssueCount"
FROM issues GROUP BY 1, 2, 3
""")
def issue_rollup(t: Tables) -> DataFrame:
    """One issue per failing row and rule, counted by rule, severity and source."""
    found = quality.rule_issues(checked_feeds(t), "line", key_text("observation_id"), "source_system")
    return found.groupBy("RuleId", "Severity", "SourceSystem").agg(out_int(count()).alias("IssueCount"))


@query("""
SELECT 'lineitem' AS entity_name, concat_ws('|', l_orderkey, l_linenumber) AS record_key, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'orders', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), count(*) FROM customer GROUP BY c_custkey HAVING count(*) > 1
UNION ALL SELECT 'events', concat_ws('|', user_id, event_type), count(*) FROM events GROUP BY user_id, event_type
          HAVING count(*) > 1
""")
def duplicate_keys(t: Tables) -> DataFrame:
    """Key values that occur more than once, for four entities."""
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
            "events": ["user_id", "event_type"]}
    parts = [quality.duplicate_keys(spread(t.raw(e), k, tasks_for(t.raw(e))), k).select(
        F.lit(e).alias("entity_name"), key_text(*k).alias("record_key"), out_int("copies").alias("copies"))
        for e, k in keys.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
SELECT 'lineitem.l_orderkey' AS relation, count(*) AS orphans FROM lineitem
 WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem
 WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem
 WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 0)
UNION ALL SELECT 'orders.o_custkey', count(*) FROM orders
 WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'documents.doc_id', count(*) FROM documents d
 WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def orphan_children(t: Tables) -> DataFrame:
    """Child rows without a parent for five relations, three of them with a restricted parent."""
    relations = [
        ("lineitem", "l_orderkey", t.raw("orders").where("o_orderstatus <> 'P'"), "o_orderkey"),
        ("lineitem", "l_partkey", t.raw("part"), "p_partkey"),
        ("lineitem", "l_suppkey", t.raw("supplier").where("s_acctbal >= 0"), "s_suppkey"),
        ("orders", "o_custkey", t.raw("customer"), "c_custkey"),
        ("documents", "doc_id", t.raw("labels"), "doc_id")]
    parts = [quality.orphans(t.raw(child), col, parent, pcol).agg(out_int(count()).alias("orphans"))
             .select(F.lit(f"{child}.{col}").alias("relation"), "orphans") for child, col, parent, pcol in relations]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
WITH periods AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS a,
                        CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 1000) AS INTEGER) AS b FROM orders)
SELECT y.k AS o_custkey, CAST(y.a AS VARCHAR) AS valid_from, y.n AS periods, count(*) AS overlapped_by
FROM (SELECT k, a, count(*) AS n FROM periods GROUP BY k, a) y
JOIN periods x ON x.k = y.k AND x.a < y.a AND y.a < x.b
GROUP BY y.k, y.a, y.n
""")
def interval_overlaps(t: Tables) -> DataFrame:
    """Order periods of a customer that begin while an earlier one still runs."""
    periods = t.orders().select("o_custkey", F.col("o_orderdate").alias("valid_from"), F.date_add(
        "o_orderdate", F.floor(F.col("o_totalprice") / 1000).cast("int")).alias("valid_to"))
    periods = spread(periods, ["o_custkey"], tasks_for(t.raw("orders")))
    found = quality.overlaps(periods, ["o_custkey"], "valid_from", "valid_to")
    return found.select("o_custkey", out_text("valid_from").alias("valid_from"), out_int("periods").alias("periods"),
                        out_int("overlapped_by").alias("overlapped_by"))


# --- authority -------------------------------------------------------------------------

POLICY = [("P-1", "1-URGENT", "ALL", 1, "F", "1995-01-01", "9999-12-31"),
          ("P-1", "2-HIGH", "EUROPE", 1, "O", "1995-01-01", "9999-12-31"),
          ("P-1", "2-HIGH", "ALL", 2, "F", "1995-01-01", "9999-12-31"),
          ("P-1", "3-MEDIUM", "ALL", 2, "P", "1995-01-01", "1998-01-01"),
          ("P-1", "3-MEDIUM", "ALL", 3, "O", "1998-01-01", "9999-12-31"),
          ("P-1", "4-NOT SPECIFIED", "ASIA", 3, "O", "1996-06-01", "9999-12-31"),
          ("P-1", "5-LOW", "ALL", 99, "NONE", "1995-01-01", "9999-12-31")]
_POLICY_SQL = ", ".join(f"('{s}', '{c}', {p}, '{e}', DATE '{a}', DATE '{b}')" for _, s, c, p, e, a, b in POLICY)


def policy_register(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame(POLICY, "policy_version string, source_system string, scope string, priority int, "
                                           "eligible_status string, valid_from string, valid_to string")
    return rows.withColumns({"valid_from": F.col("valid_from").cast("date"), "valid_to": F.col("valid_to").cast("date")})


def order_candidates(t: Tables) -> DataFrame:
    """Orders as competing reports: key (customer, year), source = priority, status = order status."""
    customer, nations = t.raw("customer"), t.nations()
    place = customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"]).select(
        F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("country_id"))
    orders = t.orders().select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderdate", "o_totalprice",
                               F.col("o_orderkey").alias("observation_id"),
                               F.col("o_orderpriority").alias("source_system"),
                               F.col("o_orderstatus").alias("report_status"))
    return resolve.match_policy(orders.join(place, "o_custkey"), policy_register(t), "source_system", "country_id",
                                "o_orderdate", "report_status")


def order_authority(t: Tables) -> resolve.Authority:
    return resolve.select_authoritative(order_candidates(t), ["o_custkey", "year"],
                                        [F.floor(F.col("o_totalprice") / 100000)],
                                        ["source_system", "observation_id"])


_AUTHORITY = f"""
policy(source, scope, priority, eligible_status, a, b) AS (VALUES {_POLICY_SQL}),
cand AS (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderkey, o_orderpriority AS source,
          o_orderstatus AS status, CAST(floor(CAST(o_totalprice AS DECIMAL(19,4)) / 100000) AS BIGINT) AS value,
          CAST(o_orderdate AS DATE) AS d, r_name
         FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
         JOIN region ON r_regionkey = n_regionkey),
matched AS (SELECT c.*, p.priority, coalesce(p.eligible_status = c.status, false) AS eligible,
  row_number() OVER (PARTITION BY o_orderkey ORDER BY p.priority NULLS LAST, p.scope = 'ALL') AS pr
 FROM cand c LEFT JOIN policy p ON p.source = c.source AND p.scope IN (c.r_name, 'ALL') AND c.d >= p.a AND c.d < p.b),
scored AS (SELECT *, count(*) OVER k AS candidate_count, min(CASE WHEN eligible THEN priority END) OVER k AS best
           FROM matched WHERE pr = 1 WINDOW k AS (PARTITION BY o_custkey, year)),
winners AS (SELECT * FROM scored WHERE eligible AND priority = best),
variants AS (SELECT o_custkey, year, count(DISTINCT value) AS variants FROM winners GROUP BY ALL),
picked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, year ORDER BY source, o_orderkey) AS n FROM winners),
key_status AS (SELECT DISTINCT s.o_custkey, s.year, s.candidate_count, s.best,
   CASE WHEN s.best IS NULL THEN 'NO_AUTHORITATIVE_SOURCE' WHEN v.variants > 1 THEN 'REVIEW_REQUIRED'
        ELSE 'SELECTED' END AS decision_status
  FROM scored s LEFT JOIN variants v USING (o_custkey, year))"""


@query(f"""
WITH {_AUTHORITY}
SELECT k.o_custkey, k.year, k.candidate_count, CAST(k.best AS BIGINT) AS best_priority, k.decision_status,
       p.o_orderkey AS selected_id, p.source AS selected_source
FROM key_status k LEFT JOIN picked p ON p.o_custkey = k.o_custkey AND p.year = k.year AND p.n = 1
     AND k.decision_status = 'SELECTED'
""")
def source_authority(t: Tables) -> DataFrame:
    """One authoritative order per customer and year, or why there is none."""
    return order_authority(t).key_status.select(
        "o_custkey", out_int("year").alias("year"), out_int("candidate_count").alias("candidate_count"),
        out_int("best_priority").alias("best_priority"), "decision_status",
        F.col("_winner.observation_id").alias("selected_id"), F.col("_winner.source_system").alias("selected_source"))


def order_evidence(t: Tables) -> resolve.Evidence:
    return resolve.decision_evidence(
        order_authority(t), ["o_custkey", "year"],
        ["source_system", "observation_id", "report_status", "eligible", "priority"], "P-1",
        {"selected_source_system": "source_system", "selected_observation_id": "observation_id"})


@query(f"""
WITH {_AUTHORITY},
named AS (SELECT k.*, p.source, p.status FROM key_status k LEFT JOIN picked p ON p.o_custkey = k.o_custkey
          AND p.year = k.year AND p.n = 1 AND k.decision_status = 'SELECTED'
          WHERE k.candidate_count > 1 OR k.decision_status <> 'SELECTED')
SELECT sha256(concat_ws('|', o_custkey, year, 'P-1')) AS decision_id, o_custkey, year, candidate_count,
  decision_status,
  CASE decision_status
   WHEN 'SELECTED' THEN 'Selected ' || source || ' (priority ' || best || ', ' || status ||
     ') under P-1. Other candidates were not eligible or had lower priority.'
   WHEN 'NO_AUTHORITATIVE_SOURCE' THEN 'No candidate met the eligible status required by P-1.'
   ELSE 'Equal-priority eligible sources disagree; owner review is required.' END AS reason
FROM named
""")
def decision_evidence(t: Tables) -> DataFrame:
    """Contested and undecided keys with their reason."""
    return order_evidence(t).decisions.select(
        "decision_id", "o_custkey", out_int("year").alias("year"), out_int("candidate_count").alias("candidate_count"),
        "decision_status", "reason")


@query(f"""
WITH {_AUTHORITY}
SELECT sha256(concat_ws('|', s.o_custkey, s.year, 'P-1')) AS decision_id, s.source AS source_system,
       s.o_orderkey AS observation_id, s.status AS report_status, s.eligible, CAST(s.priority AS BIGINT) AS priority
FROM scored s JOIN key_status k USING (o_custkey, year)
WHERE k.candidate_count > 1 OR k.decision_status <> 'SELECTED'
""")
def decision_candidates(t: Tables) -> DataFrame:
    """Every candidate of every contested key, one row each."""
    return order_evidence(t).candidates.select("decision_id", "source_system", "observation_id", "report_status",
                                               "eligible", out_int("priority").alias("priority"))
