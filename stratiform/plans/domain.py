"""Queries of the composite operators on the driver's tables: quality, quarantine, dimensions, control, monitoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions import expr
from stratiform.operators import dedup, merge, monitor, quality, scd2, watermark
from stratiform.plans import audit, datagen, schema
from stratiform.plans.registry import query
from stratiform.sources.tables import align, empty, scan

AS_OF = dt.datetime(2024, 2, 1)

# --- Bronze, quality, quarantine -----------------------------------------------------


@query("SELECT event_id, ts, 'run-1' AS pipeline_run_id, TIMESTAMP '2024-02-01' AS ingestion_timestamp, 'events' AS lineage_source, 'p' AS lineage_pipeline, 'test' AS lineage_environment, TIMESTAMP '2024-02-01' AS lineage_bronze_ts FROM events")
def bronze_lineage(spark: SparkSession, sf: str) -> DataFrame:
    out = scan(spark, sf, "events").select("event_id", "ts").withColumns(expr.bronze_lineage("run-1", "events", "p", "test", AS_OF))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ingestion_timestamp", "lineage_bronze_ts")})


def _rules() -> list[quality.Rule]:
    return [quality.not_null("status"), quality.in_set("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM")), quality.between("o_totalprice", 1000, 150000, quality.WARNING)]


def _evaluated(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return quality.evaluate(o, _rules())


_DQ = """WITH e AS (SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderdate, nullif(o_orderstatus, 'P') AS status FROM orders),
f AS (SELECT *, status IS NULL AS f1, NOT (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR o_orderpriority IS NULL) AS f2, NOT (o_totalprice BETWEEN 1000 AND 150000 OR o_totalprice IS NULL) AS f3 FROM e),
g AS (SELECT *, CASE WHEN f1 OR f2 THEN 'FAIL' WHEN f3 THEN 'WARNING' ELSE 'PASS' END AS dq_status FROM f),
h AS (SELECT *, 'status_not_null' AS rule_name, 'status' AS failed_column, 'NULL' AS failed_value, 'ERROR' AS severity FROM g WHERE f1 UNION ALL
 SELECT *, 'o_orderpriority_in_set', 'o_orderpriority', o_orderpriority, 'ERROR' FROM g WHERE f2 UNION ALL
 SELECT *, 'o_totalprice_between', 'o_totalprice', NULL, 'WARNING' FROM g WHERE f3) """


@query(_DQ + "SELECT o_orderkey, dq_status, CAST(f1 AS INTEGER) + CAST(f2 AS INTEGER) + CAST(f3 AS INTEGER) AS n_failures FROM g")
def dq_status(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf).select("o_orderkey", "dq_status", F.size("dq_failures").alias("n_failures"))


@query(_DQ + "SELECT o_orderkey, rule_name, failed_column, CASE WHEN failed_column = 'o_totalprice' THEN 'number' ELSE failed_value END AS failed_value, severity FROM h")
def dq_failures_explode(spark: SparkSession, sf: str) -> DataFrame:
    f = _evaluated(spark, sf).select("o_orderkey", F.explode("dq_failures").alias("f"))
    value = F.when(F.col("f.failed_column") == "o_totalprice", "number").otherwise(F.col("f.failed_value"))
    return f.select("o_orderkey", "f.rule_name", "f.failed_column", value.alias("failed_value"), "f.severity")


@query(_DQ + "SELECT o_orderkey, CASE WHEN f1 OR f2 OR f3 THEN 'ERROR' ELSE 'VALID' END AS validity, concat_ws(',', CASE WHEN f1 THEN 'status_not_null' END, CASE WHEN f2 THEN 'o_orderpriority_in_set' END, CASE WHEN f3 THEN 'o_totalprice_between' END) AS failed FROM g")
def dq_simple(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_names(_evaluated(spark, sf)).select("o_orderkey", "validity", F.array_join("failed_rules", ",").alias("failed"))


@query(_DQ + "SELECT count(*) AS total, count(*) FILTER (WHERE dq_status = 'PASS') AS passed, round(100.0 * count(*) FILTER (WHERE dq_status = 'PASS') / count(*), 2) AS pass_rate FROM g")
def dq_pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.metrics(_evaluated(spark, sf))


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quarantine(quality.split(_evaluated(spark, sf))[1], "run-1", AS_OF)


@query(_DQ + "SELECT o_orderkey, o_orderpriority, status, rule_name AS dq_rule_name, failed_column, severity, 'NEW' AS resolution_status, DATE '2024-02-01' AS quarantine_date, 'run-1' AS session_id FROM h")
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _quarantine(spark, sf).select("o_orderkey", "o_orderpriority", "status", "dq_rule_name", "failed_column", "severity", "resolution_status", "quarantine_date", "session_id")


@query(_DQ + "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, count(DISTINCT o_orderkey) AS n_distinct FROM h GROUP BY 1")
def quarantine_daily(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.by(_quarantine(spark, sf).withColumn("day", F.to_date("o_orderdate")), "day", distinct="o_orderkey")


@query(_DQ + "SELECT rule_name AS dq_rule_name, failed_column, severity, count(*) AS n FROM h GROUP BY ALL")
def quarantine_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.by(_quarantine(spark, sf), "dq_rule_name", "failed_column", "severity")


# --- derived attributes ------------------------------------------------------------------

_YEAR = "nullif(p_size, 7) AS years"


@query(f"SELECT p_partkey, CASE WHEN years IS NULL THEN 'Unknown' WHEN years < 18 THEN '0-17' WHEN years < 65 THEN '18-64' ELSE '65+' END AS band FROM (SELECT p_partkey, {_YEAR} FROM part)")
def age_band_3(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "part").select("p_partkey", expr.band(F.nullif("p_size", F.lit(7)), expr.BANDS_3).alias("band"))


@query("SELECT p_partkey, CASE WHEN years IS NULL THEN 'Unknown' WHEN years >= 90 THEN '90+' ELSE CAST(CAST(floor(years / 5) AS INTEGER) * 5 AS VARCHAR) || '-' || CAST(CAST(floor(years / 5) AS INTEGER) * 5 + 4 AS VARCHAR) END AS band FROM (SELECT p_partkey, nullif(p_size, 7) * 2 AS years FROM part)")
def age_band_19(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "part").select("p_partkey", expr.band(F.nullif("p_size", F.lit(7)) * 2, expr.BANDS_19).alias("band"))


@query("SELECT c_custkey, CASE WHEN c_nationkey IN (1, 2, 3, 5, 8, 13, 21) THEN c_nationkey ELSE 0 END AS race_concept_id, CASE WHEN c_nationkey IN (7, 14) THEN c_nationkey ELSE 7 END AS ethnicity_concept_id FROM customer")
def nhs_recode(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "customer").select("c_custkey", expr.recode("c_nationkey", (1, 2, 3, 5, 8, 13, 21), expr.UNKNOWN_RACE).alias("race_concept_id"), expr.recode("c_nationkey", (7, 14), expr.UNKNOWN_ETHNICITY).alias("ethnicity_concept_id"))


@query("SELECT c_custkey, c_custkey IS NOT NULL AND coalesce(g IN (8507, 8532), FALSE) AS compliant FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_nationkey < 10 THEN 8507 WHEN c_nationkey < 20 THEN 8532 ELSE 8551 END AS g FROM customer)")
def compliance_flag(spark: SparkSession, sf: str) -> DataFrame:
    g = F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_nationkey") < 10, 8507).when(F.col("c_nationkey") < 20, 8532).otherwise(8551)
    return scan(spark, sf, "customer").withColumn("g", g).select("c_custkey", expr.compliance_flag("c_custkey", "g").alias("compliant"))


@query("SELECT n_nationkey, n_name, CAST(NULL AS TIMESTAMP) AS created_timestamp, CAST(NULL AS TIMESTAMP) AS updated_timestamp, FALSE AS is_deleted FROM nation")
def add_audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    out = schema.add_columns(scan(spark, sf, "nation").drop("n_regionkey"), schema.audit_defaults())
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_timestamp", "updated_timestamp")})


# --- dimension -------------------------------------------------------------------------

DIM_FROM, CHANGE = dt.date(2024, 1, 1), dt.date(2024, 3, 1)
KEY, ATTRIBUTES = ["c_custkey"], ["c_nationkey", "c_mktsegment"]


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(*KEY, *ATTRIBUTES)
    return scd2.initial(c, DIM_FROM)


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, "ARREARS").when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return scan(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_nationkey", segment.alias("c_mktsegment"))


_SCD = """WITH dim AS (SELECT c_custkey, c_nationkey, c_mktsegment, DATE '2024-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, TRUE AS is_current FROM customer WHERE c_mktsegment <> 'BUILDING'),
src AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN 'ARREARS' WHEN c_acctbal > 9000 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
chg AS (SELECT src.*, dim.c_custkey IS NOT NULL AS known FROM src LEFT JOIN dim ON src.c_custkey = dim.c_custkey WHERE dim.c_custkey IS NULL OR src.c_nationkey IS DISTINCT FROM dim.c_nationkey OR src.c_mktsegment IS DISTINCT FROM dim.c_mktsegment),
res AS (SELECT * FROM dim WHERE c_custkey NOT IN (SELECT c_custkey FROM chg WHERE known) UNION ALL
 SELECT c_custkey, c_nationkey, c_mktsegment, effective_from, DATE '2024-03-01', FALSE FROM dim WHERE c_custkey IN (SELECT c_custkey FROM chg WHERE known) UNION ALL
 SELECT c_custkey, c_nationkey, c_mktsegment, DATE '2024-03-01', DATE '9999-12-31', TRUE FROM chg) """


@query("SELECT c_custkey, c_nationkey, c_mktsegment, DATE '2024-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, TRUE AS is_current FROM customer WHERE c_mktsegment <> 'BUILDING'")
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    return _dim(spark, sf)


@query(_SCD + "SELECT * FROM res")
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.apply(_dim(spark, sf), _changes(spark, sf), KEY, ATTRIBUTES, CHANGE, check=False)


@query(_SCD + "SELECT * FROM res")
def scd2_two_step(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.expire_then_insert(_dim(spark, sf), _changes(spark, sf), KEY, ATTRIBUTES, CHANGE)


_VERSIONS = """WITH v AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS effective_from, o_orderpriority AS attr, o_orderkey AS arrival FROM orders WHERE o_orderstatus <> 'P'),
late AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS effective_from, o_orderpriority AS attr, o_orderkey AS arrival FROM orders WHERE o_orderstatus = 'P'), """


def _history(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A dimension of order priorities by customer, and versions that arrive late."""
    o = scan(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("effective_from"), F.col("o_orderpriority").alias("attr"), F.col("o_orderkey").alias("arrival"), "o_orderstatus")
    early = dedup.latest(o.where("o_orderstatus <> 'P'").drop("o_orderstatus"), ["k", "effective_from"], ["arrival"])
    base = scd2.repair(early.select("k", "attr", "effective_from").withColumns({"effective_to": F.lit(expr.OPEN_END), "is_current": F.lit(True)}), ["k"])
    return base, o.where("o_orderstatus = 'P'").drop("o_orderstatus")


@query(_VERSIONS + """one AS (SELECT k, effective_from, attr FROM (SELECT *, row_number() OVER (PARTITION BY k, effective_from ORDER BY late DESC, arrival DESC) AS r FROM (SELECT *, 0 AS late FROM v UNION ALL SELECT *, 1 FROM late)) WHERE r = 1),
kept AS (SELECT * FROM (SELECT *, lag(attr) OVER (PARTITION BY k ORDER BY effective_from) AS p FROM one) WHERE attr IS DISTINCT FROM p)
SELECT k, attr, effective_from, coalesce(lead(effective_from) OVER (PARTITION BY k ORDER BY effective_from), DATE '9999-12-31') AS effective_to, lead(effective_from) OVER (PARTITION BY k ORDER BY effective_from) IS NULL AS is_current FROM kept""")
def scd2_backdated_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    base, late = _history(spark, sf)
    return scd2.rebuild(base, late, ["k"], ["attr"]).select("k", "attr", "effective_from", "effective_to", "is_current")


_BROKEN = """WITH b AS (SELECT c_custkey AS k, DATE '2024-01-01' AS effective_from, CASE WHEN c_acctbal < 0 THEN DATE '2024-02-01' WHEN c_acctbal > 9000 THEN DATE '2023-12-01' ELSE DATE '2024-03-01' END AS effective_to, c_acctbal > 8000 AS is_current FROM customer UNION ALL
 SELECT c_custkey, DATE '2024-03-01', DATE '9999-12-31', c_mktsegment <> 'BUILDING' FROM customer) """


def _broken(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension with gaps, overlaps, empty intervals and wrong flags."""
    d = lambda y, m, day: F.lit(dt.date(y, m, day))
    c = scan(spark, sf, "customer")
    first = c.select(F.col("c_custkey").alias("k"), d(2024, 1, 1).alias("effective_from"), F.when(F.col("c_acctbal") < 0, d(2024, 2, 1)).when(F.col("c_acctbal") > 9000, d(2023, 12, 1)).otherwise(d(2024, 3, 1)).alias("effective_to"), (F.col("c_acctbal") > 8000).alias("is_current"))
    return first.union(c.select("c_custkey", d(2024, 3, 1), F.lit(expr.OPEN_END), F.col("c_mktsegment") != "BUILDING"))


@query(_BROKEN + "SELECT k, count(*) AS n FROM b WHERE is_current GROUP BY k HAVING count(*) > 1")
def chk_multi_current(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.several_current(_broken(spark, sf), ["k"])


@query(_BROKEN + "SELECT * FROM (SELECT k, effective_from, effective_to, lead(effective_from) OVER (PARTITION BY k ORDER BY effective_from) AS next_from FROM b) WHERE next_from IS NOT NULL AND effective_to <> next_from")
def scd_gap_check(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.gaps(_broken(spark, sf), ["k"]).drop("is_current")


@query(_BROKEN + "SELECT * FROM b WHERE effective_from >= effective_to")
def chk_date_order(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.bad_order(_broken(spark, sf))


@query(_BROKEN + "SELECT * FROM b WHERE is_current <> (effective_to = DATE '9999-12-31')")
def chk_current_flag(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.bad_current(_broken(spark, sf))


@query(_BROKEN + "SELECT k, effective_from, coalesce(lead(effective_from) OVER w, DATE '9999-12-31') AS effective_to, lead(effective_from) OVER w IS NULL AS is_current FROM b WINDOW w AS (PARTITION BY k ORDER BY effective_from)")
def scd_repair(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.repair(_broken(spark, sf), ["k"])


_LATE = """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS effective, CAST(ts AS DATE) + CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 5 ELSE 400 END AS received FROM events) """


@query(_LATE + "SELECT event_id, CAST(received - effective AS INTEGER) AS days_late, CASE WHEN received - effective > 365 THEN 'rejected' WHEN received - effective > 1 THEN 'late' ELSE 'normal' END AS arrival FROM e")
def late_arrival_split(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    days = F.when(kind == "view", 0).when(kind == "click", 1).when(kind == "purchase", 5).otherwise(400)
    e = scan(spark, sf, "events").select("event_id", F.to_date("ts").alias("effective"), F.date_add(F.to_date("ts"), days).alias("received"))
    return scd2.with_arrival(e, "received", "effective").select("event_id", "days_late", "arrival")


# --- control and monitoring -------------------------------------------------------------


@query("SELECT t AS table_name, l AS layer, 'INITIALIZED' AS status, CAST(0 AS BIGINT) AS rows_processed, CAST(NULL AS TIMESTAMP) AS last_watermark FROM (VALUES ('orders'), ('events')) a(t), (VALUES ('bronze'), ('silver'), ('gold'), ('dim')) b(l)")
def control_init(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.initial_rows(spark, ["dbo.orders", "events"], AS_OF).select("table_name", "layer", "status", "rows_processed", "last_watermark")


_CONTROL = """WITH c AS (SELECT CAST(event_id AS VARCHAR) AS control_id, event_type AS table_name, CASE user_id % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' ELSE 'dim' END AS layer, ts AS last_run_time,
 CASE WHEN value > 90 THEN 'FAILED' WHEN value > 80 THEN 'RUNNING' ELSE 'SUCCESS' END AS status FROM events) """


def _control(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a control table that keeps every run."""
    layer = F.element_at(F.array(*map(F.lit, watermark.LAYERS)), (F.col("user_id") % 4 + 1).cast("int"))
    status = F.when(F.col("value") > 90, watermark.FAILED).when(F.col("value") > 80, watermark.RUNNING).otherwise(watermark.SUCCESS)
    return scan(spark, sf, "events").select(F.col("event_id").cast("string").alias("control_id"), F.col("event_type").alias("table_name"), layer.alias("layer"), F.col("ts").alias("last_run_time"), status.alias("status"))


@query(_CONTROL + "SELECT control_id, table_name, layer, last_run_time, status FROM (SELECT *, row_number() OVER (PARTITION BY table_name, layer ORDER BY last_run_time DESC, control_id DESC) AS r FROM c) WHERE r = 1")
def control_latest(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.latest_rows(_control(spark, sf))


@query(_CONTROL + "SELECT status, count(*) AS n, max(last_run_time) AS newest FROM c GROUP BY status")
def control_status(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.status_counts(_control(spark, sf))


@query("""SELECT * FROM (VALUES ('events', 'MISSING_COLUMN', 'no_such'), ('nothing', 'MISSING_TABLE', '')) a(source, finding, detail)
UNION ALL SELECT 'rare', 'SPARSE_WATERMARK', count(w) || ' of ' || count(*) FROM (SELECT CASE WHEN event_id % 50 = 0 THEN ts END AS w FROM events)
UNION ALL SELECT 'null', 'NO_WATERMARK', 'w' UNION ALL SELECT 'none', 'EMPTY', 'ts'""")
def preflight_findings(spark: SparkSession, sf: str) -> DataFrame:
    e = scan(spark, sf, "events")
    sources = {
        "events": (e, "no_such"),
        "nothing": (None, "ts"),
        "rare": (e.select(F.when(F.col("event_id") % 50 == 0, F.col("ts")).alias("w")), "w"),
        "null": (e.select(F.lit(None).cast("timestamp").alias("w")), "w"),
        "none": (e.where("event_id IS NULL"), "ts"),
        "whole": (e, "ts"),
    }
    return spark.createDataFrame([(name, *x) for name, source in sources.items() for x in watermark.preflight(*source)], "source string, finding string, detail string")


@query("SELECT count(*) AS total, count(w) AS non_null, min(w) AS least, max(w) AS greatest, count(w) < 0.1 * count(*) AS sparse FROM (SELECT CASE WHEN event_type = 'purchase' THEN ts END AS w FROM events)")
def profile_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.profile(scan(spark, sf, "events").select(F.when(F.col("event_type") == "purchase", F.col("ts")).alias("w")), "w")


@query("SELECT count(*) AS total, count(*) AS with_pipeline_run_id, count(CASE WHEN event_id % 7 > 0 THEN 1 END) AS with_lineage_source, count(*) AS with_lineage_bronze_ts FROM events")
def lineage_completeness(spark: SparkSession, sf: str) -> DataFrame:
    rows = scan(spark, sf, "events").select("event_id", "ts").withColumns(expr.bronze_lineage("run-1", "events", "p", "test", AS_OF))
    rows = rows.withColumn("lineage_source", F.when(F.col("event_id") % 7 > 0, F.col("lineage_source")))  # rows of a loader that names no source
    return monitor.lineage_completeness(rows, ["pipeline_run_id", "lineage_source", "lineage_bronze_ts"])


@query("""WITH n AS (SELECT count(*) AS total, count(*) - count(nullif(o_orderstatus, 'P')) AS status, count(*) - count(nullif(o_orderpriority, '5-LOW')) AS priority, count(*) - count(o_totalprice) AS price FROM orders),
u AS (SELECT 'status' AS column_name, status AS nulls, total FROM n UNION ALL SELECT 'priority', priority, total FROM n UNION ALL SELECT 'price', price, total FROM n), p AS (SELECT *, round(100.0 * nulls / total, 2) AS pct FROM u)
SELECT column_name, nulls, total, pct, CASE WHEN pct = 0 THEN 'NONE' WHEN pct < 5 THEN 'LOW' WHEN pct < 20 THEN 'MEDIUM' ELSE 'HIGH' END AS risk FROM p""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), F.col("o_totalprice").alias("price"))
    return monitor.null_profile(o, ["status", "priority", "price"])


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, round(count(*) / count(DISTINCT l_orderkey), 4) AS rows_per_key FROM lineitem")
def key_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.key_ratio(scan(spark, sf, "lineitem"), "l_orderkey")


_RUNS = """WITH r AS (SELECT CAST(ts AS DATE) AS day, user_id, value, CASE WHEN event_type = 'purchase' THEN 'FAILED' ELSE 'SUCCESS' END AS status, ts FROM events) """


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as pipeline runs: a purchase is a failure, the value is the duration."""
    return scan(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id", "value", "ts", F.when(F.col("event_type") == "purchase", "FAILED").otherwise("SUCCESS").alias("status"))


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of the audit table."""
    runs = _runs(spark, sf).select(F.col("ts").cast("timestamp_ntz").alias("timestamp"), "status", F.col("value").alias("duration_seconds"), F.lit("RUN").alias("event_type"))
    return align(runs, empty(spark, audit.AUDIT).schema)


@query(_RUNS + "SELECT day, count(*) AS runs, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, CAST(100.0 * count(*) FILTER (WHERE status = 'SUCCESS') / count(*) AS DECIMAL(5,2)) AS success_rate, round(avg(value), 4) AS avg_duration FROM r GROUP BY day")
def audit_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.run_kpis(_audit(spark, sf).where("event_type = 'RUN'").withColumn("day", F.to_date("timestamp")), "status", "duration_seconds", "day")


@query(_RUNS + "SELECT user_id, round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts)))) / 3600.0, 2) AS hours_old, round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts)))) / 3600.0, 2) > 24 AS stalled FROM r GROUP BY user_id")
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.freshness(_runs(spark, sf), "ts", AS_OF, "user_id")


@query(_RUNS + """, k AS (SELECT day, 100.0 * count(*) FILTER (WHERE status = 'SUCCESS') / count(*) AS rate, avg(value) / 10 AS minutes FROM r GROUP BY day)
SELECT day, CASE WHEN rate >= 95 THEN 'GREEN' WHEN rate >= 90 THEN 'AMBER' ELSE 'RED' END AS dq, CASE WHEN minutes <= 5 THEN 'GREEN' WHEN minutes <= 10 THEN 'AMBER' ELSE 'RED' END AS duration FROM k""")
def sla_status(spark: SparkSession, sf: str) -> DataFrame:
    k = _runs(spark, sf).groupBy("day").agg((100.0 * F.count_if(F.col("status") == "SUCCESS") / F.count("*")).alias("rate"), (F.avg("value") / 10).alias("minutes"))
    return k.select("day", monitor.sla_status(F.col("rate"), "dq_pass").alias("dq"), monitor.sla_status(F.col("minutes"), "duration_min").alias("duration"))


@query(_RUNS + """, d AS (SELECT day, 100.0 * count(*) FILTER (WHERE status = 'FAILED') / count(*) AS pct, max(value) AS longest, avg(value) AS average, CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM r GROUP BY day)
SELECT day, pct > 15 AS alert_quarantine, longest > 2 * average AS alert_slow, status = 'FAILED' AS alert_failed FROM d""")
def alert_flags(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAILED")
    d = _runs(spark, sf).groupBy("day").agg((100.0 * failed / F.count("*")).alias("pct"), F.max("value").alias("longest"), F.avg("value").alias("average"), F.when(failed > 0, "FAILED").otherwise("SUCCESS").alias("run_status"))
    return monitor.alerts(d, "pct", "longest", "average", "run_status").select("day", "alert_quarantine", "alert_slow", "alert_failed")


@query(_DQ + "SELECT failed_column, severity, count(*) AS n, count(DISTINCT o_orderkey) AS n_distinct FROM h GROUP BY ALL")
def quarantine_by_column(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.by(_quarantine(spark, sf), "failed_column", "severity", distinct="o_orderkey")


@query(_DQ + "SELECT rule_name AS dq_rule_name, count(*) AS n FROM h GROUP BY rule_name ORDER BY n DESC, rule_name LIMIT 2")
def topk_failing(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.topk(_quarantine(spark, sf), 2, "dq_rule_name")


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    """The quarantine after the rows of one order were fixed."""
    q = _quarantine(spark, sf)
    ids = [r[0] for r in q.where("o_orderkey <= 20").select("quarantine_id").collect()]
    return quality.resolve(q, ids, "FIXED", "someone", "mended at the source", AS_OF)


@query(_DQ + "SELECT o_orderkey, rule_name AS dq_rule_name, CASE WHEN o_orderkey <= 20 THEN 'FIXED' ELSE 'NEW' END AS resolution_status, CASE WHEN o_orderkey <= 20 THEN 'someone' END AS resolved_by FROM h")
def quarantine_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select("o_orderkey", "dq_rule_name", "resolution_status", "resolved_by")


@query(_DQ + "SELECT CASE WHEN o_orderkey <= 20 THEN 'FIXED' ELSE 'NEW' END AS resolution_status, count(*) AS n FROM h GROUP BY 1")
def quarantine_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.by(_resolved(spark, sf), "resolution_status")


_SLA_LEVELS = {"availability": "CASE WHEN v >= 99.5 THEN 'GREEN' WHEN v >= 99.0 THEN 'AMBER' ELSE 'RED' END", "duration_min": "CASE WHEN v <= 5 THEN 'GREEN' WHEN v <= 10 THEN 'AMBER' ELSE 'RED' END", "dq_pass": "CASE WHEN v >= 95 THEN 'GREEN' WHEN v >= 90 THEN 'AMBER' ELSE 'RED' END", "freshness_h": "CASE WHEN v <= 2 THEN 'GREEN' WHEN v <= 4 THEN 'AMBER' ELSE 'RED' END"}


@query("SELECT event_id, " + ", ".join(f"{sql} AS {level}" for level, sql in _SLA_LEVELS.items()) + " FROM (SELECT event_id, value AS v FROM events)")
def sla_levels(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").select("event_id", *[monitor.sla_status(F.col("value"), level).alias(level) for level in monitor.SLA])


@query(_DQ + "SELECT * FROM (SELECT 0 AS step, 'bronze' AS layer, count(*) AS n FROM g WHERE o_orderkey = 7 UNION ALL SELECT 1, 'silver', count(*) FROM g WHERE o_orderkey = 7 AND dq_status = 'PASS' UNION ALL SELECT 2, 'quarantine', count(*) FROM h WHERE o_orderkey = 7)")
def key_trace(spark: SparkSession, sf: str) -> DataFrame:
    e = _evaluated(spark, sf)
    good, _ = quality.split(e)
    return monitor.trace({"bronze": e, "silver": good, "quarantine": _quarantine(spark, sf)}, "o_orderkey", 7)


# --- cleaning, merging some columns, learned draws ------------------------------------------


@query("""WITH p AS (SELECT c_custkey, c_custkey % 9 AS g, c_custkey % 6 AS r, c_custkey % 11 AS e, 1930 + c_custkey % 90 AS y, 1 + c_custkey % 13 AS m, 1 + c_custkey % 31 AS d FROM customer),
b AS (SELECT *, TRY_CAST(y || '-' || m || '-' || d AS DATE) AS birth_date FROM p), a AS (SELECT *, CAST(date_sub('year', birth_date, DATE '2026-01-01') AS INTEGER) AS age_years FROM b)
SELECT c_custkey, CASE WHEN g IN (1, 2) THEN g ELSE 8551 END AS gender_code, CASE WHEN r IN (1, 2, 3) THEN r ELSE 0 END AS race_code, CASE WHEN e IN (1, 2, 3, 4) THEN e ELSE 7 END AS ethnicity_code, birth_date, age_years,
 CASE WHEN age_years IS NULL THEN 'Unknown' WHEN age_years >= 90 THEN '90+' ELSE CAST(age_years // 5 * 5 AS VARCHAR) || '-' || CAST(age_years // 5 * 5 + 4 AS VARCHAR) END AS age_band, 'v4' AS rules_version FROM a""")
def clean_people(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    p = scan(spark, sf, "customer").select("c_custkey", (k % 9).alias("g"), (k % 6).alias("r"), (k % 11).alias("e"), (F.lit(1930) + k % 90).alias("y"), (F.lit(1) + k % 13).alias("m"), (F.lit(1) + k % 31).alias("d"))
    out = expr.cleaned("g", "r", "e", "y", "m", "d", dt.date(2026, 1, 1), (1, 2), (1, 2, 3), (1, 2, 3, 4), "v4")
    return p.withColumns(out).select("c_custkey", *out)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer UNION ALL SELECT -1 - c_custkey, 'X', 99 FROM customer WHERE c_custkey % 3 = 0")
def merge_columns(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    third = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("X").alias("c_mktsegment"), F.lit(99).cast(c.schema["c_nationkey"].dataType).alias("c_nationkey"))
    new = third.withColumn("c_custkey", (-1 - F.col("c_custkey")).cast(c.schema["c_custkey"].dataType))
    return merge.upsert(c, third.unionByName(new), ["c_custkey"], ["c_mktsegment"])


@query("""WITH n AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment), w AS (SELECT c_mktsegment, sum(n) OVER (ORDER BY c_mktsegment) / sum(n) OVER () AS upto, row_number() OVER (ORDER BY c_mktsegment DESC) AS last FROM n),
u AS (SELECT o_orderkey, (o_orderkey * 7919 % 10007) / 10007.0 AS u FROM orders)
SELECT o_orderkey, (SELECT min(c_mktsegment) FROM w WHERE upto > u OR last = 1) AS segment FROM u""")
def learned_draw(spark: SparkSession, sf: str) -> DataFrame:
    learned = datagen.weights(scan(spark, sf, "customer"), "c_mktsegment")
    u = F.col("o_orderkey") * 7919 % 10007 / 10007.0
    return scan(spark, sf, "orders").select("o_orderkey", datagen.drawn(u, learned, "c_mktsegment").alias("segment"))


@query("""WITH v AS (SELECT c_custkey AS k, c_mktsegment AS attr, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-06-01' ELSE DATE '2023-01-01' END AS f FROM customer), s AS (SELECT k, 'NEW' AS attr FROM v WHERE k % 3 = 0)
SELECT k, attr, f AS effective_from, CASE WHEN k % 3 = 0 AND k % 2 = 1 THEN DATE '2024-01-01' ELSE DATE '9999-12-31' END AS effective_to, NOT (k % 3 = 0 AND k % 2 = 1) AS is_current FROM v
UNION ALL SELECT k, 'NEW', DATE '2024-01-01', CASE WHEN k % 2 = 0 THEN DATE '2024-06-01' ELSE DATE '9999-12-31' END, k % 2 = 1 FROM v WHERE k % 3 = 0""")
def scd2_apply_anytime(spark: SparkSession, sf: str) -> DataFrame:
    rows = scan(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("attr"))
    dim = scd2.initial(rows.withColumn("f", F.when(F.col("k") % 2 == 0, F.lit(dt.date(2024, 6, 1))).otherwise(F.lit(dt.date(2023, 1, 1)))), F.col("f")).drop("f")
    return scd2.apply_anytime(dim, rows.where("k % 3 = 0").withColumn("attr", F.lit("NEW")), ["k"], ["attr"], dt.date(2024, 1, 1))


# --- the flagship: dedup, quality, aggregate ------------------------------------------------


@query("""WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS r FROM lineitem) WHERE r = 1),
q AS (SELECT *, CASE WHEN NOT (l_quantity BETWEEN 1 AND 45) OR l_returnflag NOT IN ('A', 'N', 'R') THEN 'FAIL' WHEN NOT (l_extendedprice BETWEEN 0 AND 90000) THEN 'WARNING' ELSE 'PASS' END AS s FROM d)
SELECT l_returnflag, count(*) FILTER (WHERE s = 'PASS') AS passed, count(*) FILTER (WHERE s <> 'PASS') AS quarantined, round(sum(CASE WHEN s = 'PASS' THEN l_quantity ELSE 0 END), 2) AS quantity FROM q GROUP BY l_returnflag""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    lines = dedup.latest(scan(spark, sf, "lineitem").select(columns), columns[:2], columns[2:7])
    rules = [quality.between("l_quantity", 1, 45), quality.in_set("l_returnflag", ("A", "N", "R")), quality.between("l_extendedprice", 0, 90000, quality.WARNING)]
    q = quality.evaluate(lines, rules)
    good = F.col("dq_status") == "PASS"
    return q.groupBy("l_returnflag").agg(F.count_if(good).alias("passed"), F.count_if(~good).alias("quarantined"), F.round(F.sum(F.when(good, F.col("l_quantity")).otherwise(0)), 2).alias("quantity"))
