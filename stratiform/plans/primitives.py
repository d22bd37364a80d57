"""Queries of the single operators: scans, projections, filters, joins, aggregates, windows, sorts, sets, functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stratiform.functions import expr
from stratiform.operators import dedup, merge, monitor
from stratiform.plans.registry import query
from stratiform.sources import tables
from stratiform.sources.tables import scan

WATERMARK = dt.datetime(2024, 1, 15)
AS_OF = dt.date(2026, 1, 1)

# --- scans ---------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_full(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT count(*) AS n, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key FROM orders")
def scan_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT count(*) AS n, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key FROM {orders}", orders=scan(spark, sf, "orders"))


@query("SELECT event_id, user_id, event_type, ts FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.incremental(scan(spark, sf, "events"), "ts", WATERMARK).select("event_id", "user_id", "event_type", "ts")


@query("SELECT event_id, user_id FROM (SELECT *, CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS changed FROM events) WHERE coalesce(changed, ts) > TIMESTAMP '2024-01-15'")
def incremental_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    events = scan(spark, sf, "events").withColumn("changed", F.when(F.col("event_type") != "view", F.col("ts")))
    return tables.incremental(events, "changed", WATERMARK, fallback="ts").select("event_id", "user_id")


@query("SELECT range AS id, (range * 7 + 3) % 11 AS code FROM range(100000)")
def range_source(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(100_000).select("id", ((F.col("id") * 7 + 3) % 11).alias("code"))


_NEW_CUSTOMERS = """SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN 'ARREARS' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'"""
_OLD_CUSTOMERS = """SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'"""


def _old(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_nationkey", "c_mktsegment")


def _new(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, "ARREARS").otherwise(F.col("c_mktsegment"))
    return scan(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_nationkey", segment.alias("c_mktsegment"))


@query(f"""WITH o AS ({_OLD_CUSTOMERS}), n AS ({_NEW_CUSTOMERS})
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS change_type
FROM o FULL JOIN n ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_nationkey IS DISTINCT FROM n.c_nationkey OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment""")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return merge.snapshot_diff(_old(spark, sf), _new(spark, sf), ["c_custkey"], ["c_nationkey", "c_mktsegment"])


# --- merge ---------------------------------------------------------------------


@query(f"""WITH t AS ({_OLD_CUSTOMERS}), s AS ({_NEW_CUSTOMERS})
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert(_old(spark, sf), _new(spark, sf), ["c_custkey"])


@query(f"""WITH t AS ({_OLD_CUSTOMERS}), s AS ({_NEW_CUSTOMERS})
SELECT * FROM t UNION ALL SELECT * FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM t)""")
def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge.insert_only(_old(spark, sf), _new(spark, sf), ["c_custkey"])


@query(f"""WITH t AS ({_OLD_CUSTOMERS}), s AS ({_NEW_CUSTOMERS})
SELECT t.c_custkey, CASE WHEN s.c_custkey IS NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey, CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM t LEFT JOIN s ON t.c_custkey = s.c_custkey""")
def merge_update_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge.update_only(_old(spark, sf), _new(spark, sf), ["c_custkey"])


@query(f"""WITH t AS ({_OLD_CUSTOMERS}), s AS ({_NEW_CUSTOMERS})
SELECT t.c_custkey, t.c_nationkey, CASE WHEN s.c_mktsegment IS DISTINCT FROM t.c_mktsegment AND s.c_custkey IS NOT NULL THEN 'EXPIRED' ELSE t.c_mktsegment END AS c_mktsegment
FROM t LEFT JOIN s ON t.c_custkey = s.c_custkey""")
def merge_conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    changed = ~F.col("t.c_mktsegment").eqNullSafe(F.col("s.c_mktsegment"))
    return merge.conditional_update(_old(spark, sf), _new(spark, sf), ["c_custkey"], changed, {"c_mktsegment": F.lit("EXPIRED")})


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'LARGE' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    return merge.update_where(scan(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), F.col("o_totalprice") > 200000, {"o_orderpriority": F.lit("LARGE")}).select("o_orderkey", "o_orderpriority")


# --- projections and filters -----------------------------------------------------


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_totalprice AS BIGINT) AS price, CAST(o_orderdate AS DATE) AS day FROM (SELECT *, trunc(o_totalprice) AS p FROM orders) WHERE p = p".replace("CAST(o_totalprice AS BIGINT)", "CAST(p AS BIGINT)"))
def project_cast(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").cast("long").alias("price"), F.col("o_orderdate").cast("date").alias("day"))


@query("SELECT s_suppkey, s_name AS supplier_name, s_nationkey FROM supplier")
def project_drop(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "supplier").drop("s_acctbal").withColumnRenamed("s_name", "supplier_name")


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS DOUBLE) AS p_weight, p_brand FROM part")
def schema_align(spark: SparkSession, sf: str) -> DataFrame:
    target = StructType([StructField("p_partkey", StringType()), StructField("p_size", LongType()), StructField("p_weight", DoubleType()), StructField("p_brand", StringType())])
    return tables.align(scan(spark, sf, "part"), target)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('F') AND l_orderkey >= 100")
def filter_predicates(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return scan(spark, sf, "lineitem").where(c("l_quantity").between(10, 20) & c("l_returnflag").isin("A", "R") & ~c("l_linestatus").isin("F") & (c("l_orderkey") >= 100)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, s FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s FROM orders) WHERE s IN ('F') OR s IS NULL")
def filter_3vl(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return o.where(F.col("s").isin("F") | F.col("s").isNull())


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000")
def filter_sql_expr(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "customer").where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000").select("c_custkey", "c_mktsegment")


@query("SELECT p_partkey, p_name LIKE '%a%' AS has_a, regexp_matches(p_brand, '^Brand#[1-3]') AS low_brand, contains(p_type, 'STEEL') AS steel FROM part WHERE p_type LIKE '%E%'")
def filter_patterns(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return scan(spark, sf, "part").where(c("p_type").like("%E%")).select("p_partkey", c("p_name").like("%a%").alias("has_a"), c("p_brand").rlike("^Brand#[1-3]").alias("low_brand"), c("p_type").contains("STEEL").alias("steel"))


# --- joins -------------------------------------------------------------------------


@query(f"""WITH o AS ({_OLD_CUSTOMERS}), n AS ({_NEW_CUSTOMERS}) SELECT n.c_custkey, o.c_mktsegment AS old_segment, n.c_mktsegment AS new_segment FROM n JOIN o ON n.c_custkey = o.c_custkey WHERE n.c_mktsegment <> o.c_mktsegment""")
def join_inner_changed(spark: SparkSession, sf: str) -> DataFrame:
    o, n = _old(spark, sf).alias("o"), _new(spark, sf).alias("n")
    return n.join(o, F.col("n.c_custkey") == F.col("o.c_custkey")).where("n.c_mktsegment <> o.c_mktsegment").select("n.c_custkey", F.col("o.c_mktsegment").alias("old_segment"), F.col("n.c_mktsegment").alias("new_segment"))


@query(f"""WITH o AS ({_OLD_CUSTOMERS}), n AS ({_NEW_CUSTOMERS}) SELECT n.c_custkey, n.c_mktsegment FROM n LEFT JOIN o ON n.c_custkey = o.c_custkey WHERE o.c_custkey IS NULL OR n.c_mktsegment IS DISTINCT FROM o.c_mktsegment""")
def join_left_new_or_changed(spark: SparkSession, sf: str) -> DataFrame:
    o, n = _old(spark, sf).alias("o"), _new(spark, sf).alias("n")
    return n.join(o, F.col("n.c_custkey") == F.col("o.c_custkey"), "left").where(F.expr("o.c_custkey IS NULL OR NOT (n.c_mktsegment <=> o.c_mktsegment)")).select("n.c_custkey", "n.c_mktsegment")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def join_left_anti(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return scan(spark, sf, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
def join_left_semi(spark: SparkSession, sf: str) -> DataFrame:
    o = scan(spark, sf, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return scan(spark, sf, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def join_broadcast_lookup(spark: SparkSession, sf: str) -> DataFrame:
    # nation has 25 rows at every scale
    n = scan(spark, sf, "nation")
    return scan(spark, sf, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "s_name", "n_name")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 0")
def join_broadcast_residual(spark: SparkSession, sf: str) -> DataFrame:
    n = scan(spark, sf, "nation")
    return scan(spark, sf, "customer").join(F.broadcast(n), (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("c_acctbal") > 0), "left").select("c_custkey", "n_name")


@query("""WITH big AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000), t AS (SELECT 'orders' AS layer, count(*) AS n FROM big UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM big) UNION ALL SELECT 'customers', count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM big)) SELECT layer, n FROM t""")
def cte_layer_trace(spark: SparkSession, sf: str) -> DataFrame:
    big = scan(spark, sf, "orders").where("o_totalprice > 100000")
    lines = scan(spark, sf, "lineitem").join(big.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    customers = scan(spark, sf, "customer").join(big.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    return tables.union_positional([d.agg(F.count("*").alias("n")).select(F.lit(k).alias("layer"), "n") for k, d in (("orders", big), ("lines", lines), ("customers", customers))])


@query("SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM lineitem) AS n_lines, (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM lineitem) >= (SELECT count(*) FROM orders) AS plausible")
def scalar_subqueries(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: scan(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    return spark.sql("SELECT (SELECT count(*) FROM {orders}) AS n_orders, (SELECT count(*) FROM {lineitem}) AS n_lines, (SELECT count(*) FROM {customer}) AS n_customers, (SELECT count(*) FROM {lineitem}) >= (SELECT count(*) FROM {orders}) AS plausible", **t)


# --- aggregates ----------------------------------------------------------------------


@query("SELECT count(*) AS n FROM lineitem")
def agg_global(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS total, count(nullif(event_type, 'view')) AS with_type, count(props) AS with_props FROM events")
def agg_count_nonnull(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").agg(F.count("*").alias("total"), F.count(F.nullif("event_type", F.lit("view"))).alias("with_type"), F.count("props").alias("with_props"))


@query("SELECT CAST(sum(CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END) AS BIGINT) AS large, count(*) FILTER (WHERE l_returnflag = 'R') AS returned FROM lineitem")
def agg_conditional(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").agg(F.sum(F.when(F.col("l_quantity") > 30, 1).otherwise(0)).alias("large"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))


@query("SELECT event_type, max(ts) AS high_water, min(ts) AS low_water FROM events GROUP BY event_type")
def watermark_max(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("high_water"), F.min("ts").alias("low_water"))


@query("SELECT l_returnflag, round(avg(l_quantity), 4) AS avg_quantity, round(stddev_samp(l_quantity), 4) AS sd_quantity FROM lineitem GROUP BY l_returnflag")
def agg_stats(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 4).alias("avg_quantity"), F.round(F.stddev_samp("l_quantity"), 4).alias("sd_quantity"))


@query("SELECT o_orderstatus, quantile_disc(o_totalprice, 0.5) AS median_price FROM orders GROUP BY o_orderstatus")
def agg_median_approx(spark: SparkSession, sf: str) -> DataFrame:
    # a mergeable summary a group; its error is 1 / 1,000,000 of the rows, so it is exact up to a million
    return scan(spark, sf, "orders").groupBy("o_orderstatus").agg(F.percentile_approx("o_totalprice", 0.5, 1_000_000).alias("median_price"))


@query("SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 4) AS median_price FROM orders GROUP BY o_orderstatus")
def agg_median(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "orders").groupBy("o_orderstatus").agg(F.round(F.percentile("o_totalprice", 0.5), 4).alias("median_price"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_group(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def having_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicates(scan(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT c_mktsegment, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 4) AS pct FROM customer GROUP BY c_mktsegment")
def weighted_distribution(spark: SparkSession, sf: str) -> DataFrame:
    counted = scan(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    # the window is over one row a segment
    return counted.select("c_mktsegment", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("pct"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_daily_trend(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


# --- windows, sorts, sets ---------------------------------------------------------------


@query("SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM events) WHERE r = 1")
def dedup_latest_1key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest(scan(spark, sf, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts"], ["event_id"])


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS r FROM orders) WHERE r = 1")
def dedup_latest_3key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest(scan(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_totalprice", "o_orderkey"])


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL ORDER BY o_orderpriority DESC, o_orderstatus")
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")).orderBy(F.col("o_orderpriority").desc(), "o_orderstatus")


@query("SELECT p_brand, count(*) AS n FROM part WHERE p_size > 40 GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def topk_brands(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.topk(scan(spark, sf, "part").where("p_size > 40"), 10, "p_brand")


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part")
def union_positional(spark: SparkSession, sf: str) -> DataFrame:
    return tables.union_positional([scan(spark, sf, t).select(F.col(k).alias("k"), F.col(n).alias("name")) for t, k, n in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))])


@query("SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return tables.union_by_name([c, scan(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


# --- functions -------------------------------------------------------------------------


@query("SELECT c_custkey, concat(c_name, '!') AS loud, concat_ws('|', c_name, NULL, c_mktsegment) AS joined, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded, upper(c_mktsegment) AS upper_segment FROM customer")
def fn_string(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit("!")).alias("loud"), F.concat_ws("|", "c_name", F.lit(None).cast("string"), "c_mktsegment").alias("joined"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"), F.upper("c_mktsegment").alias("upper_segment"))


@query("SELECT c_custkey, sha256(concat_ws('||', length(a) || ':' || a, length(b) || ':' || b)) AS row_hash FROM (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS a, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS b FROM customer)")
def fn_row_hash(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return c.select("c_custkey", expr.row_hash(["c_nationkey", "c_mktsegment"]).alias("row_hash"))


@query("SELECT c_custkey, sha256(concat_ws('||', CAST(c_nationkey AS VARCHAR), coalesce(nullif(c_mktsegment, 'BUILDING'), ''))) AS row_hash FROM customer")
def fn_plain_hash(spark: SparkSession, sf: str) -> DataFrame:
    c = scan(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return c.select("c_custkey", expr.plain_hash(["c_nationkey", "c_mktsegment"]).alias("row_hash"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_old, CAST(o_orderdate AS DATE) - 30 AS month_before, DATE '9999-12-31' AS open_end FROM orders")
def fn_date(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    return scan(spark, sf, "orders").select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.datediff(F.lit(dt.date(2002, 1, 1)), d).alias("days_old"), F.date_sub(d.cast("date"), 30).alias("month_before"), F.lit(expr.OPEN_END).alias("open_end"))


@query("SELECT o_orderkey, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2026-01-01') AS INTEGER) AS age_years FROM orders")
def age_exact(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "orders").select("o_orderkey", expr.completed_years(F.col("o_orderdate").cast("date"), AS_OF).alias("age_years"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, TRY_CAST('2023-' || CAST(CAST(l_linenumber + 8 AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS DATE) AS d FROM lineitem")
def fn_try_date(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", expr.safe_date(F.lit(2023), F.col("l_linenumber") + 8, F.col("l_quantity").cast("int")).alias("d"))


@query("SELECT o_orderkey, try_strptime(t, '%d/%m/%Y %H:%M:%S') AS at FROM (SELECT o_orderkey, lpad(CAST(o_orderkey % 40 AS VARCHAR), 2, '0') || '/' || lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') || '/2024 10:20:30' AS t FROM orders)")
def fn_try_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    two = lambda n: F.lpad((F.col("o_orderkey") % n).cast("string"), 2, "0")
    text = F.concat(two(40), F.lit("/"), two(14), F.lit("/2024 10:20:30"))
    return scan(spark, sf, "orders").select("o_orderkey", expr.safe_timestamp(text, "dd/MM/yyyy HH:mm:ss").cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, make_timestamp((1700000000 + event_id * 60) * 1000000) AS at FROM events")
def fn_epoch(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").select("event_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id") * 60).cast("timestamp_ntz").alias("at"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity / 7) AS BIGINT) AS weeks, round(l_extendedprice * (1 + l_tax), 4) AS gross, CAST(trunc(l_extendedprice) AS BIGINT) AS whole FROM lineitem")
def fn_math(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return scan(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.floor(c("l_quantity") / 7).alias("weeks"), F.round(c("l_extendedprice") * (1 + c("l_tax")), 4).alias("gross"), c("l_extendedprice").cast("long").alias("whole"))


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'unknown') AS status, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 150000 THEN 'medium' ELSE 'large' END AS size, CAST(NULL AS INTEGER) AS nothing FROM orders")
def fn_conditional(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("o_totalprice")
    return scan(spark, sf, "orders").select("o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("unknown")).alias("status"), F.when(p < 50000, "small").when(p < 150000, "medium").otherwise("large").alias("size"), F.lit(None).cast(IntegerType()).alias("nothing"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def fn_json(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("SELECT s_suppkey, CASE WHEN s_name IS NULL OR s_name = '' THEN NULL ELSE sha256(concat(s_name, 'pepper')) END AS pseudonym FROM supplier")
def pseudonymize(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, sf, "supplier").select("s_suppkey", expr.pseudonymize("s_name", "pepper").alias("pseudonym"))
