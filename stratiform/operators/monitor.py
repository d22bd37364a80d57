"""Monitoring queries over tables, quarantine and audit rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (good from, tolerable from) of each service level, in percent, minutes or hours.
SLA = {"availability": (99.5, 99.0), "duration_min": (5.0, 10.0), "dq_pass": (95.0, 90.0), "freshness_h": (2.0, 4.0)}
MOST_QUARANTINED, SLOW_TIMES, STALLED_HOURS = 15.0, 2.0, 24.0


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, percent and risk of each column: one aggregate, turned into rows."""
    one = df.agg(F.count("*").alias("total"), *[(F.count("*") - F.count(c)).alias(c) for c in columns])
    stacked = one.selectExpr("total", f"stack({len(columns)}, " + ", ".join(f"'{c}', `{c}`" for c in columns) + ") as (column_name, nulls)")
    share = F.when(F.col("total") > 0, F.round(100.0 * F.col("nulls") / F.col("total"), 2)).otherwise(F.lit(0.0))
    return stacked.select("column_name", "nulls", "total", share.alias("pct")).withColumn("risk", F.when(F.col("pct") == 0, "NONE").when(F.col("pct") < 5, "LOW").when(F.col("pct") < 20, "MEDIUM").otherwise("HIGH"))


def key_ratio(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.round(F.count("*") / F.countDistinct(key), 4).alias("rows_per_key"))


def by(df: DataFrame, *keys: str, distinct: str | None = None) -> DataFrame:
    """Rows (and distinct values) of each group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *([F.countDistinct(distinct).alias("n_distinct")] if distinct else []))


def run_kpis(audit: DataFrame, status: str, duration: str, *keys: str) -> DataFrame:
    """Success rate (DECIMAL(5,2)) and mean duration of runs."""
    good = F.sum(F.when(F.col(status) == "SUCCESS", 1).otherwise(0))
    return audit.groupBy(*keys).agg(F.count("*").alias("runs"), good.cast("long").alias("succeeded"), (100.0 * good / F.count("*")).cast("decimal(5,2)").alias("success_rate"), F.round(F.avg(duration), 4).alias("avg_duration"))


def freshness(df: DataFrame, column: str, as_of: dt.datetime, *keys: str) -> DataFrame:
    hours = F.round((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max(column).cast("timestamp"))) / 3600.0, 2)
    return df.groupBy(*keys).agg(hours.alias("hours_old")).withColumn("stalled", F.col("hours_old") > STALLED_HOURS)


def sla_status(value: Column, level: str, limits: Mapping[str, tuple[float, float]] = SLA) -> Column:
    """GREEN, AMBER or RED; durations and ages are good when small."""
    good, fair = limits[level]
    ok = (lambda x: value <= x) if good < fair else (lambda x: value >= x)
    return F.when(ok(good), "GREEN").when(ok(fair), "AMBER").otherwise("RED")


def alerts(runs: DataFrame, quarantined_pct: str, duration: str, average: str, status: str) -> DataFrame:
    return runs.withColumns({"alert_quarantine": F.col(quarantined_pct) > MOST_QUARANTINED, "alert_slow": F.col(duration) > SLOW_TIMES * F.col(average), "alert_failed": F.col(status) == "FAILED"})


def topk(df: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k groups with the most rows, ties in order of the keys."""
    return by(df, *keys).orderBy(F.col("n").desc(), *keys).limit(k)


def trace(layers: Mapping[str, DataFrame], key: str, value: object) -> DataFrame:
    """The rows of one key in each layer: how many, in the layers' order."""
    counts = [df.where(F.col(key) == F.lit(value)).agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("layer"), "n") for i, (name, df) in enumerate(layers.items())]
    return reduce(DataFrame.unionByName, counts)


def reconcile(before: int, added: int, after: int) -> bool:
    return before + added == after


def lineage_completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *[F.count(c).alias(f"with_{c}") for c in columns])
