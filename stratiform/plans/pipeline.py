"""The layer runner: Bronze, Silver (and quarantine), Gold, Dimension, for any table and key.

Every layer reads what is after its own high-water mark: the later of the control table's and the greatest watermark that
the layer's table holds, since an append is written as a whole. It writes once, and takes counts and the new mark from
what it wrote in one aggregate. Marks of all layers are committed by one write at the end; a failed run commits none, and
the next run, under whatever id, goes on where each layer's table ends: nothing is loaded twice, nothing is left out.

Changes that arrive more than ``late_after_days`` after their date are logged as late, those over ``max_backdate_days``
as rejected, before the dimension is written without the latter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions import expr
from stratiform.operators import dedup, quality, scd2
from stratiform.operators.watermark import Control, Mark
from stratiform.plans.audit import Recorder, late_rows
from stratiform.sources import tables


@dataclass(frozen=True)
class Config:
    """All that a run depends on."""

    table: str
    key: str
    watermark: str
    root: str
    rules: Sequence[quality.Rule]
    attributes: Sequence[str]
    derived: Mapping[str, Column] = field(default_factory=dict)
    salt: str = "salt_key"
    pseudonymize: str | None = None
    effective: str | None = None
    watermark_fallback: str | None = None
    quarantine_warnings: bool = True
    max_backdate_days: int = 365
    late_after_days: int = 1
    notify_late_rows: int = 30
    pipeline: str = "stratiform"
    environment: str = "test"

    def path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}_{self.table}"


@dataclass
class Outcome:
    rows: dict[str, int] = field(default_factory=dict)
    quarantined: int = 0
    pass_rate: float = 0.0
    late: dict[str, int] = field(default_factory=dict)


def bronze(df: DataFrame, config: Config, run_id: str, as_of: dt.datetime) -> DataFrame:
    return df.withColumns(expr.bronze_lineage(run_id, config.table, config.pipeline, config.environment, as_of))


def silver(df: DataFrame, config: Config, run_id: str, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine rows)."""
    stamped = df.withColumns({"lineage_session_id": F.lit(run_id), "silver_processed_ts": F.lit(as_of)})
    good, bad = quality.split(quality.evaluate(stamped, config.rules), config.quarantine_warnings)
    if config.pseudonymize:
        good = good.withColumn(f"{config.pseudonymize}_pseudo", expr.pseudonymize(config.pseudonymize, config.salt))
    return good, quality.quarantine(bad, run_id, as_of)


def gold(df: DataFrame, config: Config, run_id: str, as_of: dt.datetime) -> DataFrame:
    newest = dedup.latest(df, [config.key], ["silver_processed_ts", config.watermark])
    return newest.withColumns({**config.derived, f"{config.table}_key": expr.business_key(config.key, config.salt), "lineage_session_id": F.lit(run_id), "lineage_gold_ts": F.lit(as_of), "gold_processed_ts": F.lit(as_of)})


def changes(gold_rows: DataFrame, config: Config, as_of: dt.date) -> DataFrame:
    """The newest Gold row of each key with its start date, how late it is, and whether that is normal, late or rejected."""
    key = f"{config.table}_key"
    start = F.coalesce(F.col(config.effective), F.lit(as_of)) if config.effective else F.lit(as_of)
    source = dedup.latest(gold_rows, [key], ["gold_processed_ts", config.watermark]).select(key, config.key, *config.attributes, start.alias("_start"))
    return scd2.with_arrival(source, F.lit(as_of), "_start", config.late_after_days, config.max_backdate_days)


def dimension(dim: DataFrame | None, changed: DataFrame, config: Config, as_of: dt.date) -> DataFrame:
    """The dimension with all changes but the rejected ones, on time, late or between older versions, by one rebuild of the keys they touch.

    A table without rows yet takes every change, however old.
    """
    key = f"{config.table}_key"
    if dim is None:
        return scd2.initial(changed.drop("days_late", "arrival"), F.col("_start")).drop("_start")
    source = changed.where("arrival <> 'rejected'").drop("arrival")
    touched = source.select(key).distinct()
    names = [config.key, *config.attributes]
    late = source.select(key, *names, F.col("_start").alias(scd2.FROM), F.lit(as_of).alias("arrival"))
    rebuilt = scd2.rebuild(dim.join(touched, key, "left_semi"), late, [key], names)
    return dim.join(touched, key, "left_anti").unionByName(rebuilt.select(dim.columns))


def _measure(spark: SparkSession, path: str, watermark: str, run_column: str, run_id: str) -> tuple[int, object]:
    row = spark.read.parquet(path).where(F.col(run_column) == run_id).agg(F.count("*"), F.max(watermark)).first()
    return row[0], row[1]


def run(spark: SparkSession, source: DataFrame, config: Config, as_of: dt.datetime, run_id: str, recorder: Recorder | None = None) -> Outcome:
    """One incremental run."""
    recorder = recorder or Recorder(run_id, lambda: as_of)
    control, out, marks = Control(spark, f"{config.root.rstrip('/')}/etl_control"), Outcome(), {}
    control.init([config.table], as_of)
    layer = "bronze"

    def held(name: str) -> object:
        """The greatest watermark that a layer's table holds."""
        if not tables.exists(spark, config.path(name)):
            return None
        columns = [c for c in (config.watermark, config.watermark_fallback) if c]
        table = spark.read.schema(source.select(columns).schema).parquet(config.path(name))  # it may have no file yet
        return table.agg(F.max(F.coalesce(*columns))).first()[0]

    def since(df: DataFrame, mark: object) -> DataFrame:
        return tables.incremental(df, config.watermark, mark, config.watermark_fallback)

    def after(name: str, table: str | None = None) -> object:
        """The mark of a layer, for one of its tables."""
        return max((m for m in (control.get(config.table, name), held(table or name)) if m is not None), default=None)

    def step(name: str, rows: DataFrame, path: str, run_column: str) -> int:
        tables.append(rows, path)
        n, mark = _measure(spark, path, config.watermark, run_column, run_id)
        marks[name] = Mark(mark, n)
        out.rows[name] = n
        recorder.log("LAYER", f"{name} written", name, n)
        return n

    def log_late(changed: DataFrame, have: DataFrame) -> None:
        """Append the late and the rejected changes to the log, unless a run that failed later has logged them."""
        key, log = f"{config.table}_key", f"{config.root.rstrip('/')}/late_arrival_log"
        rows = late_rows(changed.where("arrival <> 'normal'"), have.where(scd2.CURRENT), config.key, key, config.attributes, as_of, run_id, config.pipeline)
        if tables.exists(spark, log):
            rows = rows.join(spark.read.parquet(log).select("late_arrival_id"), "late_arrival_id", "left_anti").select(rows.columns)
        tables.append(rows, log)
        out.late = {r["status"]: r["count"] for r in spark.read.parquet(log).where(F.col("session_id") == run_id).groupBy("status").count().collect()}
        if n := sum(out.late.values()):
            recorder.log("LATE", f"late changes: {out.late}", "dim", n, "WARNING" if n > config.notify_late_rows else "SUCCESS")

    try:
        path = config.path("bronze")
        step("bronze", bronze(since(source, after("bronze")), config, run_id, as_of), path, "pipeline_run_id")
        layer = "silver"
        good_mark, bad_mark = after("silver"), after("silver", "quarantine")
        waiting = spark.read.parquet(path)
        good, _ = silver(since(waiting, good_mark), config, run_id, as_of)
        _, bad = silver(since(waiting, bad_mark), config, run_id, as_of)
        tables.append(bad, config.path("quarantine"), ["quarantine_date"])
        taken = since(waiting, good_mark).count()
        step("silver", good, config.path("silver"), "lineage_session_id")
        out.quarantined = taken - out.rows["silver"]
        out.pass_rate = round(100.0 * out.rows["silver"] / taken, 2) if taken else 0.0
        marks["silver"] = Mark(marks["silver"].watermark, out.rows["silver"], out.quarantined)
        layer = "gold"
        made = gold(since(spark.read.parquet(config.path("silver")), after("gold")), config, run_id, as_of)
        step("gold", made, config.path("gold"), "lineage_session_id")
        layer = "dim"
        pending = since(spark.read.parquet(config.path("gold")), control.get(config.table, "dim"))
        if not pending.isEmpty():
            have = spark.read.parquet(config.path("dim")) if tables.exists(spark, config.path("dim")) else None
            have = None if have is None or have.isEmpty() else have
            changed = changes(pending, config, as_of.date())
            if have is not None:
                log_late(changed, have)
            out.rows["dim"] = tables.replace(dimension(have, changed, config, as_of.date()), config.path("dim"))
            if broken := scd2.several_current(spark.read.parquet(config.path("dim")), [f"{config.table}_key"]).limit(1).collect():
                raise ValueError(f"several current rows: {broken}")
            marks["dim"] = Mark(pending.agg(F.max(config.watermark)).first()[0], out.rows["dim"])
        control.put_all(config.table, marks, run_id, as_of)
        recorder.log("RUN", "run ended", rows=sum(out.rows.values()))
        return out
    except Exception as exc:
        recorder.error(layer, exc)
        recorder.log("RUN", "run failed", layer, status="FAILED")
        raise
    finally:
        recorder.save(spark, f"{config.root.rstrip('/')}/audit_trail", f"{config.root.rstrip('/')}/rca_errors")
