"""High-water marks: one control row a (table, layer), kept in a small Parquet table.

Errors are raised, never read as "load everything". Marks of all layers are committed by one write.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators import dedup, merge
from stratiform.sources import tables

SCHEMA = "control_id string, table_name string, layer string, last_watermark timestamp_ntz, last_run_time timestamp_ntz, rows_processed long, rows_quarantined long, status string, session_id string, error_message string, metadata string, created_date timestamp_ntz, updated_date timestamp_ntz"
INITIALIZED, RUNNING, SUCCESS, FAILED = "INITIALIZED", "RUNNING", "SUCCESS", "FAILED"
KEYS = ("table_name", "layer")
LAYERS = ("bronze", "silver", "gold", "dim")


def base_name(table: str) -> str:
    """The part of a table name after the last dot."""
    return table.rsplit(".", 1)[-1]


def initial_rows(spark: SparkSession, table_names: Sequence[str], as_of: dt.datetime, layers: Sequence[str] = LAYERS, metadata: Mapping | None = None) -> DataFrame:
    """A control row with no mark for each table and layer."""
    text = json.dumps(dict(metadata or {}), sort_keys=True)
    data = [(f"{base_name(t)}:{layer}", base_name(t), layer, None, None, 0, 0, INITIALIZED, None, None, text, as_of, as_of) for t in table_names for layer in layers]
    return spark.createDataFrame(data, SCHEMA)


@dataclass(frozen=True)
class Mark:
    watermark: dt.datetime | None
    rows: int = 0
    quarantined: int = 0
    status: str = SUCCESS
    error: str | None = None


class Control:
    """The control table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def init(self, table_names: Sequence[str], as_of: dt.datetime, layers: Sequence[str] = LAYERS) -> int:
        """Create the table, or add the rows it lacks; existing marks stay."""
        rows = initial_rows(self.spark, table_names, as_of, layers)
        return tables.replace(merge.insert_only(self.frame(), rows, KEYS) if tables.exists(self.spark, self.path) else rows, self.path)

    def frame(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def get(self, table: str, layer: str) -> dt.datetime | None:
        found = self.frame().where((F.col("table_name") == base_name(table)) & (F.col("layer") == layer)).select("last_watermark").collect()
        if len(found) != 1:
            raise LookupError(f"{len(found)} control rows for {table}, {layer}")
        return found[0][0]

    def put(self, table: str, layer: str, mark: Mark, session_id: str, as_of: dt.datetime) -> None:
        self.put_all(table, {layer: mark}, session_id, as_of)

    def put_all(self, table: str, marks: Mapping[str, Mark], session_id: str, as_of: dt.datetime) -> None:
        """All layers in one write; a mark of None keeps the old one."""
        old = {r["layer"]: r for r in self.frame().where(F.col("table_name") == base_name(table)).collect()}
        if missing := set(marks) - set(old):
            raise LookupError(f"no control rows for {sorted(missing)}")
        data = [(old[k]["control_id"], base_name(table), k, m.watermark or old[k]["last_watermark"], as_of, m.rows, m.quarantined, m.status, session_id, m.error, old[k]["metadata"], old[k]["created_date"], as_of) for k, m in marks.items()]
        tables.replace(merge.upsert(self.frame(), self.spark.createDataFrame(data, SCHEMA), KEYS), self.path)

    def history(self, table: str | None = None, layer: str | None = None, limit: int = 10) -> DataFrame:
        df = self.frame()
        for c, v in (("table_name", table and base_name(table)), ("layer", layer)):
            df = df.where(F.col(c) == v) if v else df
        return df.orderBy(F.col("last_run_time").desc_nulls_last(), *KEYS).limit(limit)

    def ready(self) -> DataFrame:
        return self.frame().where(F.col("status") != RUNNING).orderBy(*KEYS)


def latest_rows(control: DataFrame) -> DataFrame:
    """The newest control row of each table and layer."""
    return dedup.latest(control, KEYS, ["last_run_time"], ["control_id"])


def status_counts(control: DataFrame) -> DataFrame:
    """Rows of each status, with the newest run."""
    return control.groupBy("status").agg(F.count("*").alias("n"), F.max("last_run_time").alias("newest"))


def preflight(df: DataFrame | None, column: str) -> list[tuple[str, str]]:
    """(finding, detail) of a source and its watermark column: none if it can be loaded by increments."""
    if df is None:
        return [("MISSING_TABLE", "")]
    if column.lower() not in {c.lower() for c in df.columns}:
        return [("MISSING_COLUMN", column)]
    x = profile(df, column).first()
    if not x["total"]:
        return [("EMPTY", column)]
    if not x["non_null"]:
        return [("NO_WATERMARK", column)]
    return [("SPARSE_WATERMARK", f"{x['non_null']} of {x['total']}")] if x["sparse"] else []


def profile(df: DataFrame, column: str) -> DataFrame:
    """One row about a watermark column: rows, non-null rows, least, greatest, and a warning under 10 % non-null; one pass."""
    n, some = F.count("*"), F.count(column)
    return df.agg(n.alias("total"), some.alias("non_null"), F.min(column).alias("least"), F.max(column).alias("greatest"), (some < 0.1 * n).alias("sparse"))
