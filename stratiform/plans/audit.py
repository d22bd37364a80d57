"""Audit and root-cause rows: buffered while a run lasts, written by one append each."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names and types of the audit, error and late-arrival columns.
AUDIT = "audit_id string, session_id string, timestamp timestamp_ntz, event_type string, description string, stage string, rows long, status string, duration_seconds double, metadata string"
ERRORS = "error_id string, error_type string, error_message string, context string, session_id string, timestamp timestamp_ntz, pipeline_version string, resolved boolean, severity string, stage string, resolution string"
LATE_LOG = "late_arrival_id string, session_id string, person_id int, person_key string, effective_from date, received_timestamp timestamp_ntz, received_date date, days_late int, changed_attributes string, old_values string, new_values string, records_split int, records_inserted int, processing_duration_seconds double, status string, error_message string, created_timestamp timestamp_ntz, created_by string"
#: What to look at first when a layer fails.
HINTS = {"bronze": "check the source table and its watermark column", "silver": "check the quality rules and their columns", "gold": "check derived columns and business keys", "dim": "check key uniqueness and validity intervals"}


def late_rows(late: DataFrame, current: DataFrame | None, key: str, business_key: str, attributes: Sequence[str], received: dt.datetime, session_id: str, pipeline: str) -> DataFrame:
    """Rows of LATE_LOG for late or rejected changes (``_start``, ``days_late``, ``arrival``), with the current values beside the new ones."""
    values = lambda prefix: F.to_json(F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in attributes]), {"ignoreNullFields": "false"})
    if current is not None:
        late = late.join(current.select(business_key, *[F.col(c).alias(f"_old_{c}") for c in attributes]), business_key, "left")
    else:
        late = late.withColumns({f"_old_{c}": F.lit(None).cast(late.schema[c].dataType) for c in attributes})
    taken = (F.col("arrival") == "late").cast("int")
    changed: list[Column] = [F.when(~F.col(c).eqNullSafe(F.col(f"_old_{c}")), F.lit(c)) for c in attributes]
    filled = {
        "late_arrival_id": F.sha2(F.concat_ws("|", F.col(business_key), F.col("_start").cast("string"), values("")), 256), "session_id": F.lit(session_id), "person_id": F.col(key), "person_key": F.col(business_key),
        "effective_from": F.col("_start"), "received_timestamp": F.lit(received), "received_date": F.lit(received.date()), "days_late": F.col("days_late"), "changed_attributes": F.concat_ws(",", *changed),
        "old_values": values("_old_"), "new_values": values(""), "records_split": taken, "records_inserted": taken, "status": F.when(taken == 1, "PROCESSED").otherwise("REJECTED"),
        "error_message": F.when(taken == 0, "older than the limit"), "created_timestamp": F.lit(received), "created_by": F.lit(pipeline),
    }
    kinds = [x.split(" ") for x in LATE_LOG.split(", ")]
    return late.select(*[filled.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds])


class Recorder:
    """Collects events; ``clock`` is injected so that runs can be repeated."""

    def __init__(self, session_id: str, clock: Callable[[], dt.datetime], version: str = "1"):
        self.session_id, self.clock, self.version = session_id, clock, version
        self.events: list[tuple] = []
        self.errors: list[tuple] = []

    def _id(self, kind: str, n: int) -> str:
        return hashlib.sha256(f"{self.session_id}|{kind}|{n}".encode()).hexdigest()[:32]

    def log(self, event_type: str, description: str, stage: str = "", rows: int | None = None, status: str = "SUCCESS", duration: float | None = None, **metadata: object) -> None:
        self.events.append((self._id("event", len(self.events)), self.session_id, self.clock(), event_type, description, stage, rows, status, duration, json.dumps(metadata, sort_keys=True)))

    def error(self, stage: str, exc: BaseException, severity: str = "ERROR", **context: object) -> None:
        self.errors.append((self._id("error", len(self.errors)), type(exc).__name__, str(exc)[:2000], json.dumps(context, sort_keys=True, default=str), self.session_id, self.clock(), self.version, False, severity, stage, HINTS.get(stage, "")))

    def summary(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for e in self.events:
            out[e[7]] = out.get(e[7], 0) + 1
        return out

    def save(self, spark: SparkSession, audit_path: str, error_path: str) -> None:
        for data, schema, path in ((self.events, AUDIT, audit_path), (self.errors, ERRORS, error_path)):
            if data:
                spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
        self.events, self.errors = [], []
