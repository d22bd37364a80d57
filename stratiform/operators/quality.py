"""Declarative quality rules: every failed rule of a row is kept; failing rows go to quarantine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING = "ERROR", "WARNING"
FAILURES, STATUS = "dq_failures", "dq_status"


@dataclass(frozen=True)
class Rule:
    """``holds`` must be true; null counts as failed unless the rule says otherwise."""

    name: str
    column: str
    holds: Column
    expected: str
    severity: str = ERROR
    message: str = ""

    def failure(self) -> Column:
        return F.struct(
            F.lit(self.name).alias("rule_name"),
            F.lit(self.column).alias("failed_column"),
            F.coalesce(F.col(self.column).cast("string"), F.lit("NULL")).alias("failed_value"),
            F.lit(self.expected).alias("expected_value"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.message or f"{self.column}: {self.expected} expected").alias("error_message"),
        )


def not_null(column: str, severity: str = ERROR) -> Rule:
    return Rule(f"{column}_not_null", column, F.col(column).isNotNull(), "NOT NULL", severity)


def in_set(column: str, values: Sequence[object], severity: str = ERROR, allow_null: bool = True) -> Rule:
    c = F.col(column)
    return Rule(f"{column}_in_set", column, (c.isin(list(values)) | c.isNull()) if allow_null else c.isin(list(values)), "one of " + ", ".join(map(str, values)), severity)


def between(column: str, low: object, high: object, severity: str = ERROR, allow_null: bool = True) -> Rule:
    c = F.col(column)
    return Rule(f"{column}_between", column, (c.between(low, high) | c.isNull()) if allow_null else c.between(low, high), f"{low} to {high}", severity)


def person_rules(as_of: dt.date) -> list[Rule]:
    """The three shipped rules of the person pipeline, and those for month, day and composed date."""
    from stratiform.functions.expr import safe_date

    composed = safe_date("year_of_birth", "month_of_birth", "day_of_birth").isNotNull()
    some_null = F.col("year_of_birth").isNull() | F.col("month_of_birth").isNull() | F.col("day_of_birth").isNull()
    return [
        not_null("person_id"),
        in_set("gender_concept_id", (8507, 8532, 8551)),
        between("year_of_birth", 1900, as_of.year, WARNING),
        between("month_of_birth", 1, 12, WARNING),
        between("day_of_birth", 1, 31, WARNING),
        Rule("birth_date_exists", "day_of_birth", composed | some_null, "an existing date", WARNING),
    ]


def evaluate(df: DataFrame, rules: Sequence[Rule], warnings_fail: bool = False) -> DataFrame:
    """Adds ``dq_failures`` (array of structs) and ``dq_status``: PASS, FAIL with an ERROR, else WARNING. One projection."""
    failures = F.array_compact(F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), r.failure()) for r in rules]))
    any_error = F.exists(F.col(FAILURES), lambda x: x["severity"] == ERROR)
    status = F.when(F.size(FAILURES) == 0, "PASS").when(any_error | F.lit(warnings_fail), "FAIL").otherwise("WARNING")
    return df.withColumn(FAILURES, failures).withColumn(STATUS, status)


def failed_names(df: DataFrame) -> DataFrame:
    """The older form: names of the failed rules, and VALID or ERROR."""
    return df.withColumn("failed_rules", F.col(f"{FAILURES}.rule_name")).withColumn("validity", F.when(F.size(FAILURES) == 0, "VALID").otherwise("ERROR"))


def split(evaluated: DataFrame, quarantine_warnings: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad); warnings are bad by default."""
    good = ["PASS"] if quarantine_warnings else ["PASS", "WARNING"]
    return evaluated.where(F.col(STATUS).isin(good)).drop(FAILURES, STATUS), evaluated.where(~F.col(STATUS).isin(good))


def quarantine(bad: DataFrame, session_id: str, as_of: dt.datetime) -> DataFrame:
    """One row a failed rule: metadata, resolution fields (NEW), then the whole row. Ids follow from the row, so a rerun gives the same ones."""
    columns = [c for c in bad.columns if c not in (FAILURES, STATUS)]
    out = bad.select(*columns, F.explode(FAILURES).alias("f"))
    key = F.sha2(F.concat_ws("||", F.lit(session_id), F.col("f.rule_name"), *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]), 256)
    return out.select(
        key.alias("quarantine_id"), F.lit(as_of).alias("quarantine_timestamp"), F.lit(as_of.date()).alias("quarantine_date"), F.lit(session_id).alias("session_id"),
        F.col("f.rule_name").alias("dq_rule_name"), "f.failed_column", "f.failed_value", "f.expected_value", "f.severity", "f.error_message",
        F.lit("NEW").alias("resolution_status"), F.lit(None).cast("string").alias("resolution_notes"), F.lit(None).cast("string").alias("resolved_by"), F.lit(None).cast("timestamp").alias("resolved_timestamp"),
        *columns,
    )


#: The states of a quarantine row, in order.
LIFECYCLE = ("NEW", "REVIEWED", "FIXED", "IGNORED")


def resolve(quarantined: DataFrame, ids: Sequence[str], status: str, by: str, notes: str, as_of: dt.datetime) -> DataFrame:
    if status not in LIFECYCLE:
        raise ValueError(status)
    hit = F.col("quarantine_id").isin(list(ids))
    new = {"resolution_status": F.lit(status), "resolved_by": F.lit(by), "resolution_notes": F.lit(notes), "resolved_timestamp": F.lit(as_of)}
    return quarantined.withColumns({c: F.when(hit, v.cast(quarantined.schema[c].dataType)).otherwise(F.col(c)) for c, v in new.items()})


def metrics(evaluated: DataFrame) -> DataFrame:
    """One row: total, passed and pass_rate (0 for no rows), in one pass."""
    total, good = F.count("*"), F.count_if(F.col(STATUS) == "PASS")
    return evaluated.agg(total.alias("total"), good.alias("passed"), F.when(total > 0, F.round(100.0 * good / total, 2)).otherwise(F.lit(0.0)).alias("pass_rate"))
