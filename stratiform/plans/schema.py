"""Schema inspection, evolution and migration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from stratiform.sources import tables

CREATE, MERGE, EVOLVED, RECREATE, FAILED = "CREATE", "MERGE", "EVOLVED", "RECREATE", "FAILED"


@dataclass
class Plan:
    action: str
    added: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    casts: dict[str, tuple[str, str]] = field(default_factory=dict)
    problems: list[str] = field(default_factory=list)


def _castable(old: DataType, new: DataType) -> bool:
    simple = ("array", "map", "struct", "binary")
    return old == new or not (old.typeName() in simple or new.typeName() in simple) or new.typeName() == "string"


def inspect(existing: StructType | None, incoming: StructType, recreate: bool = False) -> Plan:
    """What it takes to load ``incoming`` into ``existing``: new columns are added, conflicting types cast to the existing ones."""
    if existing is None:
        return Plan(CREATE)
    old = {f.name: f.dataType for f in existing.fields}
    new = {f.name: f.dataType for f in incoming.fields}
    plan = Plan(MERGE, [c for c in new if c not in old], [c for c in old if c not in new])
    for c in new:
        if c in old and new[c] != old[c]:
            plan.casts[c] = (new[c].simpleString(), old[c].simpleString())
            if not _castable(new[c], old[c]):
                plan.problems.append(f"{c}: {new[c].simpleString()} can't become {old[c].simpleString()}")
    if plan.problems:
        plan.action = RECREATE if recreate else FAILED
    elif plan.added:
        plan.action = EVOLVED
    return plan


def prepare(df: DataFrame, existing: StructType | None, recreate: bool = False) -> tuple[Plan, DataFrame | None]:
    """The plan, and the frame to load (existing columns first, in their order and types, then new ones); None if it failed.

    A cast that would turn a value into null is a failure (or a reason to recreate): one aggregate counts such values.
    """
    plan = inspect(existing, df.schema, recreate)
    if plan.casts and not plan.problems:
        kinds = {f.name: f.dataType for f in existing.fields}
        lost = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kinds[c]).isNull()).alias(c) for c in plan.casts]).first()
        plan.problems = [f"{c}: {lost[c]} values can't become {kinds[c].simpleString()}" for c in plan.casts if lost[c]]
        if plan.problems:
            plan.action = RECREATE if recreate else FAILED
    if plan.action == FAILED:
        return plan, None
    if existing is None or plan.action == RECREATE:
        return plan, df
    return plan, df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in existing.fields], *plan.added)


def add_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Columns with defaults, where absent."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def audit_defaults() -> dict[str, Column]:
    return {"created_timestamp": F.lit(None).cast("timestamp"), "updated_timestamp": F.lit(None).cast("timestamp"), "is_deleted": F.lit(False)}


def migrate(spark: SparkSession, path: str, defaults: Mapping[str, Column] | None = None, backup: str | None = None) -> int:
    """Rewrite a table with more columns: new path, count checked there, then swapped in; ``backup`` keeps the old files. Returns the rows."""
    old = spark.read.parquet(path)
    return tables.replace(add_columns(old, defaults or audit_defaults()), path, old.count(), backup)
