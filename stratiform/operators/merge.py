"""MERGE as DataFrame algebra: the result is a new frame, to be written with ``sources.tables.replace``.

The source must have one row a key. Keys are compared by equality, so a null key never matches: its source rows are
inserts, its target rows stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_S, _T = "_in_source", "_in_target"


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.withColumn(_S, F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return t.join(s, on, how), t, s


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Update ``columns`` (all by default) of matched rows, insert the rest."""
    columns = list(columns) if columns is not None else [c for c in target.columns if c in source.columns]
    joined, _, _ = _sides(target, source, keys, "full")
    take = F.col(f"s.{_S}").isNotNull()

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c in columns or c in keys:
            return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        return F.when(F.col(f"t.{_T}").isNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows unchanged, and the source rows whose key is new."""
    new = source.join(target.select(*keys), list(keys), "left_anti").select(source.columns)
    return target.unionByName(new.select([c for c in target.columns if c in source.columns]), allowMissingColumns=True)


def update_only(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Matched rows take the source's values; nothing is inserted."""
    columns = list(columns) if columns is not None else [c for c in target.columns if c in source.columns]
    joined, _, _ = _sides(target, source, keys, "left")
    hit = F.col(f"s.{_S}").isNotNull()
    return joined.select(*[(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in columns else F.col(f"t.{c}")).alias(c) for c in target.columns])


def conditional_update(target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Matched rows that meet the condition (written with ``t.`` and ``s.`` columns) take the assignments."""
    joined, _, _ = _sides(target, source, keys, "left")
    hit = F.col(f"s.{_S}").isNotNull() & F.coalesce(condition, F.lit(False))
    return joined.select(*[(F.when(hit, assignments[c]).otherwise(F.col(f"t.{c}")) if c in assignments else F.col(f"t.{c}")).alias(c) for c in target.columns])


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE, without a join."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys that were inserted, deleted or changed between two snapshots: what a change feed would give."""
    from stratiform.functions.expr import change_hash

    a = old.select(*keys, change_hash(columns).alias("_a"))
    b = new.select(*keys, change_hash(columns).alias("_b"))
    kind = F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "delete").when(F.col("_a") != F.col("_b"), "update")
    return a.join(b, list(keys), "full").select(*keys, kind.alias("change_type")).where("change_type is not null")
