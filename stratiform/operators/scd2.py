"""Type-2 dimensions: half-open validity intervals [effective_from, effective_to), the open one current.

Changes are judged null-safely by a hash over all attributes. All functions are pure; a caller writes the result with
``sources.tables.replace``. Joins are by key only: the current rows are one a key, so no key meets many rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.functions.expr import OPEN_END, change_hash
from stratiform.operators.dedup import assert_unique

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"


def initial(source: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """Every source row opened at ``as_of`` (a date or a date column)."""
    start = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return source.withColumns({FROM: start, TO: F.lit(OPEN_END), CURRENT: F.lit(True)})


def new_or_changed(dim: DataFrame, source: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Source rows whose key has no current row, or one with other attributes; ``_kind`` is new or changed."""
    current = dim.where(CURRENT).select(*keys, change_hash(attributes).alias("_old"))
    out = source.withColumn("_new", change_hash(attributes)).join(current, list(keys), "left")
    return out.where(~F.col("_new").eqNullSafe(F.col("_old"))).withColumn("_kind", F.when(F.col("_old").isNull(), "new").otherwise("changed")).drop("_new", "_old")


def _not_before(start: Column, as_of: dt.date, value: Column) -> Column:
    """The value; an error where a current version starts after ``as_of``."""
    return F.when(start > F.lit(as_of), F.raise_error(F.concat(F.lit(f"a change at {as_of} is older than the current version of "), start.cast("string"), F.lit(": use rebuild")))).otherwise(value)


def apply_anytime(dim: DataFrame, source: DataFrame, keys: Sequence[str], attributes: Sequence[str], as_of: dt.date) -> DataFrame:
    """``apply``, where keys whose current version starts after ``as_of`` have the change put into their history instead."""
    later = dim.where(F.col(CURRENT) & (F.col(FROM) > F.lit(as_of))).select(*keys).distinct()
    back = later.join(source.select(*keys).distinct(), list(keys), "left_semi")
    names = [c for c in dim.columns if c not in (*keys, FROM, TO, CURRENT)]
    late = source.join(back, list(keys), "left_semi").select(*keys, *names, F.lit(as_of).alias(FROM), F.lit(1).alias("arrival"))
    rest = apply(dim.join(back, list(keys), "left_anti"), source.join(back, list(keys), "left_anti"), keys, attributes, as_of)
    return rest.unionByName(rebuild(dim.join(back, list(keys), "left_semi"), late, keys, names).select(rest.columns))


def apply(dim: DataFrame, source: DataFrame, keys: Sequence[str], attributes: Sequence[str], as_of: dt.date, check: bool = True) -> DataFrame:
    """Close changed rows at ``as_of`` and open their successors; open new keys; leave the rest.

    A row opened on ``as_of`` itself is replaced in place, so no interval is empty. A change older than the current
    version is an error, not a loss of that version; ``apply_anytime`` and ``rebuild`` take such changes. One full outer
    join by key decides everything: each joined pair gives its rows, history passes by.
    """
    if check:
        assert_unique(source, keys)
    columns = [c for c in source.columns if c not in (FROM, TO, CURRENT)]
    source = source.select(columns)
    current = dim.where(CURRENT)
    c = current.withColumn("_c", change_hash(attributes)).alias("c")
    s = source.withColumn("_s", change_hash(attributes)).alias("s")
    joined = c.join(s, [F.col(f"c.{k}") == F.col(f"s.{k}") for k in keys], "full")
    changed = F.col("c._c").isNotNull() & F.col("s._s").isNotNull() & (F.col("c._c") != F.col("s._s"))
    same_day = changed & (_not_before(F.col(f"c.{FROM}"), as_of, F.col(f"c.{FROM}")) == F.lit(as_of))
    names = dim.columns
    old = F.struct(*[(F.when(changed, F.lit(as_of)).otherwise(F.col(f"c.{x}")) if x == TO else (F.col(f"c.{x}") & ~F.coalesce(changed, F.lit(False))) if x == CURRENT else F.col(f"c.{x}")).alias(x) for x in names])
    fresh = {FROM: F.lit(as_of), TO: F.lit(OPEN_END), CURRENT: F.lit(True)}
    new = F.struct(*[(fresh[x] if x in fresh else F.col(f"s.{x}") if x in columns else F.lit(None)).cast(dim.schema[x].dataType).alias(x) for x in names])
    kept = F.when(F.col("c._c").isNotNull() & ~F.coalesce(same_day, F.lit(False)), old)
    opened = F.when(F.col("s._s").isNotNull() & (F.col("c._c").isNull() | changed), new)
    out = joined.select(F.explode(F.array_compact(F.array(kept, opened))).alias("r")).select("r.*")
    return dim.where(~F.col(CURRENT)).select(names).unionByName(out.select(names))


def expire_then_insert(dim: DataFrame, source: DataFrame, keys: Sequence[str], attributes: Sequence[str], as_of: dt.date) -> DataFrame:
    """The same result in two steps, as anti and semi joins: close what changed, then insert what is new or changed."""
    news = new_or_changed(dim, source, keys, attributes)
    changed = news.where("_kind = 'changed'").select(*keys)
    current, history = dim.where(CURRENT), dim.where(~F.col(CURRENT))
    closed = current.join(changed, list(keys), "left_semi").where(_not_before(F.col(FROM), as_of, F.col(FROM)) < F.lit(as_of)).withColumns({TO: F.lit(as_of), CURRENT: F.lit(False)})
    kept = current.join(changed, list(keys), "left_anti")
    opened = initial(news.drop("_kind"), as_of)
    return history.select(dim.columns).unionByName(kept.select(dim.columns)).unionByName(closed.select(dim.columns)).unionByName(opened.select(dim.columns))


def split_late(df: DataFrame, received: str | Column, effective: str, after_days: int = 1, max_days: int | None = 365) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(normal, late, rejected) by ``days_late``; null dates are normal."""
    named = with_arrival(df, received, effective, after_days, max_days)
    return tuple(named.where(F.col("arrival") == k).drop("arrival") for k in ("normal", "late", "rejected"))


def with_arrival(df: DataFrame, received: str | Column, effective: str, after_days: int = 1, max_days: int | None = 365) -> DataFrame:
    """Adds ``days_late`` and ``arrival`` (normal, late or rejected) in one projection."""
    got = F.col(received) if isinstance(received, str) else received
    days = F.col("days_late")
    kind = F.when(days > max_days, "rejected") if max_days is not None else F.when(F.lit(False), "rejected")
    return df.withColumn("days_late", F.datediff(got, F.col(effective))).withColumn("arrival", kind.when(days > after_days, "late").otherwise("normal"))


def rebuild(dim: DataFrame, late: DataFrame, keys: Sequence[str], attributes: Sequence[str], arrival: str = "arrival") -> DataFrame:
    """Put back-dated versions into the history and rebuild the intervals.

    ``late`` has the keys, the attributes, effective_from and ``arrival``. Of versions with one start the later arrival
    wins; a version equal to the one before it goes; ends follow from the next start. Windows are by key.
    """
    columns = [*keys, *attributes, FROM]
    every = dim.select(*columns, F.lit(None).cast(late.schema[arrival].dataType).alias(arrival)).unionByName(late.select(*columns, arrival))
    start = Window.partitionBy(*keys, FROM).orderBy(F.col(arrival).desc_nulls_last(), change_hash(attributes))
    once = every.withColumn("_r", F.row_number().over(start)).where("_r = 1").withColumn("_h", change_hash(attributes))
    line = Window.partitionBy(*keys).orderBy(FROM)
    once = once.withColumn("_p", F.lag("_h").over(line)).where(~F.col("_h").eqNullSafe(F.col("_p")))
    after = F.lead(FROM).over(line)
    return once.select(*columns, F.coalesce(after, F.lit(OPEN_END)).alias(TO), after.isNull().alias(CURRENT))


def repair(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Make intervals contiguous and the last version of each key the only current one."""
    line = Window.partitionBy(*keys).orderBy(F.col(FROM), F.xxhash64(*dim.columns))
    after = F.lead(FROM).over(line)
    return dim.withColumns({TO: F.coalesce(after, F.lit(OPEN_END)), CURRENT: after.isNull()})


# --- integrity: each gives the rows that break the rule ------------------------


def several_current(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dim.where(CURRENT).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def gaps(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions whose end is not the start of the next."""
    after = F.lead(FROM).over(Window.partitionBy(*keys).orderBy(FROM))
    return dim.withColumn("next_from", after).where(F.col("next_from").isNotNull() & (F.col(TO) != F.col("next_from")))


def bad_order(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(FROM) >= F.col(TO))


def bad_current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(CURRENT) != (F.col(TO) == F.lit(OPEN_END)))
