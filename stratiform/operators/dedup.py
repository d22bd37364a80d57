"""Latest-wins deduplication and uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row a key: the greatest of ``newest`` (nulls last), ties by ``tiebreak``, then by a hash of the row.

    The rank filter becomes a window group limit, so all but one row a key and task go before the shuffle; a key that
    holds much of the table is cut down where it lies.
    """
    order = [F.col(c).desc_nulls_last() for c in (*newest, *tiebreak)]
    order.append(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]).desc())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself; raises if a key has two rows."""
    if found := duplicates(df, keys).limit(5).collect():
        raise ValueError(f"keys {list(keys)} are not unique, for instance {[tuple(r) for r in found]}")
    return df
