"""Sources and sinks over Parquet: scans, typed rows, alignment, and replacement by way of a new path."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; filters and columns chosen later reach the Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> None:
    for name in names:
        scan(spark, sf_dir, name).createOrReplaceTempView(name)


def incremental(df: DataFrame, column: str, watermark: object | None, fallback: str | None = None) -> DataFrame:
    """Rows after the watermark (a literal, so the scan prunes by it), or all rows without one.

    With ``fallback``, rows whose column is null are judged by that column, so they are not skipped for good.
    """
    if watermark is None:
        return df
    if fallback is None:
        return df.where(F.col(column) > F.lit(watermark))
    # equal to coalesce(column, fallback) > watermark, in a form whose parts reach the scan
    return df.where((F.col(column) > F.lit(watermark)) | (F.col(column).isNull() & (F.col(fallback) > F.lit(watermark))))


def rows(spark: SparkSession, data: Sequence[tuple], schema: StructType | str | Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(data), schema if isinstance(schema, StructType | str) else list(schema))


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def align(df: DataFrame, target: StructType) -> DataFrame:
    """The target's columns in its order: cast where present, null where missing; other columns go."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields])


def cast_existing(df: DataFrame, target: StructType) -> DataFrame:
    """Cast the columns that the target has to its types; keep all others."""
    types: dict[str, DataType] = {f.name: f.dataType for f in target.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; a partition column keeps one directory a value. Rows of a value reach few files, and a value with many rows several tasks."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_aligned(df: DataFrame, path: str) -> None:
    """Append rows brought to the schema that the path has; new columns are refused, not dropped."""
    target = df.sparkSession.read.parquet(path).schema
    extra = set(df.columns) - set(target.names)
    if extra:
        raise ValueError(f"columns that the target lacks: {sorted(extra)}")
    align(df, target).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append with new columns; ``read_evolving`` merges the files' schemas."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def replace(df: DataFrame, path: str, expected: int | None = None, backup: str | None = None) -> int:
    """Write a table that may be read by ``df`` itself: to a new path, counted there, then swapped in. Returns the rows.

    With ``expected``, another count raises before the swap; with ``backup``, the old files are kept there.
    """
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    n = spark.read.schema(df.schema).parquet(new).count()
    fs, target = _fs(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    if expected is not None and n != expected:
        fs.delete(hadoop(new), True)
        raise ValueError(f"{n} rows were written for {path}, {expected} expected; the table is as it was")
    if fs.exists(target) and not fs.rename(target, hadoop(old)):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(hadoop(new), target):
        fs.rename(hadoop(old), target)
        raise OSError(f"{new} can't be moved")
    if backup and fs.exists(hadoop(old)):
        if not fs.rename(hadoop(old), hadoop(backup)):
            raise OSError(f"{old} can't be moved to {backup}")
    else:
        fs.delete(hadoop(old), True)
    return n


# --- catalog ------------------------------------------------------------------


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(spark: SparkSession, table: str, schema: StructType | str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """A Parquet table of the catalog, where there is none of that name."""
    columns = _columns(schema) if isinstance(schema, StructType) else schema
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    at = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}{at}")


def add_table_columns(spark: SparkSession, table: str, schema: StructType) -> list[str]:
    """Add the columns that the table lacks; returns their names."""
    have = {c.lower() for c in spark.table(table).columns}
    new = StructType([f for f in schema.fields if f.name.lower() not in have])
    if new.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(new)})")
    return new.names


def rename_table(spark: SparkSession, table: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {to}")


def drop_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Drop the tables that exist; returns their names."""
    there = [t for t in names if spark.catalog.tableExists(t)]
    for t in there:
        spark.sql(f"DROP TABLE {t}")
    return there


def reset(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """Delete the named tables below a folder, for a run from nothing; returns those that were there."""
    there = [n for n in names if exists(spark, f"{root.rstrip('/')}/{n}")]
    for n in there:
        fs, p = _fs(spark, f"{root.rstrip('/')}/{n}")
        fs.delete(p, True)
    return there


def describe(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]


def list_tables(spark: SparkSession, pattern: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def sample_head(df: DataFrame, fraction: float, n: int, seed: int) -> DataFrame:
    """A sampled scan, at most ``n`` rows."""
    return df.sample(False, fraction, seed).limit(n)
