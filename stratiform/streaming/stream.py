"""The layered run as a stream: each micro-batch of new files goes through the same stages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratiform.plans import pipeline


def available_now(spark: SparkSession, source_path: str, schema: StructType, config: pipeline.Config, checkpoint: str, clock: Callable[[int], dt.datetime]) -> StreamingQuery:
    """Run all files that are there now, batch by batch; the batch number is the run id, so a retried batch adds no row twice."""

    def batch(df: DataFrame, number: int) -> None:
        if not df.isEmpty():
            pipeline.run(spark, df, config, clock(number), f"batch-{number}")

    return spark.readStream.schema(schema).parquet(source_path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Rows of a key once within the watermark: state is bounded by the delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, event_time: str, delay: str, width: str, *keys: str) -> DataFrame:
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *keys).agg(F.count("*").alias("n"))
