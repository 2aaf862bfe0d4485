"""Incremental processing: new page files once, upserts of results, windowed counts of late events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Processes parquet files that weren't seen before, each exactly once, and ends; the checkpoint is the list of those done."""
    s = transform(spark.readStream.schema(schema).parquet(path))
    return s.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str | Column, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(start, key, n) of events by time window; events later than ``late`` are dropped in streams."""
    k = F.col(key) if isinstance(key, str) else key
    g = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), k.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), "key", "n")


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of both, those of ``changes`` where the key is in both; null keys are kept. Repeating it changes nothing."""
    return current.join(changes.select(key), key, "left_anti").unionByName(changes)


def to_do(items: DataFrame, done: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Items that aren't done and are available."""
    return items.join(done.select(key), key, "left_anti").join(available.select(key), key, "left_semi")
