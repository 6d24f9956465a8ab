"""Streaming forms of the ranked choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_within(stream: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; state is dropped once the watermark has passed."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def best_per_window(stream: DataFrame, key: str, order_key: Column, row: Column, time: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Of each key and window the row that ranks first (order_key sorts ascending), told once the window is closed."""
    return (
        stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("window"), key)
        .agg(F.min_by(row, order_key).alias("row"), F.count(F.lit(1)).alias("n"))
    )
