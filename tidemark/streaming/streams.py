"""The first-seen filter and weekly bars as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(articles: DataFrame, time: str, keys: list[str], delay: str = "30 days") -> DataFrame:
    """Each content once, as long as its copies come within `delay` of each other; state older than that is dropped."""
    return articles.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def weekly_bars(bars: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """Weeks from Monday, finished when the watermark passes them; later bars are dropped."""
    week = F.window(time, "7 days", startTime="4 days")
    t = F.col(time)
    return (
        bars.withWatermark(time, delay)
        .groupBy(key, week.alias("w"))
        .agg(F.min_by("open", t).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", t).alias("close"), F.sum("volume").alias("volume"))
        .select(key, F.to_date("w.start").alias("week"), "open", "high", "low", "close", "volume")
    )
