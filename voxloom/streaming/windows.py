"""Event-time windows with watermarks, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, at: str, keys: list[str], width: str = "5 minutes", slide: str | None = None, late: str | None = "10 minutes", value: Column | None = None) -> DataFrame:
    """Rows, and the sum of a value, in tumbling or sliding windows; later rows than ``late`` are left out of streams."""
    marked = df.withWatermark(at, late) if late and df.isStreaming else df
    frame = F.window(at, width, slide) if slide else F.window(at, width)
    aggs = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value is not None else [])
    out = marked.groupBy(frame.alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", *(["total"] if value is not None else []))


def session_counts(df: DataFrame, at: str, keys: list[str], gap: str = "30 minutes", late: str | None = "10 minutes") -> DataFrame:
    """Rows of sessions that end after a pause of ``gap``."""
    marked = df.withWatermark(at, late) if late and df.isStreaming else df
    out = marked.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")


def latest_by_key(df: DataFrame, at: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """A stream without repeats of a key within the watermark."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)
