"""Session islands on a stream: the rule of the batch islands, with late rows up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """key, session_start, session_end, n_events: rows of one key no further apart than `gap` are one session."""
    marked = events.withWatermark(at, late)
    grouped = marked.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n_events"))
    return grouped.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")
