"""Duplicate handling by event_id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import tag_first


def dedup_events(events: DataFrame, key: str = "event_id", order: str = "arrival") -> DataFrame:
    """First arrival of every id is kept; later ones get a reject reason."""
    tagged = tag_first(events, key, order)
    reason = F.when(~F.col("is_first"), F.concat(F.lit("Duplicate event_id: "), F.col(key)))
    return tagged.withColumn("error_reason", reason).drop("is_first")


def dedup_stream(events: DataFrame, lateness: str = "5 seconds", ts: str = "event_instant") -> DataFrame:
    """Streaming dedup whose state is bounded by the watermark."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(["event_id"])
