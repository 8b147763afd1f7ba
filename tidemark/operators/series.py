"""Statistics over window-level series (a time column, a value, optional group keys).

Group totals are partial aggregates joined back (or scalar subqueries); positions are
built from per-segment counts.  No operator gathers a whole series in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import change_pct
from tidemark.functions.skew import attach_totals, with_position

FLAT = 1e-6  # a series this even has no anomalies
RANGES = {"5m": 300, "15m": 900, "1h": 3600}


def _numbered(series: DataFrame, value: str, ts: str, by: Sequence[str]) -> DataFrame:
    rows = series.select(*by, ts, F.col(value).cast("double").alias("v"))
    return attach_totals(with_position(rows, by, ts), by, F.count(F.lit(1)).alias("n"))


def series_stats(series: DataFrame, value: str = "eps", *, ts: str = "window_start", by: Sequence[str] = ()) -> DataFrame:
    """Min, max, mean, population deviation, first positions of the extremes, trend."""
    rows = _numbered(series, value, ts, by)
    half = F.greatest(F.lit(1), F.floor(F.col("n") / 2))
    first, last = F.avg(F.when(F.col("pos") < half, F.col("v"))), F.avg(F.when(F.col("pos") >= F.col("n") - half, F.col("v")))
    out = rows.groupBy(*by).agg(
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.avg("v").alias("avg"),
        F.stddev_pop("v").alias("std"),
        F.min_by("pos", F.struct("v", "pos")).alias("min_index"),
        F.max_by("pos", F.struct("v", (-F.col("pos")).alias("p"))).alias("max_index"),
        first.alias("_first"),
        last.alias("_last"),
    )
    out = out.withColumn("trend_pct", change_pct("_last", "_first")).drop("_first", "_last")
    return out.filter(F.col("avg").isNotNull())


def period_comparison(series: DataFrame, value: str = "eps", *, ts: str = "window_start", by: Sequence[str] = ()) -> DataFrame:
    """Mean of the second half against the first; one point compares with itself."""
    rows = _numbered(series, value, ts, by)
    half = F.floor(F.col("n") / 2)
    out = rows.groupBy(*by).agg(
        F.max("n").alias("n"),
        F.avg(F.when(F.col("pos") >= half, F.col("v"))).alias("current"),
        F.avg(F.when(F.col("pos") < half, F.col("v"))).alias("previous"),
    )
    single = F.col("n") < 2
    current = F.coalesce("current", F.lit(0.0))
    previous = F.when(single, current).otherwise(F.col("previous"))
    return out.select(
        *by, current.alias("current"), previous.alias("previous"),
        F.when(single, F.lit(0.0)).otherwise(change_pct(current, previous)).alias("pct"),
    )


def _with_moments(series: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    v = F.col(value).cast("double")
    return attach_totals(series, by, F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def zscore_anomalies(series: DataFrame, value: str = "eps", *, threshold: float = 1.9, by: Sequence[str] = ()) -> DataFrame:
    """Points at least `threshold` deviations from the mean, tagged peak or fall."""
    z = (F.col(value) - F.col("mean")) / F.col("std")
    rows = _with_moments(series, value, by).filter(F.col("std") >= FLAT).withColumn("z", z)
    return (
        rows.filter(F.abs("z") >= threshold)
        .withColumn("kind", F.when(F.col("z") > 0, "pico").otherwise("caida"))
        .drop("mean", "std")
    )


def filter_recent(series: DataFrame, span: str = "15m", *, ts: str = "window_start", by: Sequence[str] = ()) -> DataFrame:
    """Points within the span before the latest point (not before the wall clock)."""
    seconds = RANGES.get(span)
    if seconds is None:
        return series
    if not by:
        latest = series.agg(F.max(ts)).scalar()
        return series.filter(F.col(ts) >= F.timestamp_add("SECOND", F.lit(-seconds), latest))
    rows = attach_totals(series, by, F.max(ts).alias("_latest"))
    return rows.filter(F.col(ts) >= F.timestamp_add("SECOND", F.lit(-seconds), F.col("_latest"))).drop("_latest")


def expected_band(series: DataFrame, value: str = "eps", *, by: Sequence[str] = (), band: tuple[float, float] | None = None) -> DataFrame:
    """Expected range (mean +- deviation, not below 0, or a configured band) and deviation %."""
    rows = _with_moments(series, value, by)
    low = F.lit(float(band[0])) if band else F.greatest(F.lit(0.0), F.col("mean") - F.col("std"))
    high = F.lit(float(band[1])) if band else F.col("mean") + F.col("std")
    return (
        rows.withColumn("low", low).withColumn("high", high).withColumn("deviation_pct", change_pct(value, "mean")).drop("mean", "std")
    )


def heatmap_intensity(grid: DataFrame) -> DataFrame:
    """Row totals per type and every cell's share of the largest cell."""
    totals = attach_totals(grid, ["event_type"], F.sum("events").alias("row_total"))
    peak = grid.agg(F.max("events")).scalar()
    return totals.withColumn("_max", peak).select(
        *totals.columns,
        F.when(F.col("_max") == 0, F.lit(0.0)).otherwise(F.col("events") / F.col("_max")).alias("intensity"),
    )
