"""Whole jobs over static tables: one file or table in, all result tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import AlertLimits, AudienceLimits, Windows
from tidemark.operators import alerts as al
from tidemark.operators import audiences as au
from tidemark.operators import metrics as m
from tidemark.operators.dedup import dedup_events
from tidemark.operators.validate import dead_letters, enrich_latency, typed_events, validate_raw_event
from tidemark.sources.sinks import metric_rows
from tidemark.sources.scratch import cut_lineage


def ingest(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Published event lines (value, arrival) to (valid events, dead letters).

    Only valid rows take part in the duplicate check.  The check reads its input twice
    (first positions, then rows), so the parsed rows are written once as a columnar table
    in the shared folder and JSON is not parsed again.
    """
    checked = validate_raw_event(lines)
    bad = dead_letters(checked)
    good = cut_lineage(typed_events(checked.filter(F.col("error_reason").isNull())), "typed")
    deduped = dedup_events(good)
    again = deduped.filter(F.col("error_reason").isNotNull()).select(
        "arrival", F.col("value").alias("raw_message"), "error_reason", F.current_timestamp().alias("failed_at"), "event_id"
    )
    events = enrich_latency(deduped.filter(F.col("error_reason").isNull()).drop("error_reason", "value"))
    return events, bad.unionByName(again)


def compute_metrics(events: DataFrame, windows: Windows | None = None, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All eight metrics; windows=None treats the input as one micro-window."""
    w = windows
    one = w is None
    pick = lambda name: None if one else getattr(w, name)
    return {
        "throughput": m.throughput(events, window=pick("throughput"), by=by, duration_sec=10 if one else None),
        "active_users": m.active_users(events, window=pick("active_users"), by=by),
        "events_by_type": m.events_by_type(events, window=pick("events_by_type"), by=by),
        "top_products_viewed": m.top_viewed_products(events, window=pick("top_products"), by=by),
        "top_products_purchased": m.top_purchased_products(m.purchased_items(events, keep=by), window=pick("top_products"), by=by),
        "purchases_by_region": m.purchases_by_region(events, window=pick("purchases_by_region"), by=by),
        "conversion": m.conversion(events, window=pick("conversion"), by=by),
        "trends": m.trends(events, window=pick("trends"), slide=pick("trends_slide"), by=by),
    }


def metrics_table(events: DataFrame, length: str, kinds=("throughput", "active_users", "conversion", "trends")) -> DataFrame:
    """Scalar metrics per window in the metric table's form, with a repeatable id."""
    build = {
        "throughput": lambda: m.throughput(events, window=length),
        "active_users": lambda: m.active_users(events, window=length, sample=0),
        "conversion": lambda: m.conversion(events, window=length),
        "trends": lambda: m.trends(events, window=length, slide=None),
    }
    out = None
    for kind in kinds:
        rows = metric_rows(build[kind](), kind).withColumn("id", F.unix_micros(F.col("window_end").cast("timestamp")))
        out = rows if out is None else out.unionByName(rows)
    return out


def run_batch(
    lines: DataFrame,
    windows: Windows | None = None,
    audience_limits: AudienceLimits = AudienceLimits(),
    alert_limits: AlertLimits = AlertLimits(),
    alert_window: str = "10 seconds",
) -> dict[str, DataFrame]:
    """Ingest, metrics, audiences and alerts of one input."""
    events, rejects = ingest(lines)
    out = {"events": events, "dead_letters": rejects}
    out.update(compute_metrics(events, windows))
    out["audiences"] = au.classify_audiences(events, limits=audience_limits)
    out["alerts"] = al.detect_alerts(events, limits=alert_limits, window=alert_window)
    return out
