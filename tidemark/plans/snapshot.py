"""The dashboard snapshot: serving queries put together for one scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import metrics as m
from tidemark.operators import serving as s


def dashboard_snapshot(
    events: DataFrame,
    metrics: DataFrame,
    audiences: DataFrame,
    alerts: DataFrame,
    runs: DataFrame,
    scenario: str = "BASE",
    *,
    buckets: int = 12,
    heatmap_unit: str = "minute",
) -> dict[str, DataFrame]:
    """Every part of the snapshot as its own DataFrame.

    metrics, audiences and alerts are global; profiles, sources and the heatmap are the
    scenario's, as in the serving contract.  The product, region and type parts describe
    the whole event table given (pass one window's events for the latest window).
    """
    scenario = s.normalize_scenario(scenario)
    feed = s.alert_feed(alerts, scenario=scenario)
    kpis = s.kpi_snapshot(metrics, feed)
    kpi = lambda name: kpis.filter(F.col("kpi") == name).agg(F.max("value")).scalar()
    items = m.purchased_items(events)
    viewed = m.top_viewed_products(events, window=None)
    bought = m.top_purchased_products(items, window=None)
    conversion = m.conversion(events, window=None)
    return {
        "kpis": kpis,
        "sparklines": s.metric_history(metrics),
        "events_by_type": s.events_by_type_share(m.events_by_type(events, window=None)),
        "event_type_intervals": s.event_type_heatmap(events, scenario, buckets=buckets, unit=heatmap_unit),
        "audiences": s.audience_summary(audiences),
        "top_viewed_products": s.product_view_purchase_join(viewed, bought),
        "top_purchased_products": bought,
        "regions": s.region_stats(
            m.purchases_by_region(events, window=None), active_users=kpi("active_users"), conversion=kpi("purchase_conversion")
        ),
        "funnel": s.funnel(conversion),
        "alerts": feed,
        "infrastructure": s.pipeline_health(
            events, runs, metrics, audiences,
            feed.agg(F.count(F.lit(1))).scalar(), F.coalesce(kpi("total_processed"), F.lit(0.0)),
        ),
        "profiles": s.profile_stats(events, scenario),
        "sources": s.source_share(events, scenario),
    }


def as_document(parts: dict[str, DataFrame]) -> DataFrame:
    """One JSON text per part: (part, body).  Every part is a bounded result table."""
    out = None
    for name, df in parts.items():
        rows = df.agg(F.to_json(F.collect_list(F.struct("*"))).alias("body")).select(F.lit(name).alias("part"), "body")
        out = rows if out is None else out.unionByName(rows)
    return out
