"""Comparison of scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import AlertLimits
from tidemark.functions.expr import ratio, seconds_of
from tidemark.operators.alerts import detect_alerts


def scenario_results(events: DataFrame, *, window: str = "10 seconds", limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Load, users, sales, latency and alerts of every scenario, from its events.

    Events are reduced to (scenario, window, user) once; windows and scenarios are then
    folded from those rows, so neither a hot user nor a large scenario is gathered.
    """
    kind = F.col("event_type")
    seconds = float(max(1, seconds_of(window)))
    per_user = events.groupBy("scenario", F.window("event_ts", window).alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(kind == "PURCHASE").alias("purchases"),
        F.count_if(kind == "VIEW_PRODUCT").alias("views"),
        F.count_if(kind == "ADD_TO_CART").alias("adds"),
        F.count_if(kind == "PAYMENT_FAILED").alias("failed"),
        F.sum(F.when(kind == "PURCHASE", F.col("payload.total_amount"))).alias("amount"),
        F.sum("latency_ms").alias("lat"),
    )
    sums = ["events", "purchases", "views", "adds", "failed", "amount", "lat"]
    per_window = per_user.groupBy("scenario", "w").agg(F.count("user_id").alias("users"), *[F.sum(c).alias(c) for c in sums])
    out = per_window.groupBy("scenario").agg(
        F.sum("events").alias("total_events"),
        F.round(F.sum("events") / F.count(F.lit(1)) / seconds, 4).alias("avg_eps"),
        F.round(F.max("events") / seconds, 4).alias("peak_eps"),
        F.max("users").alias("max_active_users"),
        F.sum("purchases").alias("purchases"),
        ratio(F.sum("purchases"), F.sum("views")).alias("conversion"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("total_revenue"),
        F.greatest(F.lit(0), F.sum("adds") - F.sum("purchases")).alias("abandoned_carts"),
        F.sum("failed").alias("failed_payments"),
        ratio(F.sum("lat"), F.sum("events")).alias("avg_latency_ms"),
    )
    raised = detect_alerts(events, limits=limits, window=window, by=["scenario"])
    alerts = raised.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts")
    )
    return out.join(alerts, "scenario", "left").fillna(0, ["alerts", "critical_alerts"])


# measure -> (column, lower is better)
CONCLUSIONS = {
    "throughput": ("avg_eps", False),
    "conversion": ("conversion", False),
    "latency": ("avg_latency_ms", True),
    "alerts": ("alerts", False),
    "revenue": ("total_revenue", False),
}

RADAR = {
    "Throughput": ("avg_eps", False),
    "Conversión": ("conversion", False),
    "Ingresos": ("total_revenue", False),
    "Latencia": ("avg_latency_ms", True),
    "Estabilidad": ("alerts", True),
    "Usuarios": ("max_active_users", False),
}


def _long(results: DataFrame, measures) -> DataFrame:
    rows = [
        F.struct(F.lit(name).alias("measure"), F.col(col).cast("double").alias("value"), F.lit(low).alias("low"))
        for name, (col, low) in measures.items()
    ]
    return results.select("scenario", F.explode(F.array(*rows)).alias("m")).select("scenario", "m.*")


def scenario_conclusions(results: DataFrame) -> DataFrame:
    """Leading and trailing scenario per measure; nothing with fewer than two scenarios.

    ratio: the larger value over the smaller one, the latter at least 1.
    """
    value, name = F.col("value"), F.col("scenario")
    sign = F.when(F.col("low"), value).otherwise(-value)
    out = _long(results, CONCLUSIONS).groupBy("measure").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.struct("scenario", "value"), F.struct(sign, name)).alias("best"),
        F.max_by(F.struct("scenario", "value"), F.struct(sign, name)).alias("worst"),
        F.max("value").alias("hi"),
        F.min("value").alias("lo"),
    )
    return out.filter(F.col("n") >= 2).select(
        "measure",
        F.col("best.scenario").alias("best"), F.col("best.value").alias("best_value"),
        F.col("worst.scenario").alias("worst"), F.col("worst.value").alias("worst_value"),
        (F.col("hi") / F.greatest(F.lit(1.0), F.col("lo"))).alias("ratio"),
    )


def normalize_for_radar(results: DataFrame) -> DataFrame:
    """0-100 min-max score per measure; inverted where less is better."""
    w = Window.partitionBy("measure")  # one row per scenario
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    norm = F.when(hi == lo, F.lit(100.0)).otherwise((F.col("value") - lo) / (hi - lo) * 100.0)
    score = F.when(F.col("low"), 100.0 - norm).otherwise(norm)
    return _long(results, RADAR).select("measure", "scenario", F.round(score, 1).alias("score"))
