"""Rule-based findings over the pieces of a snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.products import leading_leak
from tidemark.operators.series import period_comparison, zscore_anomalies

# finding id -> scope, in display order (fixed values of the insight list)
SCOPES = {
    "aud-crecimiento": "audiencias",
    "aud-riesgo": "audiencias",
    "reg-top": "regiones",
    "reg-conv": "regiones",
    "prod-fuga": "productos",
    "prod-estrella": "productos",
    "evt-pico": "eventos",
    "evt-pagos": "eventos",
    "alr-componente": "alertas",
}
FAILED_TONE_PCT = 1.5
FAILED_RISK_PCT = 1.2
RISK_GROWTH_PCT = 5.0
DROP_TONE_PCT = 40.0


def _finding(df: DataFrame, name: str, tone, subject: str, value) -> DataFrame:
    place = list(SCOPES).index(name)
    tone = tone if isinstance(tone, Column) else F.lit(tone)
    return df.select(
        F.lit(place).alias("place"), F.lit(name).alias("id"), tone.alias("tone"),
        F.col(subject).cast("string").alias("subject"), value.cast("double").alias("value"),
    )


def insights(
    audiences: DataFrame, regions: DataFrame, viewed: DataFrame, purchased: DataFrame, series: DataFrame,
    shares: DataFrame, alerts: DataFrame, scope: str = "general",
) -> DataFrame:
    """Findings in display order; 4 for the general view, 3 for a single scope."""
    change = F.col("change") if "change" in audiences.columns else F.lit(0.0)
    aud = audiences.withColumn("change", change)
    up = F.when(F.col("change") >= 0, "positivo").otherwise("advertencia")
    at_risk = F.when(F.col("change") > RISK_GROWTH_PCT, "critico").otherwise("advertencia")
    top = regions.orderBy(F.desc("revenue"), "region").limit(1)
    best = regions.orderBy(F.desc("conversion"), F.desc("revenue"), "region").limit(1)
    top_name = top.select("region").scalar()
    peaks = zscore_anomalies(series).filter(F.col("kind") == "pico").orderBy(F.desc("z"), "window_start").limit(1)
    failed = shares.filter(F.col("event_type") == "PAYMENT_FAILED")
    active = alerts.filter(F.col("status") == "ACTIVA").groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    parts = {
        "aud-crecimiento": lambda: (aud.orderBy(F.desc("change"), F.desc("users"), "id").limit(1), up, "label", F.col("change")),
        "aud-riesgo": lambda: (aud.filter(F.col("audience_type") == "CARRITO_ABANDONADO"), at_risk, "label", F.col("users")),
        "reg-top": lambda: (top, "neutral", "region", F.col("national_share")),
        "reg-conv": lambda: (best.filter(F.col("region") != top_name), "positivo", "region", F.col("conversion") * 100),
        "prod-fuga": lambda: (leading_leak(viewed, purchased), "advertencia", "product_name", F.col("conversion") * 100),
        "prod-estrella": lambda: (
            purchased.orderBy(F.desc("total_revenue"), "product_id").limit(1), "positivo", "product_name", F.col("total_revenue"),
        ),
        "evt-pico": lambda: (peaks, "advertencia", "window_start", F.col("eps")),
        "evt-pagos": lambda: (
            failed, F.when(F.col("percentage") > FAILED_TONE_PCT, "critico").otherwise("neutral"), "event_type", F.col("percentage"),
        ),
        "alr-componente": lambda: (
            active.orderBy(F.desc("n"), "component").limit(1), F.when(F.col("n") > 2, "critico").otherwise("advertencia"), "component", F.col("n"),
        ),
    }
    chosen = [n for n, s in SCOPES.items() if scope in ("general", s)]
    rows = reduce(DataFrame.unionByName, [_finding(parts[n]()[0], n, *parts[n]()[1:]) for n in chosen])
    return rows.orderBy("place").limit(4 if scope == "general" else 3)


def system_summary(kpis: DataFrame, series: DataFrame, shares: DataFrame, alerts: DataFrame, regions: DataFrame) -> DataFrame:
    """One row of facts behind the summary sentence."""
    kpi = lambda name, col: kpis.filter(F.col("kpi") == name).agg(F.max(col)).scalar()
    pct = period_comparison(series).select("pct").scalar()
    failed = shares.filter(F.col("event_type") == "PAYMENT_FAILED").agg(F.max("percentage")).scalar()
    critical = alerts.agg(F.count_if((F.col("level") == "CRITICAL") & (F.col("status") == "ACTIVA"))).scalar()
    region = regions.agg(F.max_by("region", F.struct("revenue", "region"))).scalar()
    one = kpis.sparkSession.range(1).select(
        pct.alias("throughput_pct"),
        kpi("events_per_second", "value").alias("eps"),
        (kpi("purchase_conversion", "value") * 100).alias("conversion_pct"),
        kpi("purchase_conversion", "delta").alias("conversion_delta"),
        critical.alias("critical_alerts"), failed.alias("failed_pct"), region.alias("top_region"),
    )
    delta, failing = F.col("conversion_delta"), F.coalesce("failed_pct", F.lit(0.0)) > FAILED_RISK_PCT
    return one.select(
        F.when(F.col("throughput_pct") >= 0, "incremento").otherwise("reduccion").alias("direction"),
        F.abs("throughput_pct").alias("throughput_pct"),
        "eps", "conversion_pct",
        F.when(F.abs(delta) < 1, "estable").when(delta > 0, "subio").otherwise("cayo").alias("conversion_state"),
        F.when(F.col("critical_alerts") > 0, "alertas_criticas").when(failing, "pagos_rechazados").otherwise("ninguno").alias("risk"),
        F.when(F.col("critical_alerts") > 0, F.col("critical_alerts").cast("double")).when(failing, F.col("failed_pct")).alias("risk_value"),
        F.when((F.col("critical_alerts") == 0) & failing, F.col("top_region")).alias("risk_region"),
    )


def funnel_insights(stages: DataFrame, history: DataFrame, value: str = "overall_conversion_rate") -> DataFrame:
    """Worst stage of the funnel, and conversion against the first half of its history."""
    worst = stages.orderBy(F.desc("drop_from_previous"), "stage_no").limit(1).filter(F.col("drop_from_previous") > 0)
    loss = worst.select(
        F.lit("conv-fuga").alias("id"),
        F.when(F.col("drop_from_previous") > DROP_TONE_PCT, "critico").otherwise("advertencia").alias("tone"),
        F.col("stage").alias("subject"), F.col("drop_from_previous").alias("value"),
    )
    halves = period_comparison(history, value)
    trend = halves.select(
        F.lit("conv-vs-promedio").alias("id"),
        F.when(F.col("pct") >= 0, "positivo").otherwise("advertencia").alias("tone"),
        F.lit("conversion").alias("subject"), F.col("pct").alias("value"),
    )
    return loss.unionByName(trend)


def audience_overview(audiences: DataFrame) -> DataFrame:
    """Segmented users, the largest audience and the fastest growing one."""
    change = F.col("change") if "change" in audiences.columns else F.lit(0.0)
    rows = audiences.withColumn("change", change.cast("double"))
    first = lambda *order: F.min_by("audience_type", F.struct(*order))
    down = lambda c: (-F.col(c)).alias(c)
    return rows.agg(
        F.sum("users").alias("total_users"),
        F.count(F.lit(1)).alias("audiences"),
        first(down("users"), "id").alias("dominant"),
        F.max(F.struct("users", "percentage"))["percentage"].alias("dominant_percentage"),
        first(down("change"), down("users"), "id").alias("fastest_growing"),
    )
