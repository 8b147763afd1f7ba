"""Operations on the alert feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as C


def alert_filter(feed: DataFrame, level: str | None = None, status: str | None = None, text: str = "") -> DataFrame:
    """Alerts by level, status and text in title or component, newest first."""
    rows = feed
    if level:
        rows = rows.filter(F.col("level") == level)
    if status:
        rows = rows.filter(F.col("status") == status)
    if text:
        needle = text.lower()
        rows = rows.filter(F.lower("title").contains(needle) | F.lower("component").contains(needle))
    return rows.orderBy(F.desc("timestamp"), "id")


def alert_counts(feed: DataFrame) -> DataFrame:
    """Active alerts per level, zeros included, with the feed's totals."""
    spark = feed.sparkSession
    levels = spark.createDataFrame([(v,) for v in C.ALERT_LEVELS], "level string")
    active = feed.filter(F.col("status") == "ACTIVA").groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    every = Window.partitionBy()  # three rows
    return levels.join(active, "level", "left").select(
        "level",
        n.alias("active"),
        F.sum(n).over(every).alias("active_total"),
        F.sum(F.when(F.col("level") == "CRITICAL", n).otherwise(0)).over(every).alias("critical_total"),
    )


def alerts_by_component(feed: DataFrame) -> DataFrame:
    return feed.groupBy("component").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("status") == "ACTIVA").alias("active")
    )


def alert_timeline(feed: DataFrame) -> DataFrame:
    """Position 0..1 of every alert between the first and the last (last = first + 1 ms if equal)."""
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("timestamp"))
    span = feed.agg(F.struct(F.min(ms).alias("lo"), F.max(ms).alias("hi")).alias("s")).scalar()
    hi = F.when(F.col("_s.hi") == F.col("_s.lo"), F.col("_s.lo") + 1).otherwise(F.col("_s.hi"))
    return feed.withColumn("_s", span).withColumn("at", (ms - F.col("_s.lo")) / (hi - F.col("_s.lo"))).drop("_s")


def components_degraded(health: DataFrame) -> DataFrame:
    return health.agg(F.count_if(F.col("status") != "OPERATIVO").alias("degraded"))


def alert_status_overlay(feed: DataFrame, acks: DataFrame) -> DataFrame:
    """The operator's status (acknowledged, resolved) wins over the feed's."""
    mine = acks.select("id", F.col("status").alias("_status"))
    out = feed.join(mine, "id", "left").withColumn("status", F.coalesce("_status", "status"))
    return out.drop("_status")


def mean_ack_minutes(feed: DataFrame, now: Column) -> DataFrame:
    """Mean age in minutes of handled alerts, each between 0.5 and 45; 0 if none."""
    age = F.timestamp_diff("MILLISECOND", F.col("timestamp"), now) / 60000.0
    clipped = F.least(F.lit(45.0), F.greatest(F.lit(0.5), age))
    handled = feed.filter(F.col("status") != "ACTIVA")
    return handled.agg(
        F.coalesce(F.avg(clipped), F.lit(0.0)).alias("mean_ack_minutes"), F.count(F.lit(1)).alias("handled")
    )
