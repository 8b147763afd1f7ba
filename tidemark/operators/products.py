"""Product, category and region analyses over (already aggregated) metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import lookup, ratio
from tidemark.functions.skew import attach_totals, top_rows

LEAK_FACTOR = 0.75  # conversion below this share of the mean is a leak


def product_dwell(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average dwell seconds per viewed product."""
    views = events.filter((F.col("event_type") == "VIEW_PRODUCT") & F.col("payload.product_id").isNotNull())
    return views.groupBy(*by, F.col("payload.product_id").alias("product_id")).agg(
        (F.sum("payload.dwell_time_ms") / F.count("payload.dwell_time_ms") / 1000.0).alias("avg_dwell_seconds")
    )


def category_share(counts: DataFrame) -> DataFrame:
    """Both levels, category and type within it, with the category's share.

    counts: event_type, events (one row per type).  Categories without events stay.
    """
    typed = counts.select(
        lookup("event_type", C.EVENT_CATEGORY, F.lit(C.DEFAULT_CATEGORY)).alias("category"), "event_type", "events"
    )
    spark = counts.sparkSession
    frame = spark.createDataFrame([(c,) for c in C.CATEGORIES], "category string")
    rolled = (
        frame.join(typed, "category", "left")
        .rollup("category", "event_type")
        .agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.grouping("category").alias("gc"), F.grouping("event_type").alias("gt"))
        .filter((F.col("gc") == 0) & ((F.col("gt") == 1) | F.col("event_type").isNotNull()))
    )
    total = F.sum(F.when(F.col("gt") == 1, F.col("events"))).over(Window.partitionBy())  # 4 + 12 rows
    cat_total = F.max(F.when(F.col("gt") == 1, F.col("events"))).over(Window.partitionBy("category"))
    return rolled.select(
        "category",
        F.coalesce("event_type", F.lit("TOTAL")).alias("event_type"),
        "events",
        (cat_total / F.when(total == 0, F.lit(1)).otherwise(total) * 100.0).alias("category_share"),
    ).orderBy("category", F.desc("events"))


def with_conversion(products: DataFrame) -> DataFrame:
    return products.withColumn("conversion", ratio("units", "views"))


def product_matrix(products: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quadrant of every product by the means of conversion and views."""
    rows = attach_totals(with_conversion(products), by, F.avg("conversion").alias("avg_conversion"), F.avg("views").alias("avg_views"))
    converts, seen = F.col("conversion") >= F.col("avg_conversion"), F.col("views") >= F.col("avg_views")
    return rows.withColumn(
        "quadrant",
        F.when(converts & seen, "estrella").when(converts, "oculto").when(seen, "fuga").otherwise("bajo"),
    )


def quadrant_groups(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return matrix.groupBy(*by, "quadrant").agg(
        F.count(F.lit(1)).alias("products"), F.sum("views").alias("views"), F.sum("units").alias("units")
    )


def product_ranking(products: DataFrame, sort_by: str = "units", k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Top k by views, units, orders or revenue, with the value relative to the largest."""
    top = top_rows(products, list(by), [F.desc(sort_by), F.col("product_id")], k, rank="position")
    peak = F.greatest(F.lit(1.0), F.max(F.col(sort_by).cast("double")).over(Window.partitionBy(*by)))  # at most k rows
    return top.withColumn("relative", F.col(sort_by) / peak)


def region_ranking(regions: DataFrame, metric: str = "purchases", by: Sequence[str] = ()) -> DataFrame:
    """Regions by one measure, with min-max intensity (floor at 0, ceiling at least 1)."""
    group = Window.partitionBy(*by)  # one row per region
    low = F.least(F.lit(0.0), F.min(F.col(metric).cast("double")).over(group))
    high = F.greatest(F.lit(1.0), F.max(F.col(metric).cast("double")).over(group))
    return regions.withColumn(
        "position", F.row_number().over(group.orderBy(F.desc(metric), "region"))
    ).withColumn("intensity", F.when(high == low, F.lit(0.5)).otherwise((F.col(metric) - low) / (high - low)))


def product_leaks(viewed: DataFrame, purchased: DataFrame) -> DataFrame:
    """Products that convert below 0.75 of the mean, most viewed first, and the star.

    One row per finding: LEAK rows ranked by views, and the STAR with most revenue.
    """
    rows = attach_totals(with_conversion(viewed), [], F.avg("conversion").alias("avg_conversion"))
    leaks = rows.filter(F.col("conversion") < F.col("avg_conversion") * LEAK_FACTOR).select(
        F.lit("LEAK").alias("finding"), "product_id", "product_name", "views", "units",
        F.col("conversion"), "avg_conversion", F.col("revenue").cast("double").alias("revenue"),
    )
    star = purchased.orderBy(F.desc("total_revenue"), "product_id").limit(1).select(
        F.lit("STAR").alias("finding"), "product_id", "product_name", F.lit(None).cast("bigint").alias("views"), "units",
        F.lit(None).cast("double").alias("conversion"), F.lit(None).cast("double").alias("avg_conversion"),
        F.col("total_revenue").alias("revenue"),
    )
    return leaks.unionByName(star)


def leading_leak(viewed: DataFrame, purchased: DataFrame) -> DataFrame:
    """The most viewed leak, if there is one."""
    found = product_leaks(viewed, purchased).filter(F.col("finding") == "LEAK")
    return found.orderBy(F.desc("views"), "product_id").limit(1)
