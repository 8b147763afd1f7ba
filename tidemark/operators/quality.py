"""Load quality: latency percentiles, rates, reconciliation and missing deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.skew import join_null_safe

BENCHMARK_COLUMNS = (
    # fixed columns of the benchmark summary file
    "configuracion", "linger_ms", "compresion", "escenario", "segundos", "publicados", "enviados", "rechazados",
    "fallidos", "eventos_por_segundo", "latencia_p50_ms", "latencia_p95_ms", "latencia_p99_ms",
    "latencia_promedio_ms", "latencia_max_ms",
)


def exact_percentiles(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation at p * (n - 1), one column p<point> each.

    Distribution by value range: counts per distinct value, then per magnitude bucket
    (about 0.1 % wide).  Bucket offsets tell which few buckets hold the wanted ranks, and
    only those are ranked, so no group is gathered and no value list grows in memory.
    """
    for p in points:
        if not 0 <= p <= 100:
            raise ValueError(f"percentile must be between 0 and 100, not {p}")
    by = list(by)
    v = F.col(value).cast("double")
    bucket = F.floor(F.signum("v") * F.log1p(F.abs("v")) * 1000)
    counts = (
        df.filter(v.isNotNull()).groupBy(*by, v.alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("b", bucket)
    )
    buckets = counts.groupBy(*by, "b").agg(F.sum("c").alias("c"))
    order = Window.partitionBy(*by).orderBy("b")
    buckets = buckets.select(
        *by, "b",
        (F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).alias("start"),
        F.col("c").alias("size"),
        F.sum("c").over(Window.partitionBy(*by)).alias("n"),
    )
    ranks = F.array(
        *[
            F.struct(F.lit(float(p)).alias("p"), f(F.lit(p / 100.0) * (F.col("n") - 1)).cast("bigint").alias("rank"))
            for p in points
            for f in (F.floor, F.ceil)
        ]
    )
    wanted = buckets.withColumn("t", F.explode(F.array_distinct(ranks))).filter(
        (F.col("t.rank") >= F.col("start")) & (F.col("t.rank") < F.col("start") + F.col("size"))
    )
    keys = [*by, "b"]
    needed = wanted.select(*keys, "start").distinct()
    inside = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_null_safe(counts, needed, keys).withColumn("upto", F.col("start") + F.sum("c").over(inside))
    hit = ranked.select(*keys, "v", "upto", (F.col("upto") - F.col("c")).alias("from"))
    found = (
        join_null_safe(wanted.select(*keys, "n", "t.p", "t.rank"), hit, keys)
        .filter((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto")))
    )
    pair = found.groupBy(*by, "p").agg(
        F.min_by("v", "rank").alias("lo"), F.max_by("v", "rank").alias("hi"), F.max("n").alias("n")
    )
    place = F.col("p") / 100.0 * (F.col("n") - 1)
    pair = pair.withColumn("q", F.col("lo") + (F.col("hi") - F.col("lo")) * (place - F.floor(place)))
    return pair.groupBy(*by).agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(f"p{p:g}") for p in points]
    )


def latency_summary(df: DataFrame, value: str = "latency_ms", by: Sequence[str] = ()) -> DataFrame:
    """p50, p95, p99, mean and max, rounded; all zero when there is nothing to measure."""
    v = F.col(value).cast("double")
    plain = df.groupBy(*by).agg(
        F.count(v).alias("n"), (F.sum(F.col(value).cast("decimal(28,6)")).cast("double") / F.count(v)).alias("mean"), F.max(v).alias("max")
    )
    points = exact_percentiles(df, value, (50, 95, 99), by)
    if by:
        out = join_null_safe(plain, points, list(by), "left")
    else:
        p = points.agg(F.struct(*[F.max(c).alias(c) for c in ("p50", "p95", "p99")]).alias("p")).scalar()
        out = plain.withColumn("_p", p).select("n", "mean", "max", "_p.p50", "_p.p95", "_p.p99")
    rounded = [F.round(F.coalesce(F.col(c), F.lit(0.0)), 2).alias(c) for c in ("p50", "p95", "p99", "mean", "max")]
    return out.select(*by, "n", *rounded)


def rate_summary(runs: DataFrame, count: str = "enviados", seconds: str = "segundos") -> DataFrame:
    """Confirmed events per second of every run, 0 when the run took no time."""
    rate = F.when(F.col(seconds) > 0, F.round(F.col(count) / F.col(seconds), 1)).otherwise(F.lit(0.0))
    return runs.withColumn("eventos_por_segundo", rate)


def reconcile(counters: DataFrame, stored: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Problems between published, confirmed and stored counts.

    counters: published, confirmed, failed (and stored, unless given separately).
    """
    rows = counters if stored is None else counters.join(stored, list(by), "left").fillna(0, ["stored"])
    unconfirmed = F.col("published") - F.col("confirmed")
    lost = F.col("confirmed") - F.col("stored")
    return rows.select(
        *by, "published", "confirmed", "failed", "stored",
        unconfirmed.alias("unconfirmed"),
        F.greatest(F.lit(0), lost).alias("not_stored"),
        F.greatest(F.lit(0), -lost).alias("surplus"),
        F.when((unconfirmed != 0) | (F.col("failed") > 0) | (lost > 0), "LOSS").otherwise("OK").alias("verdict"),
    )


def missing_events(expected: DataFrame, consumed: DataFrame) -> DataFrame:
    """Ids that were delivered but never consumed, as a set difference.

    Repeats are folded on the map side first, so the join sees every id once per side.
    """
    return expected.distinct().join(consumed.select("event_id").distinct(), "event_id", "left_anti")


def deliveries_by_topic(deliveries: DataFrame) -> DataFrame:
    """Published and confirmed per topic and the partitions in use.

    Per (topic, partition) first; the final groups have one row per partition.
    """
    cells = deliveries.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("error").isNull() & F.col("partition").isNotNull()).alias("ok"),
    )
    return cells.groupBy("topic").agg(
        F.sum("n").alias("published"),
        F.sum("ok").alias("confirmed"),
        F.count(F.when(F.col("ok") > 0, F.col("partition"))).alias("partitions_used"),
    )


def partition_mismatch(deliveries: DataFrame) -> DataFrame:
    """Failed, unacknowledged, or wrongly placed deliveries with the reason."""
    reason = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("entrega fallida ("), F.col("error"), F.lit(")")))
        .when(F.col("partition").isNull(), F.lit("sin acuse de entrega"))
        .when(
            F.col("expected_partition").isNotNull() & (F.col("partition") != F.col("expected_partition")),
            F.concat(
                F.lit("la clave "), F.coalesce("key", F.lit("None")), F.lit(" cayó en la partición "), F.col("partition").cast("string"),
                F.lit(" y el particionador esperaba "), F.col("expected_partition").cast("string"),
            ),
        )
    )
    return deliveries.withColumn("reason", reason).filter(F.col("reason").isNotNull())
