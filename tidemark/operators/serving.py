"""Serving queries: result tables to the pieces of a dashboard snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import change_pct, lookup, percent, ratio
from tidemark.functions.skew import newest_rows, top_rows

LATEST_ORDER = ("window_end", "id")


def normalize_scenario(value: str | None) -> str:
    name = (value or "BASE").upper()
    return name if name in C.SCENARIOS else "BASE"


def latest_metrics(metrics: DataFrame, order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Newest row of every metric type; ties on the window end go to the higher id."""
    body = [c for c in metrics.columns if c != "metric_type"]
    newest = F.max_by(F.struct(*body), F.struct(*order)).alias("row")
    return metrics.groupBy("metric_type").agg(newest).select("metric_type", "row.*")


def metric_history(metrics: DataFrame, n: int = 24, order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Last n rows of every metric type; position 1 is the oldest of them."""
    last = top_rows(metrics, ["metric_type"], [F.desc(c) for c in order], n)
    oldest_first = Window.partitionBy("metric_type").orderBy(*order)  # at most n rows
    return last.withColumn("position", F.row_number().over(oldest_first))


def profile_stats(events: DataFrame, scenario: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Users, purchases, revenue and purchases per user for every profile.

    One row per (profile, user) first: the distinct count is then a plain count and a
    hot user is a single row.
    """
    bought = F.col("event_type") == "PURCHASE"
    rows = events if scenario is None else events.filter(F.col("scenario") == scenario)
    per_user = rows.groupBy(*by, "agent_profile", "user_id").agg(
        F.count_if(bought).alias("p"), F.sum(F.when(bought, F.col("payload.total_amount"))).alias("r")
    )
    out = per_user.groupBy(*by, F.col("agent_profile").alias("profile")).agg(
        F.count("user_id").alias("users"),
        F.sum("p").alias("purchases"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("double").alias("revenue"),
    )
    return out.withColumn("conversion", F.col("purchases") / F.greatest(F.lit(1), F.col("users"))).orderBy(
        F.desc("users"), "profile"
    )


def source_share(events: DataFrame, scenario: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    rows = events if scenario is None else events.filter(F.col("scenario") == scenario)
    counts = rows.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("events"))
    total = F.sum("events").over(Window.partitionBy(*by))  # a handful of sources per group
    return counts.withColumn("share", percent("events", total, 1)).orderBy(F.desc("events"), "source")


def alert_feed(alerts: DataFrame, n: int = 50, scenario: str = "BASE") -> DataFrame:
    """Newest n alerts; those of the latest window among them are the active ones."""
    newest = alerts.orderBy(F.desc("detected_at"), "alert_id").limit(n)
    at = F.coalesce("window_end", "detected_at")
    latest = F.max(at).over(Window.partitionBy())  # at most n rows
    return newest.select(
        F.col("alert_id").alias("id"),
        F.when(F.col("severity").isin(*C.ALERT_LEVELS), F.col("severity")).otherwise("WARNING").alias("level"),
        F.initcap(F.regexp_replace("alert_type", "_", " ")).alias("title"),
        F.col("message").alias("description"),
        F.col("detected_at").alias("timestamp"),
        F.lit(C.ALERT_COMPONENT).alias("component"),
        F.lit(scenario).alias("scenario"),
        F.when(at == latest, "ACTIVA").otherwise("RECONOCIDA").alias("status"),
    )


def events_by_type_share(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Category and share of the total for every event type."""
    total = F.sum("events").over(Window.partitionBy(*by))  # one row per event type
    return counts.select(
        *by,
        "event_type",
        lookup("event_type", C.EVENT_CATEGORY, F.lit(C.DEFAULT_CATEGORY)).alias("category"),
        "events",
        F.round(F.col("events") / F.greatest(F.lit(1), total) * 100.0, 2).alias("percentage"),
    )


def event_type_heatmap(
    events: DataFrame, scenario: str | None = None, *, buckets: int = 12, cap: int | None = 8000, unit: str = "minute", ts="event_ts"
) -> DataFrame:
    """Counts per (time bucket, type) of the newest events, zeros included.

    cap is the feature's own row limit: the newest `cap` events, a top-k by time.
    Buckets are keyed by timestamp, so equal clock minutes of two days stay apart.
    """
    rows = events if scenario is None else events.filter(F.col("scenario") == scenario)
    rows = rows.select(ts, "arrival", "event_type")
    if cap is not None:
        rows = newest_rows(rows, ts, "arrival", cap, unit)
    counts = rows.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    # Twelve types per bucket: the grid is spelled out from one row per bucket.
    kinds = F.array(*[F.lit(k) for k in C.EVENT_TYPES])
    per_bucket = counts.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    newest = per_bucket.orderBy(F.desc("bucket")).limit(buckets)
    grid = newest.select("bucket", "m", F.explode(kinds).alias("event_type"))
    return grid.select(
        "bucket",
        F.date_format("bucket", "HH:mm").alias("label"),
        "event_type",
        F.coalesce(F.col("m")[F.col("event_type")], F.lit(0)).alias("events"),
    )


def product_view_purchase_join(viewed: DataFrame, purchased: DataFrame, by: Sequence[str] = (), orders: DataFrame | None = None) -> DataFrame:
    """Viewed products with their purchases (0 when none).

    orders: distinct orders per product when known, else the unit count.
    """
    keys = [*by, "product_id"]
    bought = purchased.select(*keys, "units", F.col("total_revenue").alias("revenue"))
    out = viewed.select(*keys, "product_name", "category", "views").join(bought, keys, "left")
    if orders is not None:
        out = out.join(orders.select(*keys, "orders"), keys, "left")
    else:
        out = out.withColumn("orders", F.col("units"))
    zero = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    return out.select(
        *keys, "product_name", "category", "views", zero("units", "bigint"), zero("orders", "bigint"), zero("revenue", "double")
    )


def product_orders(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct orders per product."""
    pairs = items.groupBy(*by, "product_id", "order_id").agg(F.lit(1).alias("one"))
    return pairs.groupBy(*by, "product_id").agg(F.count("order_id").alias("orders"))


def funnel(conversion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The three stages in order with the loss from the stage before, in percent."""
    columns = ("views_count", "cart_additions_count", "purchases_count")
    stages = [
        F.struct(F.lit(i + 1).alias("stage_no"), F.lit(key).alias("stage"), F.lit(label).alias("label"), F.col(col).alias("value"),
                 (F.col(columns[i - 1]) if i else F.lit(None).cast("bigint")).alias("previous"))
        for i, ((key, label), col) in enumerate(zip(C.FUNNEL_STAGES, columns))
    ]
    out = conversion.select(*by, F.explode(F.array(*stages)).alias("s")).select(*by, "s.*")
    return out.select(
        *by, "stage_no", "stage", "label", "value",
        percent(F.coalesce(F.col("previous") - F.col("value"), F.lit(0)), F.coalesce("previous", F.lit(0))).alias("drop_from_previous"),
    )


def region_stats(regions: DataFrame, totals: DataFrame | None = None, by: Sequence[str] = (), active_users=None, conversion=None) -> DataFrame:
    """Label, share, ticket per region, with the global conversion and an even split of users.

    active_users and conversion are literals, columns, or scalar subqueries.
    """
    amount = F.sum("total_amount").over(Window.partitionBy(*by))  # one row per region
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    lit = lambda v: v if isinstance(v, Column) else F.lit(v if v is not None else 0)
    out = regions.select(
        *by,
        lookup(F.upper("region"), C.REGION_LABELS, F.col("region")).alias("region"),
        F.col("purchases_count").alias("purchases"),
        F.col("total_amount").alias("revenue"),
        F.round(F.col("total_amount") / F.greatest(F.lit(1.0), amount) * 100.0, 2).alias("national_share"),
        (F.col("total_amount") / F.greatest(F.lit(1), F.col("purchases_count"))).alias("avg_ticket"),
        n.alias("_n"),
    )
    return (
        out.withColumn("conversion", lit(conversion).cast("double"))
        .withColumn("active_users", F.bround(lit(active_users) / F.greatest(F.lit(1), F.col("_n"))).cast("bigint"))
        .drop("_n")
    )


def region_activity(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True per-region users and conversion from the events themselves."""
    kind = F.col("event_type")
    per_user = events.groupBy(*by, "region", "user_id").agg(
        F.count_if(kind == "VIEW_PRODUCT").alias("v"), F.count_if(kind == "PURCHASE").alias("p")
    )
    return per_user.groupBy(*by, "region").agg(
        F.count("user_id").alias("active_users"), F.sum("p").alias("purchases"), F.sum("v").alias("views")
    ).withColumn("conversion", ratio("purchases", "views"))


def audience_summary(classifications: DataFrame) -> DataFrame:
    """One row for each of the seven audiences, zeros included."""
    added = classifications.filter(F.col("action") == "ADDED")
    per_user = added.groupBy("audience_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("c"), F.max("detected_at").alias("seen")
    )
    stats = per_user.groupBy("audience_type").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("recent_detections"),
        F.sum("c").alias("confidence"),
        F.max("seen").alias("last_seen"),
    )
    # The eight newest detections of each audience, then their distinct users in order.
    newest = top_rows(
        added.select("audience_type", "user_id", "detected_at", "evidence"),
        ["audience_type"], [F.desc("detected_at"), F.col("user_id")], 8, rank="pos",
    )
    heads = newest.groupBy("audience_type").agg(
        F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("pos", "user_id"))), lambda x: x["user_id"])).alias("sample_users"),
        F.min_by("evidence", "pos").alias("evidence"),
    )
    found = stats.join(heads, "audience_type", "left")
    total = F.sum("users").over(Window.partitionBy())  # seven rows
    meta = audience_meta(classifications.sparkSession)
    out = meta.join(found, "audience_type", "left")
    users = F.coalesce("users", F.lit(0)).cast("bigint")
    return out.select(
        F.lower(F.regexp_replace("audience_type", "_", "-")).alias("id"),
        "audience_type", "label", "priority",
        users.alias("users"),
        F.round(users / F.greatest(F.lit(1), F.coalesce(total, F.lit(0))) * 100.0, 2).alias("percentage"),
        F.coalesce("recent_detections", F.lit(0)).cast("bigint").alias("recent_detections"),
        ratio(F.coalesce("confidence", F.lit(0.0)), F.coalesce("recent_detections", F.lit(0))).alias("avg_confidence"),
        "last_seen", "evidence", "sample_users",
    ).orderBy(F.desc("users"), "id")


def audience_meta(spark) -> DataFrame:
    rows = [(k, label, priority) for k, (label, priority) in C.AUDIENCES.items()]
    return spark.createDataFrame(rows, "audience_type string, label string, priority string")


KPI_SOURCES = {
    # kpi -> (metric type, payload field), tried in order; 0 counts as missing.
    "active_users": (("active_users", "active_users_count"),),
    "events_per_second": (("throughput", "events_per_second"),),
    "purchase_conversion": (("conversion", "overall_conversion_rate"),),
    "total_purchases": (("trends", "purchases_count"), ("conversion", "purchases_count")),
    "total_revenue": (("trends", "total_revenue"),),
    "total_processed": (("throughput", "total_events"), ("trends", "events_count")),
}


def kpi_snapshot(metrics: DataFrame, alerts: DataFrame, order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """Current KPIs and their change against the row before, as one row per KPI."""
    two = top_rows(metrics, ["metric_type"], [F.desc(c) for c in order], 2, rank="age")
    value = lambda kind, name, age: F.max(
        F.when((F.col("metric_type") == kind) & (F.col("age") == age), F.get_json_object("payload", f"$.{name}").cast("double"))
    )
    wide = two.agg(
        *[value(kind, name, age).alias(f"{kind}__{name}__{age}")
          for kind, name in sorted({p for ps in KPI_SOURCES.values() for p in ps}) for age in (1, 2)]
    )
    pick = lambda paths, age: F.coalesce(
        *[F.nullif(F.col(f"{kind}__{name}__{age}"), F.lit(0.0)) for kind, name in paths], F.lit(0.0)
    )
    scale = lambda kpi, col: col / 100.0 if kpi == "purchase_conversion" else col
    entries = [
        F.struct(F.lit(kpi).alias("kpi"), scale(kpi, pick(paths, 1)).alias("value"), scale(kpi, pick(paths, 2)).alias("previous"))
        for kpi, paths in KPI_SOURCES.items()
    ]
    active = alerts.filter(F.col("status") == "ACTIVA").agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    entries.append(F.struct(F.lit("active_alerts").alias("kpi"), active.alias("value"), F.lit(None).cast("double").alias("previous")))
    rows = wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return rows.select("kpi", "value", change_pct("value", "previous").alias("delta"))


def pipeline_health(events: DataFrame, runs: DataFrame, metrics: DataFrame, audiences: DataFrame, alerts_count: Column, processed: Column) -> DataFrame:
    """Messages, errors and status for each of the seven pipeline stages.

    Every input is reduced to one row and read as a scalar subquery.
    """
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    sums = runs.agg(
        F.struct(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("publicados", "enviados", "rechazados", "fallidos")]).alias("s")
    ).scalar()
    one = events.sparkSession.range(1).select(
        count(events).alias("raw"), sums.alias("s"), count(metrics).alias("metrics"), count(audiences).alias("audiences"),
        alerts_count.cast("bigint").alias("alerts"), processed.cast("bigint").alias("processed"),
    )
    facts = one.select(
        "raw", "processed", "metrics",
        (F.col("metrics") + F.col("audiences") + F.col("alerts")).alias("output"),
        F.greatest("s.publicados", "raw", "processed").alias("produced"),
        F.greatest("s.enviados", "raw", "processed").alias("delivered"),
        F.col("s.rechazados").alias("rejected"),
        F.col("s.fallidos").alias("failed"),
    )
    col, zero = F.col, F.lit(0).cast("bigint")
    healthy = (col("raw") > 0) | (col("processed") > 0) | (col("output") > 0)
    ok = F.when(healthy, "OPERATIVO").otherwise("DEGRADADO")
    up = F.lit("OPERATIVO")
    stages = [
        ("simuladores", col("produced") + col("rejected"), col("rejected"), ok),
        ("productores", col("delivered"), col("failed"), ok),
        ("kafka", F.greatest("raw", "delivered", "processed"), col("failed"), ok),
        ("flink", F.greatest("processed", "output"), zero, F.when(col("metrics") == 0, "DEGRADADO").otherwise(ok)),
        ("backend", col("output"), zero, up),
        ("transporte", col("output"), zero, up),
        ("dashboard", col("output"), zero, up),
    ]
    rows = [
        F.struct(F.lit(n).alias("stage"), m.cast("bigint").alias("messages_processed"), e.cast("bigint").alias("errors"), s.alias("status"))
        for n, m, e, s in stages
    ]
    return facts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def audit_counts(events: DataFrame, runs: DataFrame, metrics: DataFrame, audiences: DataFrame, alerts: DataFrame, last_runs: int = 5) -> DataFrame:
    """Rows per topic, metric type, audience and alert kind, and the last runs."""
    n = F.count(F.lit(1)).alias("rows")
    part = lambda df, section, *keys: df.groupBy(F.concat_ws("/", *keys).alias("key")).agg(n).select(F.lit(section).alias("section"), "key", "rows")
    newest = runs.orderBy(F.desc("started_at"), "run_id").limit(last_runs)
    return (
        part(events, "topic", "kafka_topic")
        .unionByName(part(metrics, "metric", "metric_type"))
        .unionByName(part(audiences, "audience", "audience_type"))
        .unionByName(part(alerts, "alert", "alert_type", "severity"))
        .unionByName(newest.select(F.lit("run").alias("section"), F.col("run_id").alias("key"), F.col("enviados").cast("bigint").alias("rows")))
    )
