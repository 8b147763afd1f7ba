"""The eight windowed metrics.

Each takes validated events and returns long, flat rows.  `window=None` treats the
input as one micro-window (the shape used inside foreachBatch); `by` adds group keys.
All of them are partial aggregates, so a hot window or key is reduced on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import flatten_window, money, percent, seconds_of, window_keys
from tidemark.functions.skew import top_rows


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def throughput(
    events: DataFrame, *, window: str | None = "10 seconds", slide=None, by: Sequence[str] = (), ts="event_ts", duration_sec: int | None = None
) -> DataFrame:
    """Events and events per second."""
    seconds = max(1, duration_sec if duration_sec is not None else seconds_of(window))
    out = events.groupBy(*window_keys(events, ts, window, slide), *by).agg(F.count(F.lit(1)).alias("total_events"))
    return flatten_window(out).withColumn(
        "events_per_second", F.round(F.col("total_events") / F.lit(float(seconds)), 2)
    )


def active_users(
    events: DataFrame, *, window: str | None = "60 seconds", slide=None, by: Sequence[str] = (), ts="event_ts", sample: int = 10
) -> DataFrame:
    """Distinct users and a sample of their ids (the first `sample` in id order).

    Two levels: one row per (window, user), then a count.  The sample keeps only the
    lowest ids of each window, so no id list grows with the window.
    """
    keys = window_keys(events, ts, window, slide)
    users = events.filter(F.col("user_id").isNotNull()).groupBy(*keys, *by, "user_id").agg(F.lit(1).alias("one"))
    users = flatten_window(users)
    group = [c for c in users.columns if c not in ("user_id", "one")]
    counts = users.groupBy(*group).agg(F.count(F.lit(1)).alias("active_users_count"))
    if sample <= 0:
        return counts
    lowest = top_rows(users, group, [F.col("user_id")], sample)
    ids = lowest.groupBy(*group).agg(F.sort_array(F.collect_list("user_id")).alias("unique_users_sample"))
    if not group:
        return counts.withColumn("unique_users_sample", ids.scalar())
    return counts.join(ids, group, "left")


def active_users_stream(events: DataFrame, *, window: str = "60 seconds", ts="event_instant") -> DataFrame:
    """Exact distinct users in append mode: (window, user) groups, then windows."""
    per_user = events.groupBy(F.window(ts, window), "user_id").agg(F.count(F.lit(1)).alias("n"))
    out = per_user.groupBy(F.window(F.window_time("window"), window)).agg(
        F.count(F.lit(1)).alias("active_users_count")
    )
    return flatten_window(out)


def events_by_type(
    events: DataFrame, *, window: str | None = "10 seconds", slide=None, by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """Events per type; a missing type counts as UNKNOWN."""
    kind = F.coalesce(F.col("event_type"), F.lit("UNKNOWN")).alias("event_type")
    out = events.groupBy(*window_keys(events, ts, window, slide), *by, kind).agg(F.count(F.lit(1)).alias("events"))
    return flatten_window(out)


def viewed_products(
    events: DataFrame, *, window: str | None = "60 seconds", slide=None, by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """Views per product with the name and category of the last event seen."""
    seen = events.filter(_is("VIEW_PRODUCT") & (F.length("payload.product_id") > 0)).select(
        ts,
        "arrival",
        *by,
        F.col("payload.product_id").alias("product_id"),
        F.coalesce("payload.product_name", F.lit("")).alias("product_name"),
        F.coalesce("payload.category", F.lit("")).alias("category"),
    )
    return _latest_names(seen, ts, window, slide, by, views=F.count(F.lit(1)))


def _latest_names(rows: DataFrame, ts, window, slide, by, **sums: Column) -> DataFrame:
    """Sums per product, carrying the name and category of its latest row.

    First per (product, name, category), where every buffer is fixed-width and the
    aggregate is a hash aggregate; the few name variants are then folded.
    """
    names = ["product_name", "category"]
    fine = rows.groupBy(*window_keys(rows, ts, window, slide), *by, "product_id", *names).agg(
        *[col.alias(name) for name, col in sums.items()], F.max("arrival").alias("last_arrival")
    )
    fine = flatten_window(fine)
    group = [c for c in ("window_start", "window_end") if c in fine.columns] + [*by, "product_id"]
    return fine.groupBy(*group).agg(
        *[F.max_by(n, F.struct("last_arrival", *names)).alias(n) for n in names],
        *[F.sum(name).alias(name) for name in sums],
    )


def top_viewed_products(events: DataFrame, *, k: int = 10, by: Sequence[str] = (), **how) -> DataFrame:
    counts = viewed_products(events, by=by, **how)
    group = [c for c in ("window_start", "window_end") if c in counts.columns] + list(by)
    return top_rows(counts, group, [F.desc("views"), F.col("product_id")], k, rank="position")


def purchased_items(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per purchased item with the contract's defaults for absent fields."""
    item = F.col("item")
    bought = events.filter(_is("PURCHASE")).select(
        "event_ts", "arrival", *keep, F.col("payload.order_id").alias("order_id"), F.explode("payload.items").alias("item")
    )
    return bought.filter(F.length("item.product_id") > 0).select(
        "event_ts",
        "arrival",
        *keep,
        "order_id",
        item["product_id"].alias("product_id"),
        F.coalesce(item["product_name"], F.lit("")).alias("product_name"),
        F.coalesce(item["category"], F.lit("")).alias("category"),
        F.coalesce(item["quantity"], F.lit(1)).alias("quantity"),
        F.coalesce(item["subtotal"], F.lit(0)).cast("decimal(18,2)").alias("subtotal"),
    )


def purchased_products(
    items: DataFrame, *, window: str | None = "60 seconds", slide=None, by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """Units and revenue per product over item rows."""
    sums = _latest_names(
        items, ts, window, slide, by, units=F.sum("quantity"), amount=F.sum(F.col("subtotal").cast("decimal(18,2)"))
    )
    return sums.withColumn("total_revenue", F.round(F.col("amount").cast("double"), 2)).drop("amount")


def top_purchased_products(items: DataFrame, *, k: int = 10, by: Sequence[str] = (), **how) -> DataFrame:
    """Top k by units, then revenue.  Takes item rows (see purchased_items)."""
    sums = purchased_products(items, by=by, **how)
    group = [c for c in ("window_start", "window_end") if c in sums.columns] + list(by)
    return top_rows(
        sums, group, [F.desc("units"), F.desc("total_revenue"), F.col("product_id")], k, rank="position"
    )


def purchases_by_region(
    events: DataFrame, *, window: str | None = "60 seconds", slide=None, by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """Purchases and their amount per region."""
    bought = events.filter(_is("PURCHASE"))
    region = F.coalesce(F.col("region"), F.lit(C.UNKNOWN_REGION)).alias("region")
    out = bought.groupBy(*window_keys(bought, ts, window, slide), *by, region).agg(
        F.count(F.lit(1)).alias("purchases_count"), F.round(money("payload.total_amount"), 2).alias("total_amount")
    )
    return flatten_window(out)


def conversion(
    events: DataFrame, *, window: str | None = "60 seconds", slide=None, by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """View, cart and purchase counts and the three rates between them, in percent."""
    out = events.groupBy(*window_keys(events, ts, window, slide), *by).agg(
        F.count_if(_is("VIEW_PRODUCT")).alias("views_count"),
        F.count_if(_is("ADD_TO_CART")).alias("cart_additions_count"),
        F.count_if(_is("PURCHASE")).alias("purchases_count"),
    )
    return with_rates(flatten_window(out))


def with_rates(counts: DataFrame) -> DataFrame:
    return (
        counts.withColumn("view_to_cart_rate", percent("cart_additions_count", "views_count"))
        .withColumn("cart_to_purchase_rate", percent("purchases_count", "cart_additions_count"))
        .withColumn("overall_conversion_rate", percent("purchases_count", "views_count"))
    )


def trends(
    events: DataFrame, *, window: str | None = "60 seconds", slide: str | None = "10 seconds", by: Sequence[str] = (), ts="event_ts"
) -> DataFrame:
    """Events, users, purchases and revenue per sliding window.

    Reduced per (window, user) first, so the distinct count needs no second pass over
    events and the hot user of a window is one row.
    """
    slide = slide if window else None
    per_user = sales_rows(events, ts, by).groupBy(*window_keys(events, ts, window, slide), *by, "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("bought").alias("purchases"), F.sum("amount").alias("amount")
    )
    flat = flatten_window(per_user)
    group = [c for c in ("window_start", "window_end") if c in flat.columns] + list(by)
    return flat.groupBy(*group).agg(
        F.sum("events").alias("events_count"),
        F.count("user_id").alias("active_users"),
        F.sum("purchases").alias("purchases_count"),
        F.round(F.coalesce(F.sum("amount"), F.lit(0)).cast("double"), 2).alias("total_revenue"),
    )


def sales_rows(events: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """User, sale flag and amount: cut before a sliding window copies the row per window."""
    sale = _is("PURCHASE")
    return events.select(
        ts, *by, "user_id", sale.cast("bigint").alias("bought"), F.when(sale, F.col("payload.total_amount")).alias("amount")
    )


def to_document(rows: DataFrame, keys: Sequence[str], body: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Fold bounded long rows (a top-k list, type counts) into one JSON array per key."""
    item = F.struct(*order, *[c for c in body if c not in order])
    folded = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(*[x[c].alias(c) for c in body]))
    return rows.groupBy(*keys).agg(F.to_json(F.struct(folded.alias(name))).alias("payload"))
