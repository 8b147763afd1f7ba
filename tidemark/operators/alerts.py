"""Anomaly alerts per window.

All eight rules read one aggregation per window; the traffic rules also read a moving
baseline over the (already reduced) window rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import AlertLimits
from tidemark.functions.expr import flatten_window, micros, ratio, seconds_of, to_utc_ntz, window_keys
from tidemark.functions.skew import join_null_safe
from tidemark.sources.scratch import cut_lineage

SECOND = 1_000_000  # microseconds

# type -> (id prefix, severity): fixed values of the alert contract.
ALERTS = {
    "TRAFFIC_SPIKE": ("ALT_SPIKE_", "WARNING"),
    "TRAFFIC_DROP": ("ALT_DROP_", "CRITICAL"),
    "HIGH_PAYMENT_FAILURE_RATE": ("ALT_PAYMENT_", "CRITICAL"),
    "HIGH_VALUE_PAYMENT_FAILURE": ("ALT_PAYMENT_AMOUNT_", "CRITICAL"),
    "HIGH_VALUE_CART": ("ALT_CART_", "CRITICAL"),
    "SEARCH_PRESSURE_NO_PURCHASE": ("ALT_SEARCH_", "WARNING"),
    "HIGH_CART_ACTIVITY": ("ALT_CART_ACTIVITY_", "WARNING"),
    "HIGH_LATENCY": ("ALT_LATENCY_", "WARNING"),
}


def kind(name: str) -> Column:
    return F.col("event_type") == name


def window_facts(
    events: DataFrame, limits: AlertLimits, *, window: str | None = "10 seconds", by: Sequence[str] = (), ts="event_ts", carts: bool = True
) -> DataFrame:
    """Everything the rules need, one partial aggregate per window.

    All buffers are fixed-width numbers, so this is a hash aggregate.  The first big cart
    also needs its user, a text; it comes from the few rows over the limit (a filter the
    scan can push down) and is joined per window.
    """
    failed = F.when(kind("PAYMENT_FAILED"), F.coalesce("payload.total_amount", F.lit(0)).cast("decimal(18,2)"))
    keys = window_keys(events, ts, window, None)
    out = events.groupBy(*keys, *by).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(kind("PURCHASE")).alias("purchases"),
        F.count_if(kind("PAYMENT_FAILED")).alias("payment_fails"),
        F.max(failed).cast("double").alias("max_failed"),
        F.count_if(kind("SEARCH")).alias("searches"),
        F.count_if(kind("ADD_TO_CART") | kind("REMOVE_FROM_CART")).alias("cart_edits"),
        F.sum("latency_ms").alias("latency_sum"),
        F.count("latency_ms").alias("latency_n"),
    )
    seconds = limits.duration_sec or (seconds_of(window) if window else 10)
    facts = flatten_window(out).withColumn("eps", F.col("total_events") / F.lit(float(seconds)))
    if not carts:
        return facts.withColumn("big_cart", F.lit(None).cast("struct<value: double, user_id: string>"))
    cart_value = F.coalesce("payload.cart_value_after", "payload.total_amount", F.lit(0)).cast("double")
    big = events.filter(F.col("event_type").isin("ADD_TO_CART", "PURCHASE") & (cart_value >= limits.high_cart))
    first = flatten_window(
        big.groupBy(*keys, *by).agg(F.min_by(F.struct(cart_value.alias("value"), "user_id"), "arrival").alias("big_cart"))
    )
    group = [c for c in first.columns if c != "big_cart"]
    if not group:
        return facts.withColumn("big_cart", first.scalar())
    return facts.join(first, group, "left")


#: Elements of a unit of the baseline's scan, and time chunks of a unit of its second level.
UNIT_ROWS, UNIT_CHUNKS = 1024, 256


def _scan(maps: DataFrame, unit: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Compose the linear maps b -> _d * b + _s of each unit up to each row, and (_d0, _s0) up to the one before.

    Composition is associative, so ten doubling steps cover a unit; all share one
    partitioning and order.  Nothing is divided: products may fade to zero, never overflow.
    """
    w = Window.partitionBy(*unit).orderBy(*order)
    step = 1
    while step < UNIT_ROWS:
        maps = maps.withColumns({
            "_d": F.col("_d") * F.lag("_d", step, 1.0).over(w),
            "_s": F.col("_d") * F.lag("_s", step, 0.0).over(w) + F.col("_s"),
        })
        step *= 2
    return maps.withColumns({"_d0": F.lag("_d", 1, 1.0).over(w), "_s0": F.lag("_s", 1, 0.0).over(w)})


def _units(rows: DataFrame, coarse: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number units of at most UNIT_ROWS rows inside each coarse unit."""
    w = Window.partitionBy(*coarse).orderBy(*order)
    return rows.withColumn(name, F.floor((F.row_number().over(w) - 1) / F.lit(UNIT_ROWS)))


def _totals(scanned: DataFrame, unit: Sequence[str], order: Sequence[str], *more: Column) -> DataFrame:
    """The whole map of each scanned unit: that of its last row."""
    last = F.max_by(F.struct("_d", "_s"), F.struct(*order)).alias("_m")
    return scanned.groupBy(*unit).agg(last, *more).withColumns({"_d": F.col("_m._d"), "_s": F.col("_m._s")}).drop("_m")


def eps_baseline(
    windows: DataFrame,
    *,
    alpha: float = 0.1,
    init: float | str = 50.0,
    by: Sequence[str] = (),
    value: str = "eps",
    order: str = "window_start",
    chunk: str = "3 hours",
    out: str = "baseline",
    gap: str | None = None,
) -> DataFrame:
    """Exponential moving average *before* each window: b <- alpha * eps + (1 - alpha) * b.

    Each window is a linear map of b.  Up: maps are composed inside units of a time chunk,
    and units again inside units of 256 chunks; what is left, one map per 32 days (by
    default) and per million windows, is folded per group.  Down: each unit's start gives
    the starts of its parts.  All windows of a group count, whatever alpha is.

    init is the first baseline, or the name of a column that holds it per group (the
    level carried over from an earlier batch).  gap names a column with the number of empty
    windows before each row; a run of n of them is the map b -> (1 - alpha)^n * b, and the
    level before the run is kept as `<out>_before_gap`.
    """
    by = list(by)
    initial = F.col(init) if isinstance(init, str) else F.lit(float(init))
    span = seconds_of(chunk) * 1_000_000
    one, two = [*by, "_chunk", "_unit"], [*by, "_age", "_unit2"]
    places = ["_chunk", "_unit"]
    rows = windows.withColumns({
        "_chunk": F.floor(micros(order) / F.lit(span)), "_s": F.col(value).cast("double") * F.lit(alpha),
        "_d": F.lit(1.0 - alpha) if gap is None else F.pow(F.lit(1.0 - alpha), F.col(gap) + 1),
    })
    rows = _scan(_units(rows, [*by, "_chunk"], [order], "_unit"), one, [order])
    units = _totals(rows, one, [order], F.max(initial).alias("_init")).withColumn("_age", F.floor(F.col("_chunk") / F.lit(UNIT_CHUNKS)))
    units = _scan(_units(units, [*by, "_age"], places, "_unit2"), two, places)
    ages = _totals(units, two, places, F.max("_init").alias("_init"))
    # One list per group, of a row per unit of the second level.
    listed = ages.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_age", "_unit2", "_d", "_s"))).alias("_all"), F.max("_init").alias("_init"))
    folded = F.aggregate(
        "_all",
        F.struct(F.col("_init").cast("double").alias("level"), F.expr("CAST(array() AS ARRAY<DOUBLE>)").alias("starts")),
        lambda b, x: F.struct((x["_d"] * b["level"] + x["_s"]).alias("level"), F.array_append(b["starts"], b["level"]).alias("starts")),
    )
    each = F.zip_with("_all", folded["starts"], lambda x, b: F.struct(x["_age"].alias("_age"), x["_unit2"].alias("_unit2"), b.alias("_start")))
    starts = listed.select(*by, F.explode(each).alias("_u")).select(*by, "_u.*")
    level = F.col("_d0") * F.col("_start") + F.col("_s0")
    units = join_null_safe(units, starts, two).select(*one, level.alias("_start"))
    rows = join_null_safe(rows, units, one).withColumn(out, level).drop("_chunk", "_unit", "_d", "_s", "_d0", "_s0", "_start")
    if gap is not None:
        rows = rows.withColumns({f"{out}_before_gap": F.col(out), out: F.col(out) * F.pow(F.lit(1.0 - alpha), F.col(gap))})
    return rows


def alert_rows(facts: DataFrame, limits: AlertLimits, *, by: Sequence[str] = (), only: Sequence[str] | None = None) -> DataFrame:
    """Zero to many alerts per window from the facts (with `baseline` for traffic)."""
    c = limits
    f = F.col
    attempts = f("purchases") + f("payment_fails")
    fail_pct = ratio("payment_fails", attempts) * 100.0
    latency = ratio("latency_sum", "latency_n")
    spike = (f("eps") > c.spike_multiplier * f("baseline")) & (f("total_events") > c.spike_min_events)
    drop = ~spike & (f("eps") < c.drop_multiplier * f("baseline")) & (f("baseline") > c.drop_min_baseline)
    expected = F.concat(
        F.round("eps", 1).cast("string"), F.lit(" ev/s (Media esperada: "), F.round("baseline", 1).cast("string"), F.lit(" ev/s)")
    )
    # alert type -> (condition, value, threshold, message)
    rules = {
        "TRAFFIC_SPIKE": (spike, f("eps"), c.spike_multiplier * f("baseline"), F.concat(F.lit("Spike de tráfico detectado: "), expected)),
        "TRAFFIC_DROP": (drop, f("eps"), c.drop_multiplier * f("baseline"), F.concat(F.lit("Caída drástica de tráfico: "), expected)),
        "HIGH_PAYMENT_FAILURE_RATE": (
            (attempts >= c.payment_min_attempts) & (fail_pct >= c.payment_fail_pct),
            fail_pct,
            F.lit(c.payment_fail_pct),
            F.concat(F.lit("Tasa de fallos en pasarela de pago inusualmente alta: "), F.round(fail_pct, 1).cast("string"), F.lit("%")),
        ),
        "HIGH_VALUE_PAYMENT_FAILURE": (
            f("max_failed") >= c.critical_payment,
            f("max_failed"),
            F.lit(c.critical_payment),
            F.concat(F.lit("Pago fallido de alto monto detectado: S/ "), F.round("max_failed", 2).cast("string")),
        ),
        "HIGH_VALUE_CART": (
            f("big_cart").isNotNull(),
            f("big_cart.value"),
            F.lit(c.high_cart),
            F.concat(
                F.lit("Carrito/compra por monto inusual detectado: S/ "), F.round("big_cart.value", 2).cast("string"),
                F.lit(" (Usuario: "), f("big_cart.user_id"), F.lit(")"),
            ),
        ),
        "SEARCH_PRESSURE_NO_PURCHASE": (
            (f("searches") >= c.search_min) & (f("purchases") == 0),
            f("searches"),
            F.lit(float(c.search_min)),
            F.concat(F.lit("Alta actividad de busqueda sin compras en la ventana: "), f("searches").cast("string"), F.lit(" busquedas")),
        ),
        "HIGH_CART_ACTIVITY": (
            f("cart_edits") >= c.cart_activity_min,
            f("cart_edits"),
            F.lit(float(c.cart_activity_min)),
            F.concat(F.lit("Actividad elevada de carrito: "), f("cart_edits").cast("string"), F.lit(" altas/remociones en la ventana")),
        ),
        "HIGH_LATENCY": (
            (f("latency_n") > 0) & (latency >= c.high_latency_ms),
            latency,
            F.lit(c.high_latency_ms),
            F.concat(F.lit("Latencia de ingestión elevada: "), F.round(latency, 1).cast("string"), F.lit(" ms")),
        ),
    }
    hits = []
    for name in only or rules:
        condition, value, threshold, message = rules[name]
        prefix, severity = ALERTS[name]
        hits.append(
            F.when(
                condition,
                F.struct(
                    F.lit(prefix).alias("prefix"),
                    F.lit(name).alias("alert_type"),
                    F.lit(severity).alias("severity"),
                    message.alias("message"),
                    F.round(value.cast("double"), 2).alias("current_value"),
                    F.round(threshold.cast("double"), 2).alias("threshold_value"),
                ),
            )
        )
    keys = [c for c in ("window_start", "window_end") if c in facts.columns]
    # A repeatable id makes the alert upsert idempotent when a batch is retried.
    identity = F.concat_ws("|", f("hit.alert_type"), *[f(k).cast("string") for k in [*keys, *by]])
    return facts.withColumn("hit", F.explode(F.array_compact(F.array(*hits)))).select(
        F.concat(f("hit.prefix"), F.substring(F.sha2(identity, 256), 1, 8)).alias("alert_id"),
        "hit.alert_type", "hit.severity", "hit.message", "hit.current_value", "hit.threshold_value", *keys, *by,
        # A window is judged when it is complete; without one, now.
        (f("window_end") if "window_end" in keys else to_utc_ntz(F.current_timestamp())).alias("detected_at"),
    )


def detect_alerts(
    events: DataFrame,
    *,
    limits: AlertLimits = AlertLimits(),
    window: str = "10 seconds",
    by: Sequence[str] = (),
    only: Sequence[str] | None = None,
    zero_fill: bool = False,
) -> DataFrame:
    """All alert rules over every non-empty window.

    zero_fill also judges the traffic of windows without events between the first and the
    last one (the default, like the stream it models, never sees an empty window).  They
    are kept as runs and made one by one only where a drop is reported.
    """
    names = list(only or ALERTS)
    facts = window_facts(events, limits, window=window, by=by, carts="HIGH_VALUE_CART" in names)
    traffic = any(n.startswith("TRAFFIC") for n in names)
    if not traffic:
        return alert_rows(facts.withColumn("baseline", F.lit(None).cast("double")), limits, by=by, only=names)
    levels = dict(alpha=limits.baseline_alpha, init=limits.baseline_init, by=by)
    # The baseline reads the window rows twice; one small written table (a row per
    # window) keeps that from being two scans of the events.
    facts = cut_lineage(facts, "window-facts")
    if not zero_fill:
        return alert_rows(eps_baseline(facts, **levels), limits, by=by, only=names)
    leveled = eps_baseline(with_gaps(facts, window, by), **levels, gap="gap")
    found = alert_rows(leveled, limits, by=by, only=names)
    return found.unionByName(alert_rows(empty_windows(leveled, limits, window), limits, by=by, only=["TRAFFIC_DROP"])) if "TRAFFIC_DROP" in names else found


def with_gaps(facts: DataFrame, window: str, by: Sequence[str] = (), segment: str = "1 day") -> DataFrame:
    """Add the number of empty windows between each window and the non-empty one before it (0 for the first).

    The window before is looked for inside time segments; only the first row of a segment
    needs an earlier segment's last window, and one row per segment takes part in that.
    """
    by, step = list(by), seconds_of(window) * SECOND
    cut = facts.withColumn("_segment", F.floor(micros("window_start") / F.lit(seconds_of(segment) * SECOND)))
    inside = F.lag("window_end").over(Window.partitionBy(*by, "_segment").orderBy("window_start"))
    last = cut.groupBy(*by, "_segment").agg(F.max("window_end").alias("_last"))
    last = last.select(*by, "_segment", F.lag("_last").over(Window.partitionBy(*by).orderBy("_segment")).alias("_earlier"))
    joined = join_null_safe(cut.withColumn("_inside", inside), last, [*by, "_segment"])
    before = F.coalesce("_inside", "_earlier", "window_start")
    gap = F.floor((micros("window_start") - micros(before)) / F.lit(step)).cast("bigint")
    return joined.withColumn("gap", gap).drop("_segment", "_inside", "_earlier")


def empty_windows(leveled: DataFrame, limits: AlertLimits, window: str) -> DataFrame:
    """The empty windows that a traffic drop is reported for, with their baselines.

    In a run of empty windows the baseline is b * (1 - alpha)^k, so the windows above the
    limit come first; only those are made, a thousand of a run per row.
    """
    step, d = seconds_of(window) * SECOND, 1.0 - limits.baseline_alpha
    if limits.drop_multiplier <= 0:
        return leveled.limit(0)
    b, m = F.col("baseline_before_gap"), float(limits.drop_min_baseline)
    if d >= 1 or m <= 0:  # the baseline never falls to the limit (where it fades to zero, the rule itself drops the window)
        reported = F.when(b > m, F.col("gap")).otherwise(0)
    elif d <= 0:
        reported = F.when(b > m, F.least("gap", F.lit(1))).otherwise(0)
    else:  # one more than the logarithm says: the rule decides on the last
        reported = F.when(b > m, F.least(F.col("gap"), F.floor(F.log(F.lit(m) / b) / F.lit(math.log(d))) + 2)).otherwise(0)
    runs = leveled.withColumn("_n", reported.cast("bigint")).where("_n > 0")
    parts = runs.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / F.lit(1000)))))
    in_part = F.sequence(F.col("_part") * 1000, F.least(F.col("_part") * 1000 + 999, F.col("_n") - 1))
    rows = parts.withColumn("_k", F.explode(in_part))
    first = micros("window_start") - F.col("gap") * F.lit(step)
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    start = F.timestamp_add("MICROSECOND", first + F.col("_k") * F.lit(step), epoch)
    counts = ["total_events", "purchases", "payment_fails", "searches", "cart_edits", "latency_n"]
    return rows.withColumns({
        "window_start": start, "window_end": F.timestamp_add("MICROSECOND", F.lit(step), start), "baseline": b * F.pow(F.lit(d), F.col("_k")), "eps": F.lit(0.0),
        **{c: F.lit(0).cast("bigint") for c in counts}, "latency_sum": F.lit(None).cast("bigint"), "max_failed": F.lit(None).cast("double"),
        "big_cart": F.lit(None).cast(leveled.schema["big_cart"].dataType),
    }).drop("_n", "_part", "_k")


def alert_traffic_spike(events, **how):
    return detect_alerts(events, only=["TRAFFIC_SPIKE"], **how)


def alert_traffic_drop(events, **how):
    return detect_alerts(events, only=["TRAFFIC_DROP"], **how)


def alert_payment_failure_rate(events, **how):
    return detect_alerts(events, only=["HIGH_PAYMENT_FAILURE_RATE"], **how)


def alert_high_value_payment_failure(events, **how):
    return detect_alerts(events, only=["HIGH_VALUE_PAYMENT_FAILURE"], **how)


def alert_high_value_cart(events, **how):
    return detect_alerts(events, only=["HIGH_VALUE_CART"], **how)


def alert_search_pressure(events, **how):
    return detect_alerts(events, only=["SEARCH_PRESSURE_NO_PURCHASE"], **how)


def alert_cart_activity(events, **how):
    return detect_alerts(events, only=["HIGH_CART_ACTIVITY"], **how)


def alert_high_latency(events, **how):
    return detect_alerts(events, only=["HIGH_LATENCY"], **how)
