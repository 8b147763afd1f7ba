"""Structured Streaming jobs.

`metric_stream` gives a metric as an append-mode stream on a watermark, for sinks of the
caller.  The jobs that write tables run in foreachBatch with the batch id as the write
address, so a replayed batch is a no-op; windows are kept as in `streaming/windows.py`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.contract import AlertLimits, AudienceLimits, Windows
from tidemark.functions.expr import micros, seconds_of, to_utc_ntz
from tidemark.operators import alerts as al
from tidemark.operators import audiences as au
from tidemark.operators import metrics as m
from tidemark.operators.validate import dead_letters, enrich_latency, typed_events, validate_raw_event
from tidemark.sources import sinks
from tidemark.streaming.history import history_rows, state_settings, user_history_stream
from tidemark.streaming.windows import OPEN, WindowJob, alert_facts, metric_forms, run_windows


def as_instant(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Event time as TIMESTAMP: watermarks need an instant, the contract is UTC."""
    return events.withColumn(ts, F.timestamp_micros(micros(ts)))


def utc_windows(rows: DataFrame) -> DataFrame:
    """Window bounds back to UTC wall clock, as in the batch results."""
    for c in ("window_start", "window_end"):
        if c in rows.columns:
            rows = rows.withColumn(c, to_utc_ntz(F.col(c)))
    return rows


def start(writer: DataStreamWriter, checkpoint: str, *, once: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Start with a checkpoint; once=True drains what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def for_each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **how) -> StreamingQuery:
    return start(stream.writeStream.foreachBatch(write), checkpoint, **how)


# --- ingest -----------------------------------------------------------------------


def ingest_batch(lines: DataFrame, batch_id: int, root: str) -> None:
    """Validate one micro-batch, store its new events, write the rejects."""
    if "arrival" not in lines.columns:
        lines = lines.withColumn("arrival", F.monotonically_increasing_id())
    checked = validate_raw_event(lines).persist()
    try:
        good = enrich_latency(typed_events(checked.filter(F.col("error_reason").isNull())))
        sinks.write_event_store(good, root, batch_id, rejected=checked.filter(F.col("error_reason").isNotNull()))
        invalid = f"{sinks.batch_path(root, 'dead_letters', batch_id)}/kind=invalid"
        dead_letters(checked).write.mode("overwrite").parquet(invalid)
    finally:
        checked.unpersist()


def ingest_stream(lines: DataFrame, root: str, checkpoint: str, **how) -> StreamingQuery:
    return for_each_batch(lines, lambda df, n: ingest_batch(df, n, root), checkpoint, **how)


# --- metrics ----------------------------------------------------------------------


def metric_stream(events: DataFrame, name: str, windows: Windows = Windows()) -> DataFrame:
    """One metric of a stream in append mode (typed events, event_ts in UTC).

    Spark drops late rows and keeps the last windows open; `run_metric` does neither.  The
    rankings give the product rows of closed windows; the top k is for the sink to cut,
    where all rows of a window are in one batch.
    """
    timed = as_instant(events).withWatermark("event_ts", windows.lateness)
    build = {
        "throughput": lambda: m.throughput(timed, window=windows.throughput),
        "active_users": lambda: m.active_users_stream(timed, window=windows.active_users, ts="event_ts"),
        "events_by_type": lambda: m.events_by_type(timed, window=windows.events_by_type),
        "purchases_by_region": lambda: m.purchases_by_region(timed, window=windows.purchases_by_region),
        "conversion": lambda: m.conversion(timed, window=windows.conversion),
        "trends": lambda: _trends(timed, windows),
        "top_products_viewed": lambda: _products(timed, windows, viewed=True),
        "top_products_purchased": lambda: _products(timed, windows, viewed=False),
    }
    return utc_windows(build[name]())


def _trends(timed: DataFrame, w: Windows) -> DataFrame:
    per_user = m.sales_rows(timed, "event_ts").groupBy(F.window("event_ts", w.trends, w.trends_slide), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bought").alias("p"), F.sum("amount").alias("a")
    )
    # Window ends are multiples of the slide, so one slide-long pane holds one window.
    if seconds_of(w.trends) % seconds_of(w.trends_slide):
        raise ValueError("the slide must divide the window length")
    out = per_user.groupBy(F.window(F.window_time("window"), w.trends_slide).alias("pane")).agg(
        F.sum("n").alias("events_count"),
        F.count("user_id").alias("active_users"),
        F.sum("p").alias("purchases_count"),
        F.round(F.coalesce(F.sum("a"), F.lit(0)).cast("double"), 2).alias("total_revenue"),
    )
    end = F.col("pane.end")
    rest = [c for c in out.columns if c != "pane"]
    return out.select((end - F.expr(f"INTERVAL {w.trends}")).alias("window_start"), end.alias("window_end"), *rest)


def _products(timed: DataFrame, w: Windows, *, viewed: bool) -> DataFrame:
    """Per window and product: counts and the latest name, as one streaming aggregate."""
    if viewed:
        rows = timed.filter((F.col("event_type") == "VIEW_PRODUCT") & (F.length("payload.product_id") > 0)).select(
            "event_ts", "arrival", F.col("payload.product_id").alias("product_id"),
            F.coalesce("payload.product_name", F.lit("")).alias("product_name"), F.coalesce("payload.category", F.lit("")).alias("category"),
        )
        sums = {"views": F.count(F.lit(1))}
    else:
        rows = m.purchased_items(timed)
        sums = {"units": F.sum("quantity"), "total_revenue": F.round(F.sum("subtotal").cast("double"), 2)}
    out = rows.groupBy(F.window("event_ts", w.top_products), "product_id").agg(
        F.max_by("product_name", "arrival").alias("product_name"),
        F.max_by("category", "arrival").alias("category"),
        *[col.alias(n) for n, col in sums.items()],
    )
    return m.flatten_window(out)


def run_metric(events: DataFrame, name: str, root: str, checkpoint: str, windows: Windows = Windows(), k: int = 10, **how):
    """One metric into `root/name`: closed windows batch by batch, the open ones when a once=True run has drained.

    Events that come after their window was closed are kept in `root/late/name`.
    """
    write = lambda rows, n: rows.write.mode("overwrite").parquet(sinks.batch_path(root, name, n))
    job = WindowJob(metric_forms(windows, k)[name], root, name, windows.lateness, write)
    return run_windows(events, job, checkpoint, **how)


# --- audiences --------------------------------------------------------------------

def classify_stream(
    events: DataFrame, root: str, checkpoint: str, limits: AudienceLimits = AudienceLimits(), book: au.RuleBook | None = None,
    idle: str | None = "30 days", **how,
) -> StreamingQuery:
    """Audiences of the users active in each micro-batch.

    A user without events for `idle` (by the clock; None: never) leaves the state; the
    audiences of the last evaluation are then written once more as REMOVED.
    """
    book = book or au.RuleBook()

    def write(rows: DataFrame, batch_id: int) -> None:
        facts = au.audience_facts(history_rows(rows), limits, book, extra={"expired": F.bool_or("expired")})
        action = F.when(F.col("expired"), "REMOVED").otherwise("ADDED")
        sinks.write_audiences(au.apply_rules(facts, limits, book, action=action), root, batch_id)

    stream = user_history_stream(events, limits.history_rows, None if idle is None else int(1000 * seconds_of(idle)))
    with state_settings(events.sparkSession, how.get("once", True)):
        return for_each_batch(stream, write, checkpoint, **how)


# --- alerts -----------------------------------------------------------------------


def baseline_state(spark: SparkSession, root: str, before: int, init: float) -> float:
    """The baseline after the batch before `before` (one stored number)."""
    table = sinks.read_table(spark, sinks.batch_path(root, "baseline", before - 1))
    row = None if table is None else table.first()
    return init if row is None or row["baseline"] is None else float(row["baseline"])


def alert_stream(
    events: DataFrame, root: str, checkpoint: str, *, limits: AlertLimits = AlertLimits(), window: str = "10 seconds",
    lateness: str = "5 seconds", **how,
):
    """All eight alerts of closed windows (and, when drained, of open ones), with the baseline carried across batches."""

    def write(facts: DataFrame, batch_id: int) -> None:
        spark = facts.sparkSession
        if batch_id == OPEN:
            done = sinks.batch_ids(spark, f"{root}/baseline")
            begin = baseline_state(spark, root, max(done, default=-1) + 1, limits.baseline_init)
        else:
            begin = baseline_state(spark, root, batch_id, limits.baseline_init)
        leveled = al.eps_baseline(facts, alpha=limits.baseline_alpha, init=begin).persist()
        try:
            if batch_id != OPEN:
                a = limits.baseline_alpha
                after = F.lit(a) * F.col("eps") + F.lit(1 - a) * F.col("baseline")
                end = leveled.agg(F.coalesce(F.max_by(after, "window_start"), F.lit(begin)).alias("baseline"))
                end.write.mode("overwrite").parquet(sinks.batch_path(root, "baseline", batch_id))
            sinks.write_alerts(al.alert_rows(leveled, limits), root, batch_id)
        finally:
            leveled.unpersist()

    job = WindowJob(alert_facts(limits, window), root, "alerts", lateness, write)
    return run_windows(events, job, checkpoint, **how)


def big_cart_stream(
    events: DataFrame, root: str, checkpoint: str, *, limits: AlertLimits = AlertLimits(), window: str = "10 seconds",
    lateness: str = "5 seconds", **how,
):
    """The first big cart of every window alone, for a sink of its own; `alert_stream` has it too."""

    def write(facts: DataFrame, batch_id: int) -> None:
        leveled = facts.withColumn("baseline", F.lit(None).cast("double"))
        found = al.alert_rows(leveled, limits, only=["HIGH_VALUE_CART"])
        found.withColumn("created_at", F.current_timestamp()).write.mode("overwrite").parquet(sinks.batch_path(root, "alerts_cart", batch_id))

    job = WindowJob(alert_facts(limits, window), root, "alerts_cart", lateness, write)
    return run_windows(events, job, checkpoint, **how)


# --- parity mode ------------------------------------------------------------------


def micro_window_stream(lines: DataFrame, root: str, checkpoint: str, duration_sec: int = 10, **how) -> StreamingQuery:
    """One trigger is one window: ingest, then the metrics of the batch without a window key.

    This is the processing-time form; pass every='10 seconds' and once=False to run it on
    the clock.
    """
    from tidemark.plans.batch import compute_metrics

    def write(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, root)
        spark = df.sparkSession
        path = sinks.batch_path(root, "events", batch_id)
        events = sinks.read_table(spark, path)
        if events is None or events.isEmpty():
            return  # an empty window publishes nothing
        for name, rows in compute_metrics(events).items():
            rows.write.mode("overwrite").parquet(sinks.batch_path(root, f"micro/{name}", batch_id))

    return for_each_batch(lines, write, checkpoint, **how)
