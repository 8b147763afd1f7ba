"""Windowed results of a stream from stored partial aggregates, without lost windows.

Every micro-batch is reduced to mergeable rows per window and folded into the open
windows of the batch before it.  Windows behind the watermark (newest event so far, less
the lateness) are closed: their rows are final and written once.  Rows that come after
their window was closed go to a table of their own and are counted.  When a run has
drained its input, the windows still open are written as they stand; a later run takes
them up again and replaces them.

The state after a batch is one table, addressed by the batch id and read by the next
batch alone, so a batch costs its own rows plus the open windows, however long the
stream has run, and a replayed batch writes the same files again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import contract as C
from tidemark.contract import AlertLimits, Windows
from tidemark.functions.expr import flatten_window, micros, seconds_of, window_keys
from tidemark.functions.skew import top_rows
from tidemark.operators import alerts as al
from tidemark.operators import metrics as m
from tidemark.sources import sinks

#: Batch id under which the windows still open after a drained run are written.
OPEN = sinks.OPEN
SPAN = ("window_start", "window_end")


@dataclass(frozen=True)
class Windowed:
    """A result per window in mergeable form.

    `partial` reduces events to rows of window, `keys` and measures; `merge` gives the
    aggregate that folds each measure; `final` turns merged rows into result rows.
    `reads` tells which events the result depends on.
    """

    length: str
    partial: Callable[[DataFrame, int], DataFrame]
    merge: Mapping[str, Column]
    final: Callable[[DataFrame], DataFrame]
    keys: Sequence[str] = ()
    slide: str | None = None
    reads: Column = field(default_factory=lambda: F.lit(True))


def _grouped(events: DataFrame, length: str, slide: str | None, keys: Sequence, *aggs: Column) -> DataFrame:
    return flatten_window(events.groupBy(*window_keys(events, "event_ts", length, slide), *keys).agg(*aggs))


def _sums(*names: str) -> dict[str, Column]:
    return {n: F.sum(n).alias(n) for n in names}


# --- the eight metrics --------------------------------------------------------------


def metric_forms(w: Windows = Windows(), k: int = 10, sample: int = 10) -> dict[str, Windowed]:
    """The metrics by name."""
    sale = F.col("event_type") == "PURCHASE"
    count = F.count(F.lit(1))
    user_sums = ("events", "purchases", "amount")

    def users(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy(*SPAN).agg(count.alias("active_users_count"))
        ids = top_rows(rows, SPAN, [F.col("user_id")], sample).groupBy(*SPAN).agg(F.sort_array(F.collect_list("user_id")).alias("unique_users_sample"))
        return counts.join(ids, [*SPAN], "left")

    def trends(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*SPAN).agg(
            F.sum("events").alias("events_count"), F.count("user_id").alias("active_users"), F.sum("purchases").alias("purchases_count"),
            F.round(F.coalesce(F.sum("amount"), F.lit(0)).cast("double"), 2).alias("total_revenue"),
        )

    return {
        "throughput": Windowed(
            w.throughput, lambda e, _: _grouped(e, w.throughput, None, [], count.alias("total_events")), _sums("total_events"),
            lambda r: r.withColumn("events_per_second", F.round(F.col("total_events") / F.lit(float(max(1, seconds_of(w.throughput)))), 2)),
        ),
        "active_users": Windowed(
            w.active_users, lambda e, _: _grouped(e.filter(F.col("user_id").isNotNull()), w.active_users, None, ["user_id"], count.alias("n")),
            _sums("n"), users, keys=["user_id"], reads=F.col("user_id").isNotNull(),
        ),
        "events_by_type": Windowed(
            w.events_by_type, lambda e, _: m.events_by_type(e, window=w.events_by_type), _sums("events"), lambda r: r, keys=["event_type"],
        ),
        "purchases_by_region": Windowed(
            w.purchases_by_region,
            lambda e, _: _grouped(
                e.filter(sale), w.purchases_by_region, None, [F.coalesce(F.col("region"), F.lit(C.UNKNOWN_REGION)).alias("region")],
                count.alias("purchases_count"), F.sum(F.col("payload.total_amount").cast("decimal(18,2)")).alias("amount"),
            ),
            _sums("purchases_count", "amount"),
            lambda r: r.select(*SPAN, "region", "purchases_count", F.round(F.coalesce("amount", F.lit(0)).cast("double"), 2).alias("total_amount")),
            keys=["region"], reads=sale,
        ),
        "conversion": Windowed(
            w.conversion, lambda e, _: m.conversion(e, window=w.conversion).select(*SPAN, "views_count", "cart_additions_count", "purchases_count"),
            _sums("views_count", "cart_additions_count", "purchases_count"), m.with_rates,
        ),
        "trends": Windowed(
            w.trends,
            lambda e, _: _grouped(
                m.sales_rows(e, "event_ts"), w.trends, w.trends_slide, ["user_id"], count.alias("events"), F.sum("bought").alias("purchases"), F.sum("amount").alias("amount")
            ),
            _sums(*user_sums), trends, keys=["user_id"], slide=w.trends_slide,
        ),
        "top_products_viewed": _ranking(w.top_products, k, viewed=True),
        "top_products_purchased": _ranking(w.top_products, k, viewed=False),
    }


def _ranking(length: str, k: int, *, viewed: bool) -> Windowed:
    """Sums per product and name; the name of the last batch's last event is shown."""
    names = ("product_name", "category")
    sums = ("views",) if viewed else ("units", "amount")

    def partial(events: DataFrame, batch_id: int) -> DataFrame:
        if viewed:
            rows = events.filter((F.col("event_type") == "VIEW_PRODUCT") & (F.length("payload.product_id") > 0)).select(
                "event_ts", "arrival", F.col("payload.product_id").alias("product_id"),
                *[F.coalesce(f"payload.{n}", F.lit("")).alias(n) for n in names], F.lit(1).cast("bigint").alias("views"),
            )
        else:
            rows = m.purchased_items(events).withColumn("units", F.col("quantity")).withColumn("amount", F.col("subtotal"))
        found = _grouped(rows, length, None, ["product_id", *names], *[F.sum(c).alias(c) for c in sums], F.max("arrival").alias("arrival"))
        return found.withColumn("last", F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "arrival")).drop("arrival")

    def final(rows: DataFrame) -> DataFrame:
        folded = rows.groupBy(*SPAN, "product_id").agg(*[F.max_by(n, F.struct("last", *names)).alias(n) for n in names], *[F.sum(c).alias(c) for c in sums])
        if not viewed:
            folded = folded.withColumn("total_revenue", F.round(F.col("amount").cast("double"), 2)).drop("amount")
        order = ["views"] if viewed else ["units", "total_revenue"]
        return top_rows(folded, SPAN, [*[F.desc(c) for c in order], F.col("product_id")], k, rank="position")

    return Windowed(
        length, partial, {**_sums(*sums), "last": F.max("last").alias("last")}, final, keys=["product_id", *names],
        reads=F.col("event_type") == ("VIEW_PRODUCT" if viewed else "PURCHASE"),
    )


def alert_facts(limits: AlertLimits, length: str) -> Windowed:
    """What the alert rules read, big carts included."""
    added = ("total_events", "purchases", "payment_fails", "searches", "cart_edits", "latency_sum", "latency_n", "eps")

    def partial(events: DataFrame, batch_id: int) -> DataFrame:
        facts = al.window_facts(events, limits, window=length)
        cart = F.when(F.col("big_cart").isNotNull(), F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "big_cart"))
        return facts.withColumn("first_cart", cart).drop("big_cart")

    merge = {**_sums(*added), "max_failed": F.max("max_failed").alias("max_failed"), "first_cart": F.min("first_cart").alias("first_cart")}
    return Windowed(length, partial, merge, lambda r: r.withColumn("big_cart", F.col("first_cart.big_cart")).drop("first_cart"))


# --- the job ------------------------------------------------------------------------


class WindowJob:
    """Folds micro-batches into one result; `emit` writes rows of closed (or, at the end, open) windows."""

    def __init__(self, form: Windowed, root: str, name: str, lateness: str, emit: Callable[[DataFrame, int], None]):
        self.form, self.root, self.name, self.emit = form, root, name, emit
        self.late_us = seconds_of(lateness) * 1_000_000
        self.fresh = True

    def _path(self, table: str, batch_id: int) -> str:
        return sinks.batch_path(self.root, f"_windows/{self.name}/{table}", batch_id)

    def watermark(self, spark: SparkSession, after: int) -> int | None:
        """The watermark after a batch, in microseconds; None before the first."""
        rows = sinks.read_table(spark, self._path("progress", after))
        return None if rows is None else rows.first()["watermark"]

    def open_rows(self, spark: SparkSession, after: int) -> DataFrame | None:
        rows, mark = sinks.read_table(spark, self._path("state", after)), self.watermark(spark, after)
        return None if rows is None or mark is None else rows.filter(micros("window_end") > F.lit(mark))

    def _late(self, batch: DataFrame, mark: int) -> DataFrame:
        """Events of the batch once per closed window that they missed."""
        pairs = batch.filter(self.form.reads & (micros("event_ts") < F.lit(mark))).select(
            "event_id", "event_type", "user_id", "event_ts", *window_keys(batch, "event_ts", self.form.length, self.form.slide)
        )
        return flatten_window(pairs).filter(micros("window_end") <= F.lit(mark))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.fresh and sinks.read_table(spark, sinks.batch_path(self.root, self.name, OPEN)) is not None:
            rows = spark.read.parquet(sinks.batch_path(self.root, self.name, OPEN)).limit(0)
            rows.write.mode("overwrite").parquet(sinks.batch_path(self.root, self.name, OPEN))
        self.fresh = False
        mark = self.watermark(spark, batch_id - 1)
        # A window's end lies behind its rows, so only rows before the mark can be late.
        seen = Observation()
        old = F.lit(False) if mark is None else self.form.reads & (micros("event_ts") < F.lit(mark))
        watched = batch.observe(seen, F.max(micros("event_ts")).alias("newest"), F.count_if(old).alias("old"))
        rows = self.form.partial(watched, batch_id)
        if mark is not None:
            rows = rows.filter(micros("window_end") > F.lit(mark))
            rows = self.open_rows(spark, batch_id - 1).unionByName(rows)
        keys = [*SPAN, *self.form.keys]
        state = rows.groupBy(*keys).agg(*self.form.merge.values())
        state.write.mode("overwrite").parquet(self._path("state", batch_id))
        newest, n_old = seen.get["newest"], seen.get["old"]
        if n_old:
            self._late(batch, mark).write.mode("overwrite").parquet(sinks.batch_path(self.root, f"late/{self.name}", batch_id))
        now = max(x for x in (mark, None if newest is None else newest - self.late_us, -(1 << 62)) if x is not None)
        closed = spark.read.parquet(self._path("state", batch_id)).filter(micros("window_end") <= F.lit(now))
        self.emit(self.form.final(closed), batch_id)
        spark.range(1).select(F.lit(now).cast("bigint").alias("watermark")).write.mode("overwrite").parquet(self._path("progress", batch_id))
        for table in ("state", "progress"):
            sinks.remove(spark, self._path(table, batch_id - 2))  # a replay reads the batch before, no older one

    def flush(self, spark: SparkSession, after: int) -> None:
        """Write the windows that are open after a batch as they stand."""
        rows = self.open_rows(spark, after)
        if rows is not None:
            self.emit(self.form.final(rows), OPEN)


class DrainedQuery:
    """A once=True run: waiting for its end also writes the windows still open."""

    def __init__(self, query: StreamingQuery, job: WindowJob, last: Callable[[], int | None], spark: SparkSession):
        self.query, self.job, self.last, self.spark, self.done = query, job, last, spark, False

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        if ended is not False and not self.done and (last := self.last()) is not None:
            self.job.flush(self.spark, last)
            self.done = True
        return ended

    def __getattr__(self, name):
        return getattr(self.query, name)


def run_windows(events: DataFrame, job: WindowJob, checkpoint: str, *, once: bool = True, every: str = "10 seconds"):
    """Start a job over a stream; with once=True, call awaitTermination() on what it returns."""
    from tidemark.streaming.jobs import for_each_batch

    query = for_each_batch(events, job, checkpoint, once=once, every=every)
    if not once:
        return query
    spark = events.sparkSession

    def last() -> int | None:
        """The newest committed batch, of this run or an earlier one."""
        done = sinks.batch_ids(spark, f"{job.root}/_windows/{job.name}/progress")
        return max(done, default=None)

    return DrainedQuery(query, job, last, spark)


def late_rows(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Events that came after their window was closed, once per window; None if there are none."""
    return sinks.read_table(spark, f"{root}/late/{name}")
