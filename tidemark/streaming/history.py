"""Keyed state of the audience stream: every user's last events, typed, on RocksDB.

Each task first cuts its part of a batch to the last rows per user, so a user with a
third of all events sends a bounded number of rows to the state.  State rows are typed
columns, expire by TTL, and a timer per user reports users who have gone idle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.expr import micros
from tidemark.operators import audiences as au

# The state function travels by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_FIELDS = ("event_type", "us", "source", "agent_profile", "product_id", "cart_id", "cents")
STATE_SCHEMA = "event_type string, us bigint, source string, agent_profile string, product_id string, cart_id string, cents bigint"
HISTORY_SCHEMA = f"user_id string, arrival bigint, expired boolean, {STATE_SCHEMA}"

#: Rows a task holds back while it cuts its part of a batch.
HELD = 200_000


@contextmanager
def state_settings(spark: SparkSession, once: bool):
    """Settings for queries started inside: state in RocksDB; a run that drains its input makes no batches without data.

    Timers on the clock ask for another batch without end, so such a run would never stop;
    users gone idle are then reported with the next batch that has data.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB} | ({"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if once else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _last_of_each(rows: pa.Table, n: int) -> pa.Table:
    """Of each user the n rows with the highest arrival."""
    users = rows.column("user_id").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    arrival = rows.column("arrival").to_numpy()
    order = np.lexsort((-arrival, users))
    ranked = users[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return rows.take(pa.array(np.sort(order[place < n])))


def last_rows(df: DataFrame, n: int) -> DataFrame:
    """Drop rows that cannot be among a user's last n: the map-side half of the cut, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                rows = _last_of_each(pa.Table.from_batches(held), n)
                held, size = rows.to_batches(), rows.num_rows
                if size > HELD // 2:
                    yield from held
                    held, size = [], 0
        if size:
            yield from _last_of_each(pa.Table.from_batches(held), n).to_batches()

    return df.mapInArrow(run, df.schema)


class UserHistory(StatefulProcessor):
    """The last `rows` events of a user, and a timer that ends them after `idle_ms` without events.

    Batches follow each other and arrival orders the rows of one batch; the emitted
    arrival is the place in the history, so positions may restart with every batch.
    """

    def __init__(self, rows: int, idle_ms: int | None):
        self.rows, self.idle_ms = rows, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A backstop behind the timer, which must still find the rows.
        self.events = handle.getListState("events", STATE_SCHEMA, None if self.idle_ms is None else 2 * self.idle_ms + 86_400_000)

    def _emit(self, user, kept, expired: bool) -> Iterator[Row]:
        for place, values in enumerate(kept):
            yield Row(user_id=user, arrival=place, expired=expired, **dict(zip(STATE_FIELDS, values, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: list[tuple] = []
        for r in rows:
            fresh.append((r["arrival"], tuple(r[c] for c in STATE_FIELDS)))
            if len(fresh) >= 4 * self.rows:
                fresh = sorted(fresh, key=lambda x: x[0])[-self.rows :]
        fresh = sorted(fresh, key=lambda x: x[0])[-self.rows :]
        kept = [tuple(x) for x in self.events.get()] if self.events.exists() else []
        kept = (kept + [values for _, values in fresh])[-self.rows :]
        self.events.put(kept)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._emit(key[0], kept, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = [tuple(x) for x in self.events.get()] if self.events.exists() else []
        self.events.clear()
        yield from self._emit(key[0], kept, True)

    def close(self) -> None:
        pass


def user_history_stream(events: DataFrame, rows: int = 500, idle_ms: int | None = None) -> DataFrame:
    """Last `rows` events of every user active in the batch, and of those just gone idle (expired)."""
    slim = au.history_columns(events).select(
        "user_id", "arrival", "event_type", micros("event_ts").alias("us"), "source", "agent_profile", "product_id", "cart_id",
        F.coalesce((F.col("total_amount") * 100).cast("bigint"), F.lit(0)).alias("cents"),
    )
    return last_rows(slim, rows).groupBy("user_id").transformWithState(UserHistory(rows, idle_ms), HISTORY_SCHEMA, "Append", "ProcessingTime")


def history_rows(rows: DataFrame) -> DataFrame:
    """Emitted history rows in the form the rules read."""
    return rows.select(
        "user_id", "event_type", F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).alias("event_ts"),
        "arrival", "source", "agent_profile", "product_id", "cart_id",
        (F.col("cents") / F.lit(100)).cast("decimal(18,2)").alias("total_amount"), "expired",
    )
