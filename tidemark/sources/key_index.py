"""Which keys a store already holds, at a cost that does not grow with the store.

Every batch adds one run: its new keys in hash buckets, sorted, and a Bloom filter in
pages of 32,768 bits.  `fan` runs of a level are merged into one of the next level, so
there are few runs however many batches there were.  A batch's keys are first tried
against the filters; only keys that some filter admits are looked up, few of them by
literals (which prune buckets and row groups), many by a join with the bucketed table,
whose side needs no shuffle.

Runs and manifests carry the batch id; a batch reads the manifest before it and
overwrites its own, so a replayed batch changes nothing.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import sinks
from tidemark.sources.scratch import cut_lineage

PAGE_BITS = 1 << 15
#: Filter bits per key and positions per key: about one key in 20,000 is admitted wrongly.
BITS, POSITIONS = 24, 8
#: Keys looked up by literals at most.
PROBES = 500


@dataclass(frozen=True)
class Run:
    run: int
    level: int
    rows: int

    @property
    def pages(self) -> int:
        return max(1, math.ceil(self.rows * BITS / PAGE_BITS))


def _positions(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(PAGE_BITS)) for i in range(POSITIONS)])


def _page(key: str, pages: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit("page")), pages)


class KeyIndex:
    """The index of one store; `buckets` for about a million keys each when the store is full."""

    def __init__(self, spark: SparkSession, root: str, key: str = "event_id", buckets: int = 32, fan: int = 8):
        self.spark, self.key, self.buckets, self.fan = spark, key, buckets, fan
        self.keys_path, self.filters_path, self.manifests = (f"{root}/{key}s{part}" for part in ("", "_filters", "_manifests"))
        self.table = f"keys_{hashlib.md5(self.keys_path.encode()).hexdigest()[:16]}"

    # --- runs

    def _manifest_ids(self, before: int) -> list[int]:
        return [n for n in sinks.batch_ids(self.spark, self.manifests) if n < before]

    def runs(self, before: int) -> list[Run]:
        """Live runs before a batch: at most `fan` of each level."""
        found = self._manifest_ids(before)
        if not found:
            return []
        rows = self.spark.read.parquet(sinks.batch_path(*self.manifests.rsplit("/", 1), found[-1])).collect()
        return sorted((Run(r["run"], r["level"], r["rows"]) for r in rows), key=lambda r: r.run)

    def _register(self, runs: list[Run]) -> None:
        """Tell the session's catalog of the table and its live runs; the files are the truth."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.key} STRING, batch_id BIGINT, run BIGINT) USING parquet "
            f"PARTITIONED BY (run) CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.keys_path}'"
        )
        for r in runs:
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION (run = {r.run})")

    def stored(self, runs: list[Run], batch_id: int) -> DataFrame:
        """Keys of some runs, without those of the batch itself or later ones."""
        self._register(runs)
        return self.spark.table(self.table).where(F.col("run").isin([r.run for r in runs]) & (F.col("batch_id") < batch_id))

    # --- look-up

    def admitted(self, keys: DataFrame, runs: list[Run]) -> DataFrame:
        """key, run: the keys that a run's filter admits."""
        paths = [f"{self.filters_path}/run={r.run}" for r in runs]
        filters = self.spark.read.option("basePath", self.filters_path).parquet(*paths).withColumn("run", F.col("run").cast("long"))
        tried = F.array(*[F.struct(F.lit(r.run).cast("long").alias("run"), F.lit(r.pages).cast("long").alias("pages")) for r in runs])
        probes = keys.select(self.key, F.explode(tried).alias("t")).select(self.key, "t.run", _page(self.key, F.col("t.pages")).alias("page"))
        byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = lambda p: F.expr("true") & (F.call_function("shiftright", byte(p), F.pmod(p, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return probes.join(filters, ["run", "page"]).where(F.forall(_positions(self.key), is_set)).select(self.key, "run")

    def known(self, keys: DataFrame, batch_id: int, probes: int = PROBES) -> DataFrame | None:
        """The given (distinct) keys that earlier batches stored; None if there are none."""
        runs = self.runs(batch_id)
        if not runs:
            return None
        maybe = cut_lineage(self.admitted(keys, runs), "admitted")
        summary = maybe.agg(F.count(F.lit(1)).alias("n"), F.collect_set("run").alias("runs")).first()
        if not summary["n"]:
            return None
        stored = self.stored([r for r in runs if r.run in summary["runs"]], batch_id).select(self.key)
        if summary["n"] <= probes:
            return stored.where(F.col(self.key).isin([r[0] for r in maybe.select(self.key).distinct().collect()]))
        return maybe.select(self.key).distinct().join(stored, self.key, "left_semi")

    # --- growth

    def _write(self, keys: DataFrame, run: int, level: int) -> Run:
        """Write a run and its filter."""
        self._register([])
        # A table of its own while it is written; the files then are a partition of the index.
        own, path = f"{self.table}_{run}", f"{self.keys_path}/run={run}"
        dealt = keys.select(self.key, "batch_id").repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = {run})")
        sinks.remove(self.spark, path)
        dealt.write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).saveAsTable(own)
        self.spark.sql(f"DROP TABLE {own}")
        self._register([Run(run, level, 0)])
        written = self.spark.table(self.table).where(F.col("run") == run)
        out = Run(run, level, written.count())
        spread = written.select(_page(self.key, F.lit(out.pages)).alias("page"), F.explode(_positions(self.key)).alias("p"))
        filters = spread.groupBy("page").agg(F.bitmap_construct_agg("p").alias("bits"))
        filters.write.mode("overwrite").parquet(f"{self.filters_path}/run={run}")
        return out

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Add a batch's new keys as a run, and merge levels that are full."""
        before = self.runs(batch_id)
        live = [*before, self._write(keys.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id, 0)]
        level = 0
        while len(full := [r for r in live if r.level == level]) >= self.fan:
            level += 1
            merged = self._write(self.stored(full, batch_id + 1), (level << 48) | batch_id, level)
            live = [r for r in live if r not in full] + [merged]
        rows = self.spark.createDataFrame([(r.run, r.level, r.rows) for r in live], "run long, level int, rows long")
        rows.coalesce(1).write.mode("overwrite").parquet(sinks.batch_path(*self.manifests.rsplit("/", 1), batch_id))
        self._forget(batch_id, {r.run for r in [*before, *live]})

    def _forget(self, batch_id: int, needed: set[int]) -> None:
        """Drop runs that neither a replay of this batch nor the next one reads, and manifests but the one before."""
        for run in sinks.numbers(self.spark, self.keys_path, "run="):
            if run not in needed:
                self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = {run})")
                for part in (self.keys_path, self.filters_path):
                    sinks.remove(self.spark, f"{part}/run={run}")
        for n in self._manifest_ids(batch_id)[:-1]:
            sinks.remove(self.spark, sinks.batch_path(*self.manifests.rsplit("/", 1), n))
