"""Writers.  Every table write is addressed by a batch id and overwrites that batch's
own folder, so a retried micro-batch or a lost executor leaves the same table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.skew import tag_first
from tidemark.operators.quality import BENCHMARK_COLUMNS
from tidemark.sources.scratch import work_dir

ID_BUCKETS = 32


def batch_path(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/batch_id={batch_id}"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A written table, or None while nothing has been written."""
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def _hadoop(spark: SparkSession, path: str):
    """File system and path object of a path, by Spark's own file layer."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a superseded table; one that is not there is fine."""
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers after `prefix` in the names of the folders that have been written whole."""
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return []
    found = [(s.getPath(), s.getPath().getName()) for s in files.listStatus(at)]
    done = [n for p, n in found if n.startswith(prefix) and files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n[len(prefix) :]) for n in done)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    return numbers(spark, path, "batch_id=")


def by_folder(*columns: str):
    """Gather the rows of a folder before a partitioned write, splitting large folders.

    Without it every task writes a file into every folder.  REBALANCE lets AQE merge
    small folders and split a hot one, so neither tiny files nor one huge task result.
    """
    return lambda df: df.hint("rebalance", *[F.col(c) for c in columns])


# --- event store ----------------------------------------------------------------


def write_event_store(
    events: DataFrame, root: str, batch_id: int, *, buckets: int = ID_BUCKETS, date_col: str = "event_ts", rejected: DataFrame | None = None
) -> DataFrame:
    """Insert events whose event_id is new; returns the batch's counters.

    The primary key is an index of its own (`KeyIndex`): filters tell that most ids are
    new, and what is left is looked up in buckets; neither the store nor the whole id
    history is read.  Tables are written under the batch id; a retry is a no-op.  With a
    `value` column (the raw line) the duplicates are written as dead letters too.
    `rejected` are the rows of the load that could not be read or checked, for the counters.
    """
    from tidemark.sources.key_index import KeyIndex

    spark = events.sparkSession
    index = KeyIndex(spark, root, buckets=buckets)
    # The rows are made (parsed) once and stored; ids and places alone tell which of them are new.
    load = work_dir(spark, "load")
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in ("event_id", "arrival")]
    try:
        rows = _stored(events, f"{load}/rows")
        tagged = tag_first(rows.select("event_id", "arrival"), "event_id", "arrival")
        known = index.known(tagged.filter("is_first").select("event_id"), batch_id)
        if known is None:
            marked = tagged.withColumn("stored", F.col("is_first")).drop("is_first")
        else:
            # Only first copies are looked up; further copies get keys of their own, so an id
            # with very many copies does not meet in one task.
            own = F.concat_ws("#", "event_id", F.col("arrival").cast("string"))
            keyed = tagged.withColumn("_key", F.when(F.col("is_first"), F.col("event_id")).otherwise(own))
            old = known.select(F.col("event_id").alias("_key"), F.lit(True).alias("known"))
            marked = keyed.join(old, "_key", "left").withColumn("stored", F.col("is_first") & F.col("known").isNull()).drop("is_first", "known", "_key")
        marked = _stored(marked, f"{load}/marks")
        if "value" in rows.columns:
            copies = marked.filter(~F.col("stored")).distinct()
            duplicates = rows.join(copies, same(rows, copies), "left_semi").select(
                "arrival",
                F.col("value").alias("raw_message"),
                F.concat(F.lit("Duplicate event_id: "), F.col("event_id")).alias("error_reason"),
                F.current_timestamp().alias("failed_at"),
                "event_id",
            )
            duplicates.write.mode("overwrite").parquet(f"{batch_path(root, 'dead_letters', batch_id)}/kind=duplicate")
        # Where few rows go, their ids are sent and the others stay where they are.
        gone = marked.filter(~F.coalesce("stored", F.lit(False))).distinct()
        fresh = rows.join(gone, same(rows, gone), "left_anti")
        (
            fresh.drop("value")
            .withColumn("event_date", F.col(date_col).cast("date"))
            .transform(by_folder("scenario", "event_date"))
            .write.mode("overwrite")
            .partitionBy("scenario", "event_date")
            .parquet(batch_path(root, "events", batch_id))
        )
        index.add(spark.read.schema("event_id string").parquet(batch_path(root, "events", batch_id)), batch_id)
        counters = store_counters(marked, rejected)
        counters.write.mode("overwrite").parquet(batch_path(root, "counters", batch_id))
    finally:
        remove(spark, load)
    return spark.read.parquet(batch_path(root, "counters", batch_id))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_counters(tagged: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Read, inserted, duplicate and unreadable rows of one load."""
    counts = tagged.agg(
        F.count(F.lit(1)).alias("leidos"), F.count_if(F.col("stored")).alias("insertados"), F.count_if(~F.col("stored")).alias("duplicados")
    )
    invalid = F.lit(0).cast("bigint") if rejected is None else rejected.agg(F.count(F.lit(1))).scalar()
    return counts.select((F.col("leidos") + invalid).alias("leidos"), "insertados", "duplicados", invalid.alias("invalidos"))


def read_event_store(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/events")


# --- metrics, audiences, alerts, runs -----------------------------------------------


def kafka_records(df: DataFrame, topic: Column | str, key: Column | str) -> DataFrame:
    """Rows in the shape of the Kafka sink: key, value (JSON), topic."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"), topic.alias("topic"))


def metric_rows(df: DataFrame, metric_type: str) -> DataFrame:
    """Flat metric rows as the metric table: type, window, JSON payload, creation time."""
    body = [c for c in df.columns if c not in ("window_start", "window_end")]
    return df.select(
        F.lit(metric_type).alias("metric_type"),
        "window_start",
        "window_end",
        F.to_json(F.struct(*body)).alias("payload"),
        F.current_timestamp().alias("created_at"),
    )


def write_metrics(df: DataFrame, metric_type: str, root: str, batch_id: int) -> None:
    """Append one metric's rows to the metric table (idempotent per batch)."""
    if metric_type not in C.METRIC_TOPICS:
        raise ValueError(f"unknown metric type {metric_type}")
    path = batch_path(root, f"metrics/metric={metric_type}", batch_id)
    metric_rows(df, metric_type).write.mode("overwrite").parquet(path)


def metric_messages(df: DataFrame, metric_type: str) -> DataFrame:
    """The metric's Kafka messages, keyed by the metric type."""
    records = df.withColumn("metric_type", F.lit(metric_type)).withColumn("processing_timestamp", F.current_timestamp())
    return kafka_records(records, C.METRIC_TOPICS[metric_type], F.lit(metric_type))


def audience_defaults(df: DataFrame) -> DataFrame:
    """Defaults of an audience row: action ADDED, confidence 1.0, empty evidence."""
    have = lambda name, kind: F.col(name) if name in df.columns else F.lit(None).cast(kind)
    return df.select(
        "user_id",
        "audience_type",
        F.coalesce(have("action", "string"), F.lit("ADDED")).alias("action"),
        F.coalesce(have("confidence", "double"), F.lit(1.0)).alias("confidence"),
        F.coalesce(have("evidence", "string"), F.lit("{}")).alias("evidence"),
        "detected_at",
        have("expires_at", "timestamp_ntz").alias("expires_at"),
    )


def write_audiences(df: DataFrame, root: str, batch_id: int) -> None:
    rows = audience_defaults(df).withColumn("created_at", F.current_timestamp())
    rows = rows.transform(by_folder("audience_type"))
    rows.write.mode("overwrite").partitionBy("audience_type").parquet(batch_path(root, "audiences", batch_id))


def audience_messages(df: DataFrame) -> DataFrame:
    return kafka_records(audience_defaults(df), C.AUDIENCE_TOPIC, "user_id")


#: Batch id of rows of windows that were open when a run had drained.
OPEN = -1

_LATEST = ("current_value", "detected_at")


def write_alerts(df: DataFrame, root: str, batch_id: int) -> None:
    """Append alerts to the alert log; `read_alerts` applies the upsert rule."""
    df.withColumn("created_at", F.current_timestamp()).write.mode("overwrite").parquet(batch_path(root, "alerts", batch_id))


def _folded(log: DataFrame) -> DataFrame:
    """One row of each id: the first one, with the last value and time; and where both come from."""
    fixed = [c for c in log.columns if c not in (*_LATEST, "alert_id", "first_batch", "last_batch")]
    return (
        log.groupBy("alert_id")
        .agg(
            F.min_by(F.struct(*fixed), "first_batch").alias("f"), F.max_by(F.struct(*_LATEST), "last_batch").alias("l"),
            F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch"),
        )
        .select("alert_id", "f.*", "l.*", "first_batch", "last_batch")
    )


def upsert_alerts(log: DataFrame, order: str = "batch_id") -> DataFrame:
    """Current alerts of a log: the first row of an id, with the last value and time.

    Merge on read: an update costs one appended row, never a rewrite of the table.
    """
    rows = log.withColumns({"first_batch": F.col(order), "last_batch": F.col(order)}).drop(order)
    return _folded(rows).drop("first_batch", "last_batch")


def _alert_log(spark: SparkSession, root: str, name: str) -> tuple[DataFrame | None, int]:
    """Base and later batches of one log in the same form, and the last batch in the base."""
    done = numbers(spark, f"{root}/{name}_base", "version=")
    version = max(done, default=OPEN)
    base = spark.read.parquet(f"{root}/{name}_base/version={version}") if done else None
    log = read_table(spark, f"{root}/{name}")
    if log is not None:
        # Open windows are the newest; a base holds all batches up to its version, removed or not.
        place = F.when(F.col("batch_id") == OPEN, F.lit(1 << 62)).otherwise(F.col("batch_id")).cast("bigint")
        log = log.filter((F.col("batch_id") > version) | (F.col("batch_id") == OPEN)).withColumns({"first_batch": place, "last_batch": place}).drop("batch_id")
    if base is None or log is None:
        return (log if base is None else base), version
    return base.unionByName(log, allowMissingColumns=True), version


def read_alerts(spark: SparkSession, root: str, names: tuple[str, ...] = ("alerts", "alerts_cart")) -> DataFrame | None:
    """Current alerts of the logs that the streams write, folded as `upsert_alerts` does."""
    logs = [log for n in names if (log := _alert_log(spark, root, n)[0]) is not None]
    if not logs:
        return None
    rows = logs[0]
    for more in logs[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return _folded(rows).drop("first_batch", "last_batch")


def compact_alerts(spark: SparkSession, root: str, name: str = "alerts", keep: int = 1) -> None:
    """Fold all but the newest `keep` batches of a log (those may still be replayed) into its base.

    The base is written whole under the id of its last batch before anything is removed,
    and readers leave out batches up to that id: an interrupted run loses and repeats nothing.
    """
    rows, version = _alert_log(spark, root, name)
    ids = [n for n in batch_ids(spark, f"{root}/{name}") if n > version]
    if len(ids) <= keep:
        return
    last = ids[-keep - 1] if keep else ids[-1]
    _folded(rows.filter(F.col("last_batch") <= last)).write.mode("overwrite").parquet(f"{root}/{name}_base/version={last}")
    for n in batch_ids(spark, f"{root}/{name}"):
        if OPEN < n <= last:
            remove(spark, batch_path(root, name, n))
    for n in numbers(spark, f"{root}/{name}_base", "version="):
        if n < last:
            remove(spark, f"{root}/{name}_base/version={n}")


def alert_messages(df: DataFrame) -> DataFrame:
    return kafka_records(df, C.ALERT_TOPIC, "alert_id")


def write_runs(df: DataFrame, root: str, batch_id: int) -> None:
    """Insert load summaries; a run id that is already stored is ignored."""
    known = read_table(df.sparkSession, f"{root}/runs")
    rows = df.dropDuplicates(["run_id"])
    if known is not None:
        rows = rows.join(known.filter(F.col("batch_id") < batch_id).select("run_id"), "run_id", "left_anti")
    rows.write.mode("overwrite").parquet(batch_path(root, "runs", batch_id))


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/runs")


# --- files --------------------------------------------------------------------------


def write_by_source(envelopes: DataFrame, path: str) -> None:
    """One consolidated JSONL folder, and one folder per source channel.

    envelopes: value (the line) and source_hint.
    """
    envelopes.select("value").write.mode("overwrite").text(f"{path}/all")
    split = envelopes.select("value", "source_hint").transform(by_folder("source_hint"))
    split.write.mode("overwrite").partitionBy("source_hint").text(f"{path}/by_source")


ALERT_EXPORT = {
    "id": "id", "nivel": "level", "titulo": "title", "descripcion": "description", "componente": "component",
    "escenario": "scenario", "estado": "status", "timestamp": "timestamp",
}


def export_alerts_csv(feed: DataFrame, path: str) -> None:
    """The alert feed as ';'-separated text with doubled quotes."""
    cols = [F.col(src).alias(name) for name, src in ALERT_EXPORT.items()]
    out = feed.select(*cols).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    out.write.mode("overwrite").option("sep", ";").option("header", True).option("escape", '"').csv(path)


def write_benchmark_csv(df: DataFrame, path: str) -> None:
    df.select(*BENCHMARK_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
