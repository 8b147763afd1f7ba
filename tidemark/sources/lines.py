"""Reading event text: JSON lines from files, and topics of a Kafka cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators.validate import get


def read_event_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(value, origin, arrival) of the non-blank lines of a JSONL file or folder.

    arrival numbers all lines from 0, blank ones included, by file path and place in the
    file: Spark packs splits by size, so its own row ids follow neither.  The lines of
    each split are counted first (no text is parsed), one row per split.  limit keeps the
    first lines of that order.  origin is the file with its time of change and size, so
    that events of different loads get different ids, be it of one path.
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.concat_ws("+", F.unix_micros(F.col("_metadata.file_modification_time")), F.col("_metadata.file_size")).alias("_version"),
        F.monotonically_increasing_id().alias("_row"),
    )
    split = ["origin", "_start"]
    before = F.sum("_lines").over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1))
    splits = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_first"))
    splits = splits.withColumn("_before", F.coalesce(before, F.lit(0)))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    numbered = rows.join(splits, split).select("value", F.concat_ws("@", "origin", "_version").alias("origin"), place.alias("arrival"))
    if limit is not None:
        numbered = numbered.filter(F.col("arrival") < limit)
    return numbered.filter(F.trim("value") != "")


def read_line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming form of read_event_lines over a folder that receives files.

    A stream has no row numbers; each micro-batch numbers its own rows (ingest_batch).
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).filter(F.trim("value") != "")


def read_event_stream(
    spark: SparkSession,
    bootstrap: str,
    topics: Sequence[str] = C.BUSINESS_TOPICS,
    *,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Kafka topics as (value, key, kafka_topic, kafka_partition, kafka_offset, arrival).

    Offsets live in the query's checkpoint, written after the sink, so a restart
    re-reads what was not stored.  Needs the spark-sql-kafka connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return from_kafka(reader.load(), topics)


def from_kafka(records: DataFrame, topics: Sequence[str] = C.BUSINESS_TOPICS) -> DataFrame:
    """Kafka's record columns as lines with a total arrival order.

    arrival packs (offset, topic, partition) into one BIGINT, so it is a cheap
    fixed-width sort key; within a partition, which holds all events of a user of a
    topic, it is the offset order.
    """
    topic_no = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic")), F.lit(0))
    arrival = F.shiftleft(F.col("offset"), 20) + F.shiftleft(topic_no.cast("bigint"), 12) + F.col("partition")
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.col("key").cast("string").alias("key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        arrival.alias("arrival"),
    )


def explode_payload(parsed: DataFrame, event_type: str, doc: str = "doc") -> DataFrame:
    """Typed columns of one event type's payload, from parsed published events."""
    fields = C.PAYLOAD_FIELDS[event_type]
    rows = parsed.filter(get(doc, "$.event_type") == event_type)
    return rows.select(
        get(doc, "$.event_id").alias("event_id"),
        *[F.try_variant_get(doc, f"$.payload.{name}", kind).alias(name) for name, kind in fields.items()],
    )
