"""Topic routing, partition placement and delivery counters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import lookup


def routing_table(spark: SparkSession, topics: Mapping = C.TOPICS) -> DataFrame:
    """One row per (topic, event type) of a contract's topic section."""
    rows = [(t, p, k) for t, (p, kinds) in topics.items() for k in kinds]
    return spark.createDataFrame(rows, "topic string, partitions int, event_type string")


def route_events(events: DataFrame, topics: Mapping = C.TOPICS) -> DataFrame:
    """Topic of every event by its type; a type without a route gets a reason.

    The route table is the contract itself (one entry per type), so it is a literal
    map in the projection rather than a join.
    """
    routes = {k: t for t, (_, kinds) in topics.items() for k in kinds}
    out = events.withColumn("topic", lookup("event_type", routes))
    reason = F.concat(F.lit("event_type sin ruta en el contrato: "), F.coalesce("event_type", F.lit("None")))
    return out.withColumn("error_reason", F.when(F.col("topic").isNull(), reason))


def routing_audit(routes: DataFrame, event_types: DataFrame) -> DataFrame:
    """Types routed more than once, and types without a topic."""
    twice = (
        routes.groupBy("event_type")
        .agg(F.count_distinct("topic").alias("topics"))
        .filter(F.col("topics") > 1)
        .select("event_type", F.lit("DUPLICATE").alias("problem"), "topics")
    )
    missing = (
        event_types.select("event_type")
        .distinct()
        .join(routes, "event_type", "left_anti")
        .select("event_type", F.lit("UNROUTED").alias("problem"), F.lit(0).cast("bigint").alias("topics"))
    )
    return twice.unionByName(missing)


def partition_balance(events: DataFrame, topics: Mapping = C.TOPICS) -> DataFrame:
    """Events and distinct keys per (topic, partition) that records came from, and the skew of each partition.

    events: kafka_topic, kafka_partition and the key column, as read or stored.  Rows are
    first counted per key, so a hot key is one row from there on.  A null key counts as
    one key.  Rows without a topic or partition were never placed and are left out.
    Skew is the load relative to an even one over the contract's partitions; it is null
    for a topic that the contract lacks.
    """
    key = F.col(C.PARTITION_KEY).alias("key")
    per_key = (
        events.filter(F.col("kafka_topic").isNotNull() & F.col("kafka_partition").isNotNull())
        .groupBy(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), key)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    load = per_key.groupBy("topic", "partition").agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("keys"))
    partitions = lookup("topic", {t: str(p) for t, (p, _) in topics.items()}).cast("int")
    topic_total = F.sum("events").over(_by_topic())
    return load.select(
        "topic",
        "partition",
        "events",
        "keys",
        F.round(F.col("events") * partitions / topic_total, 4).cast("double").alias("skew"),
    )


def _by_topic():
    from pyspark.sql import Window

    return Window.partitionBy("topic")  # at most one row per topic partition


def summarize_events(events: DataFrame) -> DataFrame:
    """Total, and counts by type, by profile and by source, in one pass.

    Spark expands rows per grouping set; counting the fine cells first (at most
    types x profiles x sources rows) makes the expansion a small one.
    """
    dims = ["event_type", "agent_profile", "source"]
    cells = events.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))
    sets = cells.groupingSets([[], ["event_type"], ["agent_profile"], ["source"]], *dims).agg(
        F.sum("n").alias("events"), F.grouping_id().alias("g")
    )
    dimension = (
        F.when(F.col("g") == 7, "total")
        .when(F.col("g") == 3, "event_type")
        .when(F.col("g") == 5, "agent_profile")
        .otherwise("source")
    )
    key = F.coalesce("event_type", "agent_profile", "source", F.lit("total"))
    return sets.select(dimension.alias("dimension"), key.alias("key"), "events")


def delivery_counters(tagged: DataFrame, channel: str = "source", status: str = "status") -> DataFrame:
    """Published, confirmed, rejected, failed and lost per channel, plus the total row.

    status is one of CONFIRMED, REJECTED, FAILED, PENDING; a message counts as
    published when it was handed to the broker (all but REJECTED).
    """
    s = F.col(status)
    per = tagged.groupBy(channel).agg(
        F.count_if(s != "REJECTED").alias("published"),
        F.count_if(s == "CONFIRMED").alias("confirmed"),
        F.count_if(s == "REJECTED").alias("rejected"),
        F.count_if(s == "FAILED").alias("failed"),
    )
    measures = ["published", "confirmed", "rejected", "failed"]
    total = per.rollup(channel).agg(*[F.sum(m).alias(m) for m in measures])
    return total.select(
        F.coalesce(F.col(channel), F.lit("TOTAL")).alias("channel"),
        *measures,
        (F.col("published") - F.col("confirmed")).alias("lost"),
    )
