"""The registered queries: every operator over the whole test tables.

Windows and thresholds are parameters of the operators; the test events are spread over
30 days, so the queries pass day- or hour-scale windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import lookup, to_utc_ntz
from tidemark.operators import alert_views as av
from tidemark.operators import alerts as al
from tidemark.operators import asof
from tidemark.operators import audiences as au
from tidemark.operators import dedup as dd
from tidemark.operators import insights as ins
from tidemark.operators import metrics as m
from tidemark.operators import products as pr
from tidemark.operators import quality as ql
from tidemark.operators import routing as rt
from tidemark.operators import scenarios as sc
from tidemark.operators import series as se
from tidemark.operators import serving as sv
from tidemark.operators import validate as va
from tidemark.plans import batch
from tidemark.plans.snapshot import dashboard_snapshot
from tidemark.sources import adapter as ad
from tidemark.sources import lines as ln
from tidemark.sources import sinks
from tidemark.sources.scratch import cut_lineage, work_dir
from tidemark.streaming import jobs, windows

DAY = "1 day"
DAY_SEC = 86400

AUDIENCE = C.AudienceLimits(
    compulsive_sec=12 * 3600, comparer_views=3, comparer_sec=12 * 3600, cart_timeout_sec=10 * DAY_SEC, night_events=162, high_value_amount=150.0,
    high_value_sec=DAY_SEC, undecided_cycles=2, undecided_sec=36 * 3600, multi_device_sources=4, multi_device_sec=3 * 3600,
)
#: Users of the audience queries: the table's users merged by a modulus, so that they have more events than a history holds.
CROWD = 16
ALERT = C.AlertLimits(
    payment_fail_pct=55.0, high_cart=1200.0, high_latency_ms=34000.0, critical_payment=200.0, search_min=2,
    cart_activity_min=5, spike_multiplier=1.3, spike_min_events=5, drop_multiplier=0.7, drop_min_baseline=0.001, baseline_init=0.004,
)
ALERT_WINDOW = "1 hour"
HOUR = "1 hour"


def ev(spark, sf) -> DataFrame:
    return ad.contract_events(spark, sf, ad.CORE_FIELDS)


def crowd(events: DataFrame) -> DataFrame:
    """Events of CROWD users, each with more than 500 of them at sf0.01."""
    return events.withColumn("user_id", F.concat(F.lit("USR"), (F.substring("user_id", 4, 20).cast("int") % CROWD).cast("string")))


def whole(spark, sf) -> DataFrame:
    """Events with every payload field, as the text forms need."""
    return ad.contract_events(spark, sf)


def bought(spark, sf) -> DataFrame:
    return m.purchased_items(ad.contract_events(spark, sf, ("order_id", "items")))


def no_window(df: DataFrame) -> DataFrame:
    return df.drop("window_end")


# --- sources, parsing, sinks --------------------------------------------------------


def read_event_lines(spark, sf):
    path = work_dir(spark, "lines")
    ad.event_lines(whole(spark, sf)).select("value").write.text(path)
    lines = va.parse_json(ln.read_event_lines(spark, path))
    return lines.select(
        F.when(F.col("doc").isNull(), "texto").when(va.keys_of("doc", "$").isNull(), "otro").otherwise("objeto").alias("form")
    ).groupBy("form").agg(F.count(F.lit(1)).alias("lines"))


def read_event_stream(spark, sf):
    """Kafka-shaped records through the stream reader's mapping (file stream as transport)."""
    path, out = work_dir(spark, "records"), work_dir(spark, "stream")
    rt.route_events(ev(spark, sf)).select(
        F.col("event_id").cast("binary").alias("value"), F.col("user_id").cast("binary").alias("key"), "topic",
        (F.col("arrival") % 4).cast("int").alias("partition"), F.floor(F.col("arrival") / 4).alias("offset"),
    ).write.parquet(path)
    raw = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = jobs.start(ln.from_kafka(raw).writeStream.format("parquet").option("path", f"{out}/data"), f"{out}/cp")
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data").groupBy("kafka_topic", "kafka_partition").agg(
        F.count(F.lit(1)).alias("records"), F.max("kafka_offset").alias("last_offset"),
        F.count_distinct("arrival").alias("positions"), F.min("key").alias("first_key"),
    )


def parse_envelope(spark, sf):
    return va.parse_envelope(ad.envelope_lines(whole(spark, sf))).select(
        "arrival", "source_hint", "error_reason", F.substring("original", 1, 5).alias("original_start")
    )


def payload_of(kind):
    def run(spark, sf):
        out = ln.explode_payload(valid_lines(spark, sf), kind)
        return out.select(*[F.col(c).cast("double") if t.startswith("decimal") else F.col(c) for c, t in out.dtypes if not t.startswith("array")])

    return run


def explode_purchase_items(spark, sf):
    """PURCHASE.items of valid events, one row per item."""
    items = ln.explode_payload(valid_lines(spark, sf), "PURCHASE").select("event_id", F.explode("items").alias("i"))
    return items.select(
        "event_id", "i.product_id", "i.product_name", "i.category", F.col("i.unit_price").cast("double").alias("unit_price"),
        "i.quantity", F.col("i.subtotal").cast("double").alias("subtotal"),
    )


def write_event_store(spark, sf):
    """Two loads of overlapping halves; the second one finds the first one's ids."""
    root = work_dir(spark, "store")
    events = va.enrich_latency(va.typed_events(valid_lines(spark, sf)))
    typed = cut_lineage(events.drop("value"), "typed")  # parsed once for both loads
    sinks.write_event_store(typed.filter(F.col("scenario") != "NAVIDAD"), root, 0, buckets=16)
    sinks.write_event_store(typed, root, 1, buckets=16)
    return sinks.read_event_store(spark, root).groupBy("scenario", F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"),
        F.sum(F.col("batch_id")).cast("bigint").alias("from_second_load"),
    )


def two_loads(spark, sf):
    """Two loads of one path with other content: every valid line is an event of its own."""
    root, path = work_dir(spark, "two-loads"), work_dir(spark, "load")
    lines = ad.envelope_lines(whole(spark, sf))
    for n in range(2):
        lines.filter(F.col("arrival") % (1 + 2 * n) == 0).select("value").write.mode("overwrite").text(path)
        checked = va.validate_envelope(ln.read_event_lines(spark, path))
        checked = cut_lineage(checked.select("arrival", "origin", "doc", "error_reason"), "checked")  # one parse for events and rejects
        events = va.parse_event_time(va.enrich_envelope(checked.filter("error_reason IS NULL")))
        sinks.write_event_store(events, root, n, buckets=8, rejected=checked.filter("error_reason IS NOT NULL"))
    counters = spark.read.parquet(f"{root}/counters").select(F.col("batch_id").cast("bigint").alias("load"), "leidos", "insertados", "duplicados", "invalidos")
    ids = sinks.read_event_store(spark, root).agg(F.count_distinct("event_id")).scalar()
    return counters.withColumn("ids", ids)


def store_counters(spark, sf):
    """Two loads; the second also brings the lines that cannot be read or checked."""
    root = work_dir(spark, "counters")
    checked = checked_lines(spark, sf)
    typed = cut_lineage(va.enrich_latency(va.typed_events(checked.filter("error_reason IS NULL"))).drop("value"), "typed")  # parsed once for both loads
    first = sinks.write_event_store(typed.filter(F.col("scenario") != "NAVIDAD"), root, 0, buckets=16)
    second = sinks.write_event_store(typed, root, 1, buckets=16, rejected=checked.filter("error_reason IS NOT NULL"))
    return first.withColumn("load", F.lit(0)).unionByName(second.withColumn("load", F.lit(1)))


def write_metrics(spark, sf):
    root = work_dir(spark, "metrics")
    rows = m.conversion(ev(spark, sf), window=DAY)
    sinks.write_metrics(rows, "conversion", root, 0)
    sinks.write_metrics(m.throughput(ev(spark, sf), window=DAY), "throughput", root, 0)
    back = spark.read.parquet(f"{root}/metrics")
    num = lambda name: F.get_json_object("payload", f"$.{name}").cast("double").alias(name)
    return back.select("metric_type", "window_start", "window_end", num("views_count"), num("purchases_count"), num("total_events"))


def metric_messages(spark, sf):
    msgs = sinks.metric_messages(m.throughput(ev(spark, sf), window=DAY), "throughput")
    return msgs.select("key", "topic", F.get_json_object("value", "$.total_events").cast("bigint").alias("total_events"))


def write_audiences(spark, sf):
    root = work_dir(spark, "audiences")
    rows = au.classify_audiences(crowd(ev(spark, sf)), limits=AUDIENCE).drop("action", "confidence")
    sinks.write_audiences(rows, root, 0)
    return spark.read.parquet(f"{root}/audiences").select("user_id", "audience_type", "action", "confidence", "detected_at", "expires_at")


def alert_log(spark, sf):
    """The hour's alerts of two runs: the second run raises the carts of fewer hours again."""
    first = al.detect_alerts(ev(spark, sf), limits=ALERT, window=ALERT_WINDOW)
    second = first.withColumn("current_value", F.col("current_value") + 1).filter(F.col("severity") == "CRITICAL")
    at = lambda df, n: df.withColumn("detected_at", F.timestamp_add("HOUR", F.lit(n), F.col("window_end"))).withColumn("batch_id", F.lit(n))
    return at(first, 1).unionByName(at(second, 2))


def upsert_alerts(spark, sf):
    root = work_dir(spark, "alerts")
    log = alert_log(spark, sf)
    for n in (1, 2):
        sinks.write_alerts(log.filter(F.col("batch_id") == n).drop("batch_id"), root, n)
    rows = sinks.upsert_alerts(spark.read.parquet(f"{root}/alerts"))
    return rows.select("alert_type", "severity", "current_value", "threshold_value", "window_start", "detected_at")


def read_alerts(spark, sf):
    """The logs of both alert streams read before and after a compaction."""
    root = work_dir(spark, "alert-logs")
    jobs.alert_stream(halves(spark, sf), root, f"{root}/cp", limits=ALERT, window=ALERT_WINDOW).awaitTermination()
    jobs.big_cart_stream(halves(spark, sf), root, f"{root}/cp-cart", limits=ALERT, window=ALERT_WINDOW).awaitTermination()
    cols = ["alert_type", "severity", "current_value", "threshold_value", "window_start", "detected_at"]
    before = cut_lineage(sinks.read_alerts(spark, root).select(F.lit("before").alias("state"), *cols), "before")
    for name in ("alerts", "alerts_cart"):
        sinks.compact_alerts(spark, root, name)
    return before.unionByName(sinks.read_alerts(spark, root).select(F.lit("after").alias("state"), *cols))


def runs_table(spark, sf):
    """One load per day and channel, counted from the events."""
    e = ev(spark, sf).withColumn("day", F.date_trunc("day", "event_ts").cast("timestamp_ntz")).withColumn("status", delivery_status())
    rows = e.groupBy("day", "source").agg(
        F.count_if(F.col("status") != "REJECTED").alias("publicados"), F.count_if(F.col("status") == "CONFIRMED").alias("enviados"),
        F.count_if(F.col("status") == "REJECTED").alias("rechazados"), F.count_if(F.col("status") == "FAILED").alias("fallidos"),
        F.min("event_ts").alias("started_at"), F.max("event_ts").alias("finished_at"),
    )
    return rows.select(
        F.concat_ws("-", "source", F.date_format("day", "yyyyMMdd")).alias("run_id"), F.col("source").alias("source_file"), "day",
        "publicados", "enviados", "rechazados", "fallidos", "started_at", "finished_at",
        F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at")).alias("segundos"),
    )


def delivery_status():
    n = F.col("arrival")
    return (
        F.when(n % 31 == 0, "REJECTED").when(n % 37 == 0, "FAILED").when(n % 41 == 0, "PENDING").otherwise("CONFIRMED")
    )


def write_runs(spark, sf):
    root = work_dir(spark, "runs")
    rows = runs_table(spark, sf)
    sinks.write_runs(rows.filter(F.col("source_file") != "POS"), root, 0)
    sinks.write_runs(rows.withColumn("publicados", F.lit(0).cast("bigint")), root, 1)
    return sinks.read_runs(spark, root).select(
        "run_id", "publicados", "enviados", "rechazados", "fallidos", "started_at", "finished_at", F.col("batch_id").cast("bigint").alias("batch_id")
    )


def write_by_source(spark, sf):
    path = work_dir(spark, "by_source")
    parsed = va.parse_envelope(ad.envelope_lines(whole(spark, sf))).filter(F.col("error_reason").isNull())
    sinks.write_by_source(parsed.select("value", "source_hint"), path)
    split = spark.read.text(f"{path}/by_source").groupBy(F.col("source_hint").alias("channel")).agg(F.count(F.lit(1)).alias("lines"))
    every = spark.read.text(f"{path}/all").agg(F.lit("TODOS").alias("channel"), F.count(F.lit(1)).alias("lines"))
    return split.unionByName(every)


def export_alerts_csv(spark, sf):
    path = work_dir(spark, "csv")
    feed = feed_of(spark, sf).withColumn("description", F.concat(F.lit('a;b "c", '), "title"))
    sinks.export_alerts_csv(feed, path)
    back = spark.read.option("sep", ";").option("header", True).option("escape", '"').csv(path)
    return back.select("nivel", "titulo", "descripcion", "componente", "escenario", "estado", "timestamp")


def benchmark_rows(spark, sf):
    """Latency and rate per scenario and channel in the benchmark summary's columns."""
    e = ev(spark, sf).withColumn("status", delivery_status())
    counts = e.groupBy("scenario", "source").agg(
        F.count_if(F.col("status") != "REJECTED").alias("publicados"), F.count_if(F.col("status") == "CONFIRMED").alias("enviados"),
        F.count_if(F.col("status") == "REJECTED").alias("rechazados"), F.count_if(F.col("status") == "FAILED").alias("fallidos"),
        F.timestamp_diff("SECOND", F.min("event_ts"), F.max("event_ts")).cast("double").alias("segundos"),
    )
    lat = ql.latency_summary(e, by=["scenario", "source"])
    rows = ql.rate_summary(counts.join(lat, ["scenario", "source"]))
    return rows.select(
        F.col("source").alias("configuracion"), F.lit(0).cast("bigint").alias("linger_ms"), F.lit("none").alias("compresion"),
        F.col("scenario").alias("escenario"), "segundos", "publicados", "enviados", "rechazados", "fallidos", "eventos_por_segundo",
        F.col("p50").alias("latencia_p50_ms"), F.col("p95").alias("latencia_p95_ms"), F.col("p99").alias("latencia_p99_ms"),
        F.col("mean").alias("latencia_promedio_ms"), F.col("max").alias("latencia_max_ms"),
    )


def write_benchmark_csv(spark, sf):
    path = work_dir(spark, "benchmark")
    rows = benchmark_rows(spark, sf)
    sinks.write_benchmark_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


# --- validation, dedup, routing ---------------------------------------------------------


def checked_lines(spark, sf):
    return va.validate_raw_event(ad.event_lines(whole(spark, sf)))


def valid_lines(spark, sf):
    return checked_lines(spark, sf).filter(F.col("error_reason").isNull())


def validate_envelope(spark, sf):
    return va.validate_envelope(ad.envelope_lines(whole(spark, sf))).select("arrival", "error_reason")


def validate_purchase_items(spark, sf):
    return va.validate_purchase_items(ad.envelope_lines(whole(spark, sf))).select("arrival", "error_reason")


def enrich_envelope(spark, sf):
    valid = va.validate_envelope(ad.envelope_lines(whole(spark, sf))).filter(F.col("error_reason").isNull())
    out = va.enrich_envelope(valid, load_id="checks")
    return out.select(
        "arrival", "event_id", "schema_version",
        "event_type", "event_timestamp", "user_id", "session_id", "agent_profile", "city", "region", "scenario", "source",
        F.col("ingestion_timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}\+00:00$").alias("stamped"),
        F.get_json_object("payload", "$.product_id").alias("product_id"),
    )


def validate_event(spark, sf):
    return va.validate_event(ad.event_lines(whole(spark, sf))).select("arrival", "error_reason")


def validate_raw_event(spark, sf):
    return checked_lines(spark, sf).select("arrival", "error_reason")


def check_routing(spark, sf):
    """Every message arrives on the channel of the previous source in the list."""
    parsed = va.parse_envelope(ad.envelope_lines(whole(spark, sf)))
    n = F.col("arrival")
    channel = ad.pick(C.SOURCES, F.when(n % 6 == 5, n + 1).otherwise(n))
    return va.check_routing(parsed.drop("error_reason"), channel).select("arrival", "error_reason")


def enrich_latency(spark, sf):
    return va.enrich_latency(va.typed_events(valid_lines(spark, sf))).select(
        "arrival", "event_id", "event_ts", "ingestion_ts", "latency_ms", "city", "region"
    )


def parse_event_time(spark, sf):
    parsed = va.parse_json(ad.event_lines(whole(spark, sf))).withColumn("event_timestamp", va.get("doc", "$.event_timestamp"))
    return va.parse_event_time(parsed).select("arrival", "event_ts", "epoch_ms")


def dedup_events(spark, sf):
    typed = va.typed_events(valid_lines(spark, sf))
    return dd.dedup_events(typed).select("arrival", "event_id", "error_reason")


def dedup_stream(spark, sf):
    """Every event delivered one to three times; a day of lateness covers the copies."""
    out = work_dir(spark, "dedup")
    raw = spark.readStream.schema(ad.table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    events = jobs.as_instant(ad.map_events(raw)).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("arrival") % 3).cast("int"))))
    unique = dd.dedup_stream(events, "1 day", ts="event_ts").select("event_id", "user_id", "event_type", to_utc_ntz(F.col("event_ts")).alias("event_ts"))
    jobs.start(unique.writeStream.format("parquet").option("path", f"{out}/data"), f"{out}/cp").awaitTermination()
    return spark.read.parquet(f"{out}/data")


def dead_letters(spark, sf):
    _, rejects = batch.ingest(ad.event_lines(whole(spark, sf)))
    return rejects.select("arrival", "error_reason", "event_id")


def dead_letter_key(spark, sf):
    checked = va.validate_envelope(ad.envelope_lines(whole(spark, sf)))
    return va.dead_letters(checked, form="producer").select("arrival", "error_reason", "key")


def route_events(spark, sf):
    raw = va.parse_json(ad.event_lines(whole(spark, sf))).select("arrival", va.get("doc", "$.event_type").alias("event_type"))
    return rt.route_events(raw).select("arrival", "topic", "error_reason")


def routing_audit(spark, sf):
    """A route table with one type routed twice, against the types that occur (raw forms too)."""
    topics = dict(C.TOPICS)
    topics["iot-events"] = (2, ("GPS_UPDATE", "IOT_READING", "MOTION_DETECTED", "SEARCH"))
    topics["system-events"] = (1, ())
    return rt.routing_audit(rt.routing_table(spark, topics), ev(spark, sf))


def placed(spark, sf):
    """Routed events with a partition that depends on the last character of the user."""
    partitions = lookup("topic", {t: str(p) for t, (p, _) in C.TOPICS.items()}).cast("int")
    routed = rt.route_events(ev(spark, sf)).withColumn("kafka_partition", F.ascii(F.right("user_id", F.lit(1))) % partitions)
    return routed.withColumnRenamed("topic", "kafka_topic")


def partition_balance(spark, sf):
    return rt.partition_balance(placed(spark, sf))


def partition_totals(spark, sf):
    """Balance rolled up per topic: independent of the placement itself."""
    return rt.partition_balance(placed(spark, sf)).groupBy("topic").agg(F.sum("events").alias("events"), F.sum("keys").alias("keys"))


def validate_file_report(spark, sf):
    return va.validate_file_report(ad.envelope_lines(whole(spark, sf)))


def summarize_events(spark, sf):
    return rt.summarize_events(ev(spark, sf))


def delivery_counters(spark, sf):
    return rt.delivery_counters(ev(spark, sf).withColumn("status", delivery_status()))


# --- metrics ------------------------------------------------------------------------------


def active_users(spark, sf):
    out = m.active_users(ev(spark, sf), window=DAY)
    return out.withColumn("unique_users_sample", F.array_join("unique_users_sample", ","))


def events_by_type_document(spark, sf):
    rows = m.events_by_type(ev(spark, sf), window=DAY)
    doc = m.to_document(rows, ["window_start", "window_end"], ["event_type", "events"], ["event_type"], "counts")
    return doc.select("window_start", F.get_json_object("payload", "$.counts[0].event_type").alias("first_type"),
                      F.get_json_object("payload", "$.counts[0].events").cast("bigint").alias("first_events"))


def top_purchased_products(spark, sf):
    return m.top_purchased_products(bought(spark, sf), window=DAY)


def top_purchased_orders(spark, sf):
    """The same ranking over the order lines of all years, per 30 days."""
    return m.top_purchased_products(ad.order_items(spark, sf), window="30 days", k=5)


def metric(name):
    def run(spark, sf):
        return getattr(m, name)(ev(spark, sf), window=DAY)

    return run


def metric_by(name):
    def run(spark, sf):
        return getattr(m, name)(ev(spark, sf), window=DAY, by=["scenario"])

    return run


def trends(spark, sf):
    return m.trends(ev(spark, sf), window=DAY, slide="6 hours")


STREAM_WINDOWS = C.Windows(*(["1 day"] * 7), trends_slide="6 hours", lateness="5 seconds")


#: Bytes of a row group of files made for streams.
ROW_GROUP = 4 << 20


def in_two_files(spark, sf, first) -> str:
    """The events table as a folder of two files, rows of `first` in the older one."""
    path = work_dir(spark, "two-files")
    events = ad.table(spark, sf, "events")
    # A file is a micro-batch; its row groups are small, so that many tasks read it.
    for part in (first, ~F.coalesce(first, F.lit(False))):
        events.filter(part).coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)
    return path


def mapped_stream(spark, path, fields):
    raw = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    return ad.map_events(raw, fields)


def halves(spark, sf, fields=ad.CORE_FIELDS):
    """A stream of the events in two micro-batches, cut in the middle of a day and hour."""
    return mapped_stream(spark, in_two_files(spark, sf, F.col("ts") < F.lit("2024-01-16 10:20:00").cast("timestamp_ntz")), fields)


def metric_stream(name):
    """The metric as a stream in two micro-batches; the windows open at the end are written when it has drained."""

    def run(spark, sf):
        root = work_dir(spark, f"stream-{name}")
        jobs.run_metric(halves(spark, sf, (*ad.CORE_FIELDS, "items")), name, root, f"{root}/cp", STREAM_WINDOWS).awaitTermination()
        rows = spark.read.parquet(f"{root}/{name}").drop("batch_id")
        return rows.withColumn("unique_users_sample", F.array_join("unique_users_sample", ",")) if name == "active_users" else rows

    return run


def late_rows(spark, sf):
    """Every fifth event comes in a second batch; those of closed days are late."""
    root = work_dir(spark, "late")
    path = in_two_files(spark, sf, F.col("event_id") % 5 != 0)
    jobs.run_metric(mapped_stream(spark, path, ad.CORE_FIELDS), "throughput", root, f"{root}/cp", STREAM_WINDOWS).awaitTermination()
    return windows.late_rows(spark, root, "throughput").drop("batch_id")


def throughput_without_late_rows(spark, sf):
    """The metric of the same input: days count what came before they were closed."""
    root = work_dir(spark, "late")
    path = in_two_files(spark, sf, F.col("event_id") % 5 != 0)
    jobs.run_metric(mapped_stream(spark, path, ad.CORE_FIELDS), "throughput", root, f"{root}/cp", STREAM_WINDOWS).awaitTermination()
    return spark.read.parquet(f"{root}/throughput").select("window_start", "total_events")


# --- audiences ----------------------------------------------------------------------------


def audience(name):
    def run(spark, sf):
        out = getattr(au, name)(crowd(ev(spark, sf)), AUDIENCE)
        cols = []
        for c, t in out.dtypes:
            cols.append(F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c))
        return out.select(*cols)

    return run


def classified(spark, sf):
    return au.classify_audiences(crowd(ev(spark, sf)), limits=AUDIENCE)


def classify_audiences(spark, sf):
    return classified(spark, sf).drop("evidence")


def previous_audiences(spark, sf):
    """The evaluation as of the 20th."""
    early = crowd(ev(spark, sf)).filter(F.col("event_ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return au.classify_audiences(early, limits=AUDIENCE)


def audience_changes(spark, sf):
    return au.audience_changes(classified(spark, sf), previous_audiences(spark, sf), F.lit("2024-01-31 06:00:00").cast("timestamp_ntz"))


def classify_as_of(spark, sf):
    out = asof.classify_as_of(crowd(ev(spark, sf)), limits=AUDIENCE, segment=DAY)
    return out.drop("evidence", "action")


def classify_stream(spark, sf):
    """The newest row of every user that the second of two micro-batches evaluated, over the state of both."""
    root = work_dir(spark, "audience-stream")
    jobs.classify_stream(crowd(halves(spark, sf)), root, f"{root}/cp", AUDIENCE).awaitTermination()
    rows = spark.read.parquet(f"{root}/audiences").filter("batch_id = 1")
    return rows.select("user_id", "audience_type", "action", "confidence", "detected_at", "expires_at")


# --- alerts -------------------------------------------------------------------------------


def eps_baseline(spark, sf):
    facts = al.window_facts(ev(spark, sf), ALERT, window=ALERT_WINDOW, carts=False)
    out = al.eps_baseline(facts, init=ALERT.baseline_init)
    return out.select("window_start", "eps", F.round("baseline", 9).alias("baseline"))


def alert(name):
    def run(spark, sf):
        return getattr(al, name)(ev(spark, sf), limits=ALERT, window=ALERT_WINDOW).drop("alert_id", "window_end", "detected_at")

    return run


def alerts_of(spark, sf):
    return al.detect_alerts(ev(spark, sf), limits=ALERT, window=ALERT_WINDOW)


def detect_alerts(spark, sf):
    return alerts_of(spark, sf).drop("alert_id", "message", "detected_at")


def detect_alerts_zero_fill(spark, sf):
    out = al.detect_alerts(
        ev(spark, sf), limits=ALERT, window="15 minutes", only=["TRAFFIC_DROP", "TRAFFIC_SPIKE"], zero_fill=True
    )
    return out.select("alert_type", "severity", "current_value", "threshold_value", "window_start")


def alert_stream(spark, sf):
    root = work_dir(spark, "alert-stream")
    jobs.alert_stream(halves(spark, sf), root, f"{root}/cp", limits=ALERT, window=ALERT_WINDOW).awaitTermination()
    return spark.read.parquet(f"{root}/alerts").select("alert_type", "severity", "current_value", "threshold_value", "window_start")


def big_cart_stream(spark, sf):
    root = work_dir(spark, "cart-stream")
    jobs.big_cart_stream(halves(spark, sf), root, f"{root}/cp", limits=ALERT, window=ALERT_WINDOW).awaitTermination()
    return spark.read.parquet(f"{root}/alerts_cart").select("alert_type", "severity", "current_value", "threshold_value", "window_start", "message")


def feed_of(spark, sf):
    return sv.alert_feed(alerts_of(spark, sf))


# --- serving ------------------------------------------------------------------------------


def metrics_table(spark, sf):
    return batch.metrics_table(ev(spark, sf), DAY)


def latest_metrics(spark, sf):
    num = lambda name: F.get_json_object("payload", f"$.{name}").cast("double").alias(name)
    return sv.latest_metrics(metrics_table(spark, sf)).select(
        "metric_type", "window_start", "window_end", num("total_events"), num("active_users_count"), num("overall_conversion_rate"), num("total_revenue")
    )


def metric_history(spark, sf):
    num = lambda name: F.get_json_object("payload", f"$.{name}").cast("double")
    return sv.metric_history(metrics_table(spark, sf)).select(
        "metric_type", "position", "window_end",
        F.coalesce(num("total_events"), num("active_users_count"), num("overall_conversion_rate") / 100, num("events_count")).alias("value"),
    )


def profile_stats(spark, sf):
    return sv.profile_stats(ev(spark, sf), by=["scenario"])


def source_share(spark, sf):
    return sv.source_share(ev(spark, sf), by=["scenario"])


def alert_feed(spark, sf):
    return feed_of(spark, sf).select("level", "title", "timestamp", "component", "scenario", "status")


def type_counts(spark, sf):
    return m.events_by_type(ev(spark, sf), window=None)


def events_by_type_share(spark, sf):
    return sv.events_by_type_share(type_counts(spark, sf))


def heatmap(spark, sf):
    return sv.event_type_heatmap(ev(spark, sf), buckets=48, unit="hour")


def viewed_products(spark, sf):
    return m.viewed_products(ev(spark, sf), window=None)


def purchased_products(spark, sf):
    return m.purchased_products(bought(spark, sf), window=None)


def product_table(spark, sf):
    orders = sv.product_orders(bought(spark, sf))
    return sv.product_view_purchase_join(viewed_products(spark, sf), purchased_products(spark, sf), orders=orders)


def funnel(spark, sf):
    return sv.funnel(m.conversion(ev(spark, sf), window=DAY).drop("window_end"), by=["window_start"])


def regions_of(spark, sf):
    e = ev(spark, sf)
    users = m.active_users(e, window=None, sample=0).scalar()
    conv = (m.conversion(e, window=None).select("overall_conversion_rate")).scalar() / 100
    return sv.region_stats(m.purchases_by_region(e, window=None), active_users=users, conversion=conv)


def region_activity(spark, sf):
    return sv.region_activity(ev(spark, sf))


def audience_summary(spark, sf):
    # UTF-8 text in evidence differs in field order between engines, so it is left out here.
    out = sv.audience_summary(classified(spark, sf)).drop("evidence")
    return out.withColumn("sample_users", F.array_join("sample_users", ","))


def kpi_snapshot(spark, sf):
    return sv.kpi_snapshot(metrics_table(spark, sf), feed_of(spark, sf))


def pipeline_health(spark, sf):
    e = ev(spark, sf)
    alerts = feed_of(spark, sf).agg(F.count(F.lit(1))).scalar()
    processed = e.agg(F.count(F.lit(1))).scalar()
    return sv.pipeline_health(e, runs_table(spark, sf), metrics_table(spark, sf), classified(spark, sf), alerts, processed)


def snapshot_parts(spark, sf):
    """Rows of every part of the assembled snapshot, for a scenario name that does not exist."""
    parts = dashboard_snapshot(
        ad.contract_events(spark, sf, (*ad.CORE_FIELDS, "items")), metrics_table(spark, sf), classified(spark, sf), alerts_of(spark, sf), runs_table(spark, sf),
        "no-such-scenario", heatmap_unit="hour",
    )
    out = None
    for name, df in parts.items():
        rows = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def audit_counts(spark, sf):
    e = rt.route_events(ev(spark, sf)).withColumnRenamed("topic", "kafka_topic")
    return sv.audit_counts(e, runs_table(spark, sf), metrics_table(spark, sf), classified(spark, sf), alerts_of(spark, sf))


# --- series, products, scenarios ----------------------------------------------------------------


def series(spark, sf, by=()):
    t = m.throughput(ev(spark, sf), window=HOUR, by=list(by))
    return t.select(*by, "window_start", (F.col("total_events") / 3600.0).alias("eps"), "total_events")


def rounded(df: DataFrame, digits: int = 7) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def series_stats(spark, sf):
    return rounded(se.series_stats(series(spark, sf, ["scenario"]), "total_events", by=["scenario"]))


def series_stats_global(spark, sf):
    return rounded(se.series_stats(series(spark, sf), "total_events"))


def zscore_anomalies(spark, sf):
    return rounded(se.zscore_anomalies(series(spark, sf), "total_events").drop("eps"))


def period_comparison(spark, sf):
    return rounded(se.period_comparison(series(spark, sf, ["scenario"]), "total_events", by=["scenario"]))


def filter_recent(spark, sf):
    minute = m.throughput(ev(spark, sf), window="1 minute", by=["scenario"])
    return no_window(se.filter_recent(minute, "1h", by=["scenario"])).drop("events_per_second")


def expected_band(spark, sf):
    return rounded(se.expected_band(series(spark, sf, ["scenario"]).drop("eps"), "total_events", by=["scenario"]))


def heatmap_intensity(spark, sf):
    return se.heatmap_intensity(heatmap(spark, sf)).drop("label")


def category_share(spark, sf):
    return pr.category_share(type_counts(spark, sf))


def product_matrix(spark, sf):
    return rounded(pr.product_matrix(product_table(spark, sf)).drop("product_name", "category", "revenue", "orders"))


def quadrant_groups(spark, sf):
    return pr.quadrant_groups(pr.product_matrix(product_table(spark, sf)))


def product_ranking(spark, sf):
    return pr.product_ranking(product_table(spark, sf), "revenue", 20).select("product_id", "position", "revenue", "relative")


def region_ranking(spark, sf):
    return pr.region_ranking(regions_of(spark, sf), "revenue").select("region", "revenue", "position", "intensity")


def product_leaks(spark, sf):
    found = pr.product_leaks(product_table(spark, sf), purchased_products(spark, sf)).drop("product_name")
    return rounded(found.withColumn("views", F.col("views").cast("double")))


def insights(spark, sf):
    return rounded(insight_rows(spark, sf, "general"), 6)


def insight_rows(spark, sf, scope):
    s = series(spark, sf).drop("eps").withColumnRenamed("total_events", "eps")
    return ins.insights(
        sv.audience_summary(classified(spark, sf)), regions_of(spark, sf), product_table(spark, sf), purchased_products(spark, sf),
        s, events_by_type_share(spark, sf), feed_of(spark, sf), scope,
    )


def insights_scoped(scope):
    def run(spark, sf):
        return rounded(insight_rows(spark, sf, scope), 6)

    return run


def system_summary(spark, sf):
    s = series(spark, sf).drop("eps").withColumnRenamed("total_events", "eps")
    out = ins.system_summary(kpi_snapshot(spark, sf), s, events_by_type_share(spark, sf), feed_of(spark, sf), regions_of(spark, sf))
    return rounded(out, 6)


def funnel_insights(spark, sf):
    stages = sv.funnel(m.conversion(ev(spark, sf), window=None))
    return rounded(ins.funnel_insights(stages, m.conversion(ev(spark, sf), window=DAY)), 6)


def alert_filter(spark, sf):
    rows = av.alert_filter(feed_of(spark, sf), level="WARNING", status="RECONOCIDA", text="CART")
    return rows.select("title", "level", "status", "timestamp")


def alert_counts(spark, sf):
    return av.alert_counts(feed_of(spark, sf))


def alerts_by_component(spark, sf):
    return av.alerts_by_component(feed_of(spark, sf))


def components_degraded(spark, sf):
    """Components of the feed, degraded where an alert is active."""
    hit = feed_of(spark, sf).filter(F.col("status") == "ACTIVA").groupBy("component").agg(F.count(F.lit(1)).alias("active"))
    every = feed_of(spark, sf).select("component").distinct().join(hit, "component", "left")
    return av.components_degraded(every.select("component", F.when(F.col("active") > 0, "DEGRADADO").otherwise("OPERATIVO").alias("status")))


def alert_timeline(spark, sf):
    return rounded(av.alert_timeline(feed_of(spark, sf)).select("title", "timestamp", "at"))


def acks_of(spark, sf):
    feed = feed_of(spark, sf)
    return feed.filter(F.col("level") == "CRITICAL").select("id", F.when(F.hour("timestamp") % 2 == 0, "RESUELTA").otherwise("RECONOCIDA").alias("status"))


def alert_status_overlay(spark, sf):
    return av.alert_status_overlay(feed_of(spark, sf), acks_of(spark, sf)).select("title", "timestamp", "level", "status")


def mean_ack_minutes(spark, sf):
    return rounded(av.mean_ack_minutes(feed_of(spark, sf), F.lit("2024-01-31").cast("timestamp_ntz")))


def audience_overview(spark, sf):
    return ins.audience_overview(sv.audience_summary(classified(spark, sf)))


def scenario_rows(spark, sf):
    return sc.scenario_results(ev(spark, sf), window=HOUR, limits=ALERT)


def scenario_results(spark, sf):
    return rounded(scenario_rows(spark, sf))


def scenario_conclusions(spark, sf):
    return rounded(sc.scenario_conclusions(scenario_rows(spark, sf)))


def normalize_for_radar(spark, sf):
    return sc.normalize_for_radar(scenario_rows(spark, sf))


# --- quality ----------------------------------------------------------------------------------


def latency_summary(spark, sf):
    return ql.latency_summary(ev(spark, sf), by=["source"])


def value_percentiles(spark, sf):
    """Exact percentiles of the extended price of all line items."""
    li = ad.table(spark, sf, "lineitem")
    return rounded(ql.exact_percentiles(li, "l_extendedprice", (0, 25, 50, 95, 99, 100), by=["l_returnflag"]), 4)


def rate_summary(spark, sf):
    return ql.rate_summary(runs_table(spark, sf)).select("run_id", "enviados", "segundos", "eventos_por_segundo")


def deliveries(spark, sf):
    """One delivery per event: topic, expected and actual partition, or an error."""
    n = F.col("arrival")
    status = delivery_status()
    expected = (n % 4).cast("int")
    return rt.route_events(ev(spark, sf)).select(
        "event_id", "topic", F.col("user_id").alias("key"), expected.alias("expected_partition"),
        F.when(status == "CONFIRMED", F.when(n % 43 == 0, (n + 1) % 4).otherwise(n % 4)).cast("int").alias("partition"),
        F.when(status == "FAILED", "TIMED_OUT").alias("error"),
    )


def reconcile(spark, sf):
    e = ev(spark, sf).withColumn("status", delivery_status())
    s = F.col("status")
    counters = e.groupBy("source").agg(
        F.count_if(s != "REJECTED").alias("published"), F.count_if(s == "CONFIRMED").alias("confirmed"), F.count_if(s == "FAILED").alias("failed")
    )
    stored = e.filter((s == "CONFIRMED") & (F.col("arrival") % 101 != 0)).groupBy("source").agg(F.count(F.lit(1)).alias("stored"))
    return ql.reconcile(counters, stored, by=["source"])


def missing_events(spark, sf):
    sent = deliveries(spark, sf).filter(F.col("partition").isNotNull()).select("event_id", "topic")
    read = ev(spark, sf).filter(F.col("arrival") % 53 != 0).select("event_id")
    return ql.missing_events(sent, read)


def deliveries_by_topic(spark, sf):
    return ql.deliveries_by_topic(deliveries(spark, sf))


def partition_mismatch(spark, sf):
    return ql.partition_mismatch(deliveries(spark, sf)).select("event_id", "topic", "reason")


QUERIES = {
    # sources, parsing, sinks
    "read_event_lines": read_event_lines,
    "read_event_stream": read_event_stream,
    "parse_envelope": parse_envelope,
    **{f"explode_payload_{k.lower()}": payload_of(k) for k in C.EVENT_TYPES},
    "explode_purchase_items": explode_purchase_items,
    "write_event_store": write_event_store,
    "store_counters": store_counters,
    "two_loads": two_loads,
    "write_metrics": write_metrics,
    "metric_messages": metric_messages,
    "write_audiences": write_audiences,
    "upsert_alerts": upsert_alerts,
    "read_alerts": read_alerts,
    "write_runs": write_runs,
    "write_by_source": write_by_source,
    "export_alerts_csv": export_alerts_csv,
    "write_benchmark_csv": write_benchmark_csv,
    # validation, dedup, routing
    "validate_envelope": validate_envelope,
    "validate_purchase_items": validate_purchase_items,
    "enrich_envelope": enrich_envelope,
    "validate_event": validate_event,
    "validate_raw_event": validate_raw_event,
    "check_routing": check_routing,
    "enrich_latency": enrich_latency,
    "parse_event_time": parse_event_time,
    "dedup_events": dedup_events,
    "dedup_stream": dedup_stream,
    "dead_letters": dead_letters,
    "dead_letter_key": dead_letter_key,
    "route_events": route_events,
    "routing_audit": routing_audit,
    "partition_balance": partition_balance,
    "partition_totals": partition_totals,
    "validate_file_report": validate_file_report,
    "summarize_events": summarize_events,
    "delivery_counters": delivery_counters,
    # metrics
    "throughput": metric("throughput"),
    "throughput_by_scenario": metric_by("throughput"),
    "active_users": active_users,
    "events_by_type": metric("events_by_type"),
    "events_by_type_document": events_by_type_document,
    "top_viewed_products": metric("top_viewed_products"),
    "top_viewed_products_by_scenario": metric_by("top_viewed_products"),
    "top_purchased_products": top_purchased_products,
    "top_purchased_orders": top_purchased_orders,
    "purchases_by_region": metric("purchases_by_region"),
    "conversion": metric("conversion"),
    "conversion_by_scenario": metric_by("conversion"),
    "trends": trends,
    **{f"stream_{n}": metric_stream(n) for n in C.METRIC_TOPICS},
    "late_rows": late_rows,
    "throughput_without_late_rows": throughput_without_late_rows,
    # audiences
    **{n: audience(n) for n in (
        "aud_compulsive", "aud_comparer", "aud_abandoned_cart", "aud_night_buyer", "aud_high_value", "aud_undecided", "aud_multi_device"
    )},
    "classify_audiences": classify_audiences,
    "audience_changes": audience_changes,
    "classify_as_of": classify_as_of,
    "classify_stream": classify_stream,
    # alerts
    "eps_baseline": eps_baseline,
    **{n: alert(n) for n in (
        "alert_traffic_spike", "alert_traffic_drop", "alert_payment_failure_rate", "alert_high_value_payment_failure",
        "alert_high_value_cart", "alert_search_pressure", "alert_cart_activity", "alert_high_latency"
    )},
    "detect_alerts": detect_alerts,
    "detect_alerts_zero_fill": detect_alerts_zero_fill,
    "alert_stream": alert_stream,
    "big_cart_stream": big_cart_stream,
    # serving
    "latest_metrics": latest_metrics,
    "metric_history": metric_history,
    "profile_stats": profile_stats,
    "source_share": source_share,
    "alert_feed": alert_feed,
    "events_by_type_share": events_by_type_share,
    "event_type_heatmap": heatmap,
    "product_view_purchase_join": product_table,
    "funnel": funnel,
    "region_stats": regions_of,
    "region_activity": region_activity,
    "audience_summary": audience_summary,
    "kpi_snapshot": kpi_snapshot,
    "pipeline_health": pipeline_health,
    "dashboard_snapshot": snapshot_parts,
    "audit_counts": audit_counts,
    # series, products, scenarios
    "series_stats": series_stats,
    "series_stats_global": series_stats_global,
    "zscore_anomalies": zscore_anomalies,
    "period_comparison": period_comparison,
    "product_dwell": lambda spark, sf: rounded(pr.product_dwell(ev(spark, sf))),
    "filter_recent": filter_recent,
    "expected_band": expected_band,
    "heatmap_intensity": heatmap_intensity,
    "category_share": category_share,
    "product_matrix": product_matrix,
    "quadrant_groups": quadrant_groups,
    "product_ranking": product_ranking,
    "region_ranking": region_ranking,
    "product_leaks": product_leaks,
    "insights": insights,
    **{f"insights_{s}": insights_scoped(s) for s in ("audiencias", "regiones", "productos", "eventos", "alertas")},
    "system_summary": system_summary,
    "funnel_insights": funnel_insights,
    "alert_filter": alert_filter,
    "alert_counts": alert_counts,
    "alerts_by_component": alerts_by_component,
    "components_degraded": components_degraded,
    "alert_timeline": alert_timeline,
    "alert_status_overlay": alert_status_overlay,
    "mean_ack_minutes": mean_ack_minutes,
    "audience_overview": audience_overview,
    "scenario_results": scenario_results,
    "scenario_conclusions": scenario_conclusions,
    "normalize_for_radar": normalize_for_radar,
    # quality
    "latency_summary": latency_summary,
    "value_percentiles": value_percentiles,
    "rate_summary": rate_summary,
    "reconcile": reconcile,
    "missing_events": missing_events,
    "deliveries_by_topic": deliveries_by_topic,
    "partition_mismatch": partition_mismatch,
}
