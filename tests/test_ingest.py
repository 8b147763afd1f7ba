import json

import pytest
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators import routing as rt
from tidemark.operators import validate as va
from tidemark.plans import batch
from tidemark.sources import lines as ln
from tidemark.sources import sinks
from tests.helpers import T0, event, table

SAMPLE = {
    "STRING": "x", "BIGINT": 1, "DOUBLE": 0.5, "BOOLEAN": True, "DECIMAL(18,2)": 10.5,
}
ITEM = {n: SAMPLE[t] for n, t in C.ITEM_FIELDS.items()}


def payload(kind):
    return {n: [ITEM] if t.startswith("ARRAY") else SAMPLE[t] for n, t in C.PAYLOAD_FIELDS[kind].items()}


def published(kind="VIEW_PRODUCT", **over):
    e = dict(
        event_id="evt_1", schema_version="1.0", event_type=kind, event_timestamp="2026-07-25T22:14:03.482-05:00",
        ingestion_timestamp="2026-07-25T22:14:03.610-05:00", user_id="USR1", session_id="S1", agent_profile="COMPARADOR", source="WEB",
        city=" Lima ", region="LIMA", scenario="BASE", payload=payload(kind),
    )
    e.update(over)
    return {k: v for k, v in e.items() if v is not Ellipsis}


def envelope(kind="VIEW_PRODUCT", hint="WEB", **over):
    e = {k: v for k, v in published(kind).items() if k in C.SOURCE_FIELDS}
    e.update(over)
    out = {"event": {k: v for k, v in e.items() if v is not Ellipsis}}
    return out if hint is Ellipsis else {"source_hint": hint, **out}


def reasons(spark, check, docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)]
    out = check(spark.createDataFrame(rows, "arrival bigint, value string"))
    return [r.error_reason for r in out.orderBy("arrival").collect()]


def test_every_type_passes_all_three_checks(spark):
    assert reasons(spark, va.validate_raw_event, [published(k) for k in C.EVENT_TYPES]) == [None] * 12
    assert reasons(spark, va.validate_event, [published(k) for k in C.EVENT_TYPES]) == [None] * 12
    assert reasons(spark, va.validate_envelope, [envelope(k) for k in C.EVENT_TYPES]) == [None] * 12


def test_every_missing_field_is_named(spark):
    got = reasons(spark, va.validate_raw_event, [published(**{f: ...}) for f in C.EVENT_FIELDS] + [published(**{f: None}) for f in C.EVENT_FIELDS])
    assert got == [f"Campo requerido ausente o nulo: {f}" for f in C.EVENT_FIELDS] * 2
    rest = [f for f in C.SOURCE_FIELDS if f != "event_type"]
    got = reasons(spark, va.validate_envelope, [envelope(event_type=...)] + [envelope(**{f: ...}) for f in rest])
    assert got == ["Falta event_type"] + [f"Faltan campos de A: ['{f}']" for f in rest]


def test_payload_needs_each_key_of_its_type(spark):
    docs, want = [], []
    for kind, fields in C.PAYLOAD_FIELDS.items():
        for name in fields:
            body = payload(kind)
            del body[name]
            docs.append(envelope(kind, payload=body))
            want.append(f"Payload de {kind} incompleto: faltan ['{name}']")
    assert reasons(spark, va.validate_envelope, docs) == want


def test_envelope_rules(spark):
    items = lambda v: envelope("PURCHASE", payload={**payload("PURCHASE"), "items": v})
    got = reasons(
        spark, va.validate_envelope,
        ["[1]", '{"event": 3}', envelope(event_type="X"), envelope(city=""), envelope(user_id=7), envelope(hint="FAX"), envelope(hint=...),
         envelope(payload="x"), items([]), items("x"), items([ITEM, {"product_id": "P"}]), items([3]), envelope(payload={**payload("VIEW_PRODUCT"), "price": None})],
    )
    assert got == [
        va.NOT_OBJECT_MESSAGE, va.NO_EVENT, "event_type fuera del contrato: 'X'", "city debe ser una cadena no vacía", "user_id debe ser una cadena no vacía",
        "source_hint fuera del contrato: 'FAX'", "source_hint fuera del contrato: None", va.BAD_PAYLOAD, va.EMPTY_ITEMS, va.EMPTY_ITEMS,
        "PURCHASE.items[1] incompleto: faltan ['category', 'product_name', 'quantity', 'subtotal', 'unit_price']", "PURCHASE.items[0] no es un objeto", None,
    ]


def test_strict_rules(spark):
    got = reasons(
        spark, va.validate_event,
        [published(extra=1), published(city=...), published(schema_version="2"), published(source="FAX"), published(event_id=""),
         published(event_timestamp="2026-07-25T22:14:03"), published(ingestion_timestamp="ayer"), published(event_timestamp=3), published(payload=[])],
    )
    assert got == [
        "El evento trae campos fuera del contrato: ['extra']", "El evento no tiene ['city']", "schema_version debe ser '1.0', no '2'",
        "source fuera del contrato: 'FAX'", "event_id debe ser una cadena no vacía", "event_timestamp debe traer zona horaria: '2026-07-25T22:14:03'",
        "ingestion_timestamp no es ISO-8601: 'ayer'", "event_timestamp debe ser una cadena ISO-8601", va.BAD_PAYLOAD,
    ]


def test_parse_envelope_rejects(spark):
    got = reasons(spark, va.parse_envelope, ["{no", "3", envelope(hint="FAX"), envelope(hint=...), envelope()])
    assert got == [va.BAD_LINE, va.NOT_OBJECT_MESSAGE, "source_hint fuera del contrato: 'FAX'", "source_hint fuera del contrato: None", None]


def test_enriched_event_passes_the_strict_check(spark):
    lines = spark.createDataFrame([(1, json.dumps(envelope()))], "arrival bigint, value string")
    with pytest.raises(ValueError):
        va.enrich_envelope(va.validate_envelope(lines))
    out = va.enrich_envelope(va.validate_envelope(lines), load_id="a load")
    row = out.first()
    assert row.event_timestamp == "2026-07-25T22:14:03.482-05:00" and row.source == "WEB" and "source_hint" not in out.columns
    doc = {k: v for k, v in row.asDict().items() if k != "arrival"}
    doc["payload"] = json.loads(doc["payload"])
    assert set(doc) == set(C.EVENT_FIELDS) and reasons(spark, va.validate_event, [doc]) == [None]


def test_ingest_of_a_file(spark, tmp_path):
    good = published(event_id="a")
    text = [json.dumps(good), "", "   ", "{roto", json.dumps(good), json.dumps(published(event_id="b", ingestion_timestamp="x")), json.dumps(published(user_id=...))]
    (tmp_path / "e.jsonl").write_text("\n".join(text))
    lines = ln.read_event_lines(spark, str(tmp_path / "e.jsonl"))
    assert lines.count() == 5 and ln.read_event_lines(spark, str(tmp_path / "e.jsonl"), 3).count() == 1
    events, rejects = batch.ingest(lines)
    rows = {r.event_id: r for r in events.collect()}
    assert rows["a"].latency_ms == 128 and rows["b"].latency_ms == 0 and rows["a"].city == "Lima"
    assert rows["a"].event_ts.hour == 3  # UTC, whatever the session zone is
    assert sorted(r.error_reason for r in rejects.collect()) == [
        "Campo requerido ausente o nulo: user_id", "Duplicate event_id: a", "JSON malformado",
    ]


@pytest.mark.parametrize("text,ok", [
    ("2026-07-25T22:14:03Z", True), ("2026-07-25 22:14:03+00:00", True), ("2026-07-25T22:14:03.123456-0500", True), ("2026", False), ("22:14:03", False), ("", False),
])
def test_time_forms(spark, text, ok):
    row = va.parse_event_time(spark.createDataFrame([(text,)], "event_timestamp string")).first()
    assert (row.event_ts is not None) is ok and (row.epoch_ms > 0) is ok


def test_routes(spark):
    audit = rt.routing_audit(rt.routing_table(spark), spark.createDataFrame([(k,) for k in C.EVENT_TYPES], "event_type string"))
    assert audit.count() == 0
    e = spark.createDataFrame([("PURCHASE",), ("X",)], "event_type string")
    assert {r.event_type: r.topic for r in rt.route_events(e).collect()} == {"PURCHASE": "purchase-events", "X": None}


def test_a_file_rewritten_under_its_path_is_another_load(spark, tmp_path):
    root, file = str(tmp_path / "store"), tmp_path / "e.jsonl"
    for n, texts in enumerate(([envelope(), envelope()], [envelope(), envelope(), envelope()])):
        file.write_text("\n".join(json.dumps(t) + " " * n for t in texts))
        lines = va.validate_envelope(ln.read_event_lines(spark, str(file)))
        events = va.parse_event_time(va.enrich_envelope(lines))
        assert sinks.write_event_store(events, root, n, buckets=2).first().insertados == n + 2
    assert sinks.write_event_store(events, root, 2, buckets=2).first().duplicados == 3
    kafka = va.validate_envelope(lines.drop("doc", "origin", "error_reason").withColumns({"kafka_topic": F.lit("t"), "kafka_partition": F.lit(5000), "kafka_offset": F.col("arrival")}))
    assert va.enrich_envelope(kafka).select("event_id").distinct().count() == 3


def test_event_store_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    e = table(spark, [event("SEARCH", sec=i) for i in range(10)])
    first = sinks.write_event_store(e.filter("arrival < 6"), root, 0, buckets=4).first()
    twice = e.unionByName(e.withColumn("arrival", F.col("arrival") + 100))
    second = sinks.write_event_store(twice, root, 1, buckets=4).first()
    again = sinks.write_event_store(twice, root, 1, buckets=4).first()  # a replayed batch
    assert (first.leidos, first.insertados) == (6, 6)
    assert tuple(second) == tuple(again) == (20, 4, 16, 0)
    store = sinks.read_event_store(spark, root)
    assert store.count() == 10 and store.select("event_id").distinct().count() == 10


def test_event_store_after_many_batches(spark, tmp_path):
    """Merged levels, few runs, no file of merged ones left, and every id found again."""
    from tidemark.sources.key_index import KeyIndex

    root = str(tmp_path)
    for n in range(9):
        e = table(spark, [event("SEARCH", sec=i) for i in range(30)]).withColumn("event_id", F.concat(F.lit(f"b{n}_"), "event_id"))
        index = KeyIndex(spark, root, buckets=3, fan=3)
        keys = e.select("event_id")
        assert index.known(keys, n) is None  # new ids: the filters admit none, so no id is read
        index.add(keys, n)
        if n % 2:
            index.add(keys, n)  # replayed
        assert len(index.runs(n + 1)) <= 4
    spark.sql(f"DROP TABLE {index.table}")  # a new session has no catalog entry, only files
    index = KeyIndex(spark, root, buckets=3, fan=3)
    assert [(r.level, r.rows) for r in index.runs(9)] == [(2, 270)]
    every = spark.range(9).crossJoin(spark.range(35).withColumnRenamed("id", "i")).select(F.concat(F.lit("b"), "id", F.lit("_evt_"), "i").alias("event_id"))
    for probes in (0, 1000):
        found = index.known(every, 9, probes=probes)
        assert found.count() == 270 and found.distinct().count() == 270
    assert index.known(every.filter("event_id like 'b8%'"), 8) is None  # a replay of batch 8 must not find its own ids
    live = {f"run={r.run}" for n in (8, 9) for r in index.runs(n)}
    assert {p.name for p in (tmp_path / "event_ids").iterdir() if p.name.startswith("run=")} == live
    assert len(list((tmp_path / "event_ids_manifests").iterdir())) <= 2


def test_the_id_side_of_a_look_up_is_not_shuffled(spark, tmp_path):
    from tidemark.sources.key_index import KeyIndex

    index = KeyIndex(spark, str(tmp_path), buckets=4)
    keys = spark.range(1000).select(F.col("id").cast("string").alias("event_id"))
    for n in range(3):
        index.add(keys.filter(F.col("event_id").cast("int") % 3 == n), n)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = index.known(keys, 3, probes=0)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("Bucketed: true")
        above = [line for line in plan[:scan].splitlines()]
        join = next(i for i, line in enumerate(above) if "Join" in line)
        right = plan.splitlines()[join:]
        depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in right]
        sides = [i for i, d in enumerate(depth) if i and d == min(depth[1:])]
        assert not any("Exchange" in line for line in right[sides[-1] :]) and any("Bucketed: true" in line for line in right[sides[-1] :])
        assert found.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_filters_admit_every_key_and_few_others(spark, tmp_path):
    from tidemark.sources.key_index import KeyIndex

    index = KeyIndex(spark, str(tmp_path), buckets=2)
    index.add(spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("event_id")), 0)
    tried = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("event_id"))
    admitted = index.admitted(tried, index.runs(1)).count()
    assert 20_000 <= admitted < 20_040


def test_alert_upsert_keeps_the_first_row_and_the_last_value(spark):
    log = spark.createDataFrame(
        [("A", "m1", 1.0, 1, 1), ("A", "m2", 5.0, 9, 2), ("B", "m3", 2.0, 1, 2)], "alert_id string, message string, current_value double, detected_at int, batch_id int"
    )
    assert {tuple(r) for r in sinks.upsert_alerts(log).select("alert_id", "message", "current_value", "detected_at").collect()} == {("A", "m1", 5.0, 9), ("B", "m3", 2.0, 1)}


def test_csv_quoting(spark, tmp_path):
    df = spark.createDataFrame([('a;b "c"\nd', "x,y")], "title string, description string")
    for c in ("id", "level", "component", "scenario", "status"):
        df = df.withColumn(c, F.lit(c))
    sinks.export_alerts_csv(df.withColumn("timestamp", F.lit(T0)), str(tmp_path / "c"))
    back = spark.read.option("sep", ";").option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "c")).first()
    assert back.titulo == 'a;b "c"\nd' and back.descripcion == "x,y"


def test_lines_are_numbered_by_file_and_place(spark, tmp_path):
    """Splits of several files: arrival is the line's number over the files in order of their paths."""
    names = {"b": 700, "a": 30, "c": 2000}
    for name, n in names.items():
        (tmp_path / f"{name}.jsonl").write_text("".join("\n" if i % 10 == 9 else f"{name} {i} {'x' * (i % 50)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = {r.arrival: r.value for r in ln.read_event_lines(spark, str(tmp_path)).collect()}
        first = {r.arrival for r in ln.read_event_lines(spark, str(tmp_path), 45).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    lines = [f"{name} {i} {'x' * (i % 50)}" if i % 10 != 9 else "" for name in sorted(names) for i in range(names[name])]
    assert got == {i: line for i, line in enumerate(lines) if line}
    assert first == {i for i in range(45) if lines[i]}


def test_the_rows_of_a_load_are_made_once(spark, tmp_path):
    """Ids are looked up, rows written and counted, all from one parse; rows without an id or with one id and place stay as they were."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def parsed(x):
        made.add(1)
        return x

    e = table(spark, [event("SEARCH", sec=i) for i in range(20)])
    e = e.withColumn("event_id", F.when(F.col("arrival") < 15, F.concat(F.lit("evt_"), (F.col("arrival") % 10).cast("string"))))
    e = e.unionByName(e.filter("arrival IN (3, 4)")).withColumn("event_id", parsed.asNondeterministic()("event_id")).withColumn("value", F.lit("x"))
    root = str(tmp_path)
    assert tuple(sinks.write_event_store(e, root, 0, buckets=2).first()) == (22, 17, 5, 0)
    assert made.value == 22 and sinks.read_event_store(spark, root).count() == 17
    assert spark.read.parquet(f"{root}/dead_letters/batch_id=0/kind=duplicate").count() == 5
