"""Contract checks.  Each check adds `error_reason`: null for a good row, else the
first rule that failed, in the contract's order.

A line is parsed once into a VARIANT, so types are the JSON types (a number is not
taken for a string) and everything after the parse is column expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import fence, has_zone, parse_instant

# --- Fixed reason texts --------------------------------------------------------
BAD_JSON = "JSON malformado"
BAD_LINE = "JSON inválido"
NOT_OBJECT_EVENT = "El evento debe ser un objeto JSON"
NOT_OBJECT_MESSAGE = "El mensaje no es un objeto JSON"
NOT_OBJECT_PUBLISHED = "El evento publicado no es un objeto"
NO_EVENT = "El sobre no trae un objeto 'event'"
NO_TYPE = "Falta event_type"
BAD_PAYLOAD = "payload debe ser un objeto"
EMPTY_ITEMS = "PURCHASE.items debe ser un arreglo no vacío"
# --- End of fixed reason texts --------------------------------------------------

NON_EMPTY_INPUT = ("event_timestamp", "user_id", "session_id", "city", "region")
NON_EMPTY_EVENT = ("event_id", "user_id", "session_id", "city", "region")


def get(v: str | Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def node(v, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def json_type(v: Column) -> Column:
    return F.schema_of_variant(v)


def keys_of(v, path: str) -> Column:
    """Keys of a JSON object, null when the node is not an object."""
    return F.map_keys(F.try_variant_get(v, path, "map<string,variant>"))


def is_text(v: Column) -> Column:
    return F.coalesce(json_type(v) == "STRING", F.lit(False))


def is_absent(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def quoted_list(names: Column) -> Column:
    """Sorted name list in the form the contract reports use: ['a', 'b']."""
    return F.concat(F.lit("['"), F.array_join(F.sort_array(names), "', '"), F.lit("']"))


def shown(v: Column) -> Column:
    """A JSON value as a reason text shows it: strings quoted, absent as None."""
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(is_absent(v), F.lit("None"))
        .when(is_text(v), F.concat(F.lit("'"), text, F.lit("'")))
        .when(json_type(v) == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def first_failure(checks: list[tuple[Column, Column | str]]) -> Column:
    """Reason of the first failing check; null when all pass."""
    start = (checks[0][0], checks[0][1])
    chain = F.when(start[0], _reason(start[1]))
    return reduce(lambda acc, c: acc.when(c[0], _reason(c[1])), checks[1:], chain)


def _reason(r) -> Column:
    return r if isinstance(r, Column) else F.lit(r)


def parse_json(lines: DataFrame, value: str = "value", out: str = "doc") -> DataFrame:
    return fence(lines, **{out: F.try_parse_json(value)})


def with_fields(df: DataFrame, out: str, path: str, names) -> DataFrame:
    """All wanted fields of a JSON object in one walk: texts, and the payload as VARIANT.

    The struct is null when the node is no object; a field is null when it is absent or
    JSON null.
    """
    ddl = ", ".join(f"{n}: {'variant' if n == 'payload' else 'string'}" for n in names)
    return df if out in df.columns else fence(df, **{out: F.try_variant_get("doc", path, f"struct<{ddl}>")})


# --- step 1: raw envelopes ------------------------------------------------------


def parse_envelope(lines: DataFrame) -> DataFrame:
    """Parse raw lines; reject text that is no JSON, no object, or has no valid source.

    `original` is the line itself when it is rejected.
    """
    df = parse_json(lines)
    hint = node("doc", "$.source_hint")
    keys = keys_of("doc", "$")
    reason = first_failure(
        [
            (F.col("doc").isNull(), BAD_LINE),
            (keys.isNull(), NOT_OBJECT_MESSAGE),
            (
                ~F.coalesce(get("doc", "$.source_hint").isin(*C.SOURCES), F.lit(False)),
                F.concat(F.lit("source_hint fuera del contrato: "), shown(hint)),
            ),
        ]
    )
    return (
        fence(df, error_reason=reason)
        .withColumn("source_hint", F.when(F.col("error_reason").isNull(), get("doc", "$.source_hint")))
        .withColumn("original", F.when(F.col("error_reason").isNotNull(), F.col("value")))
    )


def validate_envelope(lines: DataFrame) -> DataFrame:
    """Check {source_hint, event} envelopes before enrichment."""
    df = lines if "doc" in lines.columns else parse_json(lines)
    df = with_fields(df, "e", "$.event", C.SOURCE_FIELDS)
    df = fence(df, keys=keys_of("doc", "$.event"), payload_keys=keys_of(F.col("e.payload"), "$"))
    kind, kind_node = F.col("e.event_type"), node("doc", "$.event.event_type")
    missing = F.array_except(F.array(*[F.lit(f) for f in C.SOURCE_FIELDS]), F.col("keys"))
    payload_missing = F.array_except(_required_payload(kind), F.col("payload_keys"))
    # A field that is absent is named before a field that is null.
    checks = [
        (F.col("keys").isNull() & keys_of("doc", "$").isNull(), NOT_OBJECT_MESSAGE),
        (F.col("keys").isNull(), NO_EVENT),
        (kind.isNull(), NO_TYPE),
        (~kind.isin(*C.EVENT_TYPES), F.concat(F.lit("event_type fuera del contrato: "), shown(kind_node))),
        (F.size(missing) > 0, F.concat(F.lit("Faltan campos de A: "), quoted_list(missing))),
    ]
    for field in NON_EMPTY_INPUT:
        bad = F.coalesce(F.length(f"e.{field}") == 0, F.lit(True)) | ~is_text(node("doc", f"$.event.{field}"))
        checks.append((bad, f"{field} debe ser una cadena no vacía"))
    checks += [
        (
            ~F.coalesce(get("doc", "$.source_hint").isin(*C.SOURCES), F.lit(False)),
            F.concat(F.lit("source_hint fuera del contrato: "), shown(node("doc", "$.source_hint"))),
        ),
        (F.col("payload_keys").isNull(), BAD_PAYLOAD),
        (
            F.size(payload_missing) > 0,
            F.concat(F.lit("Payload de "), kind, F.lit(" incompleto: faltan "), quoted_list(payload_missing)),
        ),
    ]
    items_reason = F.when(kind == "PURCHASE", purchase_items_reason(F.col("e.payload"), "$.items"))
    return fence(df, error_reason=F.coalesce(first_failure(checks), items_reason)).drop("keys", "payload_keys")


def _required_payload(kind: Column) -> Column:
    chain = None
    for name, fields in C.PAYLOAD_FIELDS.items():
        names = F.array(*[F.lit(f) for f in fields])
        chain = F.when(kind == name, names) if chain is None else chain.when(kind == name, names)
    return chain


def purchase_items_reason(doc, path: str) -> Column:
    """Reason for a bad items array: not a non-empty array, or the first bad index."""
    items = F.try_variant_get(doc, path, "array<variant>")
    required = F.array(*[F.lit(f) for f in C.ITEM_FIELDS])

    def problem(item, index):
        keys = F.map_keys(F.try_variant_get(item, "$", "map<string,variant>"))
        missing = F.array_except(required, keys)
        where = F.concat(F.lit("PURCHASE.items["), index.cast("string"), F.lit("]"))
        return F.when(keys.isNull(), F.concat(where, F.lit(" no es un objeto"))).when(
            F.size(missing) > 0, F.concat(where, F.lit(" incompleto: faltan "), quoted_list(missing))
        )

    found = F.filter(F.transform(items, problem), lambda r: r.isNotNull())
    return F.when(items.isNull() | (F.size(items) == 0), F.lit(EMPTY_ITEMS)).otherwise(F.get(found, F.lit(0)))


def validate_purchase_items(lines: DataFrame, path: str = "$.event.payload.items") -> DataFrame:
    """Only the items rule, over PURCHASE envelopes."""
    df = lines if "doc" in lines.columns else parse_json(lines)
    kind = get("doc", path.split(".payload")[0] + ".event_type")
    return df.filter(kind == "PURCHASE").withColumn("error_reason", purchase_items_reason("doc", path))


def _place(columns: list[str], load_id: str | None) -> Column:
    """What tells one line from all lines of all loads."""
    if {"kafka_topic", "kafka_partition", "kafka_offset"} <= set(columns):
        return F.concat_ws("|", "kafka_topic", F.col("kafka_partition").cast("string"), F.col("kafka_offset").cast("string"))
    load = F.lit(load_id) if load_id is not None else F.col("origin") if "origin" in columns else None
    if load is None:
        raise ValueError("lines without an origin or a Kafka position need a load_id, or ids of different loads would collide")
    return F.concat_ws("|", load, F.col("arrival").cast("string"))


def enrich_envelope(
    valid: DataFrame, *, event_id: Column | None = None, ingestion_timestamp: Column | None = None, load_id: str | None = None
) -> DataFrame:
    """Valid envelopes as flat 13-field events.

    The default id hashes the line's place: topic, partition and offset, or the load and
    the arrival position in it.  The load is `load_id`, else the lines' origin (the file
    with its time of change and size).  A retried task gives the same id, another load of
    the same path others.  The two non-deterministic values can be passed in.
    """
    place = None if event_id is not None else _place(valid.columns, load_id)
    event_id = event_id if event_id is not None else F.concat(
        F.lit("evt_"), F.substring(F.sha2(place, 256), 1, 32)
    )
    now = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    stamp = ingestion_timestamp if ingestion_timestamp is not None else F.concat(now, F.lit("+00:00"))
    verbatim = [
        (F.to_json(node("doc", "$.event.payload")) if f == "payload" else get("doc", f"$.event.{f}")).alias(f)
        for f in C.SOURCE_FIELDS
    ]
    return valid.select(
        "arrival",
        event_id.alias("event_id"),
        F.lit(C.SCHEMA_VERSION).alias("schema_version"),
        *verbatim,
        stamp.alias("ingestion_timestamp"),
        get("doc", "$.source_hint").alias("source"),
    )


# --- step 2: published events ----------------------------------------------------


def validate_event(lines: DataFrame) -> DataFrame:
    """Strict check: exactly the 13 fields, enums, constant, texts, zoned timestamps."""
    df = lines if "doc" in lines.columns else parse_json(lines)
    df = with_fields(df, "f", "$", C.EVENT_FIELDS)
    df = fence(df, keys=keys_of("doc", "$"))
    keys = F.col("keys")
    wanted = F.array(*[F.lit(f) for f in C.EVENT_FIELDS])
    missing, extra = F.array_except(wanted, keys), F.array_except(keys, wanted)
    checks = [
        (keys.isNull(), NOT_OBJECT_PUBLISHED),
        (F.size(missing) > 0, F.concat(F.lit("El evento no tiene "), quoted_list(missing))),
        (F.size(extra) > 0, F.concat(F.lit("El evento trae campos fuera del contrato: "), quoted_list(extra))),
    ]
    for field, allowed in C.ENUM_FIELDS.items():
        bad = ~F.coalesce(F.col(f"f.{field}").isin(*allowed), F.lit(False))
        checks.append((bad, F.concat(F.lit(f"{field} fuera del contrato: "), shown(node("doc", f"$.{field}")))))
    version = node("doc", "$.schema_version")
    checks.append(
        (
            ~(F.coalesce(F.col("f.schema_version") == C.SCHEMA_VERSION, F.lit(False)) & is_text(version)),
            F.concat(F.lit(f"schema_version debe ser '{C.SCHEMA_VERSION}', no "), shown(version)),
        )
    )
    for field in NON_EMPTY_EVENT:
        bad = F.coalesce(F.length(f"f.{field}") == 0, F.lit(True)) | ~is_text(node("doc", f"$.{field}"))
        checks.append((bad, f"{field} debe ser una cadena no vacía"))
    for field in C.TIMESTAMP_FIELDS:
        text, v = F.col(f"f.{field}"), node("doc", f"$.{field}")
        # A value that reads as a zoned instant can only be a text.
        checks.append(
            (
                parse_instant(text).isNull() | ~has_zone(text),
                F.when(~is_text(v), f"{field} debe ser una cadena ISO-8601")
                .when(parse_instant(text).isNull(), F.concat(F.lit(f"{field} no es ISO-8601: "), shown(v)))
                .otherwise(F.concat(F.lit(f"{field} debe traer zona horaria: "), shown(v))),
            )
        )
    checks.append((keys_of(F.col("f.payload"), "$").isNull(), BAD_PAYLOAD))
    return fence(df, error_reason=first_failure(checks)).drop("keys")


def validate_raw_event(lines: DataFrame) -> DataFrame:
    """Basic check of the stream job: fields present, version, type, source, event time.

    A payload that is no object and a city or region that is no text would break the
    later steps, so they are rejected here too.
    """
    df = lines if "doc" in lines.columns else parse_json(lines)
    df = with_fields(df, "f", "$", C.EVENT_FIELDS)
    checks = [(F.col("doc").isNull(), BAD_JSON), (F.col("f").isNull(), NOT_OBJECT_EVENT)]
    for field in C.EVENT_FIELDS:
        v = F.col(f"f.{field}")
        absent = is_absent(v) if field == "payload" else v.isNull()
        checks.append((absent, f"Campo requerido ausente o nulo: {field}"))
    version, kind, source, at = (F.col(f"f.{n}") for n in ("schema_version", "event_type", "source", "event_timestamp"))
    # No number or boolean reads like an enum name, so only the version needs its type.
    checks += [
        (
            ~((version == C.SCHEMA_VERSION) & is_text(node("doc", "$.schema_version"))),
            F.concat(F.lit("Versión de esquema no soportada: "), version),
        ),
        (~kind.isin(*C.EVENT_TYPES), F.concat(F.lit("event_type inválido: "), kind)),
        (~source.isin(*C.SOURCES), F.concat(F.lit("source inválido: "), source)),
        (parse_instant(at).isNull(), F.concat(F.lit("event_timestamp no es un ISO 8601 válido: "), at)),
        (keys_of(F.col("f.payload"), "$").isNull(), BAD_PAYLOAD),
        (~is_text(node("doc", "$.city")), "city debe ser una cadena no vacía"),
        (~is_text(node("doc", "$.region")), "region debe ser una cadena no vacía"),
    ]
    return fence(df, error_reason=first_failure(checks))


def check_routing(envelopes: DataFrame, channel: Column | str) -> DataFrame:
    """Reject a message whose source_hint is not the channel that received it."""
    channel = F.lit(channel) if isinstance(channel, str) else channel
    hint = F.col("source_hint")
    wrong = ~F.coalesce(hint == channel, F.lit(False))
    reason = F.concat(
        F.lit("source_hint "), F.coalesce(hint, F.lit("None")), F.lit(" no corresponde al canal "), channel
    )
    return envelopes.withColumn("error_reason", F.when(wrong, reason))


def typed_events(valid: DataFrame) -> DataFrame:
    """Valid published events with typed columns: parse once, store typed."""
    df = with_fields(valid, "f", "$", C.EVENT_FIELDS)
    return df.select(
        "arrival",
        *[F.col(f"f.{n}").alias(n) for n in C.EVENT_FIELDS if n != "payload"],
        F.try_variant_get("f.payload", "$", C.PAYLOAD_DDL).alias("payload"),
        *[F.col(c) for c in ("value", "kafka_topic", "kafka_partition", "kafka_offset") if c in valid.columns],
    )


def enrich_latency(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Event time, processing time, ingestion latency (never negative), trimmed places."""
    event_ts, ingestion_ts = parse_instant("event_timestamp"), parse_instant("ingestion_timestamp")
    out = events.withColumn("event_ts", event_ts).withColumn("ingestion_ts", ingestion_ts)
    lag = F.timestamp_diff("MILLISECOND", F.col("event_ts"), F.col("ingestion_ts"))
    return (
        out.withColumn("latency_ms", F.greatest(F.lit(0), F.coalesce(lag, F.lit(0))).cast("bigint"))
        .withColumn("city", F.trim("city"))
        .withColumn("region", F.trim("region"))
        .withColumn("processing_timestamp", now if now is not None else F.current_timestamp())
    )


def parse_event_time(df: DataFrame, text: str = "event_timestamp", out: str = "event_ts") -> DataFrame:
    """ISO-8601 text to UTC time (null on failure) and epoch milliseconds (0 on failure)."""
    return df.withColumn(out, parse_instant(text)).withColumn(
        "epoch_ms",
        F.coalesce(F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(out)), F.lit(0)),
    )


# --- rejects ----------------------------------------------------------------------


def dead_letters(rejected: DataFrame, *, form: str = "stream", now: Column | None = None) -> DataFrame:
    """Reject records: the stream job's form or the producer's form."""
    now = now if now is not None else F.current_timestamp()
    bad = rejected.filter(F.col("error_reason").isNotNull())
    if form == "producer":
        return bad.select("arrival", "error_reason", now.alias("rejected_at"), F.col("value").alias("original"), dead_letter_key().alias("key"))
    return bad.select(
        "arrival",
        F.col("value").alias("raw_message"),
        "error_reason",
        now.alias("failed_at"),
        get("doc", "$.event_id").alias("event_id"),
    )


def dead_letter_key(doc: str = "doc") -> Column:
    """user_id of the rejected envelope when it is a non-empty text, else null."""
    user, text = node(doc, "$.event.user_id"), get(doc, "$.event.user_id")
    return F.when(is_text(user) & (F.length(text) > 0), text)


def validate_file_report(lines: DataFrame, n: int = 20) -> DataFrame:
    """First n errors of a raw file by line, with the total of lines and of errors."""
    checked = validate_envelope(lines)
    # In a file report a line that is no JSON is an error of its own.
    checked = checked.withColumn("error_reason", F.when(F.col("doc").isNull(), F.lit(BAD_LINE)).otherwise(F.col("error_reason")))
    slim = checked.select("arrival", "error_reason")
    totals = slim.agg(
        F.struct(F.count(F.lit(1)).alias("total"), F.count("error_reason").alias("errors")).alias("t")
    ).scalar()
    return (
        slim.filter(F.col("error_reason").isNotNull())
        .orderBy("arrival")
        .limit(n)
        .withColumn("_t", totals)
        .select(F.col("arrival").alias("line"), "error_reason", F.col("_t.total").alias("total"), F.col("_t.errors").alias("errors"))
    )
