"""Map the TPC-H-like test tables to contract events.

Every expression is a per-row function of the `events` row, so the mapping is one
pushed-down scan: no join, no shuffle, and unused fields are pruned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.expr import fence, pick

# Region keys by user: ten labelled regions, one unlabelled, one in lower case.
REGION_KEYS = tuple(C.REGION_LABELS) + ("ANCASH", "cusco")
CATEGORY_KEYS = ("TECNOLOGIA", "HOGAR", "MODA", "DEPORTES", "JUGUETES")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contract_events(spark: SparkSession, sf_dir: str, fields: Sequence[str] | None = None) -> DataFrame:
    return map_events(table(spark, sf_dir, "events"), fields)


def at(values, index: str) -> str:
    """SQL text: values[index mod n] of a fixed list."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), cast(pmod({index}, {len(values)}) + 1 as int))"


SIGNUP_TYPES = ("SEARCH", "LOGIN", "SEARCH", "PAGE_VIEW", "SEARCH", "GPS_UPDATE", "SOCIAL_POST", "IOT_READING")

# Contract columns as expressions over the `events` test table.
EVENT_EXPRESSIONS = {
    "event_type": f"""CASE event_type
        WHEN 'view' THEN if(event_id % 10 = 9, 'MOTION_DETECTED', 'VIEW_PRODUCT')
        WHEN 'purchase' THEN 'PURCHASE'
        WHEN 'error' THEN 'PAYMENT_FAILED'
        WHEN 'click' THEN if(event_id % 4 = 3, 'REMOVE_FROM_CART', 'ADD_TO_CART')
        ELSE {at(SIGNUP_TYPES, "event_id % 8")} END""",
    "arrival": "event_id",
    "event_id": "concat('evt_', cast(event_id as string))",
    "schema_version": f"'{C.SCHEMA_VERSION}'",
    "event_ts": "ts",
    "ingestion_ts": "timestampadd(MILLISECOND, (event_id % 50 - 2) * 1500, ts)",
    "latency_ms": "cast(greatest(0, (event_id % 50 - 2) * 1500) as bigint)",
    "user_id": "concat('USR', cast(user_id as string))",
    "session_id": "concat('SES_', cast(user_id as string), '_', cast(cast(ts as date) as string))",
    "agent_profile": at(C.AGENT_PROFILES, "user_id"),
    "source": at(C.SOURCES, "event_id"),
    "city": "concat('Ciudad ', cast(user_id % 12 as string))",
    "region": at(REGION_KEYS, "user_id"),
    "scenario": at(C.SCENARIOS, "event_id"),
    "n": "event_id",
    "u": "cast(user_id as string)",
    "k": "cast(get_json_object(props, '$.k') as int)",
    "amount": "cast(value as decimal(18,2))",
}

CART_EDITS = ("ADD_TO_CART", "REMOVE_FROM_CART")
PAYMENTS = ("PURCHASE", "PAYMENT_FAILED")
NAMED = ("VIEW_PRODUCT", "ADD_TO_CART")
DEVICES = ("GPS_UPDATE", "IOT_READING", "MOTION_DETECTED")
ITEM = "((k + i * 7) % 100)"

# Payload field -> (types that have it, expression over the columns above).
PAYLOAD_EXPRESSIONS = {
    "product_id": (("VIEW_PRODUCT", *CART_EDITS, "SOCIAL_POST"), "concat('P', lpad(cast(k as string), 3, '0'))"),
    "product_name": (NAMED, "concat('Producto ', cast(k as string), ' v', cast(n % 3 as string))"),
    "category": (NAMED, at(CATEGORY_KEYS, "k")),
    "price": (("VIEW_PRODUCT",), "cast(10 + k as decimal(18,2))"),
    "dwell_time_ms": (("VIEW_PRODUCT", "PAGE_VIEW"), "n % 9000"),
    "cart_id": ((*CART_EDITS, *PAYMENTS), "concat('C', u, '_', cast(cast(event_ts as date) as string))"),
    "order_id": (PAYMENTS, "concat('ORD', cast(n as string))"),
    "total_amount": (PAYMENTS, "amount"),
    "unit_price": (("ADD_TO_CART",), "cast(10 + k as decimal(18,2))"),
    "quantity": (CART_EDITS, "1 + n % 4"),
    "cart_size_after": (CART_EDITS, "n % 6"),
    "cart_value_after": (CART_EDITS, "cast(amount * 3 as decimal(18,2))"),
    "items": (
        ("PURCHASE",),
        f"""transform(sequence(0, cast(n % 3 as int)), i -> named_struct(
            'product_id', concat('P', lpad(cast({ITEM} as string), 3, '0')),
            'product_name', concat('Producto ', cast({ITEM} as string)),
            'category', {at(CATEGORY_KEYS, ITEM)},
            'unit_price', cast(10 + {ITEM} as decimal(18,2)),
            'quantity', cast(1 + (n + i) % 4 as bigint),
            'subtotal', cast((1 + (n + i) % 4) * (10 + {ITEM}) as decimal(18,2))))""",
    ),
    "items_count": (("PURCHASE",), "n % 3 + 1"),
    "total_units": (("PURCHASE",), "n % 3 + 1"),
    "currency": (("PURCHASE",), "'PEN'"),
    "payment_method": (PAYMENTS, "'CREDIT_CARD'"),
    "time_to_purchase_ms": (("PURCHASE",), "n % 100000"),
    "failure_reason": (("PAYMENT_FAILED",), "'FONDOS_INSUFICIENTES'"),
    "retry_count": (("PAYMENT_FAILED",), "1 + n % 3"),
    "query": (("SEARCH",), "concat('q', cast(k as string))"),
    "results_count": (("SEARCH",), "n % 50"),
    "category_filter": (("SEARCH",), at(CATEGORY_KEYS, "k")),
    "device": (("LOGIN",), "'WEB_DESKTOP'"),
    "is_first_login": (("LOGIN",), "n % 16 = 1"),
    "page_type": (("PAGE_VIEW",), "'OFFERS'"),
    "page_url": (("PAGE_VIEW",), "concat('/ofertas/', cast(k as string))"),
    "device_id": (DEVICES, "concat('DEV', cast(k as string))"),
    "latitude": (("GPS_UPDATE",), "cast(k - 50 as double) / 2"),
    "longitude": (("GPS_UPDATE",), "cast(k - 50 as double)"),
    "speed_kmh": (("GPS_UPDATE",), "cast(k as double) / 4"),
    "sensor_type": (("IOT_READING",), "'TEMP'"),
    "value": (("IOT_READING",), "cast(k as double) / 8"),
    "unit": (("IOT_READING",), "'C'"),
    "zone": (("MOTION_DETECTED",), "concat('Z', cast(k % 7 as string))"),
    "confidence": (("MOTION_DETECTED",), "cast(k % 5 as double) / 4"),
    "platform": (("SOCIAL_POST",), "'RED'"),
    "post_type": (("SOCIAL_POST",), "'REVIEW'"),
    "sentiment": (("SOCIAL_POST",), at(("POSITIVO", "NEUTRO", "NEGATIVO"), "n")),
}


# Payload fields the metrics, audiences and alerts read, without the item array.
CORE_FIELDS = ("product_id", "product_name", "category", "dwell_time_ms", "cart_id", "order_id", "total_amount", "cart_value_after")


def map_events(raw: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows of the `events` test table as enriched contract events.

    fields limits the payload: a struct made by expressions is computed whole, where a
    stored one is read column by column.

    SQL text rather than column calls: the 50 expressions cost one parse each.
    """
    base = raw.selectExpr(*[f"{sql} AS {name}" for name, sql in EVENT_EXPRESSIONS.items()])
    payload = ", ".join(
        f"'{name}', CASE WHEN event_type IN ({', '.join(repr(t) for t in types)}) THEN {sql} END"
        for name, (types, sql) in PAYLOAD_EXPRESSIONS.items()
        if fields is None or name in fields
    )
    keep = [n for n in EVENT_EXPRESSIONS if n not in ("n", "u", "k", "amount")]
    return base.selectExpr(*keep, f"named_struct({payload}) AS payload")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as purchased items (event time = order date)."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("event_ts")
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").cast("bigint").alias("arrival"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.concat(F.lit("Producto "), F.col("l_partkey").cast("string")).alias("product_name"),
        pick(CATEGORY_KEYS, F.col("l_partkey")).alias("category"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("subtotal"),
    )
    return items.join(orders, "order_key")


# --- raw text forms -----------------------------------------------------------


def _iso(ts, n):
    """ISO text in one of three zone styles, milliseconds kept."""
    millis = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    utc = F.concat(F.date_format(ts, millis), F.lit("Z"))
    lima = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(-5), ts), millis), F.lit("-05:00"))
    return F.when(n % 3 == 0, utc).when(n % 3 == 1, lima).otherwise(
        F.concat(F.date_format(ts, millis), F.lit("+00:00"))
    )


def _payload_object():
    """JSON object with exactly the fields of the event's own type.

    Nulls are dropped by to_json, and every field of the type is non-null.
    """
    return F.to_json(F.col("payload"), {"ignoreNullFields": "true"})


def spread(events: DataFrame) -> DataFrame:
    """Use all threads for text generation: a test table is one parquet row group."""
    return events.repartition(events.sparkSession.sparkContext.defaultParallelism)


def event_lines(events: DataFrame) -> DataFrame:
    """(arrival, value): published events as JSON text, some of them defective.

    Defects are a function of the row number so an oracle can predict them; one row
    in a hundred is delivered twice.
    """
    n = F.col("arrival")
    code = n % 100
    text = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    payload = F.when(code == 29, F.lit('"texto"')).otherwise(_payload_object())
    fields = [
        ("event_id", F.when(code == 31, F.lit("null")).otherwise(text("event_id"))),
        ("schema_version", F.when(code == 13, F.lit('"2.0"')).otherwise(F.lit('"1.0"'))),
        ("event_type", F.when(code == 17, F.lit('"CLICK"')).otherwise(text("event_type"))),
        (
            "event_timestamp",
            F.when(code == 23, F.lit('"ayer"')).otherwise(
                F.concat(F.lit('"'), _iso(F.col("event_ts"), n), F.lit('"'))
            ),
        ),
        (
            "ingestion_timestamp",
            F.when(code == 41, F.lit('"luego"')).otherwise(
                F.concat(F.lit('"'), _iso(F.col("ingestion_ts"), n + 1), F.lit('"'))
            ),
        ),
        ("user_id", text("user_id")),
        ("session_id", text("session_id")),
        ("agent_profile", text("agent_profile")),
        ("source", F.when(code == 19, F.lit('"FAX"')).otherwise(text("source"))),
        ("city", F.when(code == 37, F.lit("[1, 2]")).otherwise(F.concat(F.lit('"  '), "city", F.lit(' "')))),
        ("region", text("region")),
        ("scenario", text("scenario")),
        ("payload", payload),
    ]
    body = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ",
            *[
                F.when((code == 11) & F.lit(name == "user_id"), F.lit(None).cast("string")).otherwise(
                    F.concat(F.lit(f'"{name}": '), col)
                )
                for name, col in fields
            ],
            F.when(code == 43, F.lit('"source_hint": "WEB"')),
        ),
        F.lit("}"),
    )
    line = F.when(code == 3, F.lit("{esto no es JSON")).when(code == 7, F.lit("[1, 2, 3]")).otherwise(body)
    copies = F.when(code == 50, F.array(n * 2, n * 2 + 1)).otherwise(F.array(n * 2))
    return fence(spread(events).select(line.alias("_line"), F.explode(copies).alias("arrival")), value=F.col("_line")).drop("_line")


def envelope_lines(events: DataFrame) -> DataFrame:
    """(arrival, value): raw envelopes {source_hint, event} as JSON text with defects."""
    n = F.col("arrival")
    code = n % 100
    is_purchase = F.col("event_type") == "PURCHASE"
    payload = (
        F.when(code == 29, F.lit('"texto"'))
        .when(code == 47, F.lit("{}"))
        .when(is_purchase & (code == 53), _with_items("[]"))
        .when(is_purchase & (code == 59), _with_items('[{"product_id": "P1"}]'))
        .when(is_purchase & (code == 61), _with_items("[3]"))
        .otherwise(_payload_object())
    )
    text = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    fields = [
        ("event_type", F.when(code == 17, F.lit('"CLICK"')).otherwise(text("event_type")), 11),
        ("event_timestamp", F.concat(F.lit('"'), _iso(F.col("event_ts"), n), F.lit('"')), None),
        ("user_id", F.when(code == 13, F.lit('""')).otherwise(text("user_id")), 31),
        ("session_id", text("session_id"), None),
        ("agent_profile", text("agent_profile"), 37),
        ("city", F.when(code == 41, F.lit("5")).otherwise(text("city")), None),
        ("region", text("region"), 37),
        ("scenario", text("scenario"), None),
        ("payload", payload, None),
    ]
    event = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ",
            *[
                F.when(code == missing, F.lit(None).cast("string")).otherwise(
                    F.concat(F.lit(f'"{name}": '), col)
                )
                if missing is not None
                else F.concat(F.lit(f'"{name}": '), col)
                for name, col, missing in fields
            ],
        ),
        F.lit("}"),
    )
    hint = (
        F.when(code == 19, F.lit('"source_hint": "FAX", '))
        .when(code == 23, F.lit(""))
        .otherwise(F.concat(F.lit('"source_hint": "'), F.col("source"), F.lit('", ')))
    )
    body = F.concat(
        F.lit("{"), hint, F.lit('"event": '), F.when(code == 43, F.lit("[]")).otherwise(event), F.lit("}")
    )
    line = F.when(code == 3, F.lit("{esto no es JSON")).when(code == 7, F.lit("[1, 2, 3]")).otherwise(body)
    return fence(spread(events).select(line.alias("_line"), n.alias("arrival")), value=F.col("_line")).drop("_line")


def _with_items(items: str):
    """The purchase payload with its items array replaced by the given text."""
    rest = F.to_json(F.col("payload").dropFields("items"), {"ignoreNullFields": "true"})
    return F.concat(F.lit('{"items": ' + items + ", "), rest.substr(F.lit(2), F.length(rest)))
