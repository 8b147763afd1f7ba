"""SQL for the registered queries, written from the base tables for DuckDB."""

from __future__ import annotations

from checks.oracle_base import at, q, sql_list
from checks.queries import ALERT, AUDIENCE, CROWD
from tidemark import contract as C
from tidemark.sources.adapter import CATEGORY_KEYS

ORACLES: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLES[name] = q(sql)


# --- shared pieces ----------------------------------------------------------------------

PCT = lambda a, b: f"CASE WHEN {b} > 0 THEN round(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) * 100.0, 2) ELSE 0.0 END"

# Text lines: arrival 2n, and 2n + 1 for the second copy of every hundredth event.
LINES = """lines AS (
  SELECT *, n * 2 AS pos FROM ev UNION ALL SELECT *, n * 2 + 1 AS pos FROM ev WHERE n % 100 = 50
), raw_check AS (
  SELECT *, CASE n % 100
    WHEN 3 THEN 'JSON malformado' WHEN 7 THEN 'El evento debe ser un objeto JSON'
    WHEN 31 THEN 'Campo requerido ausente o nulo: event_id' WHEN 11 THEN 'Campo requerido ausente o nulo: user_id'
    WHEN 13 THEN 'Versión de esquema no soportada: 2.0' WHEN 17 THEN 'event_type inválido: CLICK'
    WHEN 19 THEN 'source inválido: FAX' WHEN 23 THEN 'event_timestamp no es un ISO 8601 válido: ayer'
    WHEN 29 THEN 'payload debe ser un objeto' WHEN 37 THEN 'city debe ser una cadena no vacía' END AS error_reason
  FROM lines
), good AS (
  SELECT *, date_trunc('millisecond', event_ts) AS ms_ts,
    CASE WHEN n % 100 = 41 THEN NULL ELSE date_trunc('millisecond', ingestion_ts) END AS ms_in
  FROM raw_check WHERE error_reason IS NULL
), good_l AS (
  SELECT *, CASE WHEN ms_in IS NULL THEN 0 ELSE greatest(0, date_diff('millisecond', ms_ts, ms_in)) END AS lag_ms FROM good
)"""


def purchase_code(code):
    return f"event_type = 'PURCHASE' AND n % 100 = {code}"


REQUIRED = {k: sorted(v) for k, v in C.PAYLOAD_FIELDS.items()}


def pylist(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def esc(text):
    return text.replace("'", "''")


EMPTY_PAYLOAD = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{esc(pylist(v))}'" for k, v in REQUIRED.items()
) + " END"
ITEMS_REASON = f"""CASE WHEN n % 100 = 53 THEN 'PURCHASE.items debe ser un arreglo no vacío'
  WHEN n % 100 = 59 THEN 'PURCHASE.items[0] incompleto: faltan {esc(pylist(sorted(set(C.ITEM_FIELDS) - {'product_id'})))}'
  WHEN n % 100 = 61 THEN 'PURCHASE.items[0] no es un objeto' END"""
ENVELOPE_REASON = f"""CASE
  WHEN n % 100 IN (3, 7) THEN 'El mensaje no es un objeto JSON'
  WHEN n % 100 = 43 THEN 'El sobre no trae un objeto ''event'''
  WHEN n % 100 = 11 THEN 'Falta event_type'
  WHEN n % 100 = 17 THEN 'event_type fuera del contrato: ''CLICK'''
  WHEN n % 100 = 31 THEN 'Faltan campos de A: {esc(pylist(['user_id']))}'
  WHEN n % 100 = 37 THEN 'Faltan campos de A: {esc(pylist(['agent_profile', 'region']))}'
  WHEN n % 100 = 13 THEN 'user_id debe ser una cadena no vacía'
  WHEN n % 100 = 41 THEN 'city debe ser una cadena no vacía'
  WHEN n % 100 = 19 THEN 'source_hint fuera del contrato: ''FAX'''
  WHEN n % 100 = 23 THEN 'source_hint fuera del contrato: None'
  WHEN n % 100 = 29 THEN 'payload debe ser un objeto'
  WHEN n % 100 = 47 THEN 'Payload de ' || event_type || ' incompleto: faltan ' || ({EMPTY_PAYLOAD})
  WHEN event_type = 'PURCHASE' THEN {ITEMS_REASON} END"""
STATUS = "CASE WHEN n % 31 = 0 THEN 'REJECTED' WHEN n % 37 = 0 THEN 'FAILED' WHEN n % 41 = 0 THEN 'PENDING' ELSE 'CONFIRMED' END"

TOPIC = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{t}'" for t, (_, kinds) in C.TOPICS.items() for k in kinds
) + " END"

ISO = """CASE {n} % 3 WHEN 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
  WHEN 1 THEN strftime({t} - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '-05:00'
  ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' END"""

# --- sources, parsing, sinks ----------------------------------------------------------------

add("read_event_lines", f"""WITH {LINES}
SELECT CASE n % 100 WHEN 3 THEN 'texto' WHEN 7 THEN 'otro' ELSE 'objeto' END AS form, count(*) AS lines FROM lines GROUP BY 1""")

add("read_event_stream", f"""SELECT {TOPIC} AS kafka_topic, CAST(n % 4 AS INTEGER) AS kafka_partition, count(*) AS records,
  max(n // 4) AS last_offset, count(*) AS positions, min(user_id) AS first_key
FROM ev GROUP BY 1, 2""")

add("parse_envelope", """SELECT n AS arrival, CASE WHEN n % 100 NOT IN (3, 7, 19, 23) THEN source END AS source_hint,
  CASE n % 100 WHEN 3 THEN 'JSON inválido' WHEN 7 THEN 'El mensaje no es un objeto JSON'
    WHEN 19 THEN 'source_hint fuera del contrato: ''FAX''' WHEN 23 THEN 'source_hint fuera del contrato: None' END AS error_reason,
  CASE n % 100 WHEN 3 THEN '{esto' WHEN 7 THEN '[1, 2' WHEN 19 THEN '{"sou' WHEN 23 THEN '{"eve' END AS original_start FROM ev""")

PAYLOAD_SQL = {
    "LOGIN": "'WEB_DESKTOP' AS device, n % 16 = 1 AS is_first_login",
    "SEARCH": f"'q' || CAST(k AS VARCHAR) AS query, n % 50 AS results_count, {at(CATEGORY_KEYS, 'k')} AS category_filter",
    "PAGE_VIEW": "'OFFERS' AS page_type, '/ofertas/' || CAST(k AS VARCHAR) AS page_url, dwell_time_ms",
    "VIEW_PRODUCT": "product_id, product_name, category, CAST(10 + k AS DOUBLE) AS price, dwell_time_ms",
    "ADD_TO_CART": "cart_id, product_id, product_name, category, CAST(10 + k AS DOUBLE) AS unit_price, 1 + n % 4 AS quantity, n % 6 AS cart_size_after, CAST(cart_value_after AS DOUBLE) AS cart_value_after",
    "REMOVE_FROM_CART": "cart_id, product_id, 1 + n % 4 AS quantity, n % 6 AS cart_size_after, CAST(cart_value_after AS DOUBLE) AS cart_value_after",
    "PURCHASE": "order_id, cart_id, n % 3 + 1 AS items_count, n % 3 + 1 AS total_units, CAST(total_amount AS DOUBLE) AS total_amount, 'PEN' AS currency, 'CREDIT_CARD' AS payment_method, n % 100000 AS time_to_purchase_ms",
    "PAYMENT_FAILED": "order_id, cart_id, CAST(total_amount AS DOUBLE) AS total_amount, 'CREDIT_CARD' AS payment_method, 'FONDOS_INSUFICIENTES' AS failure_reason, 1 + n % 3 AS retry_count",
    "GPS_UPDATE": "'DEV' || CAST(k AS VARCHAR) AS device_id, (k - 50) / 2.0::DOUBLE AS latitude, CAST(k - 50 AS DOUBLE) AS longitude, k / 4.0::DOUBLE AS speed_kmh",
    "IOT_READING": "'DEV' || CAST(k AS VARCHAR) AS device_id, 'TEMP' AS sensor_type, k / 8.0::DOUBLE AS value, 'C' AS unit",
    "MOTION_DETECTED": "'DEV' || CAST(k AS VARCHAR) AS device_id, 'Z' || CAST(k % 7 AS VARCHAR) AS zone, (k % 5) / 4.0::DOUBLE AS confidence",
    "SOCIAL_POST": "'RED' AS platform, 'REVIEW' AS post_type, product_id, " + at(("POSITIVO", "NEUTRO", "NEGATIVO"), "n") + " AS sentiment",
}
for kind, cols in PAYLOAD_SQL.items():
    names = list(C.PAYLOAD_FIELDS[kind])
    parts = [n for n in names if n != "items"]
    add(f"explode_payload_{kind.lower()}", f"""WITH {LINES}, p AS (SELECT event_id, {cols} FROM good WHERE event_type = '{kind}')
SELECT event_id, {', '.join(parts)} FROM p""")

add("explode_purchase_items", """SELECT event_id, product_id, product_name, category,
  CAST(substr(product_name, 10) AS DOUBLE) + 10 AS unit_price, quantity, CAST(subtotal AS DOUBLE) AS subtotal
FROM (SELECT * FROM items UNION ALL SELECT * FROM items WHERE arrival % 100 = 50) WHERE arrival % 100 NOT IN (3, 7, 11, 13, 17, 19, 23, 29, 31, 37)""")

add("write_event_store", f"""WITH {LINES}
SELECT scenario, CAST(CAST(ms_ts AS DATE) AS VARCHAR) AS event_date, count(DISTINCT event_id) AS events, count(DISTINCT event_id) AS ids,
  CASE WHEN scenario = 'NAVIDAD' THEN count(DISTINCT event_id) ELSE 0 END AS from_second_load
FROM good GROUP BY scenario, CAST(ms_ts AS DATE)""")

add("store_counters", f"""WITH {LINES}, loads AS (
  SELECT 0 AS load, * FROM good WHERE scenario <> 'NAVIDAD' UNION ALL SELECT 1 AS load, * FROM good)
SELECT load, count(*) + BAD AS leidos,
  CASE load WHEN 0 THEN count(DISTINCT event_id) ELSE count(DISTINCT CASE WHEN scenario = 'NAVIDAD' THEN event_id END) END AS insertados,
  count(*) - CASE load WHEN 0 THEN count(DISTINCT event_id) ELSE count(DISTINCT CASE WHEN scenario = 'NAVIDAD' THEN event_id END) END AS duplicados,
  BAD AS invalidos
FROM loads GROUP BY load""".replace("BAD", "CASE load WHEN 1 THEN (SELECT count(*) FROM lines) - (SELECT count(*) FROM good) ELSE 0 END"))

add("write_metrics", """SELECT 'conversion' AS metric_type, w AS window_start, w + INTERVAL 1 DAY AS window_end,
  (count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT'))::DOUBLE AS views_count, (count(*) FILTER (WHERE event_type = 'PURCHASE'))::DOUBLE AS purchases_count,
  CAST(NULL AS DOUBLE) AS total_events FROM ev GROUP BY w
UNION ALL SELECT 'throughput', w, w + INTERVAL 1 DAY, NULL, NULL, count(*) FROM ev GROUP BY w""")

add("metric_messages", "SELECT 'throughput' AS key, 'metrics.throughput' AS topic, count(*) AS total_events FROM ev GROUP BY w")

add("write_by_source", """SELECT source AS channel, count(*) AS lines FROM ev WHERE n % 100 NOT IN (3, 7, 19, 23) GROUP BY 1
UNION ALL SELECT 'TODOS', count(*) FROM ev WHERE n % 100 NOT IN (3, 7, 19, 23)""")

RUNS = f"""runs AS (
  SELECT source || '-' || strftime(w, '%Y%m%d') AS run_id, source, w AS day,
    count(*) FILTER (WHERE st <> 'REJECTED') AS publicados, count(*) FILTER (WHERE st = 'CONFIRMED') AS enviados,
    count(*) FILTER (WHERE st = 'REJECTED') AS rechazados, count(*) FILTER (WHERE st = 'FAILED') AS fallidos,
    min(event_ts) AS started_at, max(event_ts) AS finished_at,
    date_diff('microsecond', min(event_ts), max(event_ts)) // 1000000 AS segundos
  FROM (SELECT *, {STATUS} AS st FROM ev) GROUP BY source, w
)"""
add("write_runs", f"""WITH {RUNS}
SELECT run_id, CASE WHEN source = 'POS' THEN 0 ELSE publicados END AS publicados, enviados, rechazados, fallidos, started_at, finished_at,
  CAST(CASE WHEN source = 'POS' THEN 1 ELSE 0 END AS BIGINT) AS batch_id FROM runs""")

BENCH = f"""lat AS (
  SELECT scenario, source, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99,
    avg(latency_ms) AS mean, max(latency_ms) AS mx, count(*) AS n_all,
    count(*) FILTER (WHERE st <> 'REJECTED') AS publicados, count(*) FILTER (WHERE st = 'CONFIRMED') AS enviados,
    count(*) FILTER (WHERE st = 'REJECTED') AS rechazados, count(*) FILTER (WHERE st = 'FAILED') AS fallidos,
    CAST(date_diff('microsecond', min(event_ts), max(event_ts)) // 1000000 AS DOUBLE) AS segundos
  FROM (SELECT *, {STATUS} AS st FROM ev) GROUP BY scenario, source)"""
add("write_benchmark_csv", f"""WITH {BENCH}
SELECT source AS configuracion, CAST(0 AS BIGINT) AS linger_ms, 'none' AS compresion, scenario AS escenario, segundos, publicados, enviados,
  rechazados, fallidos, CASE WHEN segundos > 0 THEN round(enviados / segundos, 1) ELSE 0.0 END AS eventos_por_segundo,
  round(p50, 2) AS latencia_p50_ms, round(p95, 2) AS latencia_p95_ms, round(p99, 2) AS latencia_p99_ms, round(mean, 2) AS latencia_promedio_ms,
  round(CAST(mx AS DOUBLE), 2) AS latencia_max_ms FROM lat""")

# --- validation, dedup, routing ---------------------------------------------------------------

add("validate_envelope", f"SELECT n AS arrival, {ENVELOPE_REASON} AS error_reason FROM ev")
add("validate_purchase_items", f"""SELECT n AS arrival,
  CASE WHEN n % 100 IN (29, 47) THEN 'PURCHASE.items debe ser un arreglo no vacío' ELSE {ITEMS_REASON} END AS error_reason
FROM ev WHERE event_type = 'PURCHASE' AND n % 100 NOT IN (3, 7, 11, 17, 43)""")
add("enrich_envelope", f"""SELECT n AS arrival, 'evt_' || substr(sha256('checks|' || CAST(n AS VARCHAR)), 1, 32) AS event_id, '1.0' AS schema_version, event_type,
  {ISO.format(n='n', t='event_ts')} AS event_timestamp, user_id, session_id, agent_profile, city, region, scenario, source, TRUE AS stamped, product_id
FROM ev WHERE ({ENVELOPE_REASON}) IS NULL""")
add("two_loads", f"""WITH e AS (SELECT n, ({ENVELOPE_REASON}) IS NULL AS good FROM ev), l AS (SELECT 0 AS load, * FROM e UNION ALL SELECT 1 AS load, * FROM e WHERE n % 3 = 0)
SELECT CAST(load AS BIGINT) AS load, count(*) AS leidos, count(*) FILTER (WHERE good) AS insertados, CAST(0 AS BIGINT) AS duplicados,
  count(*) FILTER (WHERE NOT good) AS invalidos, (SELECT count(*) FILTER (WHERE good) FROM l) AS ids
FROM l GROUP BY load""")
add("validate_event", f"""WITH {LINES}
SELECT pos AS arrival, CASE n % 100
  WHEN 3 THEN 'El evento publicado no es un objeto' WHEN 7 THEN 'El evento publicado no es un objeto'
  WHEN 11 THEN 'El evento no tiene {esc(pylist(['user_id']))}' WHEN 43 THEN 'El evento trae campos fuera del contrato: {esc(pylist(['source_hint']))}'
  WHEN 17 THEN 'event_type fuera del contrato: ''CLICK''' WHEN 19 THEN 'source fuera del contrato: ''FAX'''
  WHEN 13 THEN 'schema_version debe ser ''1.0'', no ''2.0''' WHEN 31 THEN 'event_id debe ser una cadena no vacía'
  WHEN 37 THEN 'city debe ser una cadena no vacía' WHEN 23 THEN 'event_timestamp no es ISO-8601: ''ayer'''
  WHEN 41 THEN 'ingestion_timestamp no es ISO-8601: ''luego''' WHEN 29 THEN 'payload debe ser un objeto' END AS error_reason
FROM lines""")
add("validate_raw_event", f"WITH {LINES} SELECT pos AS arrival, error_reason FROM raw_check")
add("check_routing", f"""WITH c AS (
  SELECT n, CASE WHEN n % 100 NOT IN (3, 7, 19, 23) THEN source END AS hint, {at(C.SOURCES, 'CASE WHEN n % 6 = 5 THEN n + 1 ELSE n END')} AS channel FROM ev)
SELECT n AS arrival, CASE WHEN hint IS NULL OR hint <> channel THEN 'source_hint ' || coalesce(hint, 'None') || ' no corresponde al canal ' || channel END AS error_reason FROM c""")
add("enrich_latency", f"""WITH {LINES}
SELECT pos AS arrival, event_id, ms_ts AS event_ts, ms_in AS ingestion_ts, lag_ms AS latency_ms, city, region FROM good_l""")
add("parse_event_time", f"""WITH {LINES}
SELECT pos AS arrival, CASE WHEN ok THEN t END AS event_ts, CASE WHEN ok THEN epoch_ms(t) ELSE 0 END AS epoch_ms
FROM (SELECT *, n % 100 NOT IN (3, 7, 23) AS ok, date_trunc('millisecond', event_ts) AS t FROM lines)""")
add("dedup_events", f"""WITH {LINES}
SELECT pos AS arrival, event_id, CASE WHEN pos % 2 = 1 THEN 'Duplicate event_id: ' || event_id END AS error_reason FROM good""")
add("dedup_stream", "SELECT event_id, user_id, event_type, event_ts FROM ev")
add("dead_letters", f"""WITH {LINES}
SELECT pos AS arrival, error_reason, CASE WHEN n % 100 NOT IN (3, 7, 31) THEN event_id END AS event_id FROM raw_check WHERE error_reason IS NOT NULL
UNION ALL SELECT pos, 'Duplicate event_id: ' || event_id, event_id FROM good WHERE pos % 2 = 1""")
add("dead_letter_key", f"""SELECT n AS arrival, {ENVELOPE_REASON} AS error_reason,
  CASE WHEN n % 100 NOT IN (3, 7, 13, 31, 43) THEN user_id END AS key FROM ev WHERE ({ENVELOPE_REASON}) IS NOT NULL""")
add("route_events", f"""WITH {LINES}, t AS (
  SELECT pos, CASE WHEN n % 100 IN (3, 7) THEN NULL WHEN n % 100 = 17 THEN 'CLICK' ELSE event_type END AS event_type FROM lines)
SELECT pos AS arrival, {TOPIC} AS topic, CASE WHEN ({TOPIC}) IS NULL THEN 'event_type sin ruta en el contrato: ' || coalesce(event_type, 'None') END AS error_reason FROM t""")
add("routing_audit", """SELECT DISTINCT event_type, 'UNROUTED' AS problem, CAST(0 AS BIGINT) AS topics FROM ev WHERE event_type = 'SOCIAL_POST'
UNION ALL SELECT 'SEARCH', 'DUPLICATE', CAST(2 AS BIGINT)""")
PARTS = "CASE topic " + " ".join(f"WHEN '{t}' THEN {p}" for t, (p, _) in C.TOPICS.items()) + " END"
add("partition_balance", f"""WITH r AS (SELECT {TOPIC} AS topic, user_id FROM ev),
p AS (SELECT topic, {PARTS} AS parts, CAST(ascii(right(user_id, 1)) % {PARTS} AS INTEGER) AS partition, user_id FROM r WHERE topic IS NOT NULL),
t AS (SELECT topic, parts, partition, count(*) AS events, count(DISTINCT user_id) AS keys FROM p GROUP BY 1, 2, 3)
SELECT topic, partition, events, keys, round(CAST(events * parts AS DOUBLE) / CAST(sum(events) OVER (PARTITION BY topic) AS DOUBLE), 4) AS skew FROM t""")
add("partition_totals", f"SELECT {TOPIC} AS topic, CAST(count(*) AS BIGINT) AS events, count(DISTINCT user_id) AS keys FROM ev GROUP BY 1")
add("validate_file_report", f"""WITH c AS (SELECT n, CASE WHEN n % 100 = 3 THEN 'JSON inválido' ELSE {ENVELOPE_REASON} END AS r FROM ev),
t AS (SELECT count(*) AS total, count(r) AS errors FROM c)
SELECT n AS line, r AS error_reason, (SELECT total FROM t) AS total, (SELECT errors FROM t) AS errors FROM c WHERE r IS NOT NULL ORDER BY n LIMIT 20""")
add("summarize_events", """SELECT 'total' AS dimension, 'total' AS key, count(*) AS events FROM ev
UNION ALL SELECT 'event_type', event_type, count(*) FROM ev GROUP BY 2 UNION ALL SELECT 'agent_profile', agent_profile, count(*) FROM ev GROUP BY 2
UNION ALL SELECT 'source', source, count(*) FROM ev GROUP BY 2""")
add("delivery_counters", f"""WITH t AS (SELECT *, {STATUS} AS st FROM ev),
c AS (SELECT coalesce(source, 'TOTAL') AS channel, count(*) FILTER (WHERE st <> 'REJECTED') AS published, count(*) FILTER (WHERE st = 'CONFIRMED') AS confirmed,
  count(*) FILTER (WHERE st = 'REJECTED') AS rejected, count(*) FILTER (WHERE st = 'FAILED') AS failed FROM t GROUP BY ROLLUP (source))
SELECT *, published - confirmed AS lost FROM c""")

# --- metrics ------------------------------------------------------------------------------------

W = "w AS window_start, w + INTERVAL 1 DAY AS window_end"


def both(name, sql, group="w"):
    """The plain metric and the one grouped by scenario."""
    add(name, sql.replace("{by}", "").replace("{g}", group))
    add(f"{name}_by_scenario", sql.replace("{by}", "scenario, ").replace("{g}", f"{group}, scenario"))


both("throughput", f"SELECT {W}, {{by}}count(*) AS total_events, round(count(*) / 86400.0::DOUBLE, 2) AS events_per_second FROM ev GROUP BY {{g}}")
add("active_users", f"""SELECT {W}, count(DISTINCT user_id) AS active_users_count,
  array_to_string(list_slice(list_sort(list_distinct(list(user_id))), 1, 10), ',') AS unique_users_sample FROM ev GROUP BY w""")
add("events_by_type", f"SELECT {W}, event_type, count(*) AS events FROM ev GROUP BY w, event_type")
add("events_by_type_document", """SELECT w AS window_start, min(event_type) AS first_type, arg_min(c, event_type) AS first_events
FROM (SELECT w, event_type, count(*) AS c FROM ev GROUP BY ALL) GROUP BY w""")
VIEWED = """(SELECT {keys}product_id, arg_max(product_name, arrival) AS product_name, arg_max(category, arrival) AS category, count(*) AS views
  FROM ev WHERE event_type = 'VIEW_PRODUCT' GROUP BY {keys}product_id)"""
both("top_viewed_products", f"""SELECT {W}, {{by}}product_id, product_name, category, views, CAST(position AS INTEGER) AS position FROM (
SELECT *, row_number() OVER (PARTITION BY {{g}} ORDER BY views DESC, product_id) AS position FROM {VIEWED.replace('{keys}', 'w, {by}')}) WHERE position <= 10""")
BOUGHT = """(SELECT {keys}product_id, arg_max(product_name, arrival) AS product_name, arg_max(category, arrival) AS category,
  CAST(sum(quantity) AS BIGINT) AS units, round(CAST(sum(subtotal) AS DOUBLE), 2) AS total_revenue FROM items GROUP BY {keys}product_id)"""
add("top_purchased_products", f"""SELECT {W}, product_id, product_name, category, units, total_revenue, CAST(position AS INTEGER) AS position FROM (
SELECT *, row_number() OVER (PARTITION BY w ORDER BY units DESC, total_revenue DESC, product_id) AS position FROM {BOUGHT.replace('{keys}', 'w, ')}) WHERE position <= 10""")
ORACLES["top_purchased_orders"] = f"""WITH i AS (
  SELECT CAST(TIMESTAMP '1970-01-01' + to_days(CAST(30 * (date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) // 30) AS INTEGER)) AS TIMESTAMP) AS w,
    l_linenumber AS arrival, l_partkey AS k, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), s AS (SELECT w, k, CAST(sum(quantity) AS BIGINT) AS units, round(CAST(sum(subtotal) AS DOUBLE), 2) AS total_revenue FROM i GROUP BY w, k),
r AS (SELECT *, 'P' || CAST(k AS VARCHAR) AS product_id, row_number() OVER (PARTITION BY w ORDER BY units DESC, total_revenue DESC, 'P' || CAST(k AS VARCHAR)) AS position FROM s)
SELECT w AS window_start, w + INTERVAL 30 DAY AS window_end, product_id, 'Producto ' || CAST(k AS VARCHAR) AS product_name, {at(CATEGORY_KEYS, 'k')} AS category,
  units, total_revenue, CAST(position AS INTEGER) AS position FROM r WHERE position <= 5"""
add("purchases_by_region", f"SELECT {W}, region, count(*) AS purchases_count, round(CAST(sum(total_amount) AS DOUBLE), 2) AS total_amount FROM ev WHERE event_type = 'PURCHASE' GROUP BY w, region")
CONV = f"""(SELECT {{keys}}views_count, cart_additions_count, purchases_count, {PCT('cart_additions_count', 'views_count')} AS view_to_cart_rate,
  {PCT('purchases_count', 'cart_additions_count')} AS cart_to_purchase_rate, {PCT('purchases_count', 'views_count')} AS overall_conversion_rate
FROM (SELECT {{keys}}count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT') AS views_count, count(*) FILTER (WHERE event_type = 'ADD_TO_CART') AS cart_additions_count,
  count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchases_count FROM ev {{group}}))"""


def conv(*keys):
    k = "".join(f"{x}, " for x in keys)
    return CONV.replace("{keys}", k).replace("{group}", "GROUP BY " + ", ".join(keys) if keys else "")


add("conversion", f"SELECT {W}, * EXCLUDE (w) FROM {conv('w')}")
add("conversion_by_scenario", f"SELECT {W}, * EXCLUDE (w) FROM {conv('w', 'scenario')}")
TRENDS = """(SELECT s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS events_count, count(DISTINCT user_id) AS active_users,
  count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchases_count,
  round(coalesce(CAST(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE') AS DOUBLE), 0), 2) AS total_revenue
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, event_ts, TIMESTAMP '1970-01-01') - to_hours(6 * u) AS s FROM ev, (SELECT unnest([0, 1, 2, 3]) AS u)) GROUP BY s)"""
add("trends", f"SELECT window_start, window_end, events_count, active_users, CAST(purchases_count AS BIGINT) AS purchases_count, total_revenue FROM {TRENDS}")

for name, source in {
    "throughput": "throughput", "active_users": "active_users", "events_by_type": "events_by_type", "purchases_by_region": "purchases_by_region",
    "conversion": "conversion", "trends": "trends", "top_products_viewed": "top_viewed_products", "top_products_purchased": "top_purchased_products",
}.items():
    ORACLES[f"stream_{name}"] = ORACLES[source]
# Every fifth event comes after the others; a day is closed by the newest of those, less five seconds.
CLOSED_DAY = "w + INTERVAL 1 DAY <= (SELECT max(event_ts) - INTERVAL 5 SECOND FROM ev WHERE n % 5 <> 0)"
add("late_rows", f"""SELECT event_id, event_type, user_id, event_ts, w AS window_start, w + INTERVAL 1 DAY AS window_end
FROM ev WHERE n % 5 = 0 AND {CLOSED_DAY}""")
add("throughput_without_late_rows", f"SELECT w AS window_start, count(*) AS total_events FROM ev WHERE n % 5 <> 0 OR NOT ({CLOSED_DAY}) GROUP BY w")

# --- audiences ------------------------------------------------------------------------------------

A = AUDIENCE
SEC = lambda n: f"INTERVAL {n} SECOND"


def audience_sql(where="TRUE"):
    """Facts of every user over the last rows by arrival."""
    return f"""crowd AS (SELECT * REPLACE ('USR' || CAST(uid % {CROWD} AS VARCHAR) AS user_id) FROM ev), hist0 AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival DESC) AS age FROM crowd WHERE {where}
), hist AS (
  SELECT *, max(event_ts) OVER (PARTITION BY user_id) AS now_ts FROM hist0 WHERE age <= {A.history_rows}
), carts AS (
  SELECT user_id, cart_id, max(arrival) FILTER (WHERE event_type = 'ADD_TO_CART') AS last_add,
    arg_max(event_ts, arrival) FILTER (WHERE event_type = 'ADD_TO_CART') AS add_ts, max(now_ts) AS now_ts,
    count(*) FILTER (WHERE event_type = 'PURCHASE') AS bought
  FROM hist WHERE cart_id IS NOT NULL GROUP BY user_id, cart_id
), open_carts AS (
  SELECT user_id, string_agg(cart_id, ',' ORDER BY cart_id) AS abandoned FROM carts
  WHERE last_add IS NOT NULL AND bought = 0 AND add_ts <= now_ts - {SEC(A.cart_timeout_sec)} GROUP BY user_id
), edits AS (
  SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_ts, arrival) AS prev FROM hist
  WHERE event_type IN ('ADD_TO_CART', 'REMOVE_FROM_CART') AND event_ts >= now_ts - {SEC(A.undecided_sec)}
), cyc AS (
  SELECT user_id, count(*) FILTER (WHERE event_type = 'REMOVE_FROM_CART' AND prev = 'ADD_TO_CART') AS cycles,
    count(*) FILTER (WHERE event_type = 'ADD_TO_CART') AS adds, count(*) FILTER (WHERE event_type = 'REMOVE_FROM_CART') AS removes
  FROM edits GROUP BY user_id
), facts AS (
  SELECT user_id, max(now_ts) AS detected_at,
    count(*) FILTER (WHERE event_type = 'PURCHASE' AND event_ts >= now_ts - {SEC(A.compulsive_sec)}) AS purchases_in_window,
    count(DISTINCT CASE WHEN event_type = 'VIEW_PRODUCT' AND event_ts >= now_ts - {SEC(A.comparer_sec)} THEN product_id END) AS views,
    count(*) FILTER (WHERE event_type = 'SEARCH' AND event_ts >= now_ts - {SEC(A.comparer_sec)}) AS searches,
    count(*) FILTER (WHERE event_type = 'ADD_TO_CART' AND event_ts >= now_ts - {SEC(A.comparer_sec)}) AS cart_events,
    count(*) FILTER (WHERE event_type = 'PURCHASE' AND event_ts >= now_ts - {SEC(A.comparer_sec)}) AS comparer_purchases,
    bool_or(agent_profile = 'COMPARADOR') AS comparer_profile, bool_or(agent_profile = 'CLIENTE_INDECISO') AS undecided_profile,
    count(*) FILTER (WHERE hour(event_ts) >= {A.night_start_hour} OR hour(event_ts) < {A.night_end_hour}) AS night,
    coalesce(CAST(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE' AND event_ts >= now_ts - {SEC(A.high_value_sec)}) AS DOUBLE), 0) AS spent,
    string_agg(DISTINCT CASE WHEN event_ts >= now_ts - {SEC(A.multi_device_sec)} THEN source END, ',' ORDER BY CASE WHEN event_ts >= now_ts - {SEC(A.multi_device_sec)} THEN source END) AS sources,
    count(DISTINCT CASE WHEN event_ts >= now_ts - {SEC(A.multi_device_sec)} THEN source END) AS n_sources
  FROM hist GROUP BY user_id
), f AS (
  SELECT facts.*, abandoned, coalesce(cycles, 0) AS cycles, coalesce(adds, 0) AS adds, coalesce(removes, 0) AS removes
  FROM facts LEFT JOIN open_carts USING (user_id) LEFT JOIN cyc USING (user_id)
)"""


RULES = {
    # name -> (audience, condition, confidence, expiry seconds, evidence)
    "aud_compulsive": ("COMPRADOR_COMPULSIVO", f"purchases_in_window >= {A.compulsive_purchases}", "least(1.0::DOUBLE, 0.7::DOUBLE + 0.1::DOUBLE * purchases_in_window)", A.compulsive_sec,
                       f"purchases_in_window, {A.compulsive_purchases} AS threshold"),
    "aud_comparer": ("COMPARADOR_ACTIVO", f"(views >= {A.comparer_views} AND comparer_purchases = 0) OR (comparer_profile AND greatest(views, searches) >= {max(2, A.comparer_views - 2)})",
                     "0.85::DOUBLE", A.comparer_sec, f"views AS distinct_products_viewed, searches, cart_events AS cart_events_in_window, {A.comparer_views} AS threshold, comparer_profile AS profile_match"),
    "aud_abandoned_cart": ("CARRITO_ABANDONADO", "abandoned IS NOT NULL", "0.9::DOUBLE", None, f"abandoned AS abandoned_carts, {A.cart_timeout_sec} AS timeout_seconds"),
    "aud_night_buyer": ("COMPRADOR_NOCTURNO", f"night >= {A.night_events}", "0.8::DOUBLE", None, f"night AS night_events_count, {A.night_events} AS threshold"),
    "aud_high_value": ("USUARIO_ALTO_VALOR", f"spent >= {A.high_value_amount}", "0.95::DOUBLE", None, f"round(spent, 2) AS total_spent_pen, {A.high_value_amount}::DOUBLE AS threshold_pen"),
    "aud_undecided": ("NAVEGADOR_INDECISO", f"cycles >= {A.undecided_cycles} OR (undecided_profile AND adds >= 1 AND removes >= 1 AND cycles >= {max(1, A.undecided_cycles - 2)})",
                      "0.85::DOUBLE", None, f"cycles AS add_remove_cycles, adds AS add_to_cart_events, removes AS remove_from_cart_events, {A.undecided_cycles} AS threshold, undecided_profile AS profile_match"),
    "aud_multi_device": ("USUARIO_MULTI_DISPOSITIVO", f"n_sources >= {A.multi_device_sources}", "0.9::DOUBLE", None, f"sources AS sources_used, {A.multi_device_sources} AS threshold"),
}


def rule_select(key, evidence=True, frm="f"):
    name, cond, conf, exp, ev = RULES[key]
    expires = f"detected_at + {SEC(exp)}" if exp else "CAST(NULL AS TIMESTAMP)"
    extra = f", {ev}" if evidence else ""
    return f"SELECT user_id, '{name}' AS audience_type, 'ADDED' AS action, {conf} AS confidence, detected_at, {expires} AS expires_at{extra} FROM {frm} WHERE {cond}"


def all_rules(frm="f"):
    return " UNION ALL ".join(rule_select(k, False, frm) for k in RULES)


for key in RULES:
    add(key, f"WITH {audience_sql()} {rule_select(key)}")
add("classify_audiences", f"WITH {audience_sql()} {all_rules()}")
ORACLES["write_audiences"] = f"SELECT * REPLACE ('ADDED' AS action, 1.0::DOUBLE AS confidence) FROM ({ORACLES['classify_audiences']})"
add("classify_stream", f"""WITH {audience_sql()} SELECT * FROM ({all_rules()}) WHERE user_id IN (SELECT user_id FROM crowd WHERE event_ts >= TIMESTAMP '2024-01-16 10:20:00')""")
_before_20 = "event_ts < TIMESTAMP '2024-01-20'"
_early = q(f"WITH {audience_sql(_before_20)} {all_rules()}")
ORACLES["audience_changes"] = f"""WITH cur AS (
  SELECT * FROM ({ORACLES['classify_audiences']}) WHERE expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-31 06:00:00'), prev AS (
  SELECT *, expires_at IS NULL OR expires_at > TIMESTAMP '2024-01-31 06:00:00' AS alive FROM ({_early})
), j AS (
  SELECT coalesce(c.user_id, p.user_id) AS user_id, coalesce(c.audience_type, p.audience_type) AS audience_type, c.confidence AS c, c.detected_at AS d,
    p.confidence AS pc, p.detected_at AS pd, c.user_id IS NOT NULL AS here, coalesce(p.alive, FALSE) AS there, p.user_id IS NOT NULL AS listed
  FROM cur c FULL OUTER JOIN prev p ON c.user_id = p.user_id AND c.audience_type = p.audience_type
), a AS (
  SELECT *, CASE WHEN here AND NOT there THEN 'ADDED' WHEN NOT here AND listed THEN 'REMOVED' WHEN here AND there AND (c <> pc OR d <> pd) THEN 'UPDATED' END AS action FROM j)
SELECT user_id, audience_type, action, coalesce(c, pc) AS confidence, coalesce(d, pd) AS detected_at FROM a WHERE action IS NOT NULL"""

# As of the end of every ten-second window with activity, over the last rows so far.
_asof = audience_sql().replace(
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival DESC) AS age FROM crowd WHERE TRUE",
    """SELECT crowd.* EXCLUDE (user_id), crowd.user_id || '|' || CAST(p.b AS VARCHAR) AS user_id,
    row_number() OVER (PARTITION BY crowd.user_id, p.b ORDER BY crowd.event_ts DESC, crowd.arrival DESC) AS age
  FROM crowd JOIN (SELECT DISTINCT user_id, epoch(event_ts)::BIGINT // 10 AS b FROM (SELECT user_id, date_trunc('second', event_ts) AS event_ts FROM crowd)) p
    ON p.user_id = crowd.user_id AND crowd.event_ts < TIMESTAMP '1970-01-01' + to_seconds((p.b + 1) * 10)""",
)
add("classify_as_of", f"WITH {_asof} SELECT split_part(user_id, '|', 1) AS user_id, audience_type, confidence, detected_at, expires_at FROM ({all_rules()})")

# --- alerts ---------------------------------------------------------------------------------------

L = ALERT
FACTS = """wfacts AS (
  SELECT {by}h AS window_start, h + INTERVAL 1 HOUR AS window_end, count(*) AS total_events, count(*) / 3600.0::DOUBLE AS eps,
    count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchases, count(*) FILTER (WHERE event_type = 'PAYMENT_FAILED') AS fails,
    CAST(max(total_amount) FILTER (WHERE event_type = 'PAYMENT_FAILED') AS DOUBLE) AS max_failed,
    count(*) FILTER (WHERE event_type = 'SEARCH') AS searches, count(*) FILTER (WHERE event_type IN ('ADD_TO_CART', 'REMOVE_FROM_CART')) AS edits,
    avg(latency_ms) AS latency,
    min(arrival) FILTER (WHERE event_type IN ('ADD_TO_CART', 'PURCHASE') AND coalesce(cart_value_after, total_amount) >= HIGH) AS big
  FROM (SELECT *, date_trunc('hour', event_ts) AS h FROM ev) GROUP BY {by}h
), leveled AS (
  SELECT f.*, CAST(coalesce(e.cart_value_after, e.total_amount) AS DOUBLE) AS big_value, e.user_id AS big_user,
    list_reduce(list_prepend(INIT::DOUBLE, list(eps) OVER (PARTITION BY {part} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      lambda b, x: 0.1::DOUBLE * x + 0.9::DOUBLE * b) AS baseline
  FROM wfacts f LEFT JOIN ev e ON e.arrival = f.big
)""".replace("HIGH", str(L.high_cart)).replace("INIT", str(L.baseline_init))
FACTS_ALL = FACTS.replace("{by}", "").replace("{part}", "1")
FACTS_BY = FACTS.replace("{by}", "scenario, ").replace("{part}", "f.scenario")
SPIKE = f"(eps > {L.spike_multiplier}::DOUBLE * baseline AND total_events > {L.spike_min_events})"
ALERT_RULES = {
    "alert_traffic_spike": ("TRAFFIC_SPIKE", "WARNING", SPIKE, "eps", f"{L.spike_multiplier}::DOUBLE * baseline",
                            "'Spike de tráfico detectado: ' || CAST(round(eps, 1) AS VARCHAR) || ' ev/s (Media esperada: ' || CAST(round(baseline, 1) AS VARCHAR) || ' ev/s)'"),
    "alert_traffic_drop": ("TRAFFIC_DROP", "CRITICAL", f"NOT {SPIKE} AND eps < {L.drop_multiplier}::DOUBLE * baseline AND baseline > {L.drop_min_baseline}", "eps", f"{L.drop_multiplier}::DOUBLE * baseline",
                           "'Caída drástica de tráfico: ' || CAST(round(eps, 1) AS VARCHAR) || ' ev/s (Media esperada: ' || CAST(round(baseline, 1) AS VARCHAR) || ' ev/s)'"),
    "alert_payment_failure_rate": ("HIGH_PAYMENT_FAILURE_RATE", "CRITICAL", f"purchases + fails >= {L.payment_min_attempts} AND fails::DOUBLE / (purchases + fails) * 100.0 >= {L.payment_fail_pct}",
                                   "CASE WHEN purchases + fails > 0 THEN fails::DOUBLE / (purchases + fails) * 100.0 END", f"{L.payment_fail_pct}::DOUBLE",
                                   "'Tasa de fallos en pasarela de pago inusualmente alta: ' || CAST(round(fails::DOUBLE / (purchases + fails) * 100.0::DOUBLE, 1) AS VARCHAR) || '%'"),
    "alert_high_value_payment_failure": ("HIGH_VALUE_PAYMENT_FAILURE", "CRITICAL", f"max_failed >= {L.critical_payment}", "max_failed", f"{L.critical_payment}::DOUBLE",
                                         "'Pago fallido de alto monto detectado: S/ ' || CAST(round(max_failed, 2) AS VARCHAR)"),
    "alert_high_value_cart": ("HIGH_VALUE_CART", "CRITICAL", "big IS NOT NULL", "big_value", f"{L.high_cart}::DOUBLE",
                              "'Carrito/compra por monto inusual detectado: S/ ' || CAST(round(big_value, 2) AS VARCHAR) || ' (Usuario: ' || big_user || ')'"),
    "alert_search_pressure": ("SEARCH_PRESSURE_NO_PURCHASE", "WARNING", f"searches >= {L.search_min} AND purchases = 0", "searches", f"{float(L.search_min)}::DOUBLE",
                              "'Alta actividad de busqueda sin compras en la ventana: ' || CAST(searches AS VARCHAR) || ' busquedas'"),
    "alert_cart_activity": ("HIGH_CART_ACTIVITY", "WARNING", f"edits >= {L.cart_activity_min}", "edits", f"{float(L.cart_activity_min)}::DOUBLE",
                            "'Actividad elevada de carrito: ' || CAST(edits AS VARCHAR) || ' altas/remociones en la ventana'"),
    "alert_high_latency": ("HIGH_LATENCY", "WARNING", f"latency >= {L.high_latency_ms}", "latency", f"{L.high_latency_ms}::DOUBLE",
                           "'Latencia de ingestión elevada: ' || CAST(round(latency, 1) AS VARCHAR) || ' ms'"),
}


def alert_select(key, message=True, by=""):
    name, severity, cond, value, limit, text = ALERT_RULES[key]
    msg = f", {text} AS message" if message else ""
    return f"SELECT {by}'{name}' AS alert_type, '{severity}' AS severity, round(CAST({value} AS DOUBLE), 2) AS current_value, round(CAST({limit} AS DOUBLE), 2) AS threshold_value, window_start, window_end{msg} FROM leveled WHERE {cond}"


def all_alerts(keys=tuple(ALERT_RULES), by=""):
    return " UNION ALL ".join(alert_select(k, False, by) for k in keys)


add("eps_baseline", f"WITH {FACTS_ALL} SELECT window_start, eps, round(baseline, 9) AS baseline FROM leveled")
for key in ALERT_RULES:
    add(key, f"WITH {FACTS_ALL} SELECT * EXCLUDE (window_end) FROM ({alert_select(key)})")
add("detect_alerts", f"WITH {FACTS_ALL} {all_alerts()}")
add("upsert_alerts", f"""WITH {FACTS_ALL}, a AS ({all_alerts()})
SELECT alert_type, severity, CASE WHEN severity = 'CRITICAL' THEN current_value + 1 ELSE current_value END AS current_value, threshold_value, window_start,
  window_end + CASE WHEN severity = 'CRITICAL' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS detected_at FROM a""")
add("alert_stream", f"""WITH {FACTS_ALL} SELECT * EXCLUDE (window_end) FROM ({all_alerts()})""")
add("read_alerts", f"""WITH {FACTS_ALL}, a AS ({all_alerts()})
SELECT state, alert_type, severity, current_value, threshold_value, window_start, window_end AS detected_at FROM a, (SELECT unnest(['before', 'after']) AS state)""")
ORACLES["big_cart_stream"] = ORACLES["alert_high_value_cart"]
ALERTS = f"{FACTS_ALL}, alerts AS ({all_alerts()})"
# --- zero filled traffic ------------------------------------------------------------------------

QUARTERS = f"""span AS (SELECT time_bucket(INTERVAL 15 MINUTE, event_ts, TIMESTAMP '1970-01-01') AS b, arrival FROM ev),
grid AS (SELECT unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS window_start FROM (SELECT min(b) AS lo, max(b) AS hi FROM span)),
counted AS (SELECT window_start, count(arrival) AS total_events, count(arrival) / 900.0::DOUBLE AS eps FROM grid LEFT JOIN span ON b = window_start GROUP BY window_start),
leveled AS (SELECT *, window_start + INTERVAL 15 MINUTE AS window_end,
  list_reduce(list_prepend({L.baseline_init}::DOUBLE, list(eps) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    lambda b, x: 0.1::DOUBLE * x + 0.9::DOUBLE * b) AS baseline FROM counted)"""
add("detect_alerts_zero_fill", f"WITH {QUARTERS} SELECT * EXCLUDE (window_end) FROM ({all_alerts(('alert_traffic_spike', 'alert_traffic_drop'))})")

# --- serving ----------------------------------------------------------------------------------------

DAILY = f"""tp AS (SELECT w, count(*) AS total_events, round(count(*) / 86400.0::DOUBLE, 2) AS eps, count(DISTINCT user_id) AS users,
    count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchases,
    round(coalesce(CAST(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE') AS DOUBLE), 0), 2) AS revenue FROM ev GROUP BY w),
cv AS (SELECT w, overall_conversion_rate AS rate FROM {conv('w')}),
d AS (SELECT *, row_number() OVER (ORDER BY w DESC) AS age FROM tp JOIN cv USING (w))"""
NUL = "CAST(NULL AS DOUBLE)"
add("latest_metrics", f"""WITH {DAILY}, l AS (SELECT *, w AS window_start, w + INTERVAL 1 DAY AS window_end FROM d WHERE age = 1)
SELECT 'throughput' AS metric_type, window_start, window_end, total_events::DOUBLE AS total_events, {NUL} AS active_users_count, {NUL} AS overall_conversion_rate, {NUL} AS total_revenue FROM l
UNION ALL SELECT 'active_users', window_start, window_end, NULL, users, NULL, NULL FROM l
UNION ALL SELECT 'conversion', window_start, window_end, NULL, NULL, rate, NULL FROM l
UNION ALL SELECT 'trends', window_start, window_end, NULL, NULL, NULL, revenue FROM l""")
add("metric_history", f"""WITH {DAILY}, l AS (SELECT *, w + INTERVAL 1 DAY AS window_end, CAST(row_number() OVER (ORDER BY w) AS INTEGER) AS position FROM d WHERE age <= 24)
SELECT 'throughput' AS metric_type, position, window_end, total_events::DOUBLE AS value FROM l UNION ALL SELECT 'active_users', position, window_end, users FROM l
UNION ALL SELECT 'conversion', position, window_end, rate / 100 FROM l UNION ALL SELECT 'trends', position, window_end, total_events FROM l""")
add("profile_stats", """SELECT scenario, agent_profile AS profile, count(DISTINCT user_id) AS users, CAST(count(*) FILTER (WHERE event_type = 'PURCHASE') AS BIGINT) AS purchases,
  coalesce(CAST(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE') AS DOUBLE), 0) AS revenue,
  count(*) FILTER (WHERE event_type = 'PURCHASE') / greatest(1, count(DISTINCT user_id))::DOUBLE AS conversion FROM ev GROUP BY scenario, agent_profile""")
add("source_share", """SELECT scenario, source, count(*) AS events, round(count(*) / (sum(count(*)) OVER (PARTITION BY scenario))::DOUBLE * 100.0, 1) AS share FROM ev GROUP BY scenario, source""")
SHARE = f"""(SELECT event_type, {"CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.EVENT_CATEGORY.items()) + " ELSE 'SISTEMA' END"} AS category,
  count(*) AS events, round(count(*) / (sum(count(*)) OVER ())::DOUBLE * 100.0, 2) AS percentage FROM ev GROUP BY event_type)"""
add("events_by_type_share", f"SELECT * FROM {SHARE}")
HEAT = f"""heat AS (
  WITH recent AS (SELECT event_type, date_trunc('hour', event_ts) AS bucket FROM ev ORDER BY event_ts DESC, arrival DESC LIMIT 8000),
  b AS (SELECT DISTINCT bucket FROM recent ORDER BY bucket DESC LIMIT 48)
  SELECT b.bucket, t.event_type, count(r.event_type) AS events FROM b CROSS JOIN (SELECT unnest({sql_list(C.EVENT_TYPES)}) AS event_type) t
  LEFT JOIN recent r ON r.bucket = b.bucket AND r.event_type = t.event_type GROUP BY b.bucket, t.event_type)"""
add("event_type_heatmap", f"WITH {HEAT} SELECT bucket, strftime(bucket, '%H:%M') AS label, event_type, events FROM heat")
add("heatmap_intensity", f"""WITH {HEAT} SELECT bucket, event_type, events, CAST(sum(events) OVER (PARTITION BY event_type) AS BIGINT) AS row_total,
  events / (max(events) OVER ())::DOUBLE AS intensity FROM heat""")
PRODUCTS = f"""prod AS (
  SELECT v.product_id, v.product_name, v.category, views, coalesce(units, 0) AS units, coalesce(orders, 0) AS orders, coalesce(total_revenue, 0.0::DOUBLE) AS revenue
  FROM {VIEWED.replace('{keys}', '')} v LEFT JOIN {BOUGHT.replace('{keys}', '')} b USING (product_id)
  LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS orders FROM items GROUP BY product_id) o USING (product_id)
), pc AS (SELECT *, CASE WHEN views > 0 THEN units / views::DOUBLE ELSE 0 END AS conversion FROM prod),
pm AS (SELECT *, avg(conversion) OVER () AS avg_conversion, avg(views) OVER () AS avg_views FROM pc),
pq AS (SELECT *, CASE WHEN conversion >= avg_conversion THEN CASE WHEN views >= avg_views THEN 'estrella' ELSE 'oculto' END
  WHEN views >= avg_views THEN 'fuga' ELSE 'bajo' END AS quadrant FROM pm),
bought AS (SELECT * FROM {BOUGHT.replace('{keys}', '')})"""
add("product_view_purchase_join", f"WITH {PRODUCTS} SELECT * FROM prod")
add("product_matrix", f"""WITH {PRODUCTS} SELECT product_id, views, units, round(conversion, 7) AS conversion, round(avg_conversion, 7) AS avg_conversion,
  round(avg_views, 7) AS avg_views, quadrant FROM pq""")
add("quadrant_groups", f"WITH {PRODUCTS} SELECT quadrant, count(*) AS products, CAST(sum(views) AS BIGINT) AS views, CAST(sum(units) AS BIGINT) AS units FROM pq GROUP BY quadrant")
add("product_ranking", f"""WITH {PRODUCTS}, r AS (SELECT *, CAST(row_number() OVER (ORDER BY revenue DESC, product_id) AS INTEGER) AS position FROM prod)
SELECT product_id, position, revenue, revenue / greatest(1.0, max(revenue) OVER ()) AS relative FROM r WHERE position <= 20""")
LEAKS = """leaks AS (SELECT * FROM pm WHERE conversion < avg_conversion * 0.75::DOUBLE)"""
add("product_leaks", f"""WITH {PRODUCTS}, {LEAKS}
SELECT 'LEAK' AS finding, product_id, CAST(views AS DOUBLE) AS views, units, round(conversion, 7) AS conversion, round(avg_conversion, 7) AS avg_conversion, round(revenue, 7) AS revenue FROM leaks
UNION ALL (SELECT 'STAR', product_id, NULL, units, NULL, NULL, total_revenue FROM bought ORDER BY total_revenue DESC, product_id LIMIT 1)""")
ORACLES["product_dwell"] = q("""SELECT product_id, round(CAST(sum(dwell_time_ms) AS DOUBLE) / count(*) / 1000.0::DOUBLE, 7) AS avg_dwell_seconds FROM ev WHERE event_type = 'VIEW_PRODUCT' GROUP BY product_id""")
add("funnel", f"""WITH c AS (SELECT * FROM {conv('w')}), s AS (
  SELECT w, 1 AS stage_no, 'VIEW_PRODUCT' AS stage, 'Visualizacion de producto' AS label, views_count AS value FROM c
  UNION ALL SELECT w, 2, 'ADD_TO_CART', 'Agregado al carrito', cart_additions_count FROM c UNION ALL SELECT w, 3, 'PURCHASE', 'Compra confirmada', purchases_count FROM c),
p AS (SELECT *, lag(value) OVER (PARTITION BY w ORDER BY stage_no) AS prev FROM s)
SELECT w AS window_start, stage_no, stage, label, value, CASE WHEN prev > 0 THEN round((prev - value) / prev::DOUBLE * 100.0, 2) ELSE 0.0 END AS drop_from_previous FROM p""")
LABEL = "CASE upper(region) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.REGION_LABELS.items()) + " ELSE region END"
REGIONS = f"""reg0 AS (SELECT region, count(*) AS n, round(CAST(sum(total_amount) AS DOUBLE), 2) AS amount FROM ev WHERE event_type = 'PURCHASE' GROUP BY region),
reg AS (SELECT {LABEL} AS region, n AS purchases, amount AS revenue, round(amount / greatest(1.0, sum(amount) OVER ()) * 100.0, 2) AS national_share,
  amount / greatest(1, n) AS avg_ticket, (SELECT overall_conversion_rate FROM {conv()}) / 100 AS conversion,
  CAST(round_even((SELECT count(DISTINCT user_id) FROM ev) / (count(*) OVER ())::DOUBLE, 0) AS BIGINT) AS active_users FROM reg0)"""
add("region_stats", f"WITH {REGIONS} SELECT * FROM reg")
add("region_ranking", f"""WITH {REGIONS}, m AS (SELECT *, least(0, min(revenue) OVER ()) AS lo, greatest(1, max(revenue) OVER ()) AS hi FROM reg)
SELECT region, revenue, CAST(row_number() OVER (ORDER BY revenue DESC, region) AS INTEGER) AS position, (revenue - lo) / (hi - lo) AS intensity FROM m""")
add("region_activity", """SELECT region, count(DISTINCT user_id) AS active_users, CAST(count(*) FILTER (WHERE event_type = 'PURCHASE') AS BIGINT) AS purchases,
  CAST(count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT') AS BIGINT) AS views,
  CASE WHEN count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT') > 0 THEN count(*) FILTER (WHERE event_type = 'PURCHASE') / (count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT'))::DOUBLE ELSE 0 END AS conversion
FROM ev GROUP BY region""")
META = "meta AS (" + " UNION ALL ".join(f"SELECT '{k}' AS audience_type, '{l}' AS label, '{p}' AS priority" for k, (l, p) in C.AUDIENCES.items()) + ")"
SUMMARY = f"""{audience_sql()}, cls AS ({all_rules()}), ranked AS (SELECT *, row_number() OVER (PARTITION BY audience_type ORDER BY detected_at DESC, user_id) AS pos FROM cls),
st AS (SELECT audience_type, count(DISTINCT user_id) AS users, count(*) AS det, avg(confidence) AS conf, max(detected_at) AS last_seen FROM cls GROUP BY audience_type),
smp AS (SELECT audience_type, string_agg(user_id, ',' ORDER BY pos) AS sample_users FROM ranked WHERE pos <= 8 GROUP BY audience_type), {META},
summ AS (SELECT lower(replace(meta.audience_type, '_', '-')) AS id, meta.audience_type, label, priority, coalesce(users, 0) AS users,
  round(coalesce(users, 0) / greatest(1, coalesce(sum(users) OVER (), 0))::DOUBLE * 100.0, 2) AS percentage, coalesce(det, 0) AS recent_detections,
  coalesce(conf, 0.0::DOUBLE) AS avg_confidence, last_seen, sample_users
  FROM meta LEFT JOIN st USING (audience_type) LEFT JOIN smp USING (audience_type))"""
add("audience_summary", f"WITH {SUMMARY} SELECT * FROM summ")
add("audience_overview", f"""WITH {SUMMARY} SELECT CAST(sum(users) AS BIGINT) AS total_users, count(*) AS audiences,
  (SELECT audience_type FROM summ ORDER BY users DESC, id LIMIT 1) AS dominant, (SELECT percentage FROM summ ORDER BY users DESC, id LIMIT 1) AS dominant_percentage,
  (SELECT audience_type FROM summ ORDER BY users DESC, id LIMIT 1) AS fastest_growing FROM summ""")
FEED_CORE = f"""{ALERTS}, ordered AS (
  SELECT *, CASE alert_type {" ".join(f"WHEN '{r[0]}' THEN '{p}'" for (r, p) in zip(ALERT_RULES.values(), ['ALT_SPIKE_', 'ALT_DROP_', 'ALT_PAYMENT_', 'ALT_PAYMENT_AMOUNT_', 'ALT_CART_', 'ALT_SEARCH_', 'ALT_CART_ACTIVITY_', 'ALT_LATENCY_']))} END
    || substr(sha256(alert_type || '|' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || '|' || strftime(window_end, '%Y-%m-%d %H:%M:%S')), 1, 8) AS id FROM alerts
), newest AS (SELECT * FROM ordered ORDER BY window_end DESC, id LIMIT 50),
feed AS (SELECT id, severity AS level,
  array_to_string(list_transform(string_split(lower(replace(alert_type, '_', ' ')), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title,
  window_end AS "timestamp", 'Apache Flink' AS component, 'BASE' AS scenario,
  CASE WHEN window_end = max(window_end) OVER () THEN 'ACTIVA' ELSE 'RECONOCIDA' END AS status FROM newest)"""
add("alert_feed", f"WITH {FEED_CORE} SELECT * EXCLUDE (id) FROM feed")
add("export_alerts_csv", f"""WITH {FEED_CORE} SELECT level AS nivel, title AS titulo, 'a;b "c", ' || title AS descripcion, component AS componente, scenario AS escenario,
  status AS estado, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp" FROM feed""")
add("alert_filter", f"""WITH {FEED_CORE} SELECT title, level, status, "timestamp" FROM feed WHERE level = 'WARNING' AND status = 'RECONOCIDA'
  AND (contains(lower(title), 'cart') OR contains(lower(component), 'cart'))""")
add("alert_counts", f"""WITH {FEED_CORE}, lv AS (SELECT unnest(['INFO', 'WARNING', 'CRITICAL']) AS level), c AS (
  SELECT lv.level, count(f.id) AS active FROM lv LEFT JOIN (SELECT * FROM feed WHERE status = 'ACTIVA') f USING (level) GROUP BY lv.level)
SELECT level, active, CAST(sum(active) OVER () AS BIGINT) AS active_total, CAST(sum(CASE WHEN level = 'CRITICAL' THEN active ELSE 0 END) OVER () AS BIGINT) AS critical_total FROM c""")
add("alerts_by_component", f"WITH {FEED_CORE} SELECT component, count(*) AS alerts, count(*) FILTER (WHERE status = 'ACTIVA') AS active FROM feed GROUP BY component")
add("components_degraded", f"""WITH {FEED_CORE}, c AS (SELECT component, bool_or(status = 'ACTIVA') AS hit FROM feed GROUP BY component)
SELECT count(*) FILTER (WHERE hit) AS degraded FROM c""")
add("alert_timeline", f"""WITH {FEED_CORE}, t AS (SELECT title, "timestamp", epoch_ms("timestamp") AS ms FROM feed), s AS (SELECT *, min(ms) OVER () AS lo, max(ms) OVER () AS hi FROM t)
SELECT title, "timestamp", round((ms - lo) / (CASE WHEN hi = lo THEN lo + 1 ELSE hi END - lo)::DOUBLE, 7) AS at FROM s""")
add("alert_status_overlay", f"""WITH {FEED_CORE} SELECT title, "timestamp", level,
  CASE WHEN level = 'CRITICAL' THEN CASE WHEN hour("timestamp") % 2 = 0 THEN 'RESUELTA' ELSE 'RECONOCIDA' END ELSE status END AS status FROM feed""")
add("mean_ack_minutes", f"""WITH {FEED_CORE} SELECT round(coalesce(avg(least(45.0::DOUBLE, greatest(0.5::DOUBLE, date_diff('millisecond', "timestamp", TIMESTAMP '2024-01-31') / 60000.0::DOUBLE))), 0), 7) AS mean_ack_minutes,
  count(*) AS handled FROM feed WHERE status <> 'ACTIVA'""")
KPI = f"""{DAILY}, k AS (
  SELECT 'active_users' AS kpi, max(users) FILTER (WHERE age = 1)::DOUBLE AS value, max(users) FILTER (WHERE age = 2)::DOUBLE AS prev FROM d
  UNION ALL SELECT 'events_per_second', max(eps) FILTER (WHERE age = 1), max(eps) FILTER (WHERE age = 2) FROM d
  UNION ALL SELECT 'purchase_conversion', max(rate) FILTER (WHERE age = 1) / 100, max(rate) FILTER (WHERE age = 2) / 100 FROM d
  UNION ALL SELECT 'total_purchases', max(purchases) FILTER (WHERE age = 1), max(purchases) FILTER (WHERE age = 2) FROM d
  UNION ALL SELECT 'total_revenue', max(revenue) FILTER (WHERE age = 1), max(revenue) FILTER (WHERE age = 2) FROM d
  UNION ALL SELECT 'total_processed', max(total_events) FILTER (WHERE age = 1), max(total_events) FILTER (WHERE age = 2) FROM d
), kp AS (SELECT kpi, value, CASE WHEN prev IS NULL OR prev = 0 THEN 0.0::DOUBLE ELSE (value - prev) / prev * 100.0::DOUBLE END AS delta FROM k
  UNION ALL SELECT 'active_alerts', count(*) FILTER (WHERE status = 'ACTIVA'), 0 FROM feed)"""
add("kpi_snapshot", f"WITH {FEED_CORE}, {KPI} SELECT * FROM kp")
HEALTH = f"""one AS (SELECT (SELECT count(*) FROM ev) AS raw, (SELECT sum(publicados) FROM runs) AS pub, (SELECT sum(enviados) FROM runs) AS sent,
    (SELECT sum(rechazados) FROM runs) AS rej, (SELECT sum(fallidos) FROM runs) AS fail, (SELECT 4 * count(DISTINCT w) FROM ev) AS mets,
    (SELECT count(*) FROM cls) AS auds, (SELECT count(*) FROM feed) AS als),
o AS (SELECT *, mets + auds + als AS outp, greatest(pub, raw) AS produced, greatest(sent, raw) AS delivered FROM one)"""
add("pipeline_health", f"""WITH {FEED_CORE}, {audience_sql()}, cls AS ({all_rules()}), {RUNS}, {HEALTH}
SELECT stage, CAST(messages_processed AS BIGINT) AS messages_processed, CAST(errors AS BIGINT) AS errors, status FROM (
SELECT 'simuladores' AS stage, produced + rej AS messages_processed, rej AS errors, 'OPERATIVO' AS status FROM o
UNION ALL SELECT 'productores', delivered, fail, 'OPERATIVO' FROM o UNION ALL SELECT 'kafka', greatest(raw, delivered), fail, 'OPERATIVO' FROM o
UNION ALL SELECT 'flink', greatest(raw, outp), 0, 'OPERATIVO' FROM o UNION ALL SELECT 'backend', outp, 0, 'OPERATIVO' FROM o
UNION ALL SELECT 'transporte', outp, 0, 'OPERATIVO' FROM o UNION ALL SELECT 'dashboard', outp, 0, 'OPERATIVO' FROM o)""")
add("dashboard_snapshot", f"""WITH {FEED_CORE}, b AS (SELECT 12 * least(12, count(DISTINCT date_trunc('hour', event_ts))) AS cells FROM (SELECT * FROM ev WHERE scenario = 'BASE' ORDER BY event_ts DESC LIMIT 8000))
SELECT 'kpis' AS part, CAST(7 AS BIGINT) AS rows UNION ALL SELECT 'sparklines', 4 * least(24, count(DISTINCT w)) FROM ev
UNION ALL SELECT 'events_by_type', count(DISTINCT event_type) FROM ev UNION ALL SELECT 'event_type_intervals', cells FROM b
UNION ALL SELECT 'audiences', 7 UNION ALL SELECT 'top_viewed_products', least(10, count(DISTINCT product_id)) FROM ev WHERE event_type = 'VIEW_PRODUCT'
UNION ALL SELECT 'top_purchased_products', least(10, count(DISTINCT product_id)) FROM items
UNION ALL SELECT 'regions', count(DISTINCT region) FROM ev WHERE event_type = 'PURCHASE' UNION ALL SELECT 'funnel', 3 UNION ALL SELECT 'alerts', count(*) FROM feed
UNION ALL SELECT 'infrastructure', 7 UNION ALL SELECT 'profiles', count(DISTINCT agent_profile) FROM ev WHERE scenario = 'BASE'
UNION ALL SELECT 'sources', count(DISTINCT source) FROM ev WHERE scenario = 'BASE'""")
add("audit_counts", f"""WITH {ALERTS}, {audience_sql()}, cls AS ({all_rules()}), {RUNS}
SELECT 'topic' AS section, {TOPIC} AS key, count(*) AS rows FROM ev GROUP BY 2
UNION ALL SELECT 'metric', m, count(DISTINCT w) FROM ev, (SELECT unnest(['throughput', 'active_users', 'conversion', 'trends']) AS m) GROUP BY m
UNION ALL SELECT 'audience', audience_type, count(*) FROM cls GROUP BY audience_type
UNION ALL SELECT 'alert', alert_type || '/' || severity, count(*) FROM alerts GROUP BY alert_type, severity
UNION ALL SELECT 'run', run_id, enviados FROM (SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 5)""")

# --- series, products, scenarios ------------------------------------------------------------------------

HSER = """ser AS (SELECT scenario, date_trunc('hour', event_ts) AS window_start, count(*) AS v FROM ev GROUP BY 1, 2),
num AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY window_start) - 1 AS pos, count(*) OVER (PARTITION BY scenario) AS n FROM ser)"""
GSER = HSER.replace("SELECT scenario, date_trunc", "SELECT 1 AS scenario, date_trunc")
STATS = """(SELECT scenario, CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max, round(avg(v), 7) AS avg, round(stddev_pop(v), 7) AS std,
  min(CASE WHEN v = lo THEN pos END) AS min_index, min(CASE WHEN v = hi THEN pos END) AS max_index,
  round((avg(v) FILTER (WHERE pos >= n - half) - avg(v) FILTER (WHERE pos < half)) / avg(v) FILTER (WHERE pos < half) * 100.0::DOUBLE, 7) AS trend_pct
FROM (SELECT *, greatest(1, n // 2) AS half, min(v) OVER (PARTITION BY scenario) AS lo, max(v) OVER (PARTITION BY scenario) AS hi FROM num) GROUP BY scenario)"""
add("series_stats", f"WITH {HSER} SELECT * FROM {STATS}")
add("series_stats_global", f"WITH {GSER} SELECT * EXCLUDE (scenario) FROM {STATS}")
ZS = "z AS (SELECT *, (v - avg(v) OVER ()) / stddev_pop(v) OVER () AS z FROM ser)"
add("zscore_anomalies", f"""WITH {GSER}, {ZS}
SELECT window_start, v AS total_events, round(z, 7) AS z, CASE WHEN z > 0 THEN 'pico' ELSE 'caida' END AS kind FROM z WHERE abs(z) >= 1.9""")
HALVES = """(SELECT scenario, avg(v) FILTER (WHERE pos >= n // 2) AS current, avg(v) FILTER (WHERE pos < n // 2) AS previous FROM num GROUP BY scenario)"""
add("period_comparison", f"""WITH {HSER} SELECT scenario, round(current, 7) AS current, round(previous, 7) AS previous,
  round((current - previous) / previous * 100.0::DOUBLE, 7) AS pct FROM {HALVES}""")
add("filter_recent", """WITH s AS (SELECT scenario, date_trunc('minute', event_ts) AS window_start, count(*) AS total_events FROM ev GROUP BY 1, 2)
SELECT * FROM (SELECT *, max(window_start) OVER (PARTITION BY scenario) AS l FROM s) WHERE window_start >= l - INTERVAL 1 HOUR""".replace("SELECT * FROM (", "SELECT * EXCLUDE (l) FROM ("))
add("expected_band", f"""WITH {HSER}, b AS (SELECT *, avg(v) OVER (PARTITION BY scenario) AS m, stddev_pop(v) OVER (PARTITION BY scenario) AS s FROM ser)
SELECT scenario, window_start, v AS total_events, round(greatest(0.0::DOUBLE, m - s), 7) AS low, round(m + s, 7) AS high, round((v - m) / m * 100.0::DOUBLE, 7) AS deviation_pct FROM b""")
CAT = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.EVENT_CATEGORY.items()) + f" ELSE '{C.DEFAULT_CATEGORY}' END"
add("category_share", f"""WITH t AS (SELECT {CAT} AS category, event_type, count(*) AS events FROM ev GROUP BY 1, 2),
c AS (SELECT cat AS category, coalesce(sum(events), 0) AS total FROM (SELECT unnest({sql_list(C.CATEGORIES)}) AS cat) x LEFT JOIN t ON t.category = x.cat GROUP BY cat),
s AS (SELECT *, total / (sum(total) OVER ())::DOUBLE * 100.0::DOUBLE AS category_share FROM c)
SELECT category, 'TOTAL' AS event_type, CAST(total AS BIGINT) AS events, category_share FROM s
UNION ALL SELECT t.category, event_type, events, category_share FROM t JOIN s USING (category)""")
INSIGHT = f"""{FEED_CORE}, {SUMMARY}, {REGIONS}, {PRODUCTS}, {LEAKS}, {GSER}, {ZS}, shares AS (SELECT * FROM {SHARE}),
topreg AS (SELECT * FROM reg ORDER BY revenue DESC, region LIMIT 1), bestreg AS (SELECT * FROM reg ORDER BY conversion DESC, revenue DESC, region LIMIT 1),
found AS (
  SELECT 0 AS place, 'aud-crecimiento' AS id, 'positivo' AS tone, label AS subject, 0.0::DOUBLE AS value FROM (SELECT * FROM summ ORDER BY users DESC, id LIMIT 1)
  UNION ALL SELECT 1, 'aud-riesgo', 'advertencia', label, users FROM summ WHERE audience_type = 'CARRITO_ABANDONADO'
  UNION ALL SELECT 2, 'reg-top', 'neutral', region, national_share FROM topreg
  UNION ALL SELECT 3, 'reg-conv', 'positivo', region, conversion * 100 FROM bestreg WHERE region <> (SELECT region FROM topreg)
  UNION ALL SELECT 4, 'prod-fuga', 'advertencia', product_name, conversion * 100 FROM (SELECT * FROM leaks ORDER BY views DESC, product_id LIMIT 1)
  UNION ALL SELECT 5, 'prod-estrella', 'positivo', product_name, total_revenue FROM (SELECT * FROM bought ORDER BY total_revenue DESC, product_id LIMIT 1)
  UNION ALL SELECT 6, 'evt-pico', 'advertencia', strftime(window_start, '%Y-%m-%d %H:%M:%S'), v FROM (SELECT * FROM z WHERE z >= 1.9 ORDER BY z DESC, window_start LIMIT 1)
  UNION ALL SELECT 7, 'evt-pagos', CASE WHEN percentage > 1.5 THEN 'critico' ELSE 'neutral' END, event_type, percentage FROM shares WHERE event_type = 'PAYMENT_FAILED'
  UNION ALL SELECT 8, 'alr-componente', CASE WHEN count(*) > 2 THEN 'critico' ELSE 'advertencia' END, component, count(*) FROM feed WHERE status = 'ACTIVA' GROUP BY component)"""
PICK = "SELECT CAST(place AS INTEGER) AS place, id, tone, subject, round(CAST(value AS DOUBLE), 6) AS value FROM found"
add("insights", f"WITH {INSIGHT} {PICK} ORDER BY place LIMIT 4")
for scope, (lo, hi) in {"audiencias": (0, 1), "regiones": (2, 3), "productos": (4, 5), "eventos": (6, 7), "alertas": (8, 8)}.items():
    add(f"insights_{scope}", f"WITH {INSIGHT} {PICK} WHERE place BETWEEN {lo} AND {hi} ORDER BY place LIMIT 3")
add("system_summary", f"""WITH {FEED_CORE}, {KPI}, {REGIONS}, {GSER}, shares AS (SELECT * FROM {SHARE}), one AS (
  SELECT (SELECT (current - previous) / previous * 100.0::DOUBLE FROM {HALVES}) AS pct, (SELECT value FROM kp WHERE kpi = 'events_per_second') AS eps,
    (SELECT value * 100 FROM kp WHERE kpi = 'purchase_conversion') AS conv, (SELECT delta FROM kp WHERE kpi = 'purchase_conversion') AS delta,
    (SELECT count(*) FROM feed WHERE level = 'CRITICAL' AND status = 'ACTIVA') AS crit, (SELECT percentage FROM shares WHERE event_type = 'PAYMENT_FAILED') AS failed,
    (SELECT region FROM reg ORDER BY revenue DESC, region DESC LIMIT 1) AS top)
SELECT CASE WHEN pct >= 0 THEN 'incremento' ELSE 'reduccion' END AS direction, round(abs(pct), 6) AS throughput_pct, round(eps, 6) AS eps, round(conv, 6) AS conversion_pct,
  CASE WHEN abs(delta) < 1 THEN 'estable' WHEN delta > 0 THEN 'subio' ELSE 'cayo' END AS conversion_state,
  CASE WHEN crit > 0 THEN 'alertas_criticas' WHEN failed > 1.2 THEN 'pagos_rechazados' ELSE 'ninguno' END AS risk,
  round(CASE WHEN crit > 0 THEN crit::DOUBLE WHEN failed > 1.2 THEN failed END, 6) AS risk_value, CASE WHEN crit = 0 AND failed > 1.2 THEN top END AS risk_region FROM one""")
add("funnel_insights", f"""WITH c AS (SELECT * FROM {conv()}), s AS (
  SELECT 1 AS no, 'VIEW_PRODUCT' AS stage, 0.0::DOUBLE AS lost FROM c
  UNION ALL SELECT 2, 'ADD_TO_CART', round((views_count - cart_additions_count) / views_count::DOUBLE * 100.0, 2) FROM c
  UNION ALL SELECT 3, 'PURCHASE', round((cart_additions_count - purchases_count) / cart_additions_count::DOUBLE * 100.0, 2) FROM c),
num AS (SELECT 1 AS scenario, overall_conversion_rate AS v, row_number() OVER (ORDER BY w) - 1 AS pos, count(*) OVER () AS n FROM {conv('w')}),
h AS (SELECT (current - previous) / previous * 100.0::DOUBLE AS pct FROM {HALVES})
SELECT 'conv-fuga' AS id, CASE WHEN lost > 40 THEN 'critico' ELSE 'advertencia' END AS tone, stage AS subject, round(lost, 6) AS value FROM (SELECT * FROM s ORDER BY lost DESC, no LIMIT 1) WHERE lost > 0
UNION ALL SELECT 'conv-vs-promedio', CASE WHEN pct >= 0 THEN 'positivo' ELSE 'advertencia' END, 'conversion', round(pct, 6) FROM h""")
SCEN = f"""{FACTS_BY}, sa AS (SELECT scenario, count(*) AS alerts, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts FROM ({all_alerts(by='scenario, ')}) GROUP BY scenario),
wu AS (SELECT scenario, date_trunc('hour', event_ts) AS h, count(DISTINCT user_id) AS users, count(*) AS n FROM ev GROUP BY 1, 2),
ws AS (SELECT scenario, max(users) AS max_active_users, round(max(n) / 3600.0::DOUBLE, 4) AS peak_eps, round(sum(n) / count(*)::DOUBLE / 3600.0::DOUBLE, 4) AS avg_eps FROM wu GROUP BY scenario),
res AS (SELECT scenario, count(*) AS total_events, any_value(avg_eps) AS avg_eps, any_value(peak_eps) AS peak_eps, any_value(max_active_users) AS max_active_users,
  count(*) FILTER (WHERE event_type = 'PURCHASE') AS purchases, count(*) FILTER (WHERE event_type = 'PURCHASE') / (count(*) FILTER (WHERE event_type = 'VIEW_PRODUCT'))::DOUBLE AS conversion,
  CAST(sum(total_amount) FILTER (WHERE event_type = 'PURCHASE') AS DOUBLE) AS total_revenue,
  greatest(0, count(*) FILTER (WHERE event_type = 'ADD_TO_CART') - count(*) FILTER (WHERE event_type = 'PURCHASE')) AS abandoned_carts,
  count(*) FILTER (WHERE event_type = 'PAYMENT_FAILED') AS failed_payments, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms,
  any_value(coalesce(alerts, 0)) AS alerts, any_value(coalesce(critical_alerts, 0)) AS critical_alerts
  FROM ev JOIN ws USING (scenario) LEFT JOIN sa USING (scenario) GROUP BY scenario)"""
add("scenario_results", f"""WITH {SCEN} SELECT * REPLACE (round(conversion, 7) AS conversion, round(total_revenue, 7) AS total_revenue, round(avg_latency_ms, 7) AS avg_latency_ms,
  CAST(total_events AS BIGINT) AS total_events) FROM res""")
MEASURES = {"throughput": ("avg_eps", 0), "conversion": ("conversion", 0), "latency": ("avg_latency_ms", 1), "alerts": ("alerts", 0), "revenue": ("total_revenue", 0)}
add("scenario_conclusions", f"""WITH {SCEN}, m AS ({" UNION ALL ".join(f"SELECT '{k}' AS measure, scenario, CAST({c} AS DOUBLE) AS v, {low} AS low FROM res" for k, (c, low) in MEASURES.items())}),
r AS (SELECT *, row_number() OVER (PARTITION BY measure ORDER BY CASE WHEN low = 1 THEN v ELSE -v END, scenario) AS a,
  row_number() OVER (PARTITION BY measure ORDER BY CASE WHEN low = 1 THEN v ELSE -v END DESC, scenario DESC) AS b FROM m)
SELECT measure, max(scenario) FILTER (WHERE a = 1) AS best, round(max(v) FILTER (WHERE a = 1), 7) AS best_value, max(scenario) FILTER (WHERE b = 1) AS worst,
  round(max(v) FILTER (WHERE b = 1), 7) AS worst_value, round(max(v) / greatest(1.0::DOUBLE, min(v)), 7) AS ratio FROM r GROUP BY measure""")
RADAR = {"Throughput": ("avg_eps", 0), "Conversión": ("conversion", 0), "Ingresos": ("total_revenue", 0), "Latencia": ("avg_latency_ms", 1), "Estabilidad": ("alerts", 1), "Usuarios": ("max_active_users", 0)}
add("normalize_for_radar", f"""WITH {SCEN}, m AS ({" UNION ALL ".join(f"SELECT '{k}' AS measure, scenario, CAST({c} AS DOUBLE) AS v, {low} AS low FROM res" for k, (c, low) in RADAR.items())}),
b AS (SELECT *, min(v) OVER (PARTITION BY measure) AS lo, max(v) OVER (PARTITION BY measure) AS hi FROM m),
s AS (SELECT *, CASE WHEN lo = hi THEN 100.0::DOUBLE ELSE (v - lo) / (hi - lo) * 100.0::DOUBLE END AS x FROM b)
SELECT measure, scenario, round(CASE WHEN low = 1 THEN 100.0::DOUBLE - x ELSE x END, 1) AS score FROM s""")

# --- quality ----------------------------------------------------------------------------------------

add("latency_summary", """SELECT source, count(*) AS n, round(quantile_cont(latency_ms, 0.5), 2) AS p50, round(quantile_cont(latency_ms, 0.95), 2) AS p95,
  round(quantile_cont(latency_ms, 0.99), 2) AS p99, round(avg(latency_ms), 2) AS mean, round(CAST(max(latency_ms) AS DOUBLE), 2) AS max FROM ev GROUP BY source""")
ORACLES["value_percentiles"] = """SELECT l_returnflag, """ + ", ".join(
    f"round(quantile_cont(l_extendedprice, {p / 100}), 4) AS p{p}" for p in (0, 25, 50, 95, 99, 100)
) + " FROM lineitem GROUP BY l_returnflag"
add("rate_summary", f"WITH {RUNS} SELECT run_id, enviados, segundos, CASE WHEN segundos > 0 THEN round(enviados / segundos::DOUBLE, 1) ELSE 0.0 END AS eventos_por_segundo FROM runs")
DELIV = f"""dl AS (SELECT n, event_id, user_id AS key, {TOPIC} AS topic, CAST(n % 4 AS INTEGER) AS expected,
  CASE WHEN ({STATUS}) = 'CONFIRMED' THEN CAST(CASE WHEN n % 43 = 0 THEN (n + 1) % 4 ELSE n % 4 END AS INTEGER) END AS part, ({STATUS}) = 'FAILED' AS failed FROM ev)"""
add("reconcile", f"""WITH t AS (SELECT *, {STATUS} AS st FROM ev), c AS (
  SELECT source, count(*) FILTER (WHERE st <> 'REJECTED') AS published, count(*) FILTER (WHERE st = 'CONFIRMED') AS confirmed, count(*) FILTER (WHERE st = 'FAILED') AS failed,
    count(*) FILTER (WHERE st = 'CONFIRMED' AND n % 101 <> 0) AS stored FROM t GROUP BY source)
SELECT *, published - confirmed AS unconfirmed, greatest(0, confirmed - stored) AS not_stored, greatest(0, stored - confirmed) AS surplus,
  CASE WHEN published <> confirmed OR failed > 0 OR confirmed > stored THEN 'LOSS' ELSE 'OK' END AS verdict FROM c""")
add("missing_events", f"WITH {DELIV} SELECT event_id, topic FROM dl WHERE part IS NOT NULL AND n % 53 = 0")
add("deliveries_by_topic", f"WITH {DELIV} SELECT topic, count(*) AS published, count(part) AS confirmed, count(DISTINCT part) AS partitions_used FROM dl GROUP BY topic")
add("partition_mismatch", f"""WITH {DELIV} SELECT event_id, topic, CASE WHEN failed THEN 'entrega fallida (TIMED_OUT)' WHEN part IS NULL THEN 'sin acuse de entrega'
  ELSE 'la clave ' || key || ' cayó en la partición ' || CAST(part AS VARCHAR) || ' y el particionador esperaba ' || CAST(expected AS VARCHAR) END AS reason
FROM dl WHERE failed OR part IS NULL OR part <> expected""")
