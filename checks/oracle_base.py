"""SQL text shared by the oracles: the contract mapping of the `events` table."""

from tidemark import contract as C
from tidemark.sources.adapter import CATEGORY_KEYS, REGION_KEYS


def sql_list(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def at(values, index):
    return f"list_extract({sql_list(values)}, CAST(({index}) % {len(values)} AS INTEGER) + 1)"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

EV = f"""raw_ev AS (
  SELECT event_id AS n, ts, user_id AS uid, event_type AS kind, value, {K} AS k FROM events
), ev0 AS (
  SELECT n AS arrival, n, k, uid, 'evt_' || CAST(n AS VARCHAR) AS event_id,
    CASE kind
      WHEN 'view' THEN CASE WHEN n % 10 = 9 THEN 'MOTION_DETECTED' ELSE 'VIEW_PRODUCT' END
      WHEN 'purchase' THEN 'PURCHASE' WHEN 'error' THEN 'PAYMENT_FAILED'
      WHEN 'click' THEN CASE WHEN n % 4 = 3 THEN 'REMOVE_FROM_CART' ELSE 'ADD_TO_CART' END
      ELSE {at(("SEARCH", "LOGIN", "SEARCH", "PAGE_VIEW", "SEARCH", "GPS_UPDATE", "SOCIAL_POST", "IOT_READING"), "n % 8")}
    END AS event_type,
    ts AS event_ts, ts + to_milliseconds((n % 50 - 2) * 1500) AS ingestion_ts,
    CAST(greatest(0, (n % 50 - 2) * 1500) AS BIGINT) AS latency_ms,
    'USR' || CAST(uid AS VARCHAR) AS user_id,
    'SES_' || CAST(uid AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    {at(C.AGENT_PROFILES, "uid")} AS agent_profile,
    {at(C.SOURCES, "n")} AS source,
    'Ciudad ' || CAST(uid % 12 AS VARCHAR) AS city,
    {at(REGION_KEYS, "uid")} AS region,
    {at(C.SCENARIOS, "n")} AS scenario,
    CAST(value AS DECIMAL(18,2)) AS amount
  FROM raw_ev
), ev AS (
  SELECT *,
    CASE WHEN event_type IN ('VIEW_PRODUCT','ADD_TO_CART','REMOVE_FROM_CART','SOCIAL_POST') THEN 'P' || lpad(CAST(k AS VARCHAR), 3, '0') END AS product_id,
    CASE WHEN event_type IN ('VIEW_PRODUCT','ADD_TO_CART') THEN 'Producto ' || CAST(k AS VARCHAR) || ' v' || CAST(n % 3 AS VARCHAR) END AS product_name,
    CASE WHEN event_type IN ('VIEW_PRODUCT','ADD_TO_CART') THEN {at(CATEGORY_KEYS, "k")} END AS category,
    CASE WHEN event_type IN ('VIEW_PRODUCT','PAGE_VIEW') THEN n % 9000 END AS dwell_time_ms,
    CASE WHEN event_type IN ('ADD_TO_CART','REMOVE_FROM_CART','PURCHASE','PAYMENT_FAILED') THEN 'C' || CAST(uid AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) END AS cart_id,
    CASE WHEN event_type IN ('PURCHASE','PAYMENT_FAILED') THEN 'ORD' || CAST(n AS VARCHAR) END AS order_id,
    CASE WHEN event_type IN ('PURCHASE','PAYMENT_FAILED') THEN amount END AS total_amount,
    CASE WHEN event_type IN ('ADD_TO_CART','REMOVE_FROM_CART') THEN CAST(amount * 3 AS DECIMAL(18,2)) END AS cart_value_after,
    date_trunc('day', ts) AS w
  FROM (SELECT *, event_ts AS ts FROM ev0)
), items AS (
  SELECT event_id, order_id, n AS arrival, event_ts, w, scenario, i,
    'P' || lpad(CAST((k + i * 7) % 100 AS VARCHAR), 3, '0') AS product_id,
    'Producto ' || CAST((k + i * 7) % 100 AS VARCHAR) AS product_name,
    {at(CATEGORY_KEYS, "(k + i * 7) % 100")} AS category,
    CAST(1 + (n + i) % 4 AS BIGINT) AS quantity,
    CAST((1 + (n + i) % 4) * (10 + (k + i * 7) % 100) AS DECIMAL(18,2)) AS subtotal
  FROM (SELECT *, unnest(range(0, n % 3 + 1)) AS i FROM ev WHERE event_type = 'PURCHASE')
)"""


def q(sql: str) -> str:
    """A query over the mapped events."""
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {EV}, {sql[5:]}"
    return f"WITH {EV} {sql}"
