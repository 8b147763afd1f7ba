"""The event contract: names, enumerations, routes, payload shapes and thresholds.

Everything here is plain data.  Validators, parsers and lookups elsewhere in the
package are generated from these tables, so the contract is stated once.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values of contract version 1.0 ------------------------------------

SCHEMA_VERSION = "1.0"
DEAD_LETTER_TOPIC = "dead-letter"
PARTITION_KEY = "user_id"

EVENT_TYPES = (
    "LOGIN",
    "SEARCH",
    "PAGE_VIEW",
    "VIEW_PRODUCT",
    "ADD_TO_CART",
    "REMOVE_FROM_CART",
    "PURCHASE",
    "PAYMENT_FAILED",
    "GPS_UPDATE",
    "IOT_READING",
    "MOTION_DETECTED",
    "SOCIAL_POST",
)

SOURCES = ("WEB", "MOBILE", "IOT", "VEHICLE", "POS")

AGENT_PROFILES = (
    "COMPRADOR_COMPULSIVO",
    "COMPARADOR",
    "COMPRADOR_NOCTURNO",
    "CLIENTE_PREMIUM",
    "CLIENTE_FRECUENTE",
    "USUARIO_EXPLORADOR",
    "CLIENTE_INDECISO",
    "CLIENTE_ESTACIONAL",
)

SCENARIOS = (
    "BASE",
    "NAVIDAD",
    "CYBER_MONDAY",
    "BLACK_FRIDAY",
    "FIESTAS_PATRIAS",
    "CAMPANA_ESCOLAR",
    "DIA_DEL_PADRE",
)

# The nine fields a raw envelope carries under "event".
SOURCE_FIELDS = (
    "event_type",
    "event_timestamp",
    "user_id",
    "session_id",
    "agent_profile",
    "city",
    "region",
    "scenario",
    "payload",
)

# The thirteen fields of a published event, in the order they are checked.
EVENT_FIELDS = (
    "event_id",
    "schema_version",
    "event_type",
    "event_timestamp",
    "ingestion_timestamp",
    "user_id",
    "session_id",
    "agent_profile",
    "source",
    "city",
    "region",
    "scenario",
    "payload",
)

ENUM_FIELDS = {
    "event_type": EVENT_TYPES,
    "agent_profile": AGENT_PROFILES,
    "source": SOURCES,
    "scenario": SCENARIOS,
}

TIMESTAMP_FIELDS = ("event_timestamp", "ingestion_timestamp")

# Input topics: name -> (partitions, routed event types).
TOPICS = {
    "user-events": (
        4,
        ("LOGIN", "SEARCH", "PAGE_VIEW", "VIEW_PRODUCT", "ADD_TO_CART", "REMOVE_FROM_CART"),
    ),
    "purchase-events": (2, ("PURCHASE", "PAYMENT_FAILED")),
    "iot-events": (2, ("GPS_UPDATE", "IOT_READING", "MOTION_DETECTED")),
    "system-events": (1, ("SOCIAL_POST",)),
    "dead-letter": (1, ()),
}

BUSINESS_TOPICS = tuple(name for name in TOPICS if name != DEAD_LETTER_TOPIC)

METRIC_TOPICS = {
    "throughput": "metrics.throughput",
    "active_users": "metrics.active-users",
    "events_by_type": "metrics.events-by-type",
    "top_products_viewed": "metrics.top-products-viewed",
    "top_products_purchased": "metrics.top-products-purchased",
    "purchases_by_region": "metrics.purchases-by-region",
    "conversion": "metrics.conversion",
    "trends": "metrics.trends",
}
AUDIENCE_TOPIC = "audiences.classifications"
ALERT_TOPIC = "alerts.anomalies"

# Payload fields by event type (all required), as Spark SQL types.
ITEM_FIELDS = {
    "product_id": "STRING",
    "product_name": "STRING",
    "category": "STRING",
    "unit_price": "DECIMAL(18,2)",
    "quantity": "BIGINT",
    "subtotal": "DECIMAL(18,2)",
}
ITEM_DDL = "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in ITEM_FIELDS.items()) + ">"

PAYLOAD_FIELDS = {
    "LOGIN": {"device": "STRING", "is_first_login": "BOOLEAN"},
    "SEARCH": {"query": "STRING", "results_count": "BIGINT", "category_filter": "STRING"},
    "PAGE_VIEW": {"page_type": "STRING", "page_url": "STRING", "dwell_time_ms": "BIGINT"},
    "VIEW_PRODUCT": {
        "product_id": "STRING",
        "product_name": "STRING",
        "category": "STRING",
        "price": "DECIMAL(18,2)",
        "dwell_time_ms": "BIGINT",
    },
    "ADD_TO_CART": {
        "cart_id": "STRING",
        "product_id": "STRING",
        "product_name": "STRING",
        "category": "STRING",
        "unit_price": "DECIMAL(18,2)",
        "quantity": "BIGINT",
        "cart_size_after": "BIGINT",
        "cart_value_after": "DECIMAL(18,2)",
    },
    "REMOVE_FROM_CART": {
        "cart_id": "STRING",
        "product_id": "STRING",
        "quantity": "BIGINT",
        "cart_size_after": "BIGINT",
        "cart_value_after": "DECIMAL(18,2)",
    },
    "PURCHASE": {
        "order_id": "STRING",
        "cart_id": "STRING",
        "items": f"ARRAY<{ITEM_DDL}>",
        "items_count": "BIGINT",
        "total_units": "BIGINT",
        "total_amount": "DECIMAL(18,2)",
        "currency": "STRING",
        "payment_method": "STRING",
        "time_to_purchase_ms": "BIGINT",
    },
    "PAYMENT_FAILED": {
        "order_id": "STRING",
        "cart_id": "STRING",
        "total_amount": "DECIMAL(18,2)",
        "payment_method": "STRING",
        "failure_reason": "STRING",
        "retry_count": "BIGINT",
    },
    "GPS_UPDATE": {
        "device_id": "STRING",
        "latitude": "DOUBLE",
        "longitude": "DOUBLE",
        "speed_kmh": "DOUBLE",
    },
    "IOT_READING": {
        "device_id": "STRING",
        "sensor_type": "STRING",
        "value": "DOUBLE",
        "unit": "STRING",
    },
    "MOTION_DETECTED": {"device_id": "STRING", "zone": "STRING", "confidence": "DOUBLE"},
    "SOCIAL_POST": {
        "platform": "STRING",
        "post_type": "STRING",
        "product_id": "STRING",
        "sentiment": "STRING",
    },
}

# Serving lookups.
EVENT_CATEGORY = {
    "LOGIN": "DIGITAL",
    "SEARCH": "DIGITAL",
    "PAGE_VIEW": "DIGITAL",
    "VIEW_PRODUCT": "DIGITAL",
    "ADD_TO_CART": "COMPRAS",
    "REMOVE_FROM_CART": "COMPRAS",
    "PURCHASE": "COMPRAS",
    "PAYMENT_FAILED": "SISTEMA",
    "GPS_UPDATE": "IOT",
    "IOT_READING": "IOT",
    "MOTION_DETECTED": "IOT",
    "SOCIAL_POST": "DIGITAL",
}
DEFAULT_CATEGORY = "SISTEMA"
CATEGORIES = ("DIGITAL", "COMPRAS", "IOT", "SISTEMA")

REGION_LABELS = {
    "LIMA": "Lima",
    "AREQUIPA": "Arequipa",
    "LA_LIBERTAD": "La Libertad",
    "CUSCO": "Cusco",
    "PIURA": "Piura",
    "JUNIN": "Junín",
    "PUNO": "Puno",
    "ICA": "Ica",
    "TACNA": "Tacna",
    "MOQUEGUA": "Moquegua",
}
UNKNOWN_REGION = "DESCONOCIDA"

# audience_type -> (label, priority), in display order.
AUDIENCES = {
    "COMPRADOR_COMPULSIVO": ("Comprador compulsivo", "ALTA"),
    "COMPARADOR_ACTIVO": ("Comparador activo", "MEDIA"),
    "CARRITO_ABANDONADO": ("Carrito abandonado", "ALTA"),
    "COMPRADOR_NOCTURNO": ("Comprador nocturno", "MEDIA"),
    "USUARIO_ALTO_VALOR": ("Usuario alto valor", "ALTA"),
    "NAVEGADOR_INDECISO": ("Navegador indeciso", "MEDIA"),
    "USUARIO_MULTI_DISPOSITIVO": ("Usuario multidispositivo", "BAJA"),
}

ALERT_LEVELS = ("INFO", "WARNING", "CRITICAL")
ALERT_COMPONENT = "Apache Flink"  # component name the alert feed reports

FUNNEL_STAGES = (
    ("VIEW_PRODUCT", "Visualizacion de producto"),
    ("ADD_TO_CART", "Agregado al carrito"),
    ("PURCHASE", "Compra confirmada"),
)

PIPELINE_STAGES = (
    "simuladores",
    "productores",
    "kafka",
    "flink",
    "backend",
    "transporte",
    "dashboard",
)

# --- End of fixed values ------------------------------------------------------


def payload_ddl() -> str:
    """One nullable struct that can hold any of the twelve payloads."""
    merged: dict[str, str] = {}
    for fields in PAYLOAD_FIELDS.values():
        for name, kind in fields.items():
            if merged.setdefault(name, kind) != kind:
                raise ValueError(f"payload field {name} has two types")
    return "STRUCT<" + ", ".join(f"{n}: {t}" for n, t in merged.items()) + ">"


PAYLOAD_DDL = payload_ddl()


# --- Thresholds (defaults; every operator takes its own instance) ------------


@dataclass(frozen=True)
class Windows:
    throughput: str = "10 seconds"
    active_users: str = "60 seconds"
    events_by_type: str = "10 seconds"
    top_products: str = "60 seconds"
    purchases_by_region: str = "60 seconds"
    conversion: str = "60 seconds"
    trends: str = "60 seconds"
    trends_slide: str = "10 seconds"
    lateness: str = "5 seconds"


@dataclass(frozen=True)
class AudienceLimits:
    compulsive_purchases: int = 3
    compulsive_sec: int = 600
    comparer_views: int = 5
    comparer_sec: int = 300
    cart_timeout_sec: int = 900
    night_events: int = 3
    night_start_hour: int = 22
    night_end_hour: int = 6
    high_value_amount: float = 1000.0
    high_value_sec: int = 3600
    undecided_cycles: int = 3
    undecided_sec: int = 1800
    multi_device_sources: int = 2
    multi_device_sec: int = 3600
    history_rows: int = 500


@dataclass(frozen=True)
class AlertLimits:
    spike_multiplier: float = 3.0
    spike_min_events: int = 20
    drop_multiplier: float = 0.2
    drop_min_baseline: float = 10.0
    payment_fail_pct: float = 20.0
    payment_min_attempts: int = 5
    high_cart: float = 5000.0
    high_latency_ms: float = 30000.0
    critical_payment: float = 1800.0
    search_min: int = 35
    cart_activity_min: int = 22
    baseline_alpha: float = 0.1
    baseline_init: float = 50.0
    duration_sec: float | None = None  # what rates are divided by; None: the window's length, ten seconds without one
