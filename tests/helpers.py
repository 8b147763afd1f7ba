"""Small event tables for tests."""

from datetime import datetime, timedelta

from tidemark import contract as C

T0 = datetime(2026, 7, 25, 12, 0, 0)
SCHEMA = (
    "arrival bigint, event_id string, event_type string, event_ts timestamp_ntz, user_id string, agent_profile string, source string, "
    f"region string, scenario string, latency_ms bigint, payload {C.PAYLOAD_DDL}"
)
FIELDS = [part.split(":")[0].strip() for part in C.PAYLOAD_DDL[7:-1].replace(C.ITEM_DDL, "ITEM").split(", ")]


def event(kind, user="USR1", sec=0.0, *, source="WEB", profile="CLIENTE_FRECUENTE", region="LIMA", scenario="BASE", latency=0, **payload):
    """One event; payload values by field name."""
    return dict(kind=kind, user=user, sec=sec, source=source, profile=profile, region=region, scenario=scenario, latency=latency, payload=payload)


def table(spark, events):
    from decimal import Decimal

    def fix(v):
        return Decimal(str(v)) if isinstance(v, float) else v

    rows = []
    for i, e in enumerate(events):
        p = {k: fix(v) for k, v in e["payload"].items()}
        if "items" in p:
            p["items"] = [tuple(fix(x) for x in item) for item in p["items"]]
        rows.append(
            (i, f"evt_{i}", e["kind"], T0 + timedelta(seconds=e["sec"]), e["user"], e["profile"], e["source"], e["region"], e["scenario"],
             e["latency"], tuple(p.get(f) for f in FIELDS))
        )
    return spark.createDataFrame(rows, SCHEMA)


def buy(amount, user="USR1", sec=0.0, **more):
    return event("PURCHASE", user, sec, total_amount=float(amount), **more)
