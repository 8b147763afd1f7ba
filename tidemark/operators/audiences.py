"""Rule-based audiences per user.

A user's history is the last 500 events by arrival (a limit of the feature itself), so
after `user_history` every group is bounded and the rest of the plan stays on one
partitioning by user: reference time, cart order, facts and rules share one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import AudienceLimits
from tidemark.functions.expr import micros
from tidemark.functions.skew import top_rows

SECOND = 1_000_000  # microseconds

EVENT_COLUMNS = ("user_id", "event_type", "event_ts", "arrival", "source", "agent_profile")


@dataclass(frozen=True)
class Rule:
    """One audience: aggregates over the user's history, a predicate and its outputs.

    `facts` maps fact names to aggregate expressions over prepared history rows;
    `qualifies`, `confidence`, `evidence` and `expires_sec` are built from those facts.
    """

    name: str
    facts: Mapping[str, Callable[[AudienceLimits], Column]]
    qualifies: Callable[[AudienceLimits], Column]
    confidence: Callable[[AudienceLimits], Column]
    evidence: Mapping[str, Callable[[AudienceLimits], Column]] = field(default_factory=dict)
    expires_sec: Callable[[AudienceLimits], int] | None = None


def kind(name: str) -> Column:
    return F.col("event_type") == name


def within(seconds: int) -> Column:
    """Inclusive look-back from the user's reference time."""
    return F.col("us") >= F.col("now_us") - F.lit(seconds * SECOND)


def recent(condition: Column, seconds: int) -> Column:
    return F.count_if(condition & within(seconds))


DEFAULT_RULES = (
    Rule(
        "COMPRADOR_COMPULSIVO",
        {"purchases_in_window": lambda c: recent(kind("PURCHASE"), c.compulsive_sec)},
        lambda c: F.col("purchases_in_window") >= c.compulsive_purchases,
        lambda c: F.least(F.lit(1.0), F.lit(0.7) + F.lit(0.1) * F.col("purchases_in_window")),
        {
            "purchases_in_window": lambda c: F.col("purchases_in_window"),
            "threshold": lambda c: F.lit(c.compulsive_purchases),
        },
        lambda c: c.compulsive_sec,
    ),
    Rule(
        "COMPARADOR_ACTIVO",
        {
            "distinct_products_viewed": lambda c: F.size(
                F.collect_set(
                    F.when(
                        kind("VIEW_PRODUCT") & within(c.comparer_sec) & (F.length("product_id") > 0),
                        F.col("product_id"),
                    )
                )
            ).cast("bigint"),
            "searches": lambda c: recent(kind("SEARCH"), c.comparer_sec),
            "cart_events_in_window": lambda c: recent(kind("ADD_TO_CART"), c.comparer_sec),
            "comparer_purchases": lambda c: recent(kind("PURCHASE"), c.comparer_sec),
            "comparer_profile": lambda c: F.coalesce(
                F.bool_or(F.col("agent_profile") == "COMPARADOR"), F.lit(False)
            ),
        },
        lambda c: (
            (F.col("distinct_products_viewed") >= c.comparer_views) & (F.col("comparer_purchases") == 0)
        )
        | (
            F.col("comparer_profile")
            & (F.greatest("distinct_products_viewed", "searches") >= max(2, c.comparer_views - 2))
        ),
        lambda c: F.lit(0.85),
        {
            "distinct_products_viewed": lambda c: F.col("distinct_products_viewed"),
            "searches": lambda c: F.col("searches"),
            "cart_events_in_window": lambda c: F.col("cart_events_in_window"),
            "threshold": lambda c: F.lit(c.comparer_views),
            "profile_match": lambda c: F.col("comparer_profile"),
        },
        lambda c: c.comparer_sec,
    ),
    Rule(
        "CARRITO_ABANDONADO",
        {
            "abandoned_carts": lambda c: F.sort_array(
                F.collect_list(
                    F.when(
                        F.col("live_add") & (F.col("us") <= F.col("now_us") - F.lit(c.cart_timeout_sec * SECOND)),
                        F.col("cart_id"),
                    )
                )
            )
        },
        lambda c: F.size("abandoned_carts") > 0,
        lambda c: F.lit(0.9),
        {
            "abandoned_carts": lambda c: F.col("abandoned_carts"),
            "timeout_seconds": lambda c: F.lit(c.cart_timeout_sec),
        },
    ),
    Rule(
        "COMPRADOR_NOCTURNO",
        {
            "night_events_count": lambda c: F.count_if(
                (F.hour("local_ts") >= c.night_start_hour) | (F.hour("local_ts") < c.night_end_hour)
            )
        },
        lambda c: F.col("night_events_count") >= c.night_events,
        lambda c: F.lit(0.8),
        {
            "night_events_count": lambda c: F.col("night_events_count"),
            "threshold": lambda c: F.lit(c.night_events),
        },
    ),
    Rule(
        "USUARIO_ALTO_VALOR",
        {
            "total_spent": lambda c: F.coalesce(
                F.sum(F.when(kind("PURCHASE") & within(c.high_value_sec), F.col("total_amount"))), F.lit(0)
            ).cast("double")
        },
        lambda c: F.col("total_spent") >= c.high_value_amount,
        lambda c: F.lit(0.95),
        {
            "total_spent_pen": lambda c: F.round("total_spent", 2),
            "threshold_pen": lambda c: F.lit(c.high_value_amount),
        },
    ),
    Rule(
        "NAVEGADOR_INDECISO",
        {
            "add_remove_cycles": lambda c: F.count_if(
                kind("REMOVE_FROM_CART") & within(c.undecided_sec) & (F.col("previous_cart_event") == "ADD_TO_CART")
            ),
            "add_to_cart_events": lambda c: recent(kind("ADD_TO_CART"), c.undecided_sec),
            "remove_from_cart_events": lambda c: recent(kind("REMOVE_FROM_CART"), c.undecided_sec),
            "undecided_profile": lambda c: F.coalesce(
                F.bool_or(F.col("agent_profile") == "CLIENTE_INDECISO"), F.lit(False)
            ),
        },
        lambda c: (F.col("add_remove_cycles") >= c.undecided_cycles)
        | (
            F.col("undecided_profile")
            & (F.col("add_to_cart_events") >= 1)
            & (F.col("remove_from_cart_events") >= 1)
            & (F.col("add_remove_cycles") >= max(1, c.undecided_cycles - 2))
        ),
        lambda c: F.lit(0.85),
        {
            "add_remove_cycles": lambda c: F.col("add_remove_cycles"),
            "add_to_cart_events": lambda c: F.col("add_to_cart_events"),
            "remove_from_cart_events": lambda c: F.col("remove_from_cart_events"),
            "threshold": lambda c: F.lit(c.undecided_cycles),
            "profile_match": lambda c: F.col("undecided_profile"),
        },
    ),
    Rule(
        "USUARIO_MULTI_DISPOSITIVO",
        {
            "sources_used": lambda c: F.sort_array(
                F.collect_set(F.when(within(c.multi_device_sec) & (F.length("source") > 0), F.col("source")))
            )
        },
        lambda c: F.size("sources_used") >= c.multi_device_sources,
        lambda c: F.lit(0.9),
        {
            "sources_used": lambda c: F.col("sources_used"),
            "threshold": lambda c: F.lit(c.multi_device_sources),
        },
    ),
)


class RuleBook:
    """Pluggable rules by name; a later registration replaces an earlier one."""

    def __init__(self, rules=DEFAULT_RULES):
        self.rules: dict[str, Rule] = {}
        for rule in rules:
            self.register(rule)

    def register(self, rule: Rule) -> "RuleBook":
        self.rules[rule.name] = rule
        return self

    def unregister(self, name: str) -> "RuleBook":
        self.rules.pop(name, None)
        return self

    def only(self, *names: str) -> "RuleBook":
        return RuleBook([self.rules[n] for n in names])


def history_columns(events: DataFrame) -> DataFrame:
    """The columns the rules read, so nothing else reaches the shuffle."""
    return events.select(
        *EVENT_COLUMNS,
        F.col("payload.product_id").alias("product_id"),
        F.col("payload.cart_id").alias("cart_id"),
        F.col("payload.total_amount").alias("total_amount"),
    )


def user_history(events: DataFrame, rows: int = 500) -> DataFrame:
    """Last `rows` events of every user by arrival, hot users split on the way."""
    slim = events if "cart_id" in events.columns else history_columns(events)
    return top_rows(slim, ["user_id"], [F.desc("arrival")], rows)


def prepare_history(history: DataFrame, limits: AudienceLimits, tz: str = "UTC") -> DataFrame:
    """Per-row facts that need the user's other rows (all bounded, one partitioning)."""
    user = Window.partitionBy("user_id")
    cart = Window.partitionBy("user_id", "cart_id")
    in_order = Window.partitionBy("user_id").orderBy("us", "arrival").rowsBetween(Window.unboundedPreceding, -1)
    is_cart_edit = kind("ADD_TO_CART") | kind("REMOVE_FROM_CART")
    local = F.col("event_ts") if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col("event_ts"))
    has_cart = F.length("cart_id") > 0
    last_add = F.max(F.when(kind("ADD_TO_CART") & has_cart, F.col("arrival"))).over(cart)
    bought = F.max(F.when(kind("PURCHASE") & has_cart, F.lit(True))).over(cart)
    return (
        history.withColumn("us", micros("event_ts"))
        .withColumn("local_ts", local)
        .withColumn("now_us", F.max("us").over(user))
        .withColumn("now", F.max("event_ts").over(user))
        .withColumn(
            "live_add",
            F.coalesce((F.col("arrival") == last_add) & bought.isNull(), F.lit(False)),
        )
        .withColumn(
            "previous_cart_event",
            F.last(F.when(is_cart_edit & within(limits.undecided_sec), F.col("event_type")), ignorenulls=True).over(in_order),
        )
    )


def audience_facts(
    history: DataFrame, limits: AudienceLimits, book: RuleBook, tz: str = "UTC", extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per user with the facts of all rules, and `extra` aggregates."""
    facts = {name: build for rule in book.rules.values() for name, build in rule.facts.items()}
    return prepare_history(history, limits, tz).groupBy("user_id").agg(
        F.max("now").alias("detected_at"), *[build(limits).alias(name) for name, build in facts.items()],
        *[col.alias(name) for name, col in (extra or {}).items()],
    )


def apply_rules(
    facts: DataFrame, limits: AudienceLimits, book: RuleBook, *, flat_evidence: bool = False, action: Column | None = None
) -> DataFrame:
    """Zero to many audience rows per user."""
    action = F.lit("ADDED") if action is None else action
    hits = []
    for rule in book.rules.values():
        expires = (
            F.timestamp_add("SECOND", F.lit(rule.expires_sec(limits)), F.col("detected_at"))
            if rule.expires_sec
            else F.lit(None).cast("timestamp_ntz")
        )
        evidence = F.struct(*[build(limits).alias(n) for n, build in rule.evidence.items()])
        hits.append(
            F.when(
                rule.qualifies(limits),
                F.struct(
                    F.lit(rule.name).alias("audience_type"),
                    action.alias("action"),
                    rule.confidence(limits).cast("double").alias("confidence"),
                    (F.lit(None).cast("string") if flat_evidence else F.to_json(evidence)).alias("evidence"),
                    expires.alias("expires_at"),
                ),
            )
        )
    out = facts.withColumn("hit", F.explode(F.array_compact(F.array(*hits))))
    cols = ["user_id", "hit.audience_type", "hit.action", "hit.confidence", "detected_at", "hit.expires_at"]
    if not flat_evidence:
        return out.select(*cols, "hit.evidence")
    names = {n: b for rule in book.rules.values() for n, b in rule.evidence.items()}
    return out.select(*cols, *[b(limits).alias(n) for n, b in names.items()])


def classify_audiences(
    events: DataFrame,
    *,
    limits: AudienceLimits = AudienceLimits(),
    book: RuleBook | None = None,
    tz: str = "UTC",
    active: DataFrame | None = None,
    flat_evidence: bool = False,
) -> DataFrame:
    """All rules over every user's recent history; `active` restricts to some users."""
    book = book or RuleBook()
    if active is not None:  # before the history's shuffle
        events = history_columns(events).join(active.select("user_id").distinct(), "user_id", "left_semi")
    history = user_history(events, limits.history_rows)
    return apply_rules(audience_facts(history, limits, book, tz), limits, book, flat_evidence=flat_evidence)


def single_audience(name: str, events: DataFrame, limits: AudienceLimits, tz: str = "UTC") -> DataFrame:
    return classify_audiences(events, limits=limits, book=RuleBook().only(name), tz=tz, flat_evidence=True)


def aud_compulsive(events, limits=AudienceLimits()):
    return single_audience("COMPRADOR_COMPULSIVO", events, limits)


def aud_comparer(events, limits=AudienceLimits()):
    return single_audience("COMPARADOR_ACTIVO", events, limits)


def aud_abandoned_cart(events, limits=AudienceLimits()):
    return single_audience("CARRITO_ABANDONADO", events, limits)


def aud_night_buyer(events, limits=AudienceLimits(), tz="UTC"):
    return single_audience("COMPRADOR_NOCTURNO", events, limits, tz)


def aud_high_value(events, limits=AudienceLimits()):
    return single_audience("USUARIO_ALTO_VALOR", events, limits)


def aud_undecided(events, limits=AudienceLimits()):
    return single_audience("NAVEGADOR_INDECISO", events, limits)


def aud_multi_device(events, limits=AudienceLimits()):
    return single_audience("USUARIO_MULTI_DISPOSITIVO", events, limits)


def audience_changes(current: DataFrame, previous: DataFrame, as_of: Column) -> DataFrame:
    """Membership changes between two evaluations: ADDED, UPDATED, REMOVED.

    A row of either side whose expiry has passed counts as gone; a user still in the
    audience with another confidence or detection time is UPDATED.
    """
    keys = ["user_id", "audience_type"]
    valid = current.filter(F.col("expires_at").isNull() | (F.col("expires_at") > as_of)) if "expires_at" in current.columns else current
    now = valid.select(*keys, F.col("confidence").alias("c"), F.col("detected_at").alias("d"), F.lit(1).alias("in_now"))
    before = previous.select(
        *keys,
        F.col("confidence").alias("pc"),
        F.col("detected_at").alias("pd"),
        (F.col("expires_at").isNull() | (F.col("expires_at") > as_of)).alias("alive"),
    )
    joined = now.join(before, keys, "full_outer")
    here, there = F.col("in_now").isNotNull(), F.coalesce("alive", F.lit(False))
    was_listed = F.col("alive").isNotNull()
    action = (
        F.when(here & ~there, "ADDED")
        .when(~here & was_listed, "REMOVED")
        .when(here & there & ((F.col("c") != F.col("pc")) | (F.col("d") != F.col("pd"))), "UPDATED")
    )
    return joined.select(
        *keys, action.alias("action"), F.coalesce("c", "pc").alias("confidence"), F.coalesce("d", "pd").alias("detected_at")
    ).filter(F.col("action").isNotNull())
