"""Point-in-time audiences: the rules evaluated in every window a user is active in.

At each evaluation the history is the user's last 500 events so far.  A user's
timeline is cut into blocks of 1,500 events and each block also receives the 500 events
before it, so every group has at most 2,001 rows: a user with a third of all events
becomes many independent groups.

No frame is walked: an event counts from its own place until it leaves the look-back, so
a fact is one running sum of what came in less what went out.  Leaving by time is a
marker row placed where the look-back ends; leaving by the cap is the same sum 500 rows
earlier.  Lists (carts, sources) are read from the spans in which their items count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import AudienceLimits
from tidemark.functions.expr import micros, seconds_of
from tidemark.functions.skew import with_position
from tidemark.operators.audiences import SECOND, RuleBook, apply_rules, history_columns, kind

#: Own events of a group, in histories; with the look-back a group stays below what a window keeps in memory.
HISTORIES = 3
#: Place of events without a time: before all others.
NO_TIME = -(1 << 61)
GROUP = ("user_id", "g")


def classify_as_of(
    events: DataFrame,
    *,
    step: str = "10 seconds",
    limits: AudienceLimits = AudienceLimits(),
    book: RuleBook | None = None,
    segment: str = "1 hour",
) -> DataFrame:
    """Audience rows for every (user, window) with activity, as of the window's end.

    Only the built-in facts are available here; a custom rule must be built on them.
    """
    facts = as_of_facts(events, step, limits, segment)
    return apply_rules(facts, limits, book or RuleBook())


def as_of_facts(events: DataFrame, step: str, limits: AudienceLimits, segment: str = "1 hour") -> DataFrame:
    rows = with_position(history_columns(events), ["user_id"], "event_ts", ["arrival"], segment=seconds_of(segment))
    linked = _linked(_grouped(rows, limits.history_rows), step, limits)
    return _with_lists(_counted(linked, limits), limits)


def _grouped(rows: DataFrame, cap: int) -> DataFrame:
    """Every event in its block's group, as look-back in the next one, and the first one as the close of the one before."""
    size = HISTORIES * cap
    block, none = F.floor(F.col("pos") / size), F.array().cast("array<bigint>")
    look_back = F.when(F.col("pos") % size >= size - cap, F.array(block + 1)).otherwise(none)
    closing = F.when(F.col("pos") % size == 0, F.array(block - 1)).otherwise(none)
    spread = rows.withColumn("g", F.explode(F.concat(F.array(block), look_back, closing)))
    # A fixed number: rows get ten times wider in the group, so tasks merged by shuffled size would be too large.
    spread = spread.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *GROUP)
    return spread.withColumn("own", block == F.col("g")).withColumn("us", F.coalesce(micros("event_ts"), F.lit(NO_TIME)))


def _linked(spread: DataFrame, step: str, c: AudienceLimits) -> DataFrame:
    """Flags of each event and its neighbours of the same kind: edits, product, source, cart."""
    cap, ordered = c.history_rows, Window.partitionBy(*GROUP).orderBy("pos")
    among = lambda key: Window.partitionBy(*GROUP, key).orderBy("pos")
    here = F.struct("us", "pos", "event_type")
    one = lambda condition: F.when(condition, 1).otherwise(0)
    add, buy, remove = kind("ADD_TO_CART"), kind("PURCHASE"), kind("REMOVE_FROM_CART")
    night = (F.hour("event_ts") >= c.night_start_hour) | (F.hour("event_ts") < c.night_end_hour)
    w = F.floor(micros("event_ts") / F.lit(seconds_of(step) * SECOND))
    rows = spread.select(
        *GROUP, "own", "event_ts", "us", "pos", "event_type", w.alias("w"),
        one(buy).alias("buy"), one(add).alias("add"), one(remove).alias("remove"), one(kind("SEARCH")).alias("search"), one(night).alias("night"),
        one(F.col("agent_profile") == "COMPARADOR").alias("is_comparer"), one(F.col("agent_profile") == "CLIENTE_INDECISO").alias("is_undecided"),
        F.when(buy, F.col("total_amount")).alias("amount"), F.when(F.length("cart_id") > 0, F.col("cart_id")).alias("cart_key"),
        F.when(kind("VIEW_PRODUCT") & (F.length("product_id") > 0), F.col("product_id")).alias("viewed"),
        F.when(F.length("source") > 0, F.col("source")).alias("source"), F.coalesce(add | remove, F.lit(False)).alias("is_edit"),
    )
    near = lambda a, b, sec: (b["pos"] - a["pos"] < cap) & (b["us"] - a["us"] <= sec * SECOND)
    not_near = lambda a, b: ~F.coalesce(near(a, b, c.multi_device_sec), F.lit(False))
    cart_before = among("cart_key").rowsBetween(Window.unboundedPreceding, -1)
    cart_after = Window.partitionBy(*GROUP, "cart_key").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("is_eval", F.col("own") & ~F.coalesce(F.lead("w").over(ordered) == F.col("w"), F.lit(False)))
        .withColumn("end_us", F.max("us").over(Window.partitionBy(*GROUP)))
        .withColumns({"edit_before": F.lag(here).over(among("is_edit")), "edit_after": F.lead(here).over(among("is_edit"))})
        .withColumns({"view_before": F.lag(here).over(among("viewed")), "view_after": F.lead(here).over(among("viewed"))})
        # Occurrences of a source that reach one another are one span; it is kept at its last one.
        .withColumns({"source_before": F.lag(here).over(among("source")), "source_after": F.lead(here).over(among("source"))})
        .withColumn("source_from", F.last(F.when(not_near(F.col("source_before"), here), F.struct("pos", "us")), ignorenulls=True).over(among("source")))
        .withColumn("source_ends", F.col("source").isNotNull() & not_near(here, F.col("source_after")))
        # The last purchase before a cart add, and the next event that ends it.
        .withColumn("bought_at", F.last(F.when(F.col("buy") == 1, F.col("pos")), ignorenulls=True).over(cart_before))
        .withColumn("closed_at", F.last(F.when((F.col("buy") == 1) | (F.col("add") == 1), F.col("pos")), ignorenulls=True).over(cart_after))
    )


def _measures(near: Callable[[Column, Column], Column]) -> dict[str, tuple[Column, Column]]:
    """What an event adds to a fact when it comes in, and what it takes away when it leaves.

    `near` tells whether two events can be in one look-back.  A product counts from a view
    without another one before it, until its last view leaves; a cycle counts while its add is inside.
    """
    here = F.struct("us", "pos")
    yes = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    seen, edit = F.col("viewed").isNotNull(), F.col("is_edit")
    before, after = near(F.col("view_before"), here), near(here, F.col("view_after"))
    is_cycle = lambda a, b: (a == "ADD_TO_CART") & (b == "REMOVE_FROM_CART")
    opened = edit & is_cycle(F.col("edit_before.event_type"), F.col("event_type")) & near(F.col("edit_before"), here)
    closed = edit & is_cycle(F.col("event_type"), F.col("edit_after.event_type")) & near(here, F.col("edit_after"))
    each = lambda name: (F.col(name), F.col(name))
    return {
        "purchases_in_window": each("buy"), "searches": each("search"), "cart_events_in_window": each("add"), "comparer_purchases": each("buy"),
        "distinct_products_viewed": (yes(seen & ~F.coalesce(before, F.lit(False))), yes(seen & ~F.coalesce(after, F.lit(False)))),
        "total_spent": each("amount"), "add_remove_cycles": (yes(opened), yes(closed)),
        "add_to_cart_events": each("add"), "remove_from_cart_events": each("remove"),
        "night_events_count": each("night"), "comparer_profile": each("is_comparer"), "undecided_profile": each("is_undecided"),
    }


def _look_backs(c: AudienceLimits) -> list[tuple[int, tuple[str, ...]]]:
    """The facts by time look-back; the others see the whole history."""
    return [
        (c.compulsive_sec, ("purchases_in_window",)),
        (c.comparer_sec, ("distinct_products_viewed", "searches", "cart_events_in_window", "comparer_purchases")),
        (c.high_value_sec, ("total_spent",)),
        (c.undecided_sec, ("add_remove_cycles", "add_to_cart_events", "remove_from_cart_events")),
    ]


def _counted(linked: DataFrame, c: AudienceLimits) -> DataFrame:
    """All events with the facts that are counts or sums, over the shorter of look-back and last `cap` events."""
    cap, ordered = c.history_rows, Window.partitionBy(*GROUP).orderBy("pos")
    by_rows = _measures(lambda a, b: b["pos"] - a["pos"] < cap)
    rows = linked.withColumns({f"in_{n}": F.sum(x).over(ordered) for n, (x, _) in by_rows.items()})
    rows = rows.withColumns({f"out_{n}": F.sum(x).over(ordered) for n, (_, x) in by_rows.items()})
    less = lambda n: F.coalesce(F.col(f"in_{n}"), F.lit(0)) - F.coalesce(F.lag(f"out_{n}", cap).over(ordered), F.lit(0))
    rows = rows.withColumns({f"last_{n}": less(n) for n in by_rows}).drop(*[f"{x}_{n}" for n in by_rows for x in ("in", "out")])

    # Look-back 0 is the event itself; the others are markers of its leaving, where the group goes on that far.
    looks = list(enumerate(_look_backs(c), 1))
    marker = lambda i, sec: F.struct(F.lit(i).alias("look"), (F.col("us") + F.lit(sec * SECOND)).alias("at"))
    all_rows = F.array(F.struct(F.lit(0).alias("look"), F.col("us").alias("at")), *[marker(i, sec) for i, (sec, _) in looks])
    needed = F.filter(all_rows, lambda m: (m["look"] == 0) | (m["at"] < F.col("end_us")))
    rows = rows.withColumn("m", F.explode(needed)).withColumns({"look": F.col("m.look"), "at": F.col("m.at")}).drop("m")
    so_far = Window.partitionBy(*GROUP).orderBy("at", F.col("look") > 0)
    sums = {}
    for i, (sec, names) in looks:
        by_time = _measures(lambda a, b, sec=sec: b["us"] - a["us"] <= sec * SECOND)
        by_time["n"] = (F.lit(1), F.lit(1))
        for n in ("n", *names):
            x, y = by_time[n]
            sums[f"n_{i}" if n == "n" else f"time_{n}"] = F.sum(F.when(F.col("look") == 0, x).when(F.col("look") == i, -y)).over(so_far)
    rows = rows.withColumns(sums).filter(F.col("look") == 0)
    facts = {n: F.col(f"last_{n}") for n in by_rows}
    for i, (_, names) in looks:
        facts |= {n: F.when(F.col(f"n_{i}") >= cap, F.col(f"last_{n}")).otherwise(F.coalesce(f"time_{n}", F.lit(0))) for n in names}
    facts["total_spent"] = facts["total_spent"].cast("double")
    facts |= {n: facts[n] > 0 for n in ("comparer_profile", "undecided_profile")}
    keep = [*linked.columns, F.col("n_1").alias("peers")]
    return rows.select(*keep, *[x.alias(n) for n, x in facts.items()])


def _with_lists(rows: DataFrame, c: AudienceLimits) -> DataFrame:
    """The evaluation rows with the carts left and the sources used.

    Spans meet the evaluations of the same stretch of positions, so an evaluation tries
    the items of about one history only.
    """
    cap, size = c.history_rows, HISTORIES * c.history_rows
    stretch = max(1, cap // 4)
    facts = list(rows.columns[rows.columns.index("purchases_in_window"):])
    evaluation = F.struct("event_ts", "w", "us", "pos", "peers", *facts)
    # An item counts from a place and time on, before one place and up to one time.
    cart = F.struct(
        F.col("cart_key").alias("item"), F.greatest(F.col("pos"), F.col("bought_at") + cap).alias("from"), (F.col("us") + F.lit(c.cart_timeout_sec * SECOND)).alias("since"),
        F.least(F.col("closed_at"), F.col("pos") + cap).alias("before"), F.lit(None).cast("bigint").alias("until"), F.lit("cart").alias("kind"),
    )
    source = F.struct(
        F.col("source").alias("item"), F.col("source_from.pos").alias("from"), F.col("source_from.us").alias("since"),
        (F.col("pos") + cap).alias("before"), (F.col("us") + F.lit(c.multi_device_sec * SECOND)).alias("until"), F.lit("source").alias("kind"),
    )
    is_cart = (F.col("add") == 1) & F.col("cart_key").isNotNull() & F.col("event_ts").isNotNull()
    spans = F.array_compact(F.array(F.when(is_cart, cart), F.when(F.col("source_ends"), source)))
    first, last = F.col("g") * size, (F.col("g") + 1) * size - 1

    def stretches(s: Column) -> Column:
        # Events without a time see one another, whatever their order.
        low = F.when(s["since"] == NO_TIME, first).otherwise(F.greatest(s["from"], first))
        high = F.least(s["before"] - 1, last)
        on = (low <= high) & (s["since"] <= F.col("end_us"))
        numbers = F.sequence(F.floor(low / stretch), F.floor(high / stretch))
        return F.transform(F.when(on, numbers).otherwise(F.array().cast("array<bigint>")), lambda n: F.struct(n.alias("stretch"), s.alias("span")))

    own = F.when(F.col("is_eval"), F.array(F.struct(F.floor(F.col("pos") / stretch).alias("stretch"), F.lit(None).cast(_type(rows, cart)).alias("span"))))
    entries = F.concat(F.coalesce(own, F.array().cast(f"array<struct<stretch:bigint,span:{_type(rows, cart)}>>")), F.flatten(F.transform(spans, stretches)))
    met = (
        rows.withColumn("e", F.explode(entries))
        .groupBy(*GROUP, F.col("e.stretch").alias("stretch"))
        .agg(F.collect_list(F.when(F.col("e.span").isNull(), evaluation)).alias("evals"), F.collect_list("e.span").alias("spans"))
        .select("user_id", "spans", F.explode("evals").alias("e"))
        .select("user_id", "spans", "e.*")
    )

    def items(name: str) -> Column:
        counts = F.filter(
            "spans",
            lambda s: (s["kind"] == name) & (s["since"] <= F.col("us")) & ((s["from"] <= F.col("pos")) | ((F.col("us") == NO_TIME) & (F.col("peers") < cap)))
            & (s["before"] > F.col("pos")) & (s["until"].isNull() | (s["until"] >= F.col("us"))),
        )
        return F.sort_array(F.transform(counts, lambda s: s["item"]))

    return met.select(
        "user_id", F.col("event_ts").alias("detected_at"), "w", *facts, items("cart").alias("abandoned_carts"), items("source").alias("sources_used")
    )


def _type(rows: DataFrame, value: Column) -> str:
    return rows.select(value.alias("x")).schema["x"].dataType.simpleString()
