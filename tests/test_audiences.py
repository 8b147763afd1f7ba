import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, buy, event, table
from tidemark.contract import AudienceLimits
from tidemark.operators import asof
from tidemark.operators import audiences as au

HOUR = 3600


def found(spark, events, limits=AudienceLimits()):
    return {(r.user_id, r.audience_type) for r in au.classify_audiences(table(spark, events), limits=limits).collect()}


def views(n, **kw):
    return [event("VIEW_PRODUCT", product_id=f"P{i}", **kw) for i in range(n)]


def cycles(n, start=0, **kw):
    out = []
    for i in range(n):
        out += [event("ADD_TO_CART", sec=start + 2 * i, cart_id="C1", **kw), event("REMOVE_FROM_CART", sec=start + 2 * i + 1, cart_id="C1", **kw)]
    return out


CASES = {
    "COMPRADOR_COMPULSIVO": (
        [buy(100.0), buy(150.0), buy(200.0)],
        [buy(100.0), buy(150.0, sec=601), buy(200.0, sec=601)],
    ),
    "COMPARADOR_ACTIVO": (views(5), views(5) + [buy(1.0)]),
    "CARRITO_ABANDONADO": (
        [event("ADD_TO_CART", cart_id="C1"), event("SEARCH", sec=900)],
        [event("ADD_TO_CART", cart_id="C1"), event("SEARCH", sec=899)],
    ),
    "COMPRADOR_NOCTURNO": (
        [event("SEARCH", sec=10 * HOUR), event("SEARCH", sec=17.9 * HOUR), event("SEARCH", sec=11 * HOUR)],
        [event("SEARCH", sec=9.99 * HOUR), event("SEARCH", sec=18 * HOUR), event("SEARCH", sec=11 * HOUR)],
    ),
    "USUARIO_ALTO_VALOR": ([buy(600.0), buy(400.0, sec=HOUR)], [buy(600.0), buy(400.0, sec=HOUR + 1)]),
    "NAVEGADOR_INDECISO": (cycles(3), cycles(2)),
    "USUARIO_MULTI_DISPOSITIVO": (
        [event("PAGE_VIEW", source="WEB"), event("PAGE_VIEW", source="MOBILE")],
        [event("PAGE_VIEW", source="WEB"), event("PAGE_VIEW", source="MOBILE", sec=HOUR + 1)],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_threshold_and_just_below(spark, name):
    hit, miss = CASES[name]
    both = [dict(e, user="HIT") for e in hit] + [dict(e, user="MISS") for e in miss]
    got = {u for u, a in found(spark, both) if a == name}
    assert got == {"HIT"}


def test_profile_shortcuts(spark):
    events = (
        [event("SEARCH", "S", profile="COMPARADOR") for _ in range(3)]
        + [dict(e, user="I", profile="CLIENTE_INDECISO") for e in cycles(1)]
        + [dict(e, user="N") for e in cycles(1)]
    )
    got = found(spark, events)
    assert ("S", "COMPARADOR_ACTIVO") in got and ("I", "NAVEGADOR_INDECISO") in got and ("N", "NAVEGADOR_INDECISO") not in got


def test_a_purchase_before_or_after_saves_the_cart(spark):
    cart = dict(cart_id="C1")
    got = found(
        spark,
        [buy(1.0, "A", **cart), event("ADD_TO_CART", "A", 1, **cart), event("SEARCH", "A", 2000)]
        + [event("ADD_TO_CART", "B", 0, **cart), event("ADD_TO_CART", "B", 1500, **cart), event("SEARCH", "B", 2000)],
    )
    assert not {u for u, a in got if a == "CARRITO_ABANDONADO"}


def test_rules_can_be_added_and_removed(spark):
    rule = au.Rule(
        "BUSCADOR", {"n_searches": lambda c: au.F.count_if(au.kind("SEARCH"))}, lambda c: au.F.col("n_searches") >= 1, lambda c: au.F.lit(0.5)
    )
    book = au.RuleBook().unregister("USUARIO_MULTI_DISPOSITIVO").register(rule)
    events = table(spark, [event("SEARCH"), event("SEARCH", source="POS")])
    rows = au.classify_audiences(events, book=book).collect()
    assert [r.audience_type for r in rows] == ["BUSCADOR"]


def brute(history, c):
    """The facts of one history (list of (kind, sec, source, product, cart, amount)), oldest first."""
    now = history[-1][1]
    recent = lambda s: [h for h in history if h[1] >= now - s]
    carts, bought = {}, set()
    for k, t, _, _, cart, _ in history:
        if k == "ADD_TO_CART":
            carts[cart] = t
        if k == "PURCHASE":
            bought.add(cart)
    out = set()
    if sum(h[0] == "PURCHASE" for h in recent(c.compulsive_sec)) >= c.compulsive_purchases:
        out.add("COMPRADOR_COMPULSIVO")
    seen = {h[3] for h in recent(c.comparer_sec) if h[0] == "VIEW_PRODUCT"}
    if len(seen) >= c.comparer_views and not any(h[0] == "PURCHASE" for h in recent(c.comparer_sec)):
        out.add("COMPARADOR_ACTIVO")
    if any(cart not in bought and now - t >= c.cart_timeout_sec for cart, t in carts.items()):
        out.add("CARRITO_ABANDONADO")
    hours = [(T0 + timedelta(seconds=h[1])).hour for h in history]
    if sum(h >= 22 or h < 6 for h in hours) >= c.night_events:
        out.add("COMPRADOR_NOCTURNO")
    if sum(h[5] for h in recent(c.high_value_sec) if h[0] == "PURCHASE") >= c.high_value_amount:
        out.add("USUARIO_ALTO_VALOR")
    n, inside = 0, False
    for h in recent(c.undecided_sec):
        if h[0] == "ADD_TO_CART":
            inside = True
        elif h[0] == "REMOVE_FROM_CART":
            n += inside
            inside = False
    if n >= c.undecided_cycles:
        out.add("NAVEGADOR_INDECISO")
    if len({h[2] for h in recent(c.multi_device_sec)}) >= c.multi_device_sources:
        out.add("USUARIO_MULTI_DISPOSITIVO")
    return out


def test_point_in_time_matches_a_replay_with_a_small_history_cap(spark):
    """A hot user far over the cap, evaluated every 10 minutes."""
    rnd = random.Random(7)
    c = AudienceLimits(
        compulsive_purchases=2, comparer_views=3, night_events=3, high_value_amount=150.0, undecided_cycles=2,
        multi_device_sources=3, multi_device_sec=900, history_rows=8, cart_timeout_sec=600,
    )
    kinds = ["VIEW_PRODUCT", "ADD_TO_CART", "REMOVE_FROM_CART", "PURCHASE", "SEARCH"]
    rows, t = [], {"HOT": 0.0, "COLD": 0.0}
    for _ in range(300):
        user = "HOT" if rnd.random() < 0.8 else "COLD"
        t[user] += rnd.choice([1, 30, 200, 700, 3000])
        rows.append((user, rnd.choice(kinds), t[user], rnd.choice("ABCD"), f"P{rnd.randrange(5)}", f"C{rnd.randrange(3)}", rnd.randrange(10, 90)))
    rows.sort(key=lambda r: r[2])
    events = [
        event(k, u, s, source=src, product_id=p, cart_id=cart, total_amount=float(a)) for u, k, s, src, p, cart, a in rows
    ]
    want = set()
    for user in t:
        mine = [(k, s, src, p, cart, a) for u, k, s, src, p, cart, a in rows if u == user]
        for i, h in enumerate(mine):
            if i + 1 == len(mine) or int(mine[i + 1][1] // 600) != int(h[1] // 600):
                for name in brute(mine[max(0, i - 7): i + 1], c):
                    want.add((user, name, T0 + timedelta(seconds=h[1])))
    got = asof.classify_as_of(table(spark, events), step="10 minutes", limits=c).collect()
    assert {(r.user_id, r.audience_type, r.detected_at) for r in got} == want and len(want) > 100


def test_changes_leave_out_rows_expired_on_either_side(spark):
    from datetime import datetime

    schema = "user_id string, audience_type string, confidence double, detected_at timestamp_ntz, expires_at timestamp_ntz"
    t = lambda h: datetime(2026, 1, 1, h)
    old = [("a", "X", 1.0, t(1), None), ("b", "X", 1.0, t(1), t(20)), ("c", "X", 1.0, t(1), t(3)), ("d", "X", 1.0, t(1), t(20)), ("e", "X", 1.0, t(1), t(20))]
    new = [("a", "X", 1.0, t(1), None), ("b", "X", 0.5, t(2), t(21)), ("c", "X", 1.0, t(4), t(22)), ("d", "X", 1.0, t(4), t(5)), ("f", "X", 1.0, t(4), t(5)), ("g", "X", 1.0, t(4), t(22))]
    rows = au.audience_changes(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), F.lit(t(10)).cast("timestamp_ntz")).collect()
    assert {(r.user_id, r.action) for r in rows} == {("b", "UPDATED"), ("c", "ADDED"), ("d", "REMOVED"), ("e", "REMOVED"), ("g", "ADDED")}


def test_only_active_users_are_classified(spark):
    e = table(spark, [buy(2000, "U1", 1), buy(2000, "U2", 2)])
    got = au.classify_audiences(e, active=spark.createDataFrame([("U2",), ("U2",)], "user_id string"))
    assert {r.user_id for r in got.collect()} == {"U2"}


def test_point_in_time_walks_no_frame(spark):
    """Every window is a running sum or one fixed offset, so an event costs the same however full its look-back is."""
    import re

    facts = asof.as_of_facts(table(spark, [event("SEARCH")]), "10 seconds", AudienceLimits())
    frames = re.findall(r"specifiedwindowframe\(\w+, (\S+), (\S+?)\)[ ,)]", facts._jdf.queryExecution().optimizedPlan().toString().lower())
    assert len(frames) > 10 and all(a.startswith("unboundedpreceding") or a == b for a, b in frames)


def test_point_in_time_lists_over_several_blocks(spark):
    """Sources and carts of each event against the last 8 events, where look-backs end inside and outside the block."""
    rnd, t, rows = random.Random(11), 0, []
    c = AudienceLimits(history_rows=8, multi_device_sec=300, cart_timeout_sec=200)
    for _ in range(120):
        t += rnd.choice([1, 40, 100, 400])
        rows.append((t, rnd.choice(["ADD_TO_CART", "PURCHASE", "SEARCH"]), rnd.choice("ABCD"), f"C{rnd.randrange(4)}"))
    got = asof.as_of_facts(table(spark, [event(k, sec=s, source=src, cart_id=cart) for s, k, src, cart in rows]), "1 second", c)
    found = {(r.detected_at - T0).total_seconds(): (r.sources_used, r.abandoned_carts) for r in got.collect()}
    for i, (now, *_) in enumerate(rows):
        last = rows[max(0, i - 7): i + 1]
        added = {cart: s for s, k, _, cart in last if k == "ADD_TO_CART"}
        left = sorted(x for x, s in added.items() if now - s >= 200 and not any(k == "PURCHASE" and cart == x for _, k, _, cart in last))
        assert found[now] == (sorted({src for s, _, src, _ in last if now - s <= 300}), left)
