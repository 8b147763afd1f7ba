from tests.helpers import buy, event, table
from tidemark.operators import metrics as m

ITEM = ("P1", "Laptop", "TECNOLOGIA", 1500.0, 1, 1500.0)


def five(spark):
    return table(
        spark,
        [
            event("VIEW_PRODUCT", product_id="P1", product_name="Vieja", category="A"),
            event("VIEW_PRODUCT", product_id="P2", product_name="Mouse", category="B"),
            event("ADD_TO_CART", product_id="P1", cart_id="C1"),
            buy(1500.0, items=[ITEM]),
            event("VIEW_PRODUCT", "USR2", region="AREQUIPA", product_id="P1", product_name="Laptop", category="A"),
        ],
    )


def test_micro_window_metrics(spark):
    e = five(spark)
    t = m.throughput(e, window=None, duration_sec=10).first()
    assert (t.total_events, t.events_per_second) == (5, 0.5)
    a = m.active_users(e, window=None).first()
    assert (a.active_users_count, a.unique_users_sample) == (2, ["USR1", "USR2"])
    assert {r.event_type: r.events for r in m.events_by_type(e, window=None).collect()} == {
        "VIEW_PRODUCT": 3, "ADD_TO_CART": 1, "PURCHASE": 1,
    }
    top = m.top_viewed_products(e, window=None).collect()
    assert [(r.product_id, r.views, r.position) for r in top] == [("P1", 2, 1), ("P2", 1, 2)]
    assert top[0].product_name == "Laptop"  # the name last seen
    bought = m.top_purchased_products(m.purchased_items(e), window=None).collect()
    assert [(r.product_id, r.units, r.total_revenue) for r in bought] == [("P1", 1, 1500.0)]
    regions = m.purchases_by_region(e, window=None).collect()
    assert [(r.region, r.purchases_count, r.total_amount) for r in regions] == [("LIMA", 1, 1500.0)]
    c = m.conversion(e, window=None).first()
    assert (c.view_to_cart_rate, c.cart_to_purchase_rate, c.overall_conversion_rate) == (33.33, 100.0, 33.33)
    tr = m.trends(e, window=None).first()
    assert (tr.events_count, tr.active_users, tr.purchases_count, tr.total_revenue) == (5, 2, 1, 1500.0)


def test_windows_and_slides(spark):
    e = table(spark, [event("SEARCH", sec=s) for s in (0, 9.999, 10, 59)])
    assert [(r.window_start.second, r.total_events) for r in m.throughput(e).orderBy("window_start").collect()] == [(0, 2), (10, 1), (50, 1)]
    counts = {r.window_start: r.events_count for r in m.trends(e).collect()}
    assert max(counts.values()) == 4 and len(counts) == 11


def test_defaults_and_zero_denominators(spark):
    e = table(spark, [buy(10.0, items=[("P9", None, None, None, None, None)]), event("PURCHASE", region=None)])
    item = m.purchased_items(e).first()
    assert (item.quantity, float(item.subtotal), item.product_name) == (1, 0.0, "")
    regions = {r.region: r.total_amount for r in m.purchases_by_region(e, window=None).collect()}
    assert regions == {"LIMA": 10.0, "DESCONOCIDA": 0.0}
    c = m.conversion(e, window=None).first()
    assert (c.view_to_cart_rate, c.cart_to_purchase_rate, c.overall_conversion_rate) == (0.0, 0.0, 0.0)


def test_empty_input(spark):
    e = table(spark, [])
    assert m.throughput(e).count() == 0
    assert m.top_viewed_products(e).count() == 0
