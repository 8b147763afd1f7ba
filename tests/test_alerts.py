import random
import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, buy, event, table
from tidemark.contract import AlertLimits
from tidemark.operators import alerts as al


def kinds(spark, events, **limits):
    rows = al.detect_alerts(table(spark, events), limits=AlertLimits(**limits)).collect()
    return {r.alert_type: r for r in rows}


def failed(amount, **kw):
    return event("PAYMENT_FAILED", total_amount=float(amount), **kw)


def test_payment_rules(spark):
    got = kinds(spark, [buy(10.0)] + [failed(1450.0)] * 4, critical_payment=1000.0)
    assert got["HIGH_PAYMENT_FAILURE_RATE"].current_value == 80.0
    assert got["HIGH_VALUE_PAYMENT_FAILURE"].current_value == 1450.0
    assert "HIGH_PAYMENT_FAILURE_RATE" not in kinds(spark, [buy(10.0)] + [failed(1.0)] * 3)


def test_first_big_cart_wins(spark):
    got = kinds(
        spark,
        [event("ADD_TO_CART", "A", cart_value_after=4999.99), event("ADD_TO_CART", "B", cart_value_after=6000.0), buy(9000.0, "C")],
    )["HIGH_VALUE_CART"]
    assert got.current_value == 6000.0 and "(Usuario: B)" in got.message


@pytest.mark.parametrize("n,hit", [(34, False), (35, True)])
def test_search_pressure(spark, n, hit):
    assert ("SEARCH_PRESSURE_NO_PURCHASE" in kinds(spark, [event("SEARCH")] * n)) is hit
    assert "SEARCH_PRESSURE_NO_PURCHASE" not in kinds(spark, [event("SEARCH")] * n + [buy(1.0)])


@pytest.mark.parametrize("ms,hit", [(29999, False), (30000, True)])
def test_latency(spark, ms, hit):
    assert ("HIGH_LATENCY" in kinds(spark, [event("LOGIN", latency=ms)])) is hit


def test_cart_activity_and_repeatable_ids(spark):
    events = [event("ADD_TO_CART"), event("REMOVE_FROM_CART"), event("ADD_TO_CART")]
    a = kinds(spark, events, cart_activity_min=3)["HIGH_CART_ACTIVITY"]
    assert a.alert_id == kinds(spark, events, cart_activity_min=3)["HIGH_CART_ACTIVITY"].alert_id
    assert a.alert_id.startswith("ALT_CART_ACTIVITY_") and len(a.alert_id) == len("ALT_CART_ACTIVITY_") + 8


@pytest.mark.parametrize("alpha", [0.1, 0.5, 0.95, 1.0])
def test_baseline_equals_the_recursion(spark, alpha):
    rnd = random.Random(3)
    # Dense stretches, long gaps and many chunks.
    secs, t = [], 0
    for _ in range(700):
        t += rnd.choice([10, 10, 10, 50, 4000])
        secs.append(t)
    facts = al.window_facts(table(spark, [event("SEARCH", sec=s) for s in secs for _ in range(rnd.randrange(1, 4))]), AlertLimits(), carts=False)
    rows = al.eps_baseline(facts, alpha=alpha, chunk="2 hours").orderBy("window_start").collect()
    level = 50.0
    for r in rows:
        assert r.baseline == pytest.approx(level, rel=1e-9)
        level = alpha * r.eps + (1 - alpha) * level


def test_baseline_over_many_small_blocks_and_a_tiny_alpha(spark):
    """A block per window: 100,500 blocks, and a weight so small that the first ones still count."""
    n, alpha = 100_500, 1e-5
    rows = spark.range(n).select(
        F.timestamp_add("SECOND", F.col("id") * 10, F.lit(T0).cast("timestamp_ntz")).alias("window_start"), F.pmod(F.col("id") * 7919, F.lit(101)).cast("double").alias("eps"),
        F.when(F.col("id") % 2 == 0, "a").alias("g"),
    )
    got = al.eps_baseline(rows.filter("g = 'a' OR g IS NULL"), alpha=alpha, chunk="10 seconds", by=["g"]).select("g", "window_start", "eps", "baseline").toPandas()
    assert len(got) == n
    for _, part in got.groupby(got.g.fillna("-")):
        level, worst = 50.0, 0.0
        for eps, baseline in part.sort_values("window_start")[["eps", "baseline"]].itertuples(index=False):
            worst = max(worst, abs(baseline / level - 1))
            level = alpha * eps + (1 - alpha) * level
        assert worst < 1e-9


def test_zero_fill_reports_the_outage(spark):
    events = [event("SEARCH", sec=s / 20) for s in range(20 * 20)] + [event("SEARCH", sec=60)]
    c = AlertLimits(baseline_init=20.0)
    plain = al.detect_alerts(table(spark, events), limits=c, only=["TRAFFIC_DROP"])
    filled = al.detect_alerts(table(spark, events), limits=c, only=["TRAFFIC_DROP"], zero_fill=True)
    assert plain.count() == 1
    # Windows 20..60 s: four empty ones and the last; the baseline stays above 10 throughout.
    level, want = 20.0, 0
    for eps in (20.0, 20.0, 0.0, 0.0, 0.0, 0.0, 0.1):
        want += eps < 0.2 * level and level > 10
        level = 0.1 * eps + 0.9 * level
    assert filled.count() == want == 5


@pytest.mark.parametrize("alpha,low", [(0.1, 10.0), (0.001, 19.0), (1.0, 10.0), (0.0, 10.0)])
def test_runs_of_empty_windows_equal_the_windows(spark, alpha, low):
    """Against the recursion over every window, over several segments and groups."""
    secs = [0, 5, 3000, 3011, 90_000, 300_007, 300_015]
    e = table(spark, [event("SEARCH", sec=s, scenario="BASE" if s != 3011 else "NAVIDAD") for s in secs for _ in range(200)])
    c = AlertLimits(baseline_init=20.0, baseline_alpha=alpha, drop_min_baseline=low)
    got = sorted((r.scenario, r.window_start) for r in al.detect_alerts(e, limits=c, only=["TRAFFIC_DROP"], zero_fill=True, by=["scenario"]).collect())
    want = []
    for name, own in (("BASE", [s for s in secs if s != 3011]), ("NAVIDAD", [3011])):
        level = 20.0
        for w in range(min(own) // 10, max(own) // 10 + 1):
            eps = 200 * sum(s // 10 == w for s in own) / 10
            if eps < 0.2 * level and level > low:
                want.append((name, T0 + timedelta(seconds=10 * w)))
            level = alpha * eps + (1 - alpha) * level
    assert got == sorted(want) and (want or alpha == 1.0)


def test_an_event_of_1970_does_not_fill_half_a_century(spark):
    from datetime import datetime

    e = table(spark, [event("SEARCH", sec=s / 10) for s in range(400)])
    old = e.limit(1).withColumn("event_ts", F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"))
    found = al.detect_alerts(old.unionByName(e), limits=AlertLimits(), only=["TRAFFIC_DROP"], zero_fill=True)
    assert 10 < found.count() < 30


def test_alert_log_is_folded_without_loss(spark, tmp_path):
    """Batches, a replayed one, open windows, and a compaction that stopped before it removed anything."""
    from tidemark.sources import sinks

    root = str(tmp_path)
    facts = lambda sec, amount: al.alert_high_value_payment_failure(table(spark, [failed(amount, sec=sec)]))
    for n, amount in enumerate((2000, 2100, 2200, 2300)):
        both = facts(0, amount).withColumn("detected_at", F.timestamp_add("SECOND", F.lit(n), F.col("detected_at"))).unionByName(facts(100 + 10 * n, amount))
        sinks.write_alerts(both, root, n)
    sinks.write_alerts(facts(500, 1900), root, sinks.OPEN)
    state = lambda: sorted((r.alert_id, r.current_value, r.detected_at, r.message) for r in sinks.read_alerts(spark, root).collect())
    want = state()
    assert len(want) == 6 and [x[1] for x in want if "2000.0" in x[3] and x[1] != 2000.0] == [2300.0]
    old = tmp_path / "kept"
    shutil.copytree(tmp_path / "alerts", old)
    sinks.compact_alerts(spark, root)
    assert state() == want and sorted(p.name for p in (tmp_path / "alerts").iterdir()) == ["batch_id=-1", "batch_id=3"]
    shutil.copytree(old, tmp_path / "alerts", dirs_exist_ok=True)  # as if nothing had been removed
    assert state() == want
    sinks.compact_alerts(spark, root, keep=0)
    assert state() == want
    assert sinks.read_alerts(spark, str(tmp_path / "nothing")) is None
