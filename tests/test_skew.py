import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import skew
from tidemark.operators.quality import exact_percentiles, latency_summary
from tidemark.operators.routing import partition_balance


@pytest.fixture(scope="module")
def hot(spark):
    """One key owns two thirds of the rows."""
    return (
        spark.range(0, 30000, 1, 6)
        .select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
                F.xxhash64("id").alias("o"), "id")
    )


def test_top_rows(hot):
    pdf = hot.toPandas()
    want = pdf.sort_values("o").groupby("k").head(7)
    got = skew.top_rows(hot, ["k"], [F.col("o")], 7).toPandas()
    assert set(got.id) == set(want.id)


def test_tag_first(hot):
    pdf = hot.toPandas()
    want = set(pdf.loc[pdf.groupby("k").o.idxmin()].id)
    got = skew.tag_first(hot, "k", "o").filter("is_first").toPandas()
    assert set(got.id) == want and skew.tag_first(hot, "k", "o").count() == 30000


def test_newest_rows_and_positions(spark):
    df = spark.range(5000).select(
        F.timestamp_add("SECOND", F.pmod(F.xxhash64("id"), F.lit(90000)), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"), "id",
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
    )
    pdf = df.toPandas().sort_values(["ts", "id"])
    assert set(skew.newest_rows(df, "ts", "id", 321).toPandas().id) == set(pdf.tail(321).id)
    pdf["want"] = pdf.groupby("g").cumcount()
    got = skew.with_position(df, ["g"], "ts", ["id"]).toPandas().merge(pdf, on="id")
    assert (got.pos == got.want).all()


def test_percentiles(spark):
    one = lambda xs: spark.createDataFrame([(float(x),) for x in xs], "v double")
    q = lambda xs, *p: tuple(exact_percentiles(one(xs), "v", p).first())
    assert q(range(1, 101), 0, 50, 100) == (1.0, 50.5, 100.0)
    assert q([10, 20], 50) == (15.0,) and q([9, 1, 5], 50) == (5.0,)
    s = latency_summary(one([1.0] * 90 + [500.0] * 10), "v").first()
    assert (s.p50, s.p99) == (1.0, 500.0)
    empty = latency_summary(one([]), "v").first()
    assert (empty.n, empty.p50, empty.mean, empty.max) == (0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        exact_percentiles(one([1]), "v", (101,))
    rnd = random.Random(1)
    xs = [rnd.lognormvariate(0, 4) * rnd.choice([-1, 1]) for _ in range(4001)]
    points = (0, 1, 33.3, 50, 95, 99.9, 100)
    assert q(xs, *points) == pytest.approx(np.percentile(xs, points), rel=1e-12)


def test_partition_balance(spark):
    rows = [("user-events", 0, "a")] * 6 + [("user-events", 1, "b"), ("user-events", 1, None), ("other", 0, "a"), (None, 0, "a"), ("user-events", None, "a")]
    df = spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, user_id string")
    got = {(r.topic, r.partition): (r.events, r["keys"], r.skew) for r in partition_balance(df).collect()}
    assert got == {("user-events", 0): (6, 1, 3.0), ("user-events", 1): (2, 2, 1.0), ("other", 0): (1, 1, None)}
