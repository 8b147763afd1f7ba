"""Streams over several micro-batches give what the batch operators give."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import buy, event, table
from tests.test_ingest import published
from tidemark.contract import AlertLimits, AudienceLimits, Windows
from tidemark.operators import alerts as al
from tidemark.operators import audiences as au
from tidemark.operators import metrics as m
from tidemark.streaming import jobs, windows


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """600 events in time order, in three files."""
    rnd = random.Random(5)
    kinds = ["VIEW_PRODUCT", "ADD_TO_CART", "REMOVE_FROM_CART", "PURCHASE", "SEARCH", "PAYMENT_FAILED"]
    rows, t = [], 0.0
    for _ in range(600):
        t += rnd.choice([0.1, 0.5, 3])
        k = rnd.choice(kinds)
        rows.append(event(k, f"U{rnd.randrange(9)}", t, source=rnd.choice(["WEB", "POS"]), product_id=f"P{rnd.randrange(6)}", product_name="n",
                          category="c", cart_id="C1", total_amount=float(rnd.randrange(10, 400))))
    e = table(spark, rows)
    path = str(tmp_path_factory.mktemp("parts"))
    for i in range(3):
        e.filter(F.floor(F.col("arrival") / 200) == i).coalesce(1).write.mode("append").parquet(path)
    return e, path


def stream(spark, parts):
    e, path = parts
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name,batch,cols", [
    ("conversion", lambda e, w: m.conversion(e, window=w), ["window_start", "views_count", "overall_conversion_rate"]),
    ("trends", lambda e, w: m.trends(e, window=w, slide="10 seconds"), ["window_start", "window_end", "events_count", "active_users", "total_revenue"]),
    ("top_products_viewed", lambda e, w: m.top_viewed_products(e, window=w, k=3), ["window_start", "product_id", "views", "position"]),
])
def test_metric_stream(spark, parts, tmp_path, name, batch, cols):
    e, _ = parts
    w = Windows(*(["20 seconds"] * 7), trends_slide="10 seconds", lateness="5 seconds")
    jobs.run_metric(stream(spark, parts), name, str(tmp_path), str(tmp_path / "cp"), w, k=3).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/{name}")
    want = batch(e, "20 seconds")
    assert rows_of(got, *cols) == rows_of(want, *cols) and want.count() > 5
    assert windows.late_rows(spark, str(tmp_path), name) is None


@pytest.mark.parametrize("name,batch,cols", [
    ("conversion", lambda e, w: m.conversion(e, window=w), ["window_start", "views_count", "overall_conversion_rate"]),
    ("trends", lambda e, w: m.trends(e, window=w, slide="10 seconds"), ["window_start", "window_end", "events_count", "active_users", "total_revenue"]),
])
def test_append_mode_gives_the_closed_windows(spark, parts, tmp_path, name, batch, cols):
    e, _ = parts
    w = Windows(*(["20 seconds"] * 7), trends_slide="10 seconds", lateness="5 seconds")
    rows = jobs.metric_stream(stream(spark, parts), name, w)
    jobs.start(rows.writeStream.format("parquet").option("path", str(tmp_path / "rows")), str(tmp_path / "cp")).awaitTermination()
    closed = e.agg(F.timestamp_add("SECOND", F.lit(-5), F.max("event_ts"))).scalar()
    want = batch(e, "20 seconds").filter(F.col("window_end") <= closed)
    assert rows_of(spark.read.parquet(str(tmp_path / "rows")), *cols) == rows_of(want, *cols)


def test_a_drained_run_goes_on_and_replays_change_nothing(spark, parts, tmp_path):
    """Two runs over a growing folder: windows open after the first are taken up again."""
    e, path = parts
    w = Windows(*(["20 seconds"] * 7), trends_slide="10 seconds", lateness="5 seconds")
    grown, root, cp = tmp_path / "in", str(tmp_path), str(tmp_path / "cp")
    for i in range(2):
        e.filter(F.floor(F.col("arrival") / 300) == i).coalesce(1).write.mode("append").parquet(str(grown))
        rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(grown))
        jobs.run_metric(rows, "conversion", root, cp, w).awaitTermination()
        want = m.conversion(e.filter(F.col("arrival") < 300 * (i + 1)), window="20 seconds")
        got = spark.read.parquet(f"{root}/conversion")
        assert rows_of(got.drop("batch_id"), *want.columns) == rows_of(want, *want.columns)
        assert got.filter("batch_id = -1").count() > 0
    job = windows.WindowJob(windows.metric_forms(w)["conversion"], root, "conversion", w.lateness,
                            lambda r, n: r.write.mode("overwrite").parquet(f"{root}/conversion/batch_id={n}"))
    job(e.filter(F.col("arrival") >= 300), 1)  # the last batch once more
    job.flush(spark, 1)
    assert rows_of(spark.read.parquet(f"{root}/conversion").drop("batch_id"), *want.columns) == rows_of(want, *want.columns)
    assert sorted(x.name for x in (tmp_path / "_windows/conversion/state").iterdir()) == ["batch_id=0", "batch_id=1"]


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    e = table(spark, [event("SEARCH", "U1", t) for t in (0, 1, 30, 2, 11, 26, 31)])
    src = str(tmp_path / "in")
    for cut in (F.col("arrival") < 3, F.col("arrival") >= 3):
        e.filter(cut).coalesce(1).write.mode("append").parquet(src)
    rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    w = Windows(*(["10 seconds"] * 6), trends="20 seconds", trends_slide="10 seconds", lateness="5 seconds")
    for name, lost in (("throughput", [("evt_3", 0), ("evt_4", 10)]), ("trends", [("evt_3", -10), ("evt_3", 0), ("evt_4", 0)])):
        root = str(tmp_path / name)
        jobs.run_metric(rows, name, root, f"{root}/cp", w).awaitTermination()
        late = windows.late_rows(spark, root, name)
        base = e.agg(F.min("event_ts")).first()[0]
        assert sorted((r.event_id, (r.window_start - base).total_seconds()) for r in late.collect()) == lost
    got = {(r.window_start - base).total_seconds(): r.total_events for r in spark.read.parquet(f"{tmp_path}/throughput/throughput").collect()}
    assert got == {0: 2, 20: 1, 30: 2}


def test_alert_stream_carries_the_baseline(spark, parts, tmp_path):
    e, _ = parts
    c = AlertLimits(spike_multiplier=1.1, spike_min_events=5, drop_multiplier=0.9, drop_min_baseline=0.1, baseline_init=1.0, search_min=1)
    jobs.alert_stream(stream(spark, parts), str(tmp_path), str(tmp_path / "cp"), limits=c).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/alerts")
    assert spark.read.parquet(f"{tmp_path}/baseline").count() >= 3
    want = al.detect_alerts(e, limits=c)
    cols = ["alert_type", "window_start", "current_value", "threshold_value"]
    assert rows_of(got, *cols) == rows_of(want, *cols) and want.count() > 20


def test_big_cart_stream(spark, parts, tmp_path):
    e, _ = parts
    c = AlertLimits(high_cart=380.0)
    jobs.big_cart_stream(stream(spark, parts), str(tmp_path), str(tmp_path / "cp"), limits=c).awaitTermination()
    got = rows_of(spark.read.parquet(f"{tmp_path}/alerts_cart"), "window_start", "current_value", "message")
    want = rows_of(al.alert_high_value_cart(e, limits=c), "window_start", "current_value", "message")
    assert got == want and got


def test_audience_stream_keeps_history_across_batches(spark, parts, tmp_path):
    e, _ = parts
    c = AudienceLimits(history_rows=40, high_value_amount=500.0, night_events=1)
    jobs.classify_stream(stream(spark, parts), str(tmp_path), str(tmp_path / "cp"), c).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/audiences")
    last = got.filter(F.col("batch_id") == got.agg(F.max("batch_id")).scalar())
    cols = ["user_id", "audience_type", "confidence", "detected_at"]
    assert rows_of(last, *cols) == rows_of(au.classify_audiences(e, limits=c), *cols) and last.count() > 5


def test_an_idle_user_leaves_the_state_and_its_audiences(spark, tmp_path):
    """U1 has no events after the first run; its audiences come once more as REMOVED."""
    e = table(spark, [buy(2000, "U1", 1), buy(2000, "U2", 2), buy(3000, "U2", 3)])
    src, root = str(tmp_path / "in"), str(tmp_path)
    for i, cut in enumerate((F.col("arrival") < 2, F.col("arrival") == 2)):
        e.filter(cut).coalesce(1).write.mode("append").parquet(src)
        jobs.classify_stream(spark.readStream.schema(e.schema).parquet(src), root, str(tmp_path / "cp"), idle="8 seconds").awaitTermination()
        time.sleep(9 * (1 - i))
    rows = spark.read.parquet(f"{root}/audiences").filter("audience_type = 'USUARIO_ALTO_VALOR'")
    got = {(r.batch_id, r.user_id, r.action): r.evidence for r in rows.collect()}
    assert sorted(got) == [(0, "U1", "ADDED"), (0, "U2", "ADDED"), (1, "U1", "REMOVED"), (1, "U2", "ADDED")] or (1, "U2", "REMOVED") in got
    assert got[1, "U1", "REMOVED"] == got[0, "U1", "ADDED"]


def test_batches_are_cut_to_the_last_rows_of_each_user(spark, monkeypatch):
    from tidemark.functions.skew import top_rows
    from tidemark.streaming import history

    monkeypatch.setattr(history, "HELD", 50)
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("arrival"), F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("u"), F.col("id") % 40)).alias("user_id"))
    cut = history.last_rows(rows, 5)
    want = rows_of(top_rows(rows.fillna("-"), ["user_id"], [F.desc("arrival")], 5), "user_id", "arrival")
    assert rows_of(top_rows(cut.fillna("-"), ["user_id"], [F.desc("arrival")], 5), "user_id", "arrival") == want
    assert cut.filter("user_id = 'hot'").count() < 400


def test_ingest_stream_splits_good_rows_and_dead_letters(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    docs = [published(event_id=f"e{i % 8}") for i in range(12)] + [published(user_id=...)]
    for i in range(2):
        (src / f"{i}.jsonl").write_text("\n".join([json.dumps(d) for d in docs[i::2]] + ["{x"]))
    from tidemark.sources.lines import read_line_stream

    root = str(tmp_path / "out")
    jobs.micro_window_stream(read_line_stream(spark, str(src), 1), root, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(f"{root}/events").count() == 8
    rejects = [r.error_reason.split(":")[0] for r in spark.read.parquet(f"{root}/dead_letters").collect()]
    assert sorted(set(rejects)) == ["Campo requerido ausente o nulo", "Duplicate event_id", "JSON malformado"] and len(rejects) == 7
    assert spark.read.parquet(f"{root}/micro/throughput").agg(F.sum("total_events")).first()[0] == 8


def test_dedup_stream(spark, parts, tmp_path):
    from tidemark.operators.dedup import dedup_stream

    twice = jobs.as_instant(stream(spark, parts)).withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
    out = dedup_stream(twice, "1 minute", ts="event_ts").select("event_id")
    jobs.start(out.writeStream.format("parquet").option("path", str(tmp_path / "d")), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "d")).count() == 600


def test_a_large_micro_batch_is_read_by_many_tasks(spark, tmp_path):
    from pyarrow.parquet import ParquetFile

    from checks import queries

    rows = spark.range(400000).select(F.col("id").alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("props"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    path = queries.in_two_files(spark, str(tmp_path), F.col("event_id") < 200000)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(files) == 2 and all(ParquetFile(f.removeprefix("file://")).num_row_groups > 2 for f in files)
    assert spark.read.parquet(path).count() == 400000
