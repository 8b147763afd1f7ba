"""Null keys keep their rows, and ids of different loads differ."""

from tests.helpers import event, table

from tidemark.functions.skew import with_position
from tidemark.operators.quality import exact_percentiles, latency_summary, partition_mismatch
from tidemark.operators.routing import route_events
from tidemark.operators.validate import enrich_envelope, validate_envelope
from tidemark.sources.lines import read_event_lines


def test_null_group_has_percentiles(spark):
    df = spark.createDataFrame([(None, 4.0), (None, 8.0), ("a", 1.0)], "g string, latency_ms double")
    got = {r.g: r for r in latency_summary(df, by=["g"]).collect()}
    assert (got[None].p50, got[None].mean, got["a"].p50) == (6.0, 6.0, 1.0)
    assert exact_percentiles(df, "latency_ms", (50,), ["g"]).count() == 2


def test_null_group_keeps_positions(spark):
    df = table(spark, [event("PRODUCT_VIEW", sec=k, region=None) for k in range(3)])
    assert sorted(r.pos for r in with_position(df, ["region"], "event_ts").collect()) == [0, 1, 2]


def test_null_type_and_key_have_reasons(spark):
    routed = route_events(spark.createDataFrame([(None,)], "event_type string")).first()
    assert routed.topic is None and routed.error_reason
    placed = spark.createDataFrame([(None, None, 1, 2)], "key string, error string, partition int, expected_partition int")
    assert partition_mismatch(placed).count() == 1


def test_two_loads_have_different_ids(spark, tmp_path):
    ids = []
    for name in ("one", "two"):
        (tmp_path / f"{name}.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
        lines = read_event_lines(spark, str(tmp_path / f"{name}.jsonl"))
        doc = validate_envelope(lines)
        ids += [r.event_id for r in enrich_envelope(doc).collect()]
    assert len(set(ids)) == 4
