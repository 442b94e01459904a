"""Streaming jobs: multi-batch runs equal their batch twins; restarts add nothing."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from headway.operators import batch as B
from headway.operators import speed as S
from headway.sources import fixtures as X
from headway.streaming import jobs as J
from headway.streaming import replay as SR
from tests.conftest import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _split_live_events(spark, d):
    """Live events as three arrival folders, in event-time order."""
    ev = X.table(spark, SF_SMALL, "events").filter(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    for i, (lo, hi) in enumerate([("2024-01-24", "2024-01-26"), ("2024-01-26", "2024-01-28"),
                                  ("2024-01-28", "2024-02-01")]):
        part = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
                         & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.write.parquet(os.path.join(d, "in", f"part{i}"))
    return ev.schema


def test_speed_layer_multi_batch_equals_batch_twin(spark):
    d = tempfile.mkdtemp(prefix="hw-speed-")
    schema = _split_live_events(spark, d)
    src = J.file_stream(spark, os.path.join(d, "in"), schema=schema, max_files=1, recursive=True)
    baseline = lambda s: B.batch_view(B.route_statistics(B.clean_events(X.history_events(s, SF_SMALL))))
    q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt",
                            baseline, "6 hours", "1 hour", "30 days", J.REPLAY)
    J.run_to_completion(q)
    batches = spark.read.parquet(f"{d}/view").select("batch_id").distinct().count()
    assert batches >= 3
    view = J.read_speed_view(spark, f"{d}/view")
    windows = S.sliding_window_stats(X.live_events(spark, SF_SMALL), "6 hours", "1 hour")
    twin = S.speed_with_baseline(windows, baseline(spark))
    assert _same(view, twin)
    assert _same(J.read_snapshots(spark, f"{d}/top"), S.top_n_snapshot(windows))

    # restart on the same checkpoint: nothing new to read, nothing written
    q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt",
                            baseline, "6 hours", "1 hour", "30 days", J.REPLAY)
    J.run_to_completion(q)
    assert spark.read.parquet(f"{d}/view").select("batch_id").distinct().count() == batches


@pytest.mark.parametrize("size,slide,delay", [("6 hours", "1 hour", "1 hour"),
                                              ("5 minutes", "30 seconds", "10 minutes")])
def test_append_windows_closed_by_watermark(spark, size, slide, delay):
    out = SR.stream_windows(spark, SF_SMALL, size, slide, delay)
    ev = X.delay_events(spark, SF_SMALL)
    wm = S.speed_events(ev).agg(F.max("event_ts")).first()[0]
    twin = S.sliding_window_stats(ev, size, slide)
    closed = twin.filter(F.col("window_end").cast("timestamp")
                         <= F.lit(wm.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
                         - F.expr(f"INTERVAL {delay}"))
    assert out.count() > 0 and _same(out, closed)


def test_late_history_is_dropped(spark):
    out = SR.late_arrivals(spark, SF_SMALL, "6 hours", "1 hour", "1 hour")[0]
    assert out.count() > 0
    assert out.filter(F.col("window_start") < F.lit("2024-01-23 18:00:00").cast("timestamp_ntz")).count() == 0


def test_archive_layout_and_roundtrip(spark):
    df = SR.archive(spark, SF_SMALL)
    assert {"year", "month", "day", "hour"} <= set(df.columns)
    raw = X.raw_lines(spark, SF_SMALL)
    decodable = raw.filter(F.try_parse_json("value").isNotNull()).count()
    assert df.count() == decodable
    assert df.filter(F.col("year") < 2024).count() == 0


def test_microbatch_single_batch_equals_group_by(spark):
    stats, counters = SR.microbatch(spark, SF_SMALL, X.AS_OF)
    c = counters.first()
    assert c.batch_id == 0 and c.processed == X.table(spark, SF_SMALL, "events").count()
    assert stats.agg(F.sum("event_count")).first()[0] == stats.join(
        counters.select("batch_id"), "batch_id").agg(F.sum("event_count")).first()[0]
    assert stats.count() == c.routes_updated


def test_queries_pin_utc(spark):
    import __spark_entry__ as E

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a = E.queries()["stream_tumbling_window"](spark, SF_SMALL)
        b = E.queries()["tumbling_window_avg"](spark, SF_SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        closed = b.join(a.select("window_start", "route_id"), ["window_start", "route_id"], "left_semi")
        assert _same(a, closed) and a.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fan_out_one_source_two_consumers(spark):
    from headway.operators import batch as Bt
    from headway.sources import raw as RWs

    d = tempfile.mkdtemp(prefix="hw-fan-")
    X.raw_lines(spark, SF_SMALL).write.text(f"{d}/in")
    lines = spark.readStream.format("text").load(f"{d}/in")
    baseline = lambda s: Bt.batch_view(Bt.route_statistics(Bt.clean_events(X.history_events(s, SF_SMALL))))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    a, s = J.start_fan_out(lines, f"{d}/raw", f"{d}/view", f"{d}/top", f"{d}/ckpt", baseline,
                           trigger=J.REPLAY, now=now, size="6 hours", slide="1 hour",
                           watermark="30 days")
    J.run_to_completion(a)
    J.run_to_completion(s)
    decodable = X.raw_lines(spark, SF_SMALL).filter(F.try_parse_json("value").isNotNull()).count()
    assert RWs.read_raw_json(spark, f"{d}/raw").count() == decodable
    view = J.read_speed_view(spark, f"{d}/view")
    speed_recs = RWs.parse_speed_records(X.raw_lines(spark, SF_SMALL), now=now)
    assert view.agg(F.sum("event_count")).first()[0] == 6 * speed_recs.count()


def test_speed_layer_out_of_order_batches_update_windows(spark):
    d = tempfile.mkdtemp(prefix="hw-ooo-")
    ev = X.table(spark, SF_SMALL, "events").filter(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    first = F.col("event_type").isin("click", "error")
    ev.filter(first).write.parquet(os.path.join(d, "in", "a"))
    src = J.file_stream(spark, os.path.join(d, "in"), schema=ev.schema, max_files=1, recursive=True)
    baseline = lambda s: B.batch_view(B.route_statistics(B.clean_events(X.history_events(s, SF_SMALL))))

    def run():
        q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt",
                                baseline, "6 hours", "1 hour", "30 days", J.REPLAY)
        J.run_to_completion(q)

    run()
    ev.filter(~first).write.parquet(os.path.join(d, "in", "b"))   # the rest, same period
    run()
    windows = S.sliding_window_stats(X.live_events(spark, SF_SMALL), "6 hours", "1 hour")
    assert _same(J.read_speed_view(spark, f"{d}/view"), S.speed_with_baseline(windows, baseline(spark)))
    assert _same(J.read_snapshots(spark, f"{d}/top"), S.top_n_snapshot(windows))


def test_archive_records_carry_arrival_metadata(spark):
    from headway.schemas import ARCHIVE_EXTRAS, RAW_SCHEMA
    from headway.sources import raw as RWs
    from pyspark.sql import types as T

    d = tempfile.mkdtemp(prefix="hw-arch-")
    X.raw_lines(spark, SF_SMALL).write.text(f"{d}/in")
    q = J.start_archive(spark.readStream.format("text").load(f"{d}/in"), f"{d}/raw", f"{d}/ckpt", J.REPLAY)
    J.run_to_completion(q)
    schema = T.StructType(RAW_SCHEMA.fields + ARCHIVE_EXTRAS.fields)
    rows = RWs.read_raw_json(spark, f"{d}/raw", schema=schema)
    assert rows.filter(F.col("_kinesis_sequence").isNull() | F.col("_kinesis_arrival").isNull()).count() == 0
    assert rows.select("_kinesis_sequence").distinct().count() == rows.count()


def test_archive_keeps_every_object_whole(spark):
    import json

    lines = ['{"route_id":"R1"} ', '{"route_id":"R1"}\t', "{}", " { } ", "[1]", "42", '"x"', "null", "not json", "",
             '{"a":{"b":{}}}', '{"route_id":"R1"}', '{"route_id":"R1"}', '{"t":"ends }"}']
    d = tempfile.mkdtemp(prefix="hw-arch-")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{d}/in")
    q = J.start_archive(spark.readStream.format("text").load(f"{d}/in"), f"{d}/raw", f"{d}/ckpt", J.REPLAY)
    J.run_to_completion(q)
    got = [json.loads(r.value) for r in spark.read.text(f"{d}/raw").select("value").collect()]
    assert len(got) == 8 and len({r.pop("_kinesis_sequence") for r in got}) == 8
    assert all(r.pop("_kinesis_arrival") for r in got)
    want = [{"route_id": "R1"}] * 4 + [{}, {}, {"a": {"b": {}}}, {"t": "ends }"}]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_archive_takes_sequence_and_arrival_from_a_log(spark):
    import json

    rows = spark.createDataFrame([(b'{"a":1}', 0, 7, "2024-01-10 10:00:00"), (b'{"a":1}', 0, 8, "2024-01-10 10:00:01")],
                                 "value binary, partition int, offset long, timestamp string")
    out = J.archive_lines(rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))).collect()
    assert sorted((json.loads(r.value)["_kinesis_sequence"], json.loads(r.value)["_kinesis_arrival"]) for r in out) == [
        ("0:7", "2024-01-10T10:00:00.000000"), ("0:8", "2024-01-10T10:00:01.000000")]


@pytest.mark.parametrize("name", ["stream_sliding_window", "stream_tumbling_window", "stream_top_n", "stream_anomalies",
                                  "microbatch_stats", "batch_counters", "archive_raw"])
def test_a_folder_of_parts_gives_the_same_result(spark, name, events_folder):
    from headway.plans.catalog import QUERIES

    one, many = QUERIES[name](spark, SF_SMALL), QUERIES[name](spark, events_folder)
    assert one.count() > 0 and _same(one, many)


@pytest.fixture(scope="module")
def events_folder(spark):
    d = tempfile.mkdtemp(prefix="hw-parts-")
    X.table(spark, SF_SMALL, "events").repartition(4).write.parquet(f"{d}/events.parquet")
    return d
