"""Hand-made edge rows for rules the provided data cannot hit."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.operators import batch as B
from headway.operators import reports as RP
from headway.operators import serving as V
from headway.operators import speed as S
from headway.sources import feed as FD
from headway.sources import raw as RW

AS_OF = datetime(2024, 1, 28, 12, 0, 0)
TRIP = C.TRIP_UPDATES


def events(spark, rows):
    """rows: (event_id, 'yyyy-MM-dd HH:mm:ss[.ffffff]', route_id, delay, source)."""
    df = spark.createDataFrame(
        rows, "event_id string, ts string, route_id string, delay_seconds int, source string"
    )
    return df.withColumn("event_ts", F.col("ts").cast("timestamp")).drop("ts")


def one(df, col):
    return [r[col] for r in df.collect()]


def test_late_is_strictly_over_60(spark):
    ev = events(spark, [("a", "2024-01-28 11:59:00", "R1", 60, TRIP),
                        ("b", "2024-01-28 11:59:00", "R1", 61, TRIP)])
    row = S.window_stats(ev, AS_OF).collect()[0]
    assert (row.event_count, row.late_count, row.max_delay_seconds) == (2, 1, 61)


@pytest.mark.parametrize("delta,expected", [
    (60.0, "NORMAL"), (60.01, "WORSE_THAN_USUAL"), (120.0, "WORSE_THAN_USUAL"),
    (120.01, "SIGNIFICANTLY_WORSE_THAN_USUAL"), (-60.0, "NORMAL"), (-60.01, "BETTER_THAN_USUAL"),
])
def test_verdict_thresholds(spark, delta, expected):
    df = spark.createDataFrame([(delta,)], "d double")
    assert one(df.select(C.verdict(F.lit(True), F.lit(True), "d").alias("v")), "v") == [expected]


def test_verdict_presence(spark):
    df = spark.createDataFrame([(True, False), (False, True), (False, False)], "s boolean, b boolean")
    got = one(df.select(C.verdict("s", "b", F.lit(None).cast("double")).alias("v")), "v")
    assert got == ["LIVE_ONLY_NO_HISTORY", "HISTORICAL_ONLY_NO_LIVE_DATA", None]


def _windows(spark, avgs):
    rows = [("2024-01-28 06:00:00", "2024-01-28 12:00:00", f"R{i}", 1, a, 10, 0)
            for i, a in enumerate(avgs)]
    df = spark.createDataFrame(rows, "ws string, we string, route_id string, event_count long, "
                                     "avg_delay_seconds double, max_delay_seconds int, late_count long")
    return df.select(F.col("ws").cast("timestamp_ntz").alias("window_start"),
                     F.col("we").cast("timestamp_ntz").alias("window_end"), "*").drop("ws", "we")


def test_anomaly_thresholds(spark):
    avgs = [60.0, 60.01, 10.0, 10.0, 10.0, 0.0]
    baselines = [30.0, 30.0, 0.0, -5.0, None, 30.0]
    win = _windows(spark, avgs)
    base = spark.createDataFrame(
        [(f"R{i}", "Sunday_12", b) for i, b in enumerate(baselines) if b is not None],
        "route_id string, time_bucket string, avg_delay_seconds double")
    out = {r.route_id: r for r in S.speed_with_baseline(win, base).collect()}
    assert out["R0"].is_anomaly is False and out["R0"].anomaly_ratio == 2.0
    assert out["R1"].is_anomaly is True
    for r in ("R2", "R3", "R4"):
        assert out[r].anomaly_ratio is None and out[r].is_anomaly is False
    assert out["R4"].batch_baseline_seconds is None
    assert out["R5"].anomaly_ratio == 0.0 and out["R5"].is_anomaly is False


def test_as_of_window_bounds(spark):
    ev = events(spark, [
        ("in_start", "2024-01-28 11:55:00", "R1", 5, TRIP),
        ("out_before", "2024-01-28 11:54:59.999999", "R2", 5, TRIP),
        ("in_end", "2024-01-28 12:00:00", "R3", 5, TRIP),
    ])
    routes = sorted(one(S.window_stats(ev, AS_OF), "route_id"))
    assert routes == ["R1", "R3"]


@pytest.mark.parametrize("pre", [True, False])
def test_sliding_window_end_is_exclusive(spark, pre):
    ev = events(spark, [("a", "2024-01-28 12:00:00", "R1", 5, TRIP)])
    out = S.sliding_window_stats(ev, "5 minutes", "30 seconds", pre_aggregate=pre)
    ends = sorted(str(x) for x in one(out, "window_end"))
    assert len(ends) == 10
    assert "2024-01-28 12:00:00" not in ends
    assert ends[0] == "2024-01-28 12:00:30" and ends[-1] == "2024-01-28 12:05:00"


def test_pre_aggregated_sliding_equals_native(spark):
    from tests.conftest import SF_SMALL
    from headway.sources.fixtures import delay_events

    ev = delay_events(spark, SF_SMALL)
    a = S.sliding_window_stats(ev, "2 hours", "30 minutes", pre_aggregate=True)
    b = S.sliding_window_stats(ev, "2 hours", "30 minutes", pre_aggregate=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # every speed event lands in size / slide = 4 windows
    n = S.speed_events(ev).count()
    assert a.agg(F.sum("event_count")).first()[0] == 4 * n


def test_bad_ingestion_time(spark):
    lines = spark.createDataFrame([
        ('{"event_id":"a","ingestion_time":"bad","route_id":"R1","delay_seconds":10,'
         '"source":"tfi_trip_updates"}',),
        ('{"event_id":"b","route_id":"R1","delay_seconds":20,"source":"tfi_trip_updates"}',),
        ('{"event_id":"c","ingestion_time":"2024-01-28T10:00:00.5Z","route_id":"R1",'
         '"delay_seconds":30,"source":"tfi_trip_updates"}',),
    ], "value string")
    stats = B.route_statistics(B.clean_events(RW.parse_raw_lines(lines))).collect()
    by_hour = {r.hour_of_day: (r.day_of_week, r.observations, r.avg_delay) for r in stats}
    assert by_hour[None] == (None, 2, 15.0)
    assert by_hour[10] == ("Sunday", 1, 30.0)
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    speed = {r.event_id: str(r.event_ts) for r in RW.parse_speed_records(lines, now=now).collect()}
    assert speed["a"] == speed["b"] == "2024-02-01 00:00:00"
    assert speed["c"].startswith("2024-01-28 10:00:00.5")


def test_route_null_and_empty(spark):
    ev = events(spark, [("n", "2024-01-28 11:59:00", None, 5, TRIP),
                        ("e", "2024-01-28 11:59:00", "", 5, TRIP),
                        ("k", "2024-01-28 11:59:00", "R1", 5, TRIP)])
    assert sorted(one(B.clean_events(ev), "event_id")) == ["e", "k"]
    assert one(S.window_stats(ev, AS_OF), "route_id") == ["R1"]


def test_delay_encodings(spark):
    base = '"event_id":"{}","ingestion_time":"2024-01-28T11:59:00Z","route_id":"R1","source":"tfi_trip_updates"'
    vals = {"s45": '"45"', "f": "45.7", "nf": "-45.7", "x": '"x"', "sp": '" +7 "', "sf": '"45.7"',
            "i": "12", "nul": "null"}
    lines = spark.createDataFrame(
        [("{" + base.format(k) + f',"delay_seconds":{v}' + "}",) for k, v in vals.items()]
        + [("{" + base.format("missing") + "}",)], "value string")
    batch = {r.event_id: r.delay_seconds for r in RW.parse_raw_lines(lines).collect()}
    assert batch == {"s45": None, "f": None, "nf": None, "x": None, "sp": None, "sf": None,
                     "i": 12, "nul": None, "missing": None}
    assert one(B.clean_events(RW.parse_raw_lines(lines)), "event_id") == ["i"]
    speed = {r.event_id: r.delay_seconds for r in RW.parse_speed_records(lines).collect()}
    assert speed == {"s45": 45, "f": 45, "nf": -45, "sp": 7, "i": 12}


def test_corrupt_line_counted_others_kept(spark):
    lines = spark.createDataFrame([
        ('{"event_id":"a","route_id":"R1","delay_seconds":10,"source":"tfi_trip_updates"}',),
        ('{"event_id":"b","route_id":"R1","delay_se',),
    ], "value string")
    r = RW.malformed_records(lines).first()
    assert (r.records, r.malformed, r.decoded) == (2, 1, 1)
    assert one(RW.parse_speed_records(lines), "event_id") == ["a"]


def test_envelope_roundtrip(spark):
    import base64
    import json

    recs = [{"event_id": "a", "route_id": "R1", "delay_seconds": 70, "source": TRIP},
            {"event_id": "b", "route_id": "R2", "delay_seconds": "5", "source": TRIP}]
    env = json.dumps({"Records": [{"kinesis": {"data": base64.b64encode(json.dumps(r).encode()).decode()}}
                                  for r in recs] + [{"kinesis": {"data": "!!notbase64"}}]})
    lines = RW.decode_envelope(spark.createDataFrame([(env,)], "value string"))
    assert lines.count() == 3
    got = {r.event_id: r.delay_seconds for r in RW.parse_speed_records(lines).collect()}
    assert got == {"a": 70, "b": 5}
    assert RW.malformed_records(lines).first().malformed == 1


def test_ties_ordered_by_route(spark):
    ev = events(spark, [("1", "2024-01-01 10:00:00", "B", 50, TRIP),
                        ("2", "2024-01-01 10:00:00", "A", 50, TRIP),
                        ("3", "2024-01-01 10:00:00", "C", 10, TRIP)])
    assert one(B.top_delayed_routes(B.clean_events(ev)), "route_id") == ["A", "B", "C"]
    live = events(spark, [("1", "2024-01-28 11:58:00", "B", 50, TRIP),
                          ("2", "2024-01-28 11:58:00", "A", 50, TRIP)])
    top = S.top_delayed_live(live, AS_OF)
    assert [(r["rank"], r.route_id) for r in top.collect()] == [(1, "A"), (2, "B")]


def test_duplicate_event_ids_both_counted(spark):
    ev = events(spark, [("same", "2024-01-01 10:00:00", "R1", 10, TRIP),
                        ("same", "2024-01-01 10:00:00", "R1", 20, TRIP)])
    r = B.route_statistics(B.clean_events(ev)).first()
    assert (r.observations, r.avg_delay) == (2, 15.0)


def test_delay_label_and_severity(spark):
    df = spark.createDataFrame([(x,) for x in (None, -5.0, 0.0, 59.5, 60.0, 61.0, 125.0)], "x double")
    got = one(df.select(C.delay_label("x").alias("l")), "l")
    assert got == ["–", "5s early", "0s late", "1m late", "1m late", "1m 1s late", "2m 5s late"]
    sev = spark.createDataFrame([(x,) for x in (None, 59.0, 60.0, 299.0, 300.0)], "x double")
    assert one(sev.select(C.delay_severity("x").alias("s")), "s") == ["ok", "ok", "warn", "warn", "crit"]
    dl = spark.createDataFrame([(x,) for x in (None, 121.0, 61.0, -61.0, 0.0)], "x double")
    assert one(dl.select(C.delta_label("x").alias("s")), "s") == [
        "No history", "Much worse", "Worse", "Better", "Normal"]


def test_percentiles_nearest_index(spark):
    rows = [(1, float(v), "200", True) for v in range(1, 101)] + [(1, None, "500", False)]
    req = spark.createDataFrame(rows, "concurrency int, latency_ms double, status string, success boolean")
    r = RP.latency_report(req).first()
    assert (r.requests, r.successful, r.failed) == (101, 100, 1)
    assert (r.p95_ms, r.p99_ms, r.p50_ms, r.avg_latency_ms) == (96.0, 100.0, 50.5, 50.5)


def test_exact_ranks_hot_group_spread_over_tasks(spark):
    import random

    random.seed(7)
    hot = [("hot", float(random.randint(0, 5000))) for _ in range(20000)]
    cold = [("cold", float(v)) for v in range(1, 8)]
    df = spark.createDataFrame(hot + cold, "g string, v double")
    targets = spark.createDataFrame(
        [("hot", "a", 1), ("hot", "b", 10000), ("hot", "c", 20000), ("cold", "a", 4)],
        "g string, key string, r long")
    got = {(r.g, r.key): r.v for r in RP.exact_ranks(df, "g", "v", targets).collect()}
    s = sorted(v for _, v in hot)
    assert got == {("hot", "a"): s[0], ("hot", "b"): s[9999], ("hot", "c"): s[19999],
                   ("cold", "a"): 4.0}


def test_speedup_golden(spark):
    runs = spark.createDataFrame(
        [(1, "COMPLETED", 195.97), (2, "COMPLETED", 180.92), (4, "COMPLETED", 195.98),
         (8, "COMPLETED", 196.02)], "partitions int, state string, time_seconds double")
    out = RP.speedup_report(runs.withColumn("job", F.lit("j")), ["job"]).orderBy("partitions").collect()
    assert [r.speedup for r in out] == [1.0, 1.083, 1.0, 1.0]
    assert [r.efficiency for r in out] == [1.0, 0.542, 0.25, 0.125]


def test_speedup_failed_runs(spark):
    runs = spark.createDataFrame(
        [(1, "FAILED", 10.0), (2, "COMPLETED", 8.0), (4, "FAILED", 3.0), (8, "COMPLETED", 2.0)],
        "partitions int, state string, time_seconds double")
    out = RP.speedup_report(runs.withColumn("job", F.lit("j")), ["job"]).orderBy("partitions").collect()
    assert [r.speedup for r in out] == [0.0, 1.0, 0.0, 4.0]


def test_feed_departure_else_arrival(spark):
    from headway.schemas import FEED_MESSAGE

    msg = {"ingestion_time": "2024-01-28T11:59:00Z", "entity": [
        {"id": "e1", "trip_update": {"trip": {"trip_id": "T1", "route_id": "R1"}, "stop_time_update": [
            {"stop_sequence": 1, "stop_id": "S1", "departure": {"delay": 30}, "arrival": {"delay": 5}},
            {"stop_sequence": 2, "stop_id": "S2", "departure": {}},
            {"stop_sequence": 3, "stop_id": "S3", "arrival": {"delay": 9}},
            {"stop_sequence": 4, "stop_id": "S4"},
        ]}},
        {"id": "e2", "vehicle": {"trip": {"trip_id": "T2"}, "vehicle": {"id": "V9"},
                                 "position": {"latitude": 53.3}}},
    ]}
    import json

    msgs = spark.createDataFrame([(json.dumps(msg),)], "j string").select(
        F.from_json("j", FEED_MESSAGE).alias("m")).select("m.*")
    trips = {r.event_id: r.delay_seconds for r in FD.flatten_trip_updates(msgs).collect()}
    assert trips == {"e1_1": 30, "e1_2": 0, "e1_3": 9}
    veh = FD.flatten_vehicle_positions(msgs).first()
    assert (veh.event_id, veh.route_id, veh.vehicle_id, veh.longitude) == ("vp_e2", "", "V9", 0.0)
    keys = {r.event_id: r.partition_key for r in FD.ingest_union(msgs).collect()}
    assert keys["vp_e2"] == "unknown" and keys["e1_1"] == "R1"


def test_merge_presence_and_current_bucket(spark):
    win = _windows(spark, [100.0, 50.0])            # R0, R1 live at 12:00 Sunday
    base = spark.createDataFrame([("R0", "Sunday_12", 10.0), ("R2", "Sunday_12", 5.0),
                                  ("R1", "Sunday_11", 1.0)],
                                 "route_id string, time_bucket string, avg_delay_seconds double")
    rows = S.speed_with_baseline(win, base)
    m = {r.route_id: r for r in V.serving_merge(rows, base, AS_OF).collect()}
    assert m["R0"].verdict == "WORSE_THAN_USUAL" and m["R0"].delta_vs_historical == 90.0
    assert m["R1"].verdict == "LIVE_ONLY_NO_HISTORY" and m["R1"].delta_vs_historical is None
    assert m["R2"].verdict == "HISTORICAL_ONLY_NO_LIVE_DATA"


def test_invariants_on_fixture(spark):
    from tests.conftest import SF_SMALL
    from headway.plans import catalog as Q

    clean = Q.q_clean_events(spark, SF_SMALL).count()
    stats = Q.q_route_statistics(spark, SF_SMALL)
    assert stats.agg(F.sum("observations")).first()[0] == clean
    snap = Q.q_top_n_snapshot(spark, SF_SMALL)
    bad = snap.groupBy("window_end").agg(F.max("rank").alias("m"), F.count(F.lit(1)).alias("c")).filter(
        F.col("m") != F.col("c"))
    assert bad.count() == 0
    rows = Q.q_speed_with_baseline(spark, SF_SMALL)
    assert rows.filter(F.col("is_anomaly") & ~(F.col("batch_baseline_seconds") > 0)).count() == 0


def test_outputs_conform_to_declared_schemas(spark):
    from headway import schemas as SC
    from headway.sources import fixtures as X
    from tests.conftest import SF_SMALL

    def shape(df):
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    msgs = X.feed_messages(spark, SF_SMALL)
    assert shape(FD.flatten_trip_updates(msgs)) == shape(spark.createDataFrame([], SC.DELAY_EVENT))
    assert shape(FD.flatten_vehicle_positions(msgs)) == shape(spark.createDataFrame([], SC.VEHICLE_POSITION))
    assert shape(X.api_requests(spark, SF_SMALL)) == shape(spark.createDataFrame([], SC.API_REQUESTS))
    assert shape(X.ingest_runs(spark, SF_SMALL)) == shape(spark.createDataFrame([], SC.INGEST_RUNS))
    runs = X.batch_runs(spark, SF_SMALL).drop("job_date")
    assert sorted(shape(runs)) == sorted(shape(spark.createDataFrame([], SC.BATCH_RUNS)))
    assert shape(X.table(spark, SF_SMALL, "events")) == shape(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def test_snapshot_json_roundtrip(spark):
    from headway.plans import catalog as Q
    from tests.conftest import SF_SMALL

    rows = Q.snapshots(spark, SF_SMALL)
    back = S.parse_top_n_json(S.top_n_json(rows))
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
