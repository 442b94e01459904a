"""Named queries over a data directory: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the provided tables (through the fixed feed mapping in
``headway.sources.fixtures``) and runs over all of their rows; only where live
rows meet a baseline are they split in time into history and live part. Parameters
(evaluation instant, window sizes) are fixed here so the SQL oracle in
``headway.plans.oracle`` can state the same query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.operators import batch as B
from headway.operators import reports as RP
from headway.operators import serving as V
from headway.operators import speed as S
from headway.operators import states as ST
from headway.schemas import RAW_SCHEMA
from headway.session import ensure_utc
from headway.sources import feed as FD
from headway.sources import fixtures as X
from headway.sources import raw as RW
from headway.sources.published import read_view
from headway.streaming import replay as SR

AS_OF = X.AS_OF
# The fixture has about one event per route and five minutes, so the
# registered queries use 6-hour windows sliding by one hour; the operators'
# defaults stay 5 minutes / 30 seconds.
SIZE = "6 hours"
SLIDE = "1 hour"
TUMBLE = "1 minute"
TOP_N = 5
DETAIL_ROUTE = "R05"
PREFIX_N = 3
BETWEEN = (datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18))
# an incremental run up to each of these hours; the last one is after every flush
INCREMENTS = [datetime(2024, 1, 8), datetime(2024, 1, 8, 5), datetime(2024, 1, 20), datetime(2024, 1, 20), datetime(2025, 1, 1)]

Query = Callable[[SparkSession, str], DataFrame]


# -- shared building blocks ---------------------------------------------------

def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch statistics of the whole table."""
    return B.route_statistics(B.clean_events(X.delay_events(spark, sf_dir)))


def history_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch statistics of what lies before the live part: the baseline that live rows meet."""
    return B.route_statistics(B.clean_events(X.history_events(spark, sf_dir)))


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batch_view(history_statistics(spark, sf_dir))


def live_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sliding_window_stats(X.live_events(spark, sf_dir), SIZE, SLIDE)


def states(spark: SparkSession, sf_dir: str, route: str | None = None, closed: bool = False) -> DataFrame:
    """Newest live window and baselines of each route at AS_OF, from one scan."""
    events = X.delay_events(spark, sf_dir)
    events = events if route is None else events.filter(F.col("route_id") == route)
    return ST.route_states(events, X.HISTORY_UNTIL, AS_OF, SIZE, SLIDE, closed)


def speed_rows(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    base = base if base is not None else baseline(spark, sf_dir)
    return S.speed_with_baseline(live_windows(spark, sf_dir), base)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-N snapshots of every window of the whole table."""
    return S.top_n_snapshot(S.sliding_window_stats(X.delay_events(spark, sf_dir), SIZE, SLIDE), TOP_N)


# -- batch layer ----------------------------------------------------------------

def q_clean_events(spark, sf_dir):
    c = B.clean_events(X.delay_events(spark, sf_dir))
    return c.select(
        "event_id", "route_id", "trip_id", "stop_sequence", "delay_seconds",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "day_of_week", "hour_of_day",
    )


def q_input_counts(spark, sf_dir):
    return B.input_counts(X.delay_events(spark, sf_dir))


def q_route_statistics(spark, sf_dir):
    return statistics(spark, sf_dir)


def q_top_delayed_routes(spark, sf_dir):
    return B.top_delayed_routes(B.clean_events(X.delay_events(spark, sf_dir)))


def q_batch_view(spark, sf_dir):
    return B.batch_view(statistics(spark, sf_dir))


def q_time_bucket(spark, sf_dir):
    return B.event_time_buckets(B.clean_events(X.delay_events(spark, sf_dir)))


def q_batch_delay_history(spark, sf_dir):
    return B.batch_delay_history(statistics(spark, sf_dir))


# -- speed layer ----------------------------------------------------------------

def q_window_stats(spark, sf_dir):
    return S.window_stats(X.delay_events(spark, sf_dir), AS_OF, SIZE)


def q_sliding_window_stats(spark, sf_dir):
    return S.sliding_window_stats(X.delay_events(spark, sf_dir), SIZE, SLIDE)


def q_tumbling_window_avg(spark, sf_dir):
    return S.tumbling_window_avg(X.delay_events(spark, sf_dir), TUMBLE)


def q_top_delayed_live(spark, sf_dir):
    return S.top_delayed_live(X.delay_events(spark, sf_dir), AS_OF, SIZE, TOP_N)


def q_top_n_snapshot(spark, sf_dir):
    return snapshots(spark, sf_dir)


def q_latest_snapshot(spark, sf_dir):
    return S.latest_snapshot(snapshots(spark, sf_dir), AS_OF)


def q_latest_snapshot_json(spark, sf_dir):
    return S.latest_snapshot_from_json(S.top_n_json(snapshots(spark, sf_dir)), AS_OF)


def q_top_delayed_n(spark, sf_dir):
    return S.top_delayed_n(snapshots(spark, sf_dir), PREFIX_N, AS_OF)


def q_speed_with_baseline(spark, sf_dir):
    return speed_rows(spark, sf_dir)


def q_anomaly_windows(spark, sf_dir):
    return S.anomaly_windows(speed_rows(spark, sf_dir))


def q_anomalies(spark, sf_dir):
    return V.current_anomalies(ST.newest_windows(states(spark, sf_dir)), AS_OF)


def q_anomaly_alerts(spark, sf_dir):
    return V.anomaly_alerts(V.current_anomalies(ST.newest_windows(states(spark, sf_dir)), AS_OF))


def q_speed_view_live(spark, sf_dir):
    return S.speed_view_live(speed_rows(spark, sf_dir), AS_OF)


# -- serving layer --------------------------------------------------------------

def q_latest_per_route(spark, sf_dir):
    return ST.newest_windows(states(spark, sf_dir))


def q_serving_merge(spark, sf_dir):
    return ST.merged_states(states(spark, sf_dir))


def q_serving_merge_history(spark, sf_dir):
    base = baseline(spark, sf_dir)
    return V.serving_merge_history(speed_rows(spark, sf_dir, base), base)


def q_verdict(spark, sf_dir):
    return q_serving_merge_history(spark, sf_dir).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def q_route_detail(spark, sf_dir):
    return ST.merged_states(states(spark, sf_dir, DETAIL_ROUTE))


def q_live_summary(spark, sf_dir):
    return V.live_summary(S.window_stats(X.delay_events(spark, sf_dir), AS_OF, SIZE), TOP_N)


def q_kpis(spark, sf_dir):
    return ST.state_kpis(states(spark, sf_dir, closed=True), TOP_N)


def q_top_delayed_enriched(spark, sf_dir):
    return ST.enriched_top(states(spark, sf_dir), TOP_N)


def _labelled_windows(spark, sf_dir):
    """Rounded means and maxima of every window of the whole table."""
    windows = S.sliding_window_stats(X.delay_events(spark, sf_dir), SIZE, SLIDE)
    return windows.select("window_end", "route_id", C.half_even("avg_delay_seconds", 2).alias("avg_delay_seconds"),
                          "max_delay_seconds")


def q_delay_label(spark, sf_dir):
    return V.delay_labels(_labelled_windows(spark, sf_dir)).select(
        "window_end", "route_id", "avg_delay_seconds", "delay_label",
        C.delay_label("max_delay_seconds").alias("max_delay_label"),
    )


def q_delay_severity(spark, sf_dir):
    return _labelled_windows(spark, sf_dir).select(
        "window_end", "route_id", "avg_delay_seconds", "max_delay_seconds",
        C.delay_severity("avg_delay_seconds").alias("avg_severity"),
        C.delay_severity("max_delay_seconds").alias("max_severity"),
    )


def q_delta_label(spark, sf_dir):
    return q_serving_merge_history(spark, sf_dir).select(
        "route_id", "time_bucket", "window_end", "delta_vs_historical",
        C.delta_label("delta_vs_historical").alias("delta_label"),
    )


def q_relative_delay(spark, sf_dir):
    return V.relative_delay(snapshots(spark, sf_dir))


# -- ingestion ------------------------------------------------------------------

def q_raw_json_scan(spark, sf_dir):
    return RW.parse_raw_lines(X.raw_lines(spark, sf_dir))


def q_archive_route_statistics(spark, sf_dir):
    raw = RW.parse_raw_lines(X.raw_lines(spark, sf_dir))
    return B.route_statistics(B.clean_events(raw))


def _speed_records(lines):
    recs = RW.parse_speed_records(lines, now=X.ts_literal(AS_OF))
    return recs.select("event_id", "route_id", "delay_seconds", C.to_ntz("event_ts").alias("event_ts"))


def q_coerce_delay(spark, sf_dir):
    return _speed_records(X.raw_lines(spark, sf_dir))


def q_decode_envelope(spark, sf_dir):
    return _speed_records(RW.decode_envelope(X.envelopes(spark, sf_dir)))


def q_malformed_records(spark, sf_dir):
    return RW.malformed_records(RW.decode_envelope(X.envelopes(spark, sf_dir)))


def q_flatten_trip_updates(spark, sf_dir):
    return FD.flatten_trip_updates(X.feed_messages(spark, sf_dir))


def q_flatten_vehicle_positions(spark, sf_dir):
    return FD.flatten_vehicle_positions(X.feed_messages(spark, sf_dir))


def q_ingest_union(spark, sf_dir):
    return FD.ingest_union(X.feed_messages(spark, sf_dir))


# -- run-log reports ------------------------------------------------------------

def q_latency_report(spark, sf_dir):
    return RP.latency_report(X.api_requests(spark, sf_dir))


def q_throughput_report(spark, sf_dir):
    return RP.throughput_report(X.ingest_runs(spark, sf_dir))


def q_speedup_report(spark, sf_dir):
    return RP.speedup_report(X.batch_runs(spark, sf_dir), job=["job_date"])


# -- streaming (replays of the streaming jobs with availableNow) ----------------

STREAM_WATERMARK = "1 hour"
TUMBLE_WATERMARK = "10 minutes"


TUMBLE_COLUMNS = ("window_start", "window_end", "route_id", "avg_delay_seconds", "event_count")


def q_stream_sliding_window(spark, sf_dir):
    return SR.all_windows(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK).drop("is_final")


def q_stream_tumbling_window(spark, sf_dir):
    return SR.all_windows(spark, sf_dir, TUMBLE, None, TUMBLE_WATERMARK).select(*TUMBLE_COLUMNS)


def q_stream_open_windows(spark, sf_dir):
    return SR.all_windows(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK).filter(~F.col("is_final")).drop("is_final")


def q_stream_closed_windows(spark, sf_dir):
    return SR.stream_windows(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK)


def q_stream_closed_tumbling(spark, sf_dir):
    return SR.stream_windows(spark, sf_dir, TUMBLE, None, TUMBLE_WATERMARK).select(*TUMBLE_COLUMNS)


def q_stream_top_n(spark, sf_dir):
    return SR.speed_layer(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK, TOP_N, live_only=False)[1]


def q_stream_anomalies(spark, sf_dir):
    return SR.speed_layer(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK, TOP_N)[0].filter("is_anomaly")


def q_microbatch_stats(spark, sf_dir):
    return SR.microbatch(spark, sf_dir, AS_OF)[0]


def q_batch_counters(spark, sf_dir):
    return SR.microbatch(spark, sf_dir, AS_OF)[1].select("batch_id", "processed", "routes_updated")


def q_stream_late_data(spark, sf_dir):
    return SR.late_arrivals(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK)[0].filter("is_final").drop("is_final")


def q_stream_late_report(spark, sf_dir):
    late = SR.late_arrivals(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK)[1]
    return late.select("route_id", C.to_ntz("pane_start").alias("pane_start"), F.col("n").alias("events"),
                       F.col("s").alias("sum_delay"), F.col("m").alias("max_delay"), F.col("l").alias("late_count"))


def q_stream_late_corrected(spark, sf_dir):
    return SR.late_arrivals(spark, sf_dir, SIZE, SLIDE, STREAM_WATERMARK, corrected=True)[0].drop("is_final")


def _fan_out(spark, sf_dir):
    return SR.fan_out(spark, sf_dir, AS_OF, SIZE, SLIDE, STREAM_WATERMARK)


def q_fan_out_archive(spark, sf_dir):
    return _fan_out(spark, sf_dir)[0].select(
        *[f.name for f in RAW_SCHEMA.fields], F.col("_kinesis_sequence").isNotNull().alias("has_sequence"),
        F.col("_kinesis_arrival").isNotNull().alias("has_arrival"))


def q_fan_out_quarantine(spark, sf_dir):
    return _fan_out(spark, sf_dir)[1]


def q_fan_out_speed_view(spark, sf_dir):
    return _fan_out(spark, sf_dir)[2].select("window_start", "window_end", "route_id", "event_count", "avg_delay_seconds",
                                             "max_delay_seconds", "late_count")


def q_archive_between(spark, sf_dir):
    return SR.between(spark, sf_dir, BETWEEN[0], BETWEEN[1]).select(*[f.name for f in RAW_SCHEMA.fields])


def q_published_route_statistics(spark, sf_dir):
    rows = read_view(spark, f"{SR.published(spark, sf_dir)}/route_statistics")
    return rows.withColumn("generated_at", F.try_to_timestamp("generated_at").isNotNull()).withColumnRenamed(
        "generated_at", "has_generated_at")


def q_published_top_routes(spark, sf_dir):
    return read_view(spark, f"{SR.published(spark, sf_dir)}/top_delayed_routes")


def q_incremental_batch_view(spark, sf_dir):
    return read_view(spark, f"{SR.incremental(spark, sf_dir, INCREMENTS)}/batch_view")


def q_event_time_fallback(spark, sf_dir):
    return _speed_records(X.untimed_lines(spark, sf_dir))


def q_served_rows(spark, sf_dir):
    return ST.served_states(states(spark, sf_dir), AS_OF, SIZE)


def q_summary(spark, sf_dir):
    return V.summary(S.window_stats(X.delay_events(spark, sf_dir), AS_OF, SIZE), AS_OF, TOP_N)


def q_throughput_elapsed(spark, sf_dir):
    return RP.throughput_report(X.ingest_runs(spark, sf_dir), X.ingest_spans(spark, sf_dir))


def q_archive_raw(spark, sf_dir):
    return SR.archive(spark, sf_dir).select(*[f.name for f in RAW_SCHEMA.fields])


_QUERIES: dict[str, Query] = {
    "clean_events": q_clean_events,
    "input_counts": q_input_counts,
    "route_statistics": q_route_statistics,
    "top_delayed_routes": q_top_delayed_routes,
    "batch_view": q_batch_view,
    "time_bucket": q_time_bucket,
    "batch_delay_history": q_batch_delay_history,
    "window_stats": q_window_stats,
    "sliding_window_stats": q_sliding_window_stats,
    "tumbling_window_avg": q_tumbling_window_avg,
    "top_delayed_live": q_top_delayed_live,
    "top_n_snapshot": q_top_n_snapshot,
    "latest_snapshot": q_latest_snapshot,
    "latest_snapshot_json": q_latest_snapshot_json,
    "top_delayed_n": q_top_delayed_n,
    "speed_with_baseline": q_speed_with_baseline,
    "anomaly_windows": q_anomaly_windows,
    "anomalies": q_anomalies,
    "anomaly_alerts": q_anomaly_alerts,
    "speed_view_live": q_speed_view_live,
    "latest_per_route": q_latest_per_route,
    "serving_merge": q_serving_merge,
    "serving_merge_history": q_serving_merge_history,
    "verdict": q_verdict,
    "route_detail": q_route_detail,
    "live_summary": q_live_summary,
    "kpis": q_kpis,
    "top_delayed_enriched": q_top_delayed_enriched,
    "delay_label": q_delay_label,
    "delay_severity": q_delay_severity,
    "delta_label": q_delta_label,
    "relative_delay": q_relative_delay,
    "raw_json_scan": q_raw_json_scan,
    "archive_route_statistics": q_archive_route_statistics,
    "coerce_delay": q_coerce_delay,
    "decode_envelope": q_decode_envelope,
    "malformed_records": q_malformed_records,
    "flatten_trip_updates": q_flatten_trip_updates,
    "flatten_vehicle_positions": q_flatten_vehicle_positions,
    "ingest_union": q_ingest_union,
    "latency_report": q_latency_report,
    "throughput_report": q_throughput_report,
    "speedup_report": q_speedup_report,
    "stream_sliding_window": q_stream_sliding_window,
    "stream_tumbling_window": q_stream_tumbling_window,
    "stream_top_n": q_stream_top_n,
    "stream_anomalies": q_stream_anomalies,
    "microbatch_stats": q_microbatch_stats,
    "batch_counters": q_batch_counters,
    "stream_late_data": q_stream_late_data,
    "stream_late_report": q_stream_late_report,
    "stream_late_corrected": q_stream_late_corrected,
    "stream_open_windows": q_stream_open_windows,
    "stream_closed_windows": q_stream_closed_windows,
    "stream_closed_tumbling": q_stream_closed_tumbling,
    "fan_out_archive": q_fan_out_archive,
    "fan_out_quarantine": q_fan_out_quarantine,
    "fan_out_speed_view": q_fan_out_speed_view,
    "archive_between": q_archive_between,
    "published_route_statistics": q_published_route_statistics,
    "published_top_routes": q_published_top_routes,
    "incremental_batch_view": q_incremental_batch_view,
    "event_time_fallback": q_event_time_fallback,
    "served_rows": q_served_rows,
    "summary": q_summary,
    "throughput_elapsed": q_throughput_elapsed,
    "archive_raw": q_archive_raw,
}


def _utc(q: Query) -> Query:
    """Every query runs with the session zone pinned to UTC (all clocks are UTC)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return q(spark, sf_dir)

    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


QUERIES: dict[str, Query] = {name: _utc(q) for name, q in _QUERIES.items()}
