"""Serving layer: merge the live and the historical view into one verdict per route."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.functions.columns import ts_literal
from headway.operators.speed import duration_seconds, latest_snapshot

SPEED_FIELDS = (
    "window_start", "window_end", "event_count", "avg_delay_seconds", "max_delay_seconds",
    "late_count", "batch_baseline_seconds", "anomaly_ratio", "is_anomaly",
)


def latest_per_route(speed_rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Newest speed-view row of every route (at or before ``as_of``).

    ``max_by`` is an ordinary aggregate: it is combined map-side, so even a
    route holding a third of all rows costs one row per task in the shuffle.
    """
    rows = speed_rows
    if as_of is not None:
        rows = rows.filter(F.col("window_end") <= C.to_ntz(ts_literal(as_of)))
    fields = [f for f in SPEED_FIELDS if f in rows.columns]
    newest = rows.groupBy("route_id").agg(
        F.max_by(F.struct(*fields), F.col("window_end")).alias("r")
    )
    return newest.select("route_id", *[F.col(f"r.{f}").alias(f) for f in fields])


def with_verdict(rows: DataFrame, has_speed: str = "has_speed", has_batch: str = "has_batch") -> DataFrame:
    """Delta and verdict of rows with both sides' means and presence flags.

    Presence is a flag, not inferred from a NULL mean: a present side whose mean is
    missing counts as 0, as in the reference. The verdict is on the unrounded delta.
    """
    has_s, has_b = F.coalesce(F.col(has_speed), F.lit(False)), F.coalesce(F.col(has_batch), F.lit(False))
    delta = F.coalesce(F.col("live_avg_delay_seconds"), F.lit(0.0)) - F.coalesce(
        F.col("historical_avg_delay_seconds"), F.lit(0.0)
    )
    delta = F.when(has_s & has_b, delta)
    return rows.withColumn("delta", delta).withColumn(
        "verdict", C.verdict(has_s, has_b, F.col("delta"))
    ).withColumn("delta_vs_historical", C.half_even("delta", 1)).drop("delta")


def _merge(speed: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge with presence flags."""
    s = speed.withColumn("_has_speed", F.lit(True))
    b = batch.withColumn("_has_batch", F.lit(True))
    return with_verdict(s.join(b, keys, "full"), "_has_speed", "_has_batch").drop("_has_speed", "_has_batch")


def serving_merge(speed_rows: DataFrame, baseline: DataFrame, as_of: datetime) -> DataFrame:
    """One merged row per route: its newest live window against the current bucket.

    Only the current bucket of the baseline is read, 1/168 of it.
    """
    bucket = C.time_bucket(ts_literal(as_of))
    live = latest_per_route(speed_rows, as_of).select(
        "route_id",
        bucket.alias("time_bucket"),
        F.col("window_end").alias("speed_window_end"),
        F.col("avg_delay_seconds").alias("live_avg_delay_seconds"),
        F.col("event_count").alias("live_event_count"),
        "is_anomaly",
    )
    # one bucket of the baseline, filtered at its scan
    hist = baseline.filter(F.col("time_bucket") == bucket).select(
        "route_id", "time_bucket", F.col("avg_delay_seconds").alias("historical_avg_delay_seconds")
    )
    merged = _merge(live, hist, ["route_id", "time_bucket"])
    return merged.select(
        "route_id", "time_bucket", "speed_window_end", "live_avg_delay_seconds",
        "live_event_count", "is_anomaly", "historical_avg_delay_seconds",
        "delta_vs_historical", "verdict",
    )


def serving_merge_history(speed_rows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Verdict for every live window (bulk form of the merge).

    Keyed on (route_id, bucket of window_end); a baseline bucket that no live
    window hits comes out as HISTORICAL_ONLY_NO_LIVE_DATA.
    """
    live = speed_rows.select(
        "route_id", "time_bucket", "window_end",
        F.col("avg_delay_seconds").alias("live_avg_delay_seconds"),
        F.col("event_count").alias("live_event_count"),
    )
    hist = baseline.select(
        "route_id", "time_bucket", F.col("avg_delay_seconds").alias("historical_avg_delay_seconds")
    )
    merged = _merge(live, hist, ["route_id", "time_bucket"])
    return merged.select(
        "route_id", "time_bucket", "window_end", "live_avg_delay_seconds", "live_event_count",
        "historical_avg_delay_seconds", "delta_vs_historical", "verdict",
    )


def served_rows(speed_rows: DataFrame, baseline: DataFrame, as_of: datetime, size: str = C.WINDOW_SIZE) -> DataFrame:
    """The merged row as it is served: all fields of both sides, and the time of the merge."""
    bucket = C.time_bucket(ts_literal(as_of))
    live = latest_per_route(speed_rows, as_of)
    live = live.select("route_id", bucket.alias("time_bucket"),
                       *[F.col(f).alias(f"live_{f}") for f in SPEED_FIELDS if f in live.columns],
                       F.lit(duration_seconds(size) / 60).alias("live_window_size_minutes"))
    hist = baseline.filter(F.col("time_bucket") == bucket).select(
        "route_id", "time_bucket", F.col("avg_delay_seconds").alias("historical_avg_delay_seconds"))
    return _merge(live, hist, ["route_id", "time_bucket"]).withColumn("merged_at", C.to_ntz(ts_literal(as_of)))


def summary(window: DataFrame, as_of: datetime, n: int = C.TOP_N) -> DataFrame:
    """One row: the time, the length of the current top list, and its first element in full."""
    first = F.struct("route_id", "avg_delay_seconds", "max_delay_seconds", "event_count")
    row = window.agg(F.least(F.count(F.lit(1)), F.lit(n)).cast("int").alias("live_routes_tracked"),
                     F.min_by(first, _top_of()).alias("top"))
    return row.select(
        C.to_ntz(ts_literal(as_of)).alias("as_of"), "live_routes_tracked",
        F.when(F.col("top").isNotNull(), F.lit(1)).alias("top_rank"), F.col("top.route_id").alias("top_route_id"),
        C.half_even("top.avg_delay_seconds", 1).alias("top_avg_delay_seconds"),
        F.col("top.max_delay_seconds").alias("top_max_delay_seconds"), F.col("top.event_count").alias("top_event_count"),
        F.lit("operational").alias("system_status"))


def route_detail(speed_rows: DataFrame, baseline: DataFrame, as_of: datetime,
                 route_id: str) -> DataFrame:
    """Merged row of one route; the route filter is pushed into both inputs."""
    speed = speed_rows.filter(F.col("route_id") == route_id)
    base = baseline.filter(F.col("route_id") == route_id)
    return serving_merge(speed, base, as_of)


def current_anomalies(speed_rows: DataFrame, as_of: datetime) -> DataFrame:
    """Routes whose newest live window is flagged anomalous."""
    latest = latest_per_route(speed_rows, as_of)
    return latest.filter(F.col("is_anomaly")).select(
        "route_id", "window_end", "event_count", "avg_delay_seconds",
        "batch_baseline_seconds", "anomaly_ratio",
    )


def anomaly_alerts(anomalies: DataFrame, n: int = 6) -> DataFrame:
    """The first ``n`` alerts, strongest ratio first, with their display text."""
    top = anomalies.orderBy(F.desc("anomaly_ratio"), F.asc("route_id")).limit(n)
    return top.select(
        "route_id", "avg_delay_seconds", "event_count", "anomaly_ratio",
        # one decimal, ties up (as the dashboard's toFixed(1) shows it)
        (F.floor(F.col("anomaly_ratio") * 10 + 0.5) / 10).alias("ratio_display"),
        C.delay_label("avg_delay_seconds").alias("avg_delay_label"),
    )


def _top_of(avg: str = "avg_delay_seconds", route: str = "route_id"):
    """Order key of the top list: highest mean first, then route_id (min_by picks rank 1)."""
    return F.struct((-F.col(avg)).alias("neg_avg"), F.col(route).alias("route"))


def live_summary(window: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """One row: routes in the current window, size of the top list, top route and its mean.

    ``window`` is the per-route statistics of the current window; one
    aggregate computes every field (no join of single-row results).
    """
    return window.agg(
        F.count(F.lit(1)).alias("routes_in_window"),
        F.least(F.count(F.lit(1)), F.lit(n)).cast("int").alias("top_list_size"),
        F.min_by("route_id", _top_of()).alias("top_route_id"),
        C.half_even(F.min_by("avg_delay_seconds", _top_of()), 1).alias("top_route_avg_delay_seconds"),
    )


def kpis(window: DataFrame, anomalies: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """Dashboard tiles: top route and its delay text, routes tracked, active anomalies.

    Both inputs are stacked and reduced by one aggregate with conditional
    parts, so the tiles come from a single pass and no join.
    """
    w = window.select("route_id", "avg_delay_seconds", F.lit(False).alias("_anomaly"))
    a = anomalies.select("route_id", F.lit(None).cast("double").alias("avg_delay_seconds"),
                         F.lit(True).alias("_anomaly"))
    return kpi_tiles(w.unionByName(a), ~F.col("_anomaly"), F.col("_anomaly"), n)


def kpi_tiles(rows: DataFrame, live: Column, anomaly: Column, n: int = C.TOP_N) -> DataFrame:
    """The tiles of rows that are ``live`` (in the current window) or an ``anomaly``."""
    top_key = F.when(live, _top_of())
    head = rows.agg(
        F.min_by(F.when(live, F.col("route_id")), top_key).alias("top_route_id"),
        C.half_even(F.min_by(F.when(live, F.col("avg_delay_seconds")), top_key), 1)
        .alias("top_avg_delay_seconds"),
        F.least(F.count_if(live), F.lit(n)).alias("routes_tracked"),
        F.count_if(anomaly).alias("active_anomalies"),
    )
    return head.withColumn("top_delay_label", C.delay_label("top_avg_delay_seconds"))


def top_delayed_enriched(snapshot_rows: DataFrame, merged: DataFrame,
                         as_of: datetime | None = None) -> DataFrame:
    """Newest top list with each route's delta against history (dashboard table)."""
    latest = latest_snapshot(snapshot_rows, as_of)
    delta = merged.select("route_id", "delta_vs_historical", "verdict")
    return latest.join(delta, "route_id", "left").select(
        "window_end", "rank", "route_id", "avg_delay_seconds", "max_delay_seconds",
        "event_count", "delta_vs_historical", "verdict",
        C.delta_label("delta_vs_historical").alias("delta_label"),
    )


def relative_delay(snapshot_rows: DataFrame) -> DataFrame:
    """Bar length of every top-list entry relative to the worst route of its list."""
    from pyspark.sql import Window

    worst = F.max(F.coalesce(F.col("avg_delay_seconds"), F.lit(0.0))).over(
        Window.partitionBy("window_end")
    )
    return snapshot_rows.select(
        "window_end", "rank", "route_id", "avg_delay_seconds",
        F.when(worst > 0, C.js_round(F.col("avg_delay_seconds") / worst * 120))
        .otherwise(F.lit(4)).cast("int").alias("bar_px"),
    )


def delay_labels(rows: DataFrame, value: str = "avg_delay_seconds") -> DataFrame:
    """Label and severity of a delay column."""
    return rows.withColumn("delay_label", C.delay_label(value)).withColumn(
        "delay_severity", C.delay_severity(value)
    )
