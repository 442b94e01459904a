"""Speed layer: event-time windows, top-N, baseline lookup and anomalies.

Every operator here is a batch twin of a streaming query in
``headway.streaming``; both use the same expressions, so replaying a log with
``availableNow`` gives the same rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.functions.columns import ts_literal


def duration_seconds(duration: str) -> int:
    """'5 minutes' / '30 seconds' / '6 hours' / '1 day' -> seconds."""
    value, unit = duration.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(value) * scale


def speed_events(events: DataFrame) -> DataFrame:
    """Rows the speed layer accepts (trip updates with a non-empty route and a delay)."""
    return events.filter(C.speed_filter())


def stat_columns(delay: str = "delay_seconds") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        F.avg(delay).alias("avg_delay_seconds"),
        F.max(delay).alias("max_delay_seconds"),
        F.sum(C.late_flag(delay)).cast("bigint").alias("late_count"),
    ]


def window_stats(events: DataFrame, as_of: datetime, size: str = C.WINDOW_SIZE) -> DataFrame:
    """Per-route statistics of the window ending at ``as_of``.

    Events with ``as_of - size <= event_ts <= as_of`` count (closed at both
    ends: the live process has no later rows yet; recorded data needs the
    upper bound).
    """
    end = ts_literal(as_of)
    start = ts_literal(as_of - timedelta(seconds=duration_seconds(size)))
    inside = (F.col("event_ts") >= start) & (F.col("event_ts") <= end)
    return (
        speed_events(events)
        .filter(inside)
        .groupBy("route_id")
        .agg(*stat_columns())
        .select(C.to_ntz(end).alias("window_end"), "route_id", "event_count",
                "avg_delay_seconds", "max_delay_seconds", "late_count")
    )


def pane_columns() -> list[Column]:
    """Mergeable statistics of one pane: count, exact sum, max, late count."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("delay_seconds").cast("bigint")).alias("s"),
        F.max("delay_seconds").alias("m"),
        F.sum(C.late_flag("delay_seconds")).cast("bigint").alias("l"),
    ]


def pane_aggregates(events: DataFrame, slide: str) -> DataFrame:
    """(route_id, pane_start, n, s, m, l) per slide-long pane of the speed events."""
    return speed_events(events).groupBy(
        "route_id", F.window("event_ts", slide).start.alias("pane_start")
    ).agg(*pane_columns())


def pane_window_starts(pane_start: Column, size: str, slide: str) -> Column:
    """Starts of the ``size / slide`` sliding windows that contain a pane (an array)."""
    k = duration_seconds(size) // duration_seconds(slide)
    step = duration_seconds(slide) * 1_000_000
    p = F.unix_micros(pane_start)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.timestamp_micros(p - i.cast("bigint") * F.lit(step).cast("bigint")))


def windows_from_panes(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Fan pane aggregates out to the windows covering them and merge (exact)."""
    fanned = panes.select("route_id", "n", "s", "m", "l",
                          F.explode(pane_window_starts(F.col("pane_start"), size, slide)).alias("window_start"))
    return fanned.groupBy("route_id", "window_start").agg(
        F.sum("n").alias("event_count"),
        (F.sum("s").cast("double") / F.sum("n")).alias("avg_delay_seconds"),
        F.max("m").alias("max_delay_seconds"),
        F.sum("l").cast("bigint").alias("late_count"),
    ).withColumn(
        "window_end",
        F.timestamp_micros(F.unix_micros("window_start") + F.lit(duration_seconds(size) * 1_000_000).cast("bigint")),
    )


def sliding_window_stats(
    events: DataFrame,
    size: str = C.WINDOW_SIZE,
    slide: str = C.WINDOW_SLIDE,
    pre_aggregate: bool = True,
) -> DataFrame:
    """Per-route statistics of every ``[start, start + size)`` window, sliding by ``slide``.

    With ``pre_aggregate`` (and ``size`` a multiple of ``slide``) events are
    first reduced to slide-long panes (count, exact sum, max, late count) and
    each pane is then fanned out to the ``size / slide`` windows covering it.
    The fan-out runs on pane aggregates instead of on every event, which at a
    high event rate removes the ``size / slide`` row expansion from the scan.
    The result is exact: mean = sum / count, max of maxima.
    """
    if pre_aggregate and duration_seconds(size) % duration_seconds(slide) == 0:
        out = windows_from_panes(pane_aggregates(events, slide), size, slide)
    else:
        out = (
            speed_events(events).groupBy("route_id", F.window("event_ts", size, slide).alias("w"))
            .agg(*stat_columns())
            .select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
        )
    return out.select(
        C.to_ntz("window_start").alias("window_start"),
        C.to_ntz("window_end").alias("window_end"),
        "route_id", "event_count", "avg_delay_seconds", "max_delay_seconds", "late_count",
    )


def tumbling_window_avg(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Per-route mean delay in fixed, non-overlapping windows."""
    return (
        speed_events(events)
        .groupBy("route_id", F.window("event_ts", size).alias("w"))
        .agg(
            F.avg("delay_seconds").alias("avg_delay_seconds"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .select(
            C.to_ntz("w.start").alias("window_start"),
            C.to_ntz("w.end").alias("window_end"),
            "route_id", "avg_delay_seconds", "event_count",
        )
    )


def _ranked(stats: DataFrame) -> Column:
    return F.row_number().over(
        Window.partitionBy("window_end").orderBy(F.desc("avg_delay_seconds"), F.asc("route_id"))
    )


def _top_list_columns() -> list[Column]:
    return [
        "window_end",
        F.col("rank").cast("int").alias("rank"),
        "route_id",
        C.half_even("avg_delay_seconds", 1).alias("avg_delay_seconds"),
        "max_delay_seconds",
        "event_count",
    ]


def top_delayed_live(events: DataFrame, as_of: datetime, size: str = C.WINDOW_SIZE,
                     n: int = C.TOP_N) -> DataFrame:
    """The ``n`` routes with the highest mean delay in the window ending at ``as_of``.

    ``orderBy().limit()`` becomes a per-task top-k (TakeOrderedAndProject);
    the rank is numbered on the ``n`` surviving rows only.
    """
    top = window_stats(events, as_of, size).orderBy(
        F.desc("avg_delay_seconds"), F.asc("route_id")
    ).limit(n)
    return top.withColumn("rank", _ranked(top)).select(*_top_list_columns())


def top_n_snapshot(windows: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """Ranked top-``n`` routes of every window (one row per window and rank).

    ``row_number() <= n`` is planned as a window group limit, so each task
    keeps only ``n`` rows per window before the shuffle.
    """
    return (
        windows.withColumn("rank", _ranked(windows))
        .filter(F.col("rank") <= n)
        .select(*_top_list_columns())
    )


def top_n_lists(snapshot_rows: DataFrame) -> DataFrame:
    """Stored form of the snapshot: one row per window with an ordered array."""
    return snapshot_rows.groupBy("window_end").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("rank"), F.col("route_id"), F.col("avg_delay_seconds"),
                    F.col("max_delay_seconds"), F.col("event_count"),
                )
            )
        ).alias("top_routes")
    )


def top_n_json(snapshot_rows: DataFrame) -> DataFrame:
    """Snapshot as stored for the dashboard: one row per window, the list as JSON text."""
    lists = top_n_lists(snapshot_rows)
    return lists.select("window_end", F.to_json("top_routes").alias("top_routes"))


TOP_LIST = ("array<struct<rank:int,route_id:string,avg_delay_seconds:double,"
            "max_delay_seconds:int,event_count:bigint>>")


def parse_top_n_json(json_rows: DataFrame) -> DataFrame:
    """Stored JSON lists back to one row per entry (an empty or missing list gives no row)."""
    return _entries(json_rows.select("window_end", F.from_json("top_routes", TOP_LIST).alias("l")), "l")


def _newest_list(lists: DataFrame, as_of: datetime | None, value: str) -> DataFrame:
    """The newest stored list at or before ``as_of`` as one row (none if there is none).

    A global ``max_by`` is combined per task before its single final step, so
    only one row per task moves, whatever the number of windows.
    """
    if as_of is not None:
        lists = lists.filter(F.col("window_end") <= C.to_ntz(ts_literal(as_of)))
    newest = lists.agg(F.max_by(F.struct("window_end", value), "window_end").alias("s"))
    return newest.select(F.col("s.window_end").alias("window_end"), F.col(f"s.{value}").alias(value))


def _entries(rows: DataFrame, array: str) -> DataFrame:
    return rows.select("window_end", F.explode(array).alias("e")).select(
        "window_end", "e.rank", "e.route_id", "e.avg_delay_seconds", "e.max_delay_seconds",
        "e.event_count")


def latest_snapshot(snapshot_rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Entries of the newest snapshot at or before ``as_of`` (no rows if there is none).

    One pass: one list per window (at most ``n`` entries), the newest list,
    then its entries; no join of the snapshot with itself.
    """
    return _entries(_newest_list(top_n_lists(snapshot_rows), as_of, "top_routes"), "top_routes")


def latest_snapshot_from_json(json_rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """As :func:`latest_snapshot`, from the stored JSON form: newest row, parsed, exploded."""
    newest = _newest_list(json_rows, as_of, "top_routes")
    return _entries(newest.select("window_end", F.from_json("top_routes", TOP_LIST).alias("l")), "l")


def top_delayed_n(snapshot_rows: DataFrame, n: int, as_of: datetime | None = None) -> DataFrame:
    """First ``n`` entries of the newest snapshot (never more than stored)."""
    return latest_snapshot(snapshot_rows, as_of).filter(F.col("rank") <= n)


def flagged_columns(mean: str, baseline: str, threshold: float = C.ANOMALY_RATIO) -> list[Column]:
    """Rounded mean, baseline and ratio of a window, and whether it is anomalous."""
    ratio = C.anomaly_ratio(mean, baseline)
    return [
        C.half_even(mean, 2).alias("avg_delay_seconds"),
        C.half_even(baseline, 2).alias("batch_baseline_seconds"),
        C.half_even(ratio, 2).alias("anomaly_ratio"),
        C.is_anomaly(ratio, threshold).alias("is_anomaly"),
    ]


def speed_with_baseline(windows: DataFrame, baseline: DataFrame,
                        threshold: float = C.ANOMALY_RATIO) -> DataFrame:
    """Attach the historical mean of the bucket of ``window_end`` and flag anomalies.

    The baseline is (route, 168 buckets) and small; the join carries no hint:
    AQE measures the materialised baseline and broadcasts it only when it is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else it keeps a
    shuffled join.
    """
    keyed = windows.withColumn("time_bucket", C.time_bucket("window_end"))
    joined = keyed.join(
        baseline.select("route_id", "time_bucket",
                        F.col("avg_delay_seconds").alias("baseline")),
        ["route_id", "time_bucket"],
        "left",
    )
    mean, *flags = flagged_columns("avg_delay_seconds", "baseline", threshold)
    return joined.select("window_start", "window_end", "route_id", "time_bucket", "event_count", mean,
                         "max_delay_seconds", "late_count", *flags)


def anomaly_windows(speed_rows: DataFrame) -> DataFrame:
    """Every (window, route) whose live mean exceeds the threshold."""
    return speed_rows.filter(F.col("is_anomaly"))


def speed_view_live(speed_rows: DataFrame, as_of: datetime) -> DataFrame:
    """Rows of the speed view still alive at ``as_of`` (TTL one hour after the window end)."""
    return speed_rows.withColumn("ttl", C.ttl_of(F.col("window_end").cast("timestamp"))).filter(
        (F.col("ttl") > F.unix_timestamp(ts_literal(as_of)))
        & (F.col("window_end") <= C.to_ntz(ts_literal(as_of)))
    )
