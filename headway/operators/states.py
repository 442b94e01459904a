"""Everything that is served about a route, from one scan of its events.

The serving queries need three things of each route: its newest live window, the
historical mean of the bucket that window falls in, and that of the current bucket.
Computed from separate views they read the events once for each. Here one
conditional aggregate reduces history to hours of the week and live events to panes
in the same pass; those few rows of a route are then reduced to one.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.functions.columns import ts_literal
from headway.operators.serving import SPEED_FIELDS, kpi_tiles, with_verdict
from headway.operators.speed import duration_seconds, flagged_columns, pane_columns

MICROS = 1_000_000


def hour_of_week(ts: Column) -> Column:
    """The (weekday, hour) of a time as one number."""
    return F.dayofweek(ts) * 24 + F.hour(ts)


def _floor_to(micros: Column, step: int) -> Column:
    step = F.lit(step).cast("bigint")
    return micros - F.pmod(micros, step)


def route_slots(events: DataFrame, since: datetime, as_of: datetime, size: str, slide: str,
                closed: bool = False) -> DataFrame:
    """(route_id, hour, pane, n, s, m, l): history before ``since`` by hour of the week, live events by pane.

    ``hour`` is NULL for live rows, ``pane`` (its start in microseconds) for history.
    A record counts by the batch layer's filter before ``since`` and by the speed
    layer's from then on. Panes are as long as the greatest common divisor of ``size``
    and ``slide``, so every window is a run of whole panes. With ``closed``, ``w_n`` and
    ``w_s`` count and sum what lies in ``[as_of - size, as_of]``, both ends included.
    """
    step = math.gcd(duration_seconds(size), duration_seconds(slide)) * MICROS
    ts = F.col("event_ts")
    past = ts < ts_literal(since)
    rows = events.filter(ts <= ts_literal(as_of) if closed else ts < ts_literal(as_of)).filter(
        F.when(past, C.batch_filter()).otherwise(C.speed_filter()))
    columns = pane_columns()
    if closed:
        start = as_of - timedelta(seconds=duration_seconds(size))
        inside = (ts >= ts_literal(start)) & C.speed_filter()
        columns += [F.count_if(inside).alias("w_n"),
                    F.sum(F.when(inside, F.col("delay_seconds").cast("bigint"))).alias("w_s")]
    return rows.groupBy(
        "route_id", F.when(past, hour_of_week(ts)).alias("hour"),
        F.when(~past, _floor_to(F.unix_micros(ts), step)).alias("pane"),
    ).agg(*columns)


def route_states(events: DataFrame, since: datetime, as_of: datetime, size: str = C.WINDOW_SIZE,
                 slide: str = C.WINDOW_SLIDE, closed: bool = False) -> DataFrame:
    """One row for each route with a live window that ends by ``as_of`` or a baseline in its bucket.

    Columns: ``route_id``, ``time_bucket`` (of ``as_of``), the speed row of the newest
    window (NULL without one), its unrounded ``live_mean``, ``has_speed``, ``has_batch``,
    ``historical_avg_delay_seconds`` of the current bucket, and with ``closed`` the
    ``window_mean`` of ``[as_of - size, as_of]``. Windows must not be shorter than the slide.
    """
    long, step = duration_seconds(size) * MICROS, duration_seconds(slide) * MICROS
    if long < step:
        raise ValueError("a window must be at least as long as the slide")
    slots = route_slots(events, since, as_of, size, slide, closed)
    last_end = _floor_to(F.unix_micros(ts_literal(as_of)) - F.lit(long).cast("bigint"), step) + F.lit(long).cast("bigint")
    pane = F.col("pane")
    newest = F.max(F.when(pane < last_end, pane)).over(Window.partitionBy("route_id"))
    # NULL without a live pane; least() would pass over it
    end = F.when(F.col("newest").isNotNull(), F.least(last_end, _floor_to(F.col("newest"), step) + F.lit(long).cast("bigint")))
    rows = slots.withColumn("newest", newest).withColumn("end", end)
    inside = (pane >= F.col("end") - F.lit(long).cast("bigint")) & (pane < F.col("end"))
    of_window = F.col("hour") == hour_of_week(F.timestamp_micros("end"))
    of_now = F.col("hour") == hour_of_week(ts_literal(as_of))

    def mean(part: Column) -> Column:
        return F.sum(F.when(part, F.col("s"))).cast("double") / F.sum(F.when(part, F.col("n")))

    columns = [
        F.max("end").alias("end"),
        F.sum(F.when(inside, F.col("n"))).alias("event_count"),
        mean(inside).alias("live_mean"),
        F.max(F.when(inside, F.col("m"))).alias("max_delay_seconds"),
        F.sum(F.when(inside, F.col("l"))).alias("late_count"),
        mean(of_window).alias("baseline"),
        mean(of_now).alias("historical_avg_delay_seconds"),
    ]
    if closed:
        columns.append((F.sum("w_s").cast("double") / F.nullif(F.sum("w_n"), F.lit(0))).alias("window_mean"))
    states = rows.groupBy("route_id").agg(*columns)
    has_speed = F.col("end").isNotNull()
    out = states.select(
        "route_id", C.time_bucket(ts_literal(as_of)).alias("time_bucket"), "live_mean",
        C.to_ntz(F.timestamp_micros(F.col("end") - F.lit(long).cast("bigint"))).alias("window_start"),
        C.to_ntz(F.timestamp_micros("end")).alias("window_end"), "event_count", "max_delay_seconds", "late_count",
        *flagged_columns("live_mean", "baseline"),
        has_speed.alias("has_speed"), F.col("historical_avg_delay_seconds").isNotNull().alias("has_batch"),
        "historical_avg_delay_seconds", *(["window_mean"] if closed else []),
    ).withColumn("is_anomaly", F.when(F.col("has_speed"), F.col("is_anomaly")))
    kept = F.col("has_speed") | F.col("has_batch")
    return out.filter(kept | F.col("window_mean").isNotNull() if closed else kept)


def newest_windows(states: DataFrame) -> DataFrame:
    """Speed row of each route's newest window."""
    return states.filter("has_speed").select("route_id", *SPEED_FIELDS)


def merged_states(states: DataFrame) -> DataFrame:
    """The merged row of each route: newest live window against the current bucket."""
    merged = with_verdict(states.filter(F.col("has_speed") | F.col("has_batch"))
                          .withColumnRenamed("avg_delay_seconds", "live_avg_delay_seconds"))
    return merged.select(
        "route_id", "time_bucket", F.col("window_end").alias("speed_window_end"), "live_avg_delay_seconds",
        F.col("event_count").alias("live_event_count"), "is_anomaly", "historical_avg_delay_seconds",
        "delta_vs_historical", "verdict",
    )


def served_states(states: DataFrame, as_of: datetime, size: str = C.WINDOW_SIZE) -> DataFrame:
    """The merged row as it is served: all fields of both sides, and the time of the merge."""
    live = states.filter(F.col("has_speed") | F.col("has_batch")).select(
        "route_id", "time_bucket", *[F.col(f).alias(f"live_{f}") for f in SPEED_FIELDS],
        F.when(F.col("has_speed"), F.lit(duration_seconds(size) / 60)).alias("live_window_size_minutes"),
        "historical_avg_delay_seconds", "has_speed", "has_batch")
    return with_verdict(live).drop("has_speed", "has_batch").withColumn("merged_at", C.to_ntz(ts_literal(as_of)))


def state_kpis(states: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """Dashboard tiles from the states of a closed window."""
    return kpi_tiles(states.withColumn("avg_delay_seconds", F.col("window_mean")),
                     F.col("window_mean").isNotNull(), F.coalesce(F.col("is_anomaly"), F.lit(False)), n)


def enriched_top(states: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """The newest top list with each route's delta against history.

    The newest window with data is the newest of any route, so the list is the first
    ``n`` routes by window end and mean, of which those of an older window are left out.
    """
    merged = with_verdict(states.filter("has_speed").withColumnRenamed("avg_delay_seconds", "live_avg_delay_seconds"))
    top = merged.orderBy(F.desc("window_end"), F.desc("live_mean"), F.asc("route_id")).limit(n)
    order = Window.orderBy(F.desc("window_end"), F.desc("live_mean"), F.asc("route_id"))      # of n rows
    top = top.withColumn("rank", F.row_number().over(order)).withColumn("first", F.first("window_end").over(order))
    return top.filter(F.col("window_end") == F.col("first")).select(
        "window_end", F.col("rank").cast("int").alias("rank"), "route_id",
        C.half_even("live_mean", 1).alias("avg_delay_seconds"), "max_delay_seconds", "event_count",
        "delta_vs_historical", "verdict", C.delta_label("delta_vs_historical").alias("delta_label"))
