"""Batch layer: delay statistics over the archived history.

All operators are DataFrame -> DataFrame and lazy. Aggregations are plain
``groupBy().agg()`` so Spark runs a map-side partial aggregate before the
shuffle (the shuffle carries one row per key and task, not one per event).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import columns as C

TOP_ROUTES = 20


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``event_ts`` parsed from ``ingestion_time`` unless already present."""
    if "event_ts" in df.columns:
        return df
    return df.withColumn("event_ts", C.parse_event_time("ingestion_time"))


def clean_events(raw: DataFrame) -> DataFrame:
    """Records with a route and a delay, plus weekday and hour of the event.

    A record whose time cannot be parsed is kept, with NULL weekday and hour.
    The empty route ``''`` is kept (only the speed layer drops it).
    """
    df = with_event_time(raw).filter(C.batch_filter())
    return df.withColumn("day_of_week", C.day_of_week("event_ts")).withColumn(
        "hour_of_day", C.hour_of_day("event_ts")
    )


def input_counts(raw: DataFrame) -> DataFrame:
    """One row: records read, records kept by the batch filter, records dropped."""
    kept = F.count_if(C.batch_filter())
    return raw.agg(
        F.count(F.lit(1)).alias("raw_records"),
        kept.alias("clean_records"),
        (F.count(F.lit(1)) - kept).alias("dropped_records"),
    )


def route_bucket_partials(clean: DataFrame) -> DataFrame:
    """Mergeable partial aggregate per (route, weekday, hour): sum, max, count.

    Integers are summed exactly as BIGINT; the mean derived from it is the
    same double Spark's ``avg`` gives for an INT column, and the route totals
    can be derived from these rows without a second scan of the input.
    """
    return clean.groupBy("route_id", "day_of_week", "hour_of_day").agg(
        F.sum(F.col("delay_seconds").cast("bigint")).alias("sum_delay"),
        F.max("delay_seconds").alias("max_delay"),
        F.count(F.lit(1)).alias("observations"),
    )


def statistics_from_partials(partials: DataFrame) -> DataFrame:
    return partials.select(
        "route_id",
        "day_of_week",
        "hour_of_day",
        (F.col("sum_delay").cast("double") / F.col("observations")).alias("avg_delay"),
        "max_delay",
        "observations",
    )


def route_statistics(clean: DataFrame) -> DataFrame:
    """Mean, max and count of delay per route, weekday and hour of day."""
    return statistics_from_partials(route_bucket_partials(clean))


def rank_routes(totals: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    """Most delayed first; equal means ordered by route_id (deterministic)."""
    return totals.orderBy(F.desc("average_delay"), F.asc("route_id")).limit(n)


def top_delayed_routes(clean: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    """The ``n`` routes with the highest mean delay over the whole history."""
    totals = clean.groupBy("route_id").agg(
        F.avg("delay_seconds").alias("average_delay"),
        F.count(F.lit(1)).alias("records"),
    )
    return rank_routes(totals, n)


def top_routes_from_partials(partials: DataFrame, n: int = TOP_ROUTES) -> DataFrame:
    """Same result as :func:`top_delayed_routes`, from the bucket partials."""
    totals = partials.groupBy("route_id").agg(
        (F.sum("sum_delay").cast("double") / F.sum("observations")).alias("average_delay"),
        F.sum("observations").alias("records"),
    )
    return rank_routes(totals, n)


def batch_view(route_stats: DataFrame) -> DataFrame:
    """Key-value baseline (route_id, time_bucket) -> avg_delay_seconds.

    Rows whose time could not be parsed have no bucket and cannot be looked
    up, so they are left out.
    """
    return route_stats.filter(
        F.col("day_of_week").isNotNull() & F.col("hour_of_day").isNotNull()
    ).select(
        "route_id",
        F.concat(
            F.col("day_of_week"), F.lit("_"), F.lpad(F.col("hour_of_day").cast("string"), 2, "0")
        ).alias("time_bucket"),
        F.col("avg_delay").alias("avg_delay_seconds"),
    )


def batch_delay_history(route_stats: DataFrame) -> DataFrame:
    """Route statistics under the column names of the external history table.

    No static route catalogue is ever loaded, so ``route_short_name`` is NULL.
    """
    return route_stats.select(
        "route_id",
        F.lit(None).cast("string").alias("route_short_name"),
        F.concat(
            F.col("day_of_week"), F.lit("_"), F.lpad(F.col("hour_of_day").cast("string"), 2, "0")
        ).alias("time_bucket"),
        F.col("avg_delay").alias("avg_delay_seconds"),
        F.col("max_delay").cast("double").alias("max_delay_seconds"),
        F.col("observations").alias("trip_count"),
        "day_of_week",
        "hour_of_day",
    )


def event_time_buckets(clean: DataFrame) -> DataFrame:
    """Per event: its ``<Weekday>_<HH>`` bucket (the key shared with the speed layer)."""
    return clean.select(
        "event_id", "route_id", C.to_ntz("event_ts").alias("event_ts"),
        C.time_bucket("event_ts").alias("time_bucket"),
    )
