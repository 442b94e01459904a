"""Delay events derived from the provided ``events`` table.

The provided test data has no transit feed, so a fixed column mapping turns
each ``events`` row into one feed record (trip update, or vehicle position for
``view`` rows). The mapping is written once here and once in the SQL oracle.
Vehicle-position rows carry no delay, exactly like the real feed, so the
batch layer's not-null filter removes them.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.columns import TRIP_UPDATES, VEHICLE_POSITIONS, ts_literal
from headway.schemas import EVENTS
from headway.session import ensure_utc

# Fixed split of the recorded data into the batch layer's history and the
# live part the speed layer sees; and the fixed evaluation instant.
HISTORY_UNTIL = datetime(2024, 1, 24, 0, 0, 0)
AS_OF = datetime(2024, 1, 28, 12, 0, 0)
ROUTES = 12                      # route_id = 'R' || lpad(user_id % 12, 2, '0')


DECLARED = {"events": EVENTS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; declared schemas skip the footer read at planning time."""
    reader = spark.read.schema(DECLARED[name]) if name in DECLARED else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _route(user_id: Column) -> Column:
    return F.concat(F.lit("R"), F.lpad((user_id % F.lit(ROUTES)).cast("string"), 2, "0"))


def events_to_delay_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows onto the flat delay-event schema (plus ``event_ts``)."""
    is_vehicle = F.col("event_type") == F.lit("view")
    event_ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingestion_time"),
        event_ts.alias("event_ts"),
        _route(F.col("user_id")).alias("route_id"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("trip_id"),
        F.get_json_object("props", "$.k").cast("int").alias("stop_sequence"),
        F.when(~is_vehicle, (F.floor(F.col("value") * 4) - 60).cast("int")).alias("delay_seconds"),
        F.when(is_vehicle, F.lit(VEHICLE_POSITIONS)).otherwise(F.lit(TRIP_UPDATES)).alias("source"),
    )


def delay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feed records of a data directory (trip updates and vehicle rows)."""
    ensure_utc(spark)
    return events_to_delay_events(table(spark, sf_dir, "events"))


def _ntz_literal(when: datetime) -> Column:
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def history_events(spark: SparkSession, sf_dir: str, until: datetime = HISTORY_UNTIL) -> DataFrame:
    """Records the batch layer has archived (event time before ``until``).

    The bound is applied to the stored column so it reaches the Parquet scan
    as a pushed filter (row-group skipping).
    """
    ensure_utc(spark)
    events = table(spark, sf_dir, "events").filter(F.col("ts") < _ntz_literal(until))
    return events_to_delay_events(events)


def live_events(spark: SparkSession, sf_dir: str, since: datetime = HISTORY_UNTIL) -> DataFrame:
    """Records that arrive after the last batch run (the speed layer's input)."""
    ensure_utc(spark)
    events = table(spark, sf_dir, "events").filter(F.col("ts") >= _ntz_literal(since))
    return events_to_delay_events(events)


# -- derived raw inputs ----------------------------------------------------------
# The same events, in the shapes the pipeline receives them: JSON lines as the
# log delivers them, base64 envelopes, and decoded nested feed messages. The
# event type decides the encoding, so every rule of the parsers is exercised
# at the scale of the table:
#   click    -> trip update, delay as a JSON integer
#   purchase -> trip update, delay as JSON text ("45")
#   error    -> trip update, delay as a JSON fraction (value * 4 - 60)
#   signup   -> trip update line cut short (malformed JSON)
#   view     -> vehicle position (no delay)

def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text line per event (column ``value``)."""
    ensure_utc(spark)
    return raw_lines_from(table(spark, sf_dir, "events"))


def raw_lines_from(ev: DataFrame) -> DataFrame:
    """:func:`raw_lines` of an ``events``-shaped frame (batch or streaming)."""
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    d_int = (F.floor(F.col("value") * 4) - 60).cast("int")
    route = _route(F.col("user_id"))
    trip = F.concat(F.lit("T"), F.col("user_id").cast("string"))
    trip_json = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        _iso(ts).alias("ingestion_time"),
        route.alias("route_id"),
        trip.alias("trip_id"),
        k.alias("stop_sequence"),
        F.concat(F.lit("S"), k.cast("string")).alias("stop_id"),
        F.date_format(ts, "yyyyMMdd").alias("start_date"),
        F.lit(0).alias("schedule_relationship"),
        F.lit(TRIP_UPDATES).alias("source"),
    ))
    delay_text = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('"'), d_int.cast("string"), F.lit('"')))
        .when(F.col("event_type") == "error", (F.col("value") * 4 - 60).cast("string"))
        .otherwise(d_int.cast("string"))
    )
    with_delay = F.concat(
        F.expr("substring(tj, 1, length(tj) - 1)"), F.lit(',"delay_seconds":'), delay_text, F.lit("}")
    )
    vehicle_json = F.to_json(F.struct(
        F.concat(F.lit("vp_"), F.col("event_id").cast("string")).alias("event_id"),
        _iso(ts).alias("ingestion_time"),
        route.alias("route_id"),
        trip.alias("trip_id"),
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.lit(VEHICLE_POSITIONS).alias("source"),
    ))
    return ev.withColumn("tj", trip_json).select(
        F.when(F.col("event_type") == "view", vehicle_json)
        .when(F.col("event_type") == "signup", F.expr("substring(tj, 1, length(tj) - 1)"))
        .otherwise(with_delay)
        .alias("value")
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each JSON line wrapped as a delivered record: ``{"Records":[{"kinesis":{"data":b64}}]}``."""
    return envelopes_from(raw_lines(spark, sf_dir))


def envelopes_from(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.to_json(F.struct(F.array(F.struct(F.struct(
            F.base64(F.encode("value", "UTF-8")).alias("data")).alias("kinesis"))).alias("Records")
        )).alias("value")
    )


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One decoded feed message per event, with one entity.

    click: departure and arrival present (departure wins); purchase: arrival
    only; error: departure present with its delay unset (counts as 0);
    signup: neither (the stop update yields no record); view: vehicle entity.
    """
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    d_int = (F.floor(F.col("value") * 4) - 60).cast("int")
    delay = lambda c: F.struct(c.alias("delay"))
    no_delay = F.lit(None).cast("struct<delay:int>")
    arrival = F.when(et == "click", delay(d_int - 30)).when(et == "purchase", delay(d_int)).otherwise(no_delay)
    departure = (F.when(et == "click", delay(d_int))
                 .when(et == "error", delay(F.lit(None).cast("int"))).otherwise(no_delay))
    route = _route(F.col("user_id"))
    trip_id = F.concat(F.lit("T"), F.col("user_id").cast("string"))
    trip_update = F.struct(
        F.struct(trip_id.alias("trip_id"), route.alias("route_id"),
                 F.date_format(ts, "yyyyMMdd").alias("start_date"),
                 F.lit(0).alias("schedule_relationship")).alias("trip"),
        F.array(F.struct(k.alias("stop_sequence"), F.concat(F.lit("S"), k.cast("string")).alias("stop_id"),
                         arrival.alias("arrival"), departure.alias("departure"))).alias("stop_time_update"),
    )
    vehicle = F.struct(
        F.struct(route.alias("route_id"), trip_id.alias("trip_id")).alias("trip"),
        F.struct(F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("id")).alias("vehicle"),
        F.struct(
            (F.lit(53.0) + k / 1000).cast("float").alias("latitude"),
            (F.lit(-6.0) - k / 1000).cast("float").alias("longitude"),
            (k * 3.6).cast("float").alias("bearing"),
            F.col("value").cast("float").alias("speed"),
        ).alias("position"),
        (k % 7).cast("int").alias("occupancy_status"),
    )
    is_view = et == "view"
    entity = F.struct(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("id"),
        F.when(~is_view, trip_update).alias("trip_update"),
        F.when(is_view, vehicle).alias("vehicle"),
    )
    return ev.select(_iso(ts).alias("ingestion_time"), F.array(entity).alias("entity"))


# -- run logs for the report operators -------------------------------------------
# Concurrency level, target rate and partition count are taken from the user id;
# an ``error`` event is a failed request / record.

def api_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: concurrency, latency (ms, NULL on failure), status, success."""
    ev = table(spark, sf_dir, "events")
    ok = F.col("event_type") != "error"
    return ev.select(
        F.element_at(F.array(*[F.lit(c) for c in (1, 5, 10, 20)]), (F.col("user_id") % 4 + 1).cast("int"))
        .alias("concurrency"),
        F.when(ok, F.col("value")).alias("latency_ms"),
        F.when(ok, F.lit("200")).otherwise(F.lit("500")).alias("status"),
        ok.alias("success"),
    )


def ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest log: target rate of the run, success of the put, time it was sent."""
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.element_at(F.array(*[F.lit(r) for r in (10, 50, 100, 200, 500)]),
                     (F.col("user_id") % 5 + 1).cast("int")).alias("target_rate"),
        (F.col("event_type") != "error").alias("success"),
        F.col("ts").cast("timestamp").alias("sent_at"),
    )


def ingest_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of whole ingest runs: from the hour of the first record to the end of the hour of the last."""
    hour = F.date_trunc("hour", "sent_at")
    return ingest_runs(spark, sf_dir).groupBy("target_rate").agg(
        F.min(hour).alias("started_at"), F.timestamp_add("HOUR", F.lit(1), F.max(hour)).alias("ended_at"))


def untimed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines; those whose event id is divisible by 3 have a time that cannot be read."""
    number = F.get_json_object("value", "$.event_id").try_cast("bigint")
    broken = F.regexp_replace("value", '"ingestion_time":"[^"]*"', '"ingestion_time":"soon"')
    return raw_lines(spark, sf_dir).select(F.when(number % 3 == 0, broken).otherwise(F.col("value")).alias("value"))


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-run log: one run per day (job) and partition count 1/2/4/8.

    The elapsed time is the day's summed event value in exact cents; a run
    whose largest value exceeds 480 counts as FAILED.
    """
    ev = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return ev.groupBy(
        F.to_date("ts").alias("job_date"),
        F.pow(F.lit(2), F.col("user_id") % 4).cast("int").alias("partitions"),
    ).agg(
        F.when(F.max("value") > 480, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("state"),
        (F.sum(cents) / 100).alias("time_seconds"),
    )
