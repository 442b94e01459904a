"""Declared schemas of the data model (all fields nullable, as on ingest)."""

from __future__ import annotations

from pyspark.sql import types as T

# The provided ``events`` table (declared, so a scan needs no footer sampling).
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Flat trip-update record as the poller emits it.
DELAY_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("ingestion_time", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("stop_sequence", T.IntegerType()),
        T.StructField("stop_id", T.StringType()),
        T.StructField("delay_seconds", T.IntegerType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("schedule_relationship", T.IntegerType()),
        T.StructField("source", T.StringType()),
    ]
)

# Flat vehicle-position record.
VEHICLE_POSITION = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("ingestion_time", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("bearing", T.FloatType()),
        T.StructField("speed_ms", T.FloatType()),
        T.StructField("occupancy_status", T.IntegerType()),
        T.StructField("source", T.StringType()),
    ]
)

# What the batch layer declares when it scans the raw archive: eight of the
# record's fields; everything else in the JSON is dropped by the reader.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("ingestion_time", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("stop_sequence", T.IntegerType()),
        T.StructField("stop_id", T.StringType()),
        T.StructField("delay_seconds", T.IntegerType()),
        T.StructField("source", T.StringType()),
    ]
)

# Archive rows additionally carry arrival metadata.
ARCHIVE_EXTRAS = T.StructType(
    [
        T.StructField("_kinesis_sequence", T.StringType()),
        T.StructField("_kinesis_arrival", T.StringType()),
    ]
)

_DELAY = T.StructType([T.StructField("delay", T.IntegerType())])

# Decoded real-time feed message (trip updates and vehicle positions).
FEED_MESSAGE = T.StructType(
    [
        T.StructField("ingestion_time", T.StringType()),
        T.StructField(
            "entity",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField(
                            "trip_update",
                            T.StructType(
                                [
                                    T.StructField(
                                        "trip",
                                        T.StructType(
                                            [
                                                T.StructField("trip_id", T.StringType()),
                                                T.StructField("route_id", T.StringType()),
                                                T.StructField("start_date", T.StringType()),
                                                T.StructField(
                                                    "schedule_relationship", T.IntegerType()
                                                ),
                                            ]
                                        ),
                                    ),
                                    T.StructField(
                                        "stop_time_update",
                                        T.ArrayType(
                                            T.StructType(
                                                [
                                                    T.StructField("stop_sequence", T.IntegerType()),
                                                    T.StructField("stop_id", T.StringType()),
                                                    T.StructField("arrival", _DELAY),
                                                    T.StructField("departure", _DELAY),
                                                ]
                                            )
                                        ),
                                    ),
                                ]
                            ),
                        ),
                        T.StructField(
                            "vehicle",
                            T.StructType(
                                [
                                    T.StructField(
                                        "trip",
                                        T.StructType(
                                            [
                                                T.StructField("route_id", T.StringType()),
                                                T.StructField("trip_id", T.StringType()),
                                            ]
                                        ),
                                    ),
                                    T.StructField(
                                        "vehicle",
                                        T.StructType([T.StructField("id", T.StringType())]),
                                    ),
                                    T.StructField(
                                        "position",
                                        T.StructType(
                                            [
                                                T.StructField("latitude", T.FloatType()),
                                                T.StructField("longitude", T.FloatType()),
                                                T.StructField("bearing", T.FloatType()),
                                                T.StructField("speed", T.FloatType()),
                                            ]
                                        ),
                                    ),
                                    T.StructField("occupancy_status", T.IntegerType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

# Encoded envelope delivered by the log: records[].kinesis.data = base64(JSON).
ENVELOPE = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "kinesis",
                            T.StructType([T.StructField("data", T.StringType())]),
                        )
                    ]
                )
            ),
        )
    ]
)

# Element of the ranked top-N list.
TOP_ROUTE = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("avg_delay_seconds", T.DoubleType()),
        T.StructField("max_delay_seconds", T.IntegerType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

# Run logs consumed by the report operators.
API_REQUESTS = T.StructType(
    [
        T.StructField("concurrency", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("success", T.BooleanType()),
    ]
)
# One row per record sent; a run's elapsed time is the span of its send times.
INGEST_RUNS = T.StructType(
    [
        T.StructField("target_rate", T.IntegerType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("sent_at", T.TimestampType()),
    ]
)
BATCH_RUNS = T.StructType(
    [
        T.StructField("partitions", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("time_seconds", T.DoubleType()),
    ]
)
