"""Flatten decoded real-time feed messages into flat records.

Input rows follow ``headway.schemas.FEED_MESSAGE`` (one row per polled
message). ``explode`` runs inside the scan stage: no shuffle, one output row
per stop update, so a message of any size never lands in one task as a unit
beyond the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.sources.raw import partition_key


def _str(c: Column) -> Column:
    """Unset protobuf string -> ''."""
    return F.coalesce(c, F.lit(""))


def _num(c: Column, zero) -> Column:
    """Unset protobuf number -> 0."""
    return F.coalesce(c, F.lit(zero))


def departure_else_arrival(stu: Column) -> Column:
    """Delay of a stop update: the departure's if the departure is present, else
    the arrival's; a present struct with an unset delay gives 0; neither -> NULL.

    Presence is of the struct, so ``coalesce(departure.delay, arrival.delay)``
    would be wrong for a present departure with an unset delay.
    """
    dep, arr = stu.getField("departure"), stu.getField("arrival")
    return (
        F.when(dep.isNotNull(), _num(dep.getField("delay"), 0))
        .when(arr.isNotNull(), _num(arr.getField("delay"), 0))
    )


def flatten_trip_updates(messages: DataFrame) -> DataFrame:
    """One delay event per stop update that carries a departure or an arrival."""
    ent = messages.select("ingestion_time", F.explode("entity").alias("e")).filter(
        F.col("e.trip_update").isNotNull()
    )
    stu = ent.select(
        "ingestion_time", "e.id", F.col("e.trip_update.trip").alias("trip"),
        F.explode("e.trip_update.stop_time_update").alias("u"),
    )
    rows = stu.select(
        F.concat_ws("_", F.col("id"), _num(F.col("u.stop_sequence"), 0).cast("string")).alias("event_id"),
        "ingestion_time",
        _str(F.col("trip.route_id")).alias("route_id"),
        _str(F.col("trip.trip_id")).alias("trip_id"),
        _num(F.col("u.stop_sequence"), 0).alias("stop_sequence"),
        _str(F.col("u.stop_id")).alias("stop_id"),
        departure_else_arrival(F.col("u")).alias("delay_seconds"),
        _str(F.col("trip.start_date")).alias("start_date"),
        _num(F.col("trip.schedule_relationship"), 0).alias("schedule_relationship"),
        F.lit(TRIP_UPDATES).alias("source"),
    )
    return rows.filter(F.col("delay_seconds").isNotNull())


def flatten_vehicle_positions(messages: DataFrame) -> DataFrame:
    """One position record per entity that carries a vehicle."""
    ent = messages.select("ingestion_time", F.explode("entity").alias("e")).filter(
        F.col("e.vehicle").isNotNull()
    )
    v = F.col("e.vehicle")
    return ent.select(
        F.concat(F.lit("vp_"), _str(F.col("e.id"))).alias("event_id"),
        "ingestion_time",
        _str(v.getField("trip").getField("route_id")).alias("route_id"),
        _str(v.getField("trip").getField("trip_id")).alias("trip_id"),
        _str(v.getField("vehicle").getField("id")).alias("vehicle_id"),
        _num(v.getField("position").getField("latitude"), 0.0).cast("float").alias("latitude"),
        _num(v.getField("position").getField("longitude"), 0.0).cast("float").alias("longitude"),
        _num(v.getField("position").getField("bearing"), 0.0).cast("float").alias("bearing"),
        _num(v.getField("position").getField("speed"), 0.0).cast("float").alias("speed_ms"),
        _num(v.getField("occupancy_status"), 0).alias("occupancy_status"),
        F.lit(VEHICLE_POSITIONS).alias("source"),
    )


def ingest_union(messages: DataFrame) -> DataFrame:
    """Both record kinds in one frame (missing fields NULL), with the log key.

    Equal to ``flatten_trip_updates ∪ flatten_vehicle_positions`` by name, but
    built in one pass: each entity is turned into an array of full-width
    records (its stop updates, or its one vehicle record) and exploded once,
    so the feed is scanned a single time.
    """
    trips = flatten_trip_updates(messages)
    vehicles = flatten_vehicle_positions(messages)
    fields = list(dict.fromkeys(trips.columns + vehicles.columns))
    types = {f.name: f.dataType for f in trips.schema.fields + vehicles.schema.fields}

    def record(values: dict) -> Column:
        return F.struct(*[(values[c] if c in values else F.lit(None)).cast(types[c]).alias(c)
                          for c in fields])

    e = F.col("e")
    tu, v = e.getField("trip_update"), e.getField("vehicle")
    trip = tu.getField("trip")

    def trip_record(u: Column) -> Column:
        seq = _num(u.getField("stop_sequence"), 0)
        return record({
            "event_id": F.concat_ws("_", e.getField("id"), seq.cast("string")),
            "ingestion_time": F.col("ingestion_time"),
            "route_id": _str(trip.getField("route_id")),
            "trip_id": _str(trip.getField("trip_id")),
            "stop_sequence": seq,
            "stop_id": _str(u.getField("stop_id")),
            "delay_seconds": departure_else_arrival(u),
            "start_date": _str(trip.getField("start_date")),
            "schedule_relationship": _num(trip.getField("schedule_relationship"), 0),
            "source": F.lit(TRIP_UPDATES),
        })

    pos = v.getField("position")
    vehicle_record = record({
        "event_id": F.concat(F.lit("vp_"), _str(e.getField("id"))),
        "ingestion_time": F.col("ingestion_time"),
        "route_id": _str(v.getField("trip").getField("route_id")),
        "trip_id": _str(v.getField("trip").getField("trip_id")),
        "vehicle_id": _str(v.getField("vehicle").getField("id")),
        "latitude": _num(pos.getField("latitude"), 0.0),
        "longitude": _num(pos.getField("longitude"), 0.0),
        "bearing": _num(pos.getField("bearing"), 0.0),
        "speed_ms": _num(pos.getField("speed"), 0.0),
        "occupancy_status": _num(v.getField("occupancy_status"), 0),
        "source": F.lit(VEHICLE_POSITIONS),
    })
    none = F.filter(F.array(vehicle_record), lambda _: F.lit(False))     # typed empty array
    stops = F.filter(F.transform(tu.getField("stop_time_update"), trip_record),
                     lambda r: r.getField("delay_seconds").isNotNull())
    records = F.concat(
        F.coalesce(F.when(tu.isNotNull(), stops), none),
        F.when(v.isNotNull(), F.array(vehicle_record)).otherwise(none),
    )
    rows = messages.select("ingestion_time", F.explode("entity").alias("e")).select(
        F.explode(records).alias("r")).select("r.*")
    return rows.withColumn("partition_key", partition_key("route_id"))
