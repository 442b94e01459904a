"""Raw record sources: the JSON archive, JSON text lines, base64 envelopes.

Two parsing contracts exist and are kept apart on purpose:

* batch (``parse_raw_lines`` / ``read_raw_json``): the declared nullable
  schema; a value of the wrong JSON type becomes NULL, unknown fields are
  dropped, a malformed line becomes a row of NULLs.
* speed (``parse_speed_records``): duck-typed like the live processor; the
  delay is coerced (``coerce_delay``), bad lines are skipped and counted.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.functions.columns import ts_literal
from headway.schemas import ENVELOPE, RAW_SCHEMA

PARTITIONS = ("year", "month", "day", "hour")


def read_raw_json(spark: SparkSession, path: str, since: datetime | None = None,
                  until: datetime | None = None, schema=RAW_SCHEMA, max_lag: timedelta | None = None,
                  clock_skew: timedelta = timedelta(hours=1)) -> DataFrame:
    """Scan the JSON-lines archive with the declared schema (PERMISSIVE).

    Below ``path`` the archive is laid out as ``year=/month=/day=/hour=``, so
    the scan also yields those integer columns. Directories are named by flush
    time, which is never before event time by more than ``clock_skew``: a
    ``since`` bound prunes the directories before it. A record may be flushed any
    time later, so ``until`` prunes only if ``max_lag`` states how late. The exact
    event-time bounds are applied afterwards; a record whose time can't be parsed
    is kept, as an unbounded read keeps it.
    """
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if not set(PARTITIONS) <= set(df.columns) or (since is None and until is None):
        return df
    key = F.col("year") * 1_000_000 + F.col("month") * 10_000 + F.col("day") * 100 + F.col("hour")

    def hour_key(t: datetime) -> int:
        return t.year * 1_000_000 + t.month * 10_000 + t.day * 100 + t.hour

    if since is not None:
        df = df.filter(key >= hour_key(since - clock_skew))
    if until is not None and max_lag is not None:
        df = df.filter(key <= hour_key(until + max_lag))
    ts = C.parse_event_time("ingestion_time")
    if since is not None:
        df = df.filter((ts >= ts_literal(since)) | ts.isNull())
    if until is not None:
        df = df.filter((ts < ts_literal(until)) | ts.isNull())
    return df


# Fields the speed layer reads from a record; the delay stays untyped (VARIANT)
# so that coerce_delay can tell 45, "45", 45.7 and "x" apart.
SPEED_FIELDS = ("event_id string, route_id string, source string, ingestion_time string, "
                "delay_seconds variant")


def parse_once(lines: DataFrame, schema, text: str = "value") -> DataFrame:
    """One row of ``schema`` fields per JSON line, parsing each line exactly once.

    The parse runs as the input of a generator (``inline_outer``). A generator
    is a barrier for Catalyst: later filters on the parsed fields are not
    pushed below it and the field accesses are not inlined into copies of the
    parse, which would otherwise re-parse the line once per field and once
    per predicate. A line that is not a JSON object gives a row of NULLs.
    """
    parsed = F.from_json(F.col(text), schema, {"mode": "PERMISSIVE"})
    return lines.select(F.inline_outer(F.array(parsed)))


def parse_raw_lines(lines: DataFrame, text: str = "value", schema=RAW_SCHEMA) -> DataFrame:
    """Batch-contract parse of JSON text lines (same rules as the JSON reader)."""
    return parse_once(lines, schema, text)


def coerce_delay(delay: Column) -> Column:
    """Delay of a speed-layer record as the live processor reads it: ``int(x)``.

    ``delay`` is a VARIANT. Numbers truncate toward zero (45.7 -> 45,
    -45.7 -> -45), booleans give 0/1, text counts only when it is an integer
    literal (``"45"``, ``" +7 "``); anything else (``"45.7"``, ``"x"``, null,
    missing) is NULL, i.e. the record is skipped.
    """
    kind = F.schema_of_variant(delay)
    text = F.try_variant_get(delay, "$", "string")
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)\s*$", 1)
    return (
        F.when(delay.isNull() | (kind == "VOID"), F.lit(None).cast("int"))
        .when(kind == "STRING", F.when(digits != "", digits.try_cast("int")))
        .otherwise(F.try_variant_get(delay, "$", "double").try_cast("int"))
    )


def parse_speed_records(lines: DataFrame, text: str = "value",
                        now: Column | None = None) -> DataFrame:
    """Speed-contract parse: keep decodable trip updates with a route and a usable delay.

    ``now`` replaces a missing or unparsable ``ingestion_time`` (the live
    processor uses the wall clock; a replay passes a fixed instant).
    """
    ts = C.event_time_or("ingestion_time", now if now is not None else F.current_timestamp())
    return speed_candidates(lines, text).filter(C.speed_filter()).withColumn("event_ts", ts)


def speed_candidates(lines: DataFrame, text: str = "value") -> DataFrame:
    """Every line parsed once with the speed layer's fields and coerced delay (nothing dropped)."""
    return parse_once(lines, SPEED_FIELDS, text).withColumn(
        "delay_seconds", coerce_delay(F.col("delay_seconds")))


def is_record(text: str = "value") -> Column:
    """Whether a line is a JSON object, as a record must be."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(text))).startswith("OBJECT"), F.lit(False))


def malformed_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row: lines read, lines that are not JSON objects, lines decoded."""
    bad = F.count_if(~is_record(text))
    return lines.agg(
        F.count(F.lit(1)).alias("records"),
        bad.alias("malformed"),
        (F.count(F.lit(1)) - bad).alias("decoded"),
    )


def decode_envelope(envelopes: DataFrame, text: str = "value") -> DataFrame:
    """Delivered batches -> one decoded payload line per record (column ``value``).

    ``Records[].kinesis.data`` is base64 of the UTF-8 JSON record. An
    undecodable payload stays as a line that the speed parser then skips and
    ``malformed_records`` counts.
    """
    env = envelopes.select(F.from_json(F.col(text), ENVELOPE).alias("e"))
    recs = env.select(F.explode_outer("e.Records").alias("r")).filter(F.col("r").isNotNull())
    return recs.select(
        F.try_to_binary(F.col("r.kinesis.data"), F.lit("base64")).cast("string").alias("value")
    )


def partition_key(route: Column | str = "route_id") -> Column:
    """Log partition key: the route, ``'unknown'`` when missing or empty."""
    r = F.col(route) if isinstance(route, str) else route
    return F.coalesce(F.nullif(r, F.lit("")), F.lit("unknown"))
