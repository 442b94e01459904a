"""Replays of the streaming jobs over the provided tables (``availableNow``).

Each replay runs the production job definition to completion against a
fresh folder below the session's checkpoint root and returns what the job
wrote, read back as a DataFrame; a second run on the same checkpoint adds
nothing (the source offsets are committed).
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators import batch as B
from headway.plans.batch_job import run_batch_job, run_incremental_job
from headway.schemas import ARCHIVE_EXTRAS, RAW_SCHEMA
from headway.session import scratch_path
from headway.sources import fixtures as X
from headway.sources import hours as H
from headway.sources import raw as RW
from headway.streaming import jobs as J


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "replays", f"{name}-{uuid.uuid4().hex[:12]}")


def _ntz(t: datetime):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _baseline(spark: SparkSession, sf_dir: str, path: str):
    """Batch view of the history, written once for a replay; each micro-batch reads it."""
    B.batch_view(B.route_statistics(B.clean_events(X.history_events(spark, sf_dir)))).write.parquet(path)
    return lambda spark: spark.read.parquet(path)


def stream_windows(spark: SparkSession, sf_dir: str, size: str, slide: str | None,
                   watermark: str) -> DataFrame:
    """Append-mode window statistics of the whole event log (closed windows only)."""
    d = _run_dir(spark, "windows")
    events = X.events_to_delay_events(J.event_stream(spark, sf_dir))
    q = J.start_parquet_sink(J.windowed_stats(events, size, slide, watermark),
                             f"{d}/out", f"{d}/ckpt", J.REPLAY)
    J.run_to_completion(q)
    return spark.read.parquet(f"{d}/out")


def speed_layer(spark: SparkSession, sf_dir: str, size: str, slide: str, watermark: str,
                n: int, live_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Speed layer over the live part of the log, or all of it: (speed view, top-N snapshots)."""
    d = _run_dir(spark, "speed")
    raw = J.event_stream(spark, sf_dir)
    if live_only:
        raw = raw.filter(F.col("ts") >= _ntz(X.HISTORY_UNTIL))
    events = X.events_to_delay_events(raw)
    q = J.start_speed_layer(events, f"{d}/view", f"{d}/top", f"{d}/ckpt", _baseline(spark, sf_dir, f"{d}/batch_view"),
                            size, slide, watermark, J.REPLAY, n)
    J.run_to_completion(q)
    return J.read_speed_view(spark, f"{d}/view"), J.read_snapshots(spark, f"{d}/top")


def microbatch(spark: SparkSession, sf_dir: str, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """Micro-batch variant over the delivered envelopes: (route stats, counters)."""
    d = _run_dir(spark, "microbatch")
    lines = RW.decode_envelope(X.envelopes_from(X.raw_lines_from(J.event_stream(spark, sf_dir))))
    q = J.start_microbatch(lines, f"{d}/stats", f"{d}/counters", f"{d}/ckpt",
                           _baseline(spark, sf_dir, f"{d}/batch_view"),
                           now=X.ts_literal(as_of), trigger=J.REPLAY)
    J.run_to_completion(q)
    # the batch id is a folder name: discovery would read it back as INT
    def read(path):
        return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))

    return read(f"{d}/stats"), read(f"{d}/counters")


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive the JSON lines, then scan the archive the way the batch job does."""
    d = _run_dir(spark, "archive")
    q = J.start_archive(X.raw_lines_from(J.event_stream(spark, sf_dir)), f"{d}/raw", f"{d}/ckpt",
                        J.REPLAY)
    J.run_to_completion(q)
    return RW.read_raw_json(spark, f"{d}/raw")


def all_windows(spark: SparkSession, sf_dir: str, size: str, slide: str | None, watermark: str) -> DataFrame:
    """Statistics of every window of the event log, open ones too, with ``is_final``."""
    d = _run_dir(spark, "all-windows")
    events = X.events_to_delay_events(J.event_stream(spark, sf_dir))
    J.run_to_completion(J.start_windows(events, f"{d}/out", f"{d}/ckpt", size, slide, watermark, J.REPLAY))
    return J.read_windows(spark, f"{d}/out", f"{d}/ckpt/state", watermark)


def late_arrivals(spark: SparkSession, sf_dir: str, size: str, slide: str, watermark: str,
                  corrected: bool = False) -> tuple[DataFrame, DataFrame]:
    """The history arrives after the live data, so all of it is late: (windows, late panes).

    Two queries read their part of the log one after the other into one state; nothing is
    copied. The watermark of the first is past every history pane, so these
    are reported and stay out of the windows, until ``corrected`` adds them.
    """
    d = _run_dir(spark, "late")
    raw, cut = J.event_stream(spark, sf_dir), _ntz(X.HISTORY_UNTIL)
    for name, part in (("live", raw.filter(F.col("ts") >= cut)), ("history", raw.filter(F.col("ts") < cut))):
        J.run_to_completion(J.start_windows(X.events_to_delay_events(part), f"{d}/out", f"{d}/{name}", size, slide, watermark,
                                            J.REPLAY, state_path=f"{d}/state"))
    panes = J.PaneWindows(f"{d}/state", size, slide, watermark)
    if corrected:
        panes.correct(spark, J.window_table(f"{d}/out"))
    return J.read_windows(spark, f"{d}/out", f"{d}/state", watermark), panes.late.read(spark)


def fan_out(spark: SparkSession, sf_dir: str, as_of: datetime, size: str, slide: str,
            watermark: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One read of the JSON lines into the archive, the quarantine and the speed view.

    The lines are first put down as the files that a log's reader would find.
    """
    d = _run_dir(spark, "fan-out")
    X.raw_lines(spark, sf_dir).write.text(f"{d}/in")
    lines = spark.readStream.format("text").load(f"{d}/in")
    base = _baseline(spark, sf_dir, f"{d}/batch_view")
    J.run_to_completion(J.start_fan_out_once(lines, f"{d}/raw", f"{d}/view", f"{d}/top", f"{d}/ckpt", base, J.REPLAY,
                                             X.ts_literal(as_of), size, slide, watermark, f"{d}/bad"))
    schema = T.StructType(RAW_SCHEMA.fields + ARCHIVE_EXTRAS.fields)
    return (RW.read_raw_json(spark, f"{d}/raw", schema=schema), J.quarantine_counts(spark, f"{d}/bad"),
            J.read_speed_view(spark, f"{d}/view"))


def hour_archive(spark: SparkSession, sf_dir: str, lag_hours: int = 30) -> str:
    """An archive of the JSON lines by flush hour, flushed up to ``lag_hours`` after the event."""
    d = _run_dir(spark, "hours")
    lines = X.raw_lines(spark, sf_dir).filter(RW.is_record("value"))
    t = F.try_to_timestamp(F.get_json_object("value", "$.ingestion_time"))
    lag = F.pmod(F.xxhash64("value"), F.lit(lag_hours)).cast("int")
    at = F.timestamp_add("HOUR", lag, F.col("t"))
    flushed = lines.withColumn("t", t).withColumn("at", at)
    (flushed.select("value", F.year("at").alias("year"), *[
        F.lpad(f("at").cast("string"), 2, "0").alias(n)
        for n, f in (("month", F.month), ("day", F.dayofmonth), ("hour", F.hour))])
        .repartition("year", "month", "day", "hour").write.partitionBy("year", "month", "day", "hour").text(f"{d}/raw"))
    return f"{d}/raw"


def between(spark: SparkSession, sf_dir: str, since: datetime, until: datetime) -> DataFrame:
    """Bounded read of an archive whose records came up to 30 hours late, by the ranges of its hour folders."""
    archive = hour_archive(spark, sf_dir)
    ranges = _run_dir(spark, "ranges")
    H.update_ranges(spark, archive, ranges, datetime.max)
    return H.read_between(spark, archive, ranges, since, until)


def published(spark: SparkSession, sf_dir: str) -> str:
    """Root of the views that the batch job publishes over the whole event log."""
    root = _run_dir(spark, "published")
    run_batch_job(spark, "", root, raw=X.delay_events(spark, sf_dir))
    return root


def incremental(spark: SparkSession, sf_dir: str, stops: list[datetime]) -> str:
    """Root of the views after incremental runs, each up to the next of ``stops``, over an archive."""
    archive, root = hour_archive(spark, sf_dir), _run_dir(spark, "incremental")
    for stop in stops:
        run_incremental_job(spark, archive, root, stop)
    return root
