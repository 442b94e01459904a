"""Structured Streaming jobs: speed layer, micro-batch variant, raw archive.

Every job reads a replayable file source, keeps its progress in a checkpoint
folder and writes idempotently, so a restarted job (lost executor, lost
driver) resumes where its last committed batch ended:

* window statistics: event-time windows with a watermark; append mode emits a
  window once the watermark passes its end; late rows are dropped by Spark.
* speed view, top-N snapshot, open windows: each batch's events become panes, and the
  windows that hold one are recomputed for all routes from the pane table,
  the only state. Tables are upserted by batch number (``upsert``), so a
  retried batch replaces its own rows.
* fan-out: one read of the source feeds several sinks, each with a ledger of batches.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.functions import columns as C
from headway.operators import speed as S
from headway.sources import files
from headway.sources import raw as RW
from headway.streaming.upsert import UpsertTable

Trigger = dict


def production_trigger(seconds: int = 30) -> Trigger:
    return {"processingTime": f"{seconds} seconds"}


REPLAY: Trigger = {"availableNow": True}


# -- sources -------------------------------------------------------------------

def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                glob: str | None = None, max_files: int | None = None,
                recursive: bool = False) -> DataFrame:
    """Replayable file source; ``max_files`` bounds a micro-batch."""
    if schema is None:
        reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        schema = reader.format(fmt).load(path).schema
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path)


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The provided ``events`` table as a stream: one file or a folder of part files.

    The path is a pattern that matches the table only, so a streaming source takes
    a single file as well. ``max_files`` bounds a micro-batch; a replay leaves it open.
    """
    from headway.schemas import EVENTS

    return file_stream(spark, os.path.join(sf_dir, "events.parque[t]"), schema=EVENTS, max_files=max_files)


# -- windowed statistics ---------------------------------------------------------

def windowed_stats(events: DataFrame, size: str = C.WINDOW_SIZE, slide: str | None = C.WINDOW_SLIDE,
                   watermark: str = "10 minutes") -> DataFrame:
    """Per-route statistics of event-time windows (append mode: closed windows only).

    Sliding windows whose size is a multiple of the slide are built in two
    chained stateful aggregations: events -> slide-long panes -> windows over
    the panes' event time (``window_time``). Every event then enters one pane
    instead of being copied into ``size / slide`` windows; the second step
    fans out pane rows only. ``slide=None`` gives tumbling windows.
    """
    ev = S.speed_events(events).withWatermark("event_ts", watermark)
    panes_ok = slide and slide != size and S.duration_seconds(size) % S.duration_seconds(slide) == 0
    if panes_ok:
        panes = ev.groupBy("route_id", F.window("event_ts", slide).alias("p")).agg(*S.pane_columns())
        stats = panes.groupBy("route_id", F.window(F.window_time("p"), size, slide).alias("w")).agg(
            F.sum("n").alias("event_count"),
            (F.sum("s").cast("double") / F.sum("n")).alias("avg_delay_seconds"),
            F.max("m").alias("max_delay_seconds"),
            F.sum("l").cast("bigint").alias("late_count"),
        )
    else:
        win = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
        stats = ev.groupBy(win.alias("w"), "route_id").agg(*S.stat_columns())
    return stats.select(
        C.to_ntz("w.start").alias("window_start"), C.to_ntz("w.end").alias("window_end"),
        "route_id", "event_count", "avg_delay_seconds", "max_delay_seconds", "late_count",
    )


def start_parquet_sink(stream: DataFrame, path: str, checkpoint: str, trigger: Trigger,
                       mode: str = "append", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    w = (stream.writeStream.outputMode(mode).format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


# -- speed view (foreachBatch upsert) and top-N snapshot -------------------------

VIEW_COLUMNS = ("window_start", "window_end", "route_id", "time_bucket", "event_count",
                "avg_delay_seconds", "max_delay_seconds", "late_count", "batch_baseline_seconds",
                "anomaly_ratio", "is_anomaly")
TOP_COLUMNS = ("window_end", "rank", "route_id", "avg_delay_seconds", "max_delay_seconds",
               "event_count")


VIEW = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("route_id", T.StringType()), T.StructField("time_bucket", T.StringType()),
    T.StructField("event_count", T.LongType()), T.StructField("avg_delay_seconds", T.DoubleType()),
    T.StructField("max_delay_seconds", T.IntegerType()), T.StructField("late_count", T.LongType()),
    T.StructField("batch_baseline_seconds", T.DoubleType()), T.StructField("anomaly_ratio", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()), T.StructField("window_size_minutes", T.DoubleType()),
    T.StructField("ttl", T.LongType())])
SNAPSHOT = T.StructType([
    T.StructField("window_end", T.TimestampNTZType()), T.StructField("top_routes", T.ArrayType(T.StructType([
        T.StructField("rank", T.IntegerType()), T.StructField("route_id", T.StringType()),
        T.StructField("avg_delay_seconds", T.DoubleType()), T.StructField("max_delay_seconds", T.IntegerType()),
        T.StructField("event_count", T.LongType())])))])
PANES = T.StructType([
    T.StructField("route_id", T.StringType()), T.StructField("pane_start", T.TimestampType()),
    T.StructField("n", T.LongType()), T.StructField("s", T.LongType()), T.StructField("m", T.IntegerType()),
    T.StructField("l", T.LongType())])


def add_panes(rows: DataFrame) -> DataFrame:
    """Panes of several batches as one: every statistic is a sum or a maximum."""
    return rows.groupBy("route_id", "pane_start").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("m").alias("m"), F.sum("l").alias("l"))


def view_table(path: str) -> UpsertTable:
    return UpsertTable(path, VIEW, ("route_id", "window_end"), "window_end")


def snapshot_table(path: str) -> UpsertTable:
    return UpsertTable(path, SNAPSHOT, ("window_end",), "window_end")


def pane_table(path: str) -> UpsertTable:
    return UpsertTable(path, PANES, ("route_id", "pane_start"), "pane_start", add_panes)


def read_speed_view(spark: SparkSession, path: str, alive_at: Column | None = None,
                    columns: tuple[str, ...] = VIEW_COLUMNS) -> DataFrame:
    """Current speed view: the newest written row of every (route_id, window_end).

    With ``alive_at`` (a timestamp) rows whose TTL has passed are left out, and
    the filter on ``dt`` prunes date folders older than the TTL.
    """
    alive = None if alive_at is None else (
        (F.col("ttl") > F.unix_timestamp(alive_at))
        & (F.col("dt") >= F.to_date(alive_at - F.expr(f"INTERVAL {C.TTL_SECONDS} SECONDS"))))
    return view_table(path).read(spark, alive).select(*columns)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Current top-N list of every window: rows of its newest snapshot batch."""
    return snapshot_table(path).read(spark).select("window_end", F.inline("top_routes")).select(*TOP_COLUMNS)


class Sink(Protocol):
    """What a micro-batch is handed to."""

    def __call__(self, batch: DataFrame, batch_id: int) -> None: ...


class PaneWindows:
    """Windows of a stream from one table of panes, which is all the state there is.

    A batch's events are reduced to panes (count, sum, maximum, late count), written
    under the batch's number and added up with those of other batches when read.
    :meth:`add` returns the windows that hold an updated pane, open ones
    too, for all routes; only their panes are read.

    The watermark trails the newest event of the batches before by ``delay``. Panes
    that ended by then are late: they go to the ``late`` table and, with
    ``correct_late``, into their windows too.
    """

    def __init__(self, path: str, size: str, slide: str, delay: str, correct_late: bool = False):
        if S.duration_seconds(size) % S.duration_seconds(slide):
            raise ValueError("window size must be a multiple of the slide")
        self.path, self.size, self.slide, self.correct_late = path, size, slide, correct_late
        self.delay = timedelta(seconds=S.duration_seconds(delay))
        self.panes, self.late = pane_table(os.path.join(path, "panes")), pane_table(os.path.join(path, "late"))

    def _watermark(self, spark: SparkSession, batch_id: int, newest: datetime) -> datetime | None:
        """The watermark that holds for a batch; a retried batch gets the same one."""
        at = os.path.join(self.path, "NEWEST")
        known = files.read_pointer(spark, at)
        before = None if known is None else known["before" if known["batch"] == batch_id else "newest"]
        files.write_pointer(spark, at, {"batch": batch_id, "before": before,
                                        "newest": max(before or "", newest.isoformat(timespec="microseconds"))})
        return datetime.fromisoformat(before) - self.delay if before else None

    def add(self, events: DataFrame, batch_id: int) -> DataFrame | None:
        """Windows (all columns of the batch twin) that hold a pane of this batch; None without any."""
        spark = events.sparkSession
        pane = F.window("event_ts", self.slide)
        own = (S.speed_events(events).groupBy("route_id", pane.start.alias("pane_start"), pane.end.alias("pane_end"))
               .agg(*S.pane_columns(), F.max("event_ts").alias("newest")).persist())
        try:
            text = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
            at = own.agg(F.date_format(F.max("newest"), text).alias("newest"), F.to_date(F.min("pane_start")).alias("first"),
                         F.to_date(F.max("pane_start")).alias("last")).first()
            if at.newest is None:
                return None
            mark = self._watermark(spark, batch_id, datetime.fromisoformat(at.newest))
            fresh = own
            if mark is not None:
                late = F.col("pane_end") <= C.ts_literal(mark)
                self.late.write(own.where(late), batch_id)
                fresh = own if self.correct_late else own.where(~late)
            self.panes.write(fresh, batch_id)
            touched = self.panes.rows(spark).where((F.col("batch_id") == batch_id) & F.col("dt").between(at.first, at.last))
            return self.windows(spark, touched, days=(at.first, at.last))
        finally:
            own.unpersist()

    def uncorrected(self, spark: SparkSession) -> DataFrame:
        """Late panes that are in no window yet."""
        upto = self.panes.pointer(spark).get("corrected", -1)
        return add_panes(self.late.rows(spark).where(F.col("batch_id") > upto))

    def correct(self, spark: SparkSession, windows: UpsertTable) -> None:
        """Add the late panes to their windows while the query is stopped.

        The windows are upserted first, which may be repeated; then the panes take the
        late ones in the step that marks them as taken.
        """
        last = files.read_pointer(spark, os.path.join(self.path, "NEWEST"))["batch"]
        late = self.uncorrected(spark)
        windows.compact(spark, last, more=self.windows(spark, late, late))
        self.panes.compact(spark, last, more=late, mark={"corrected": last})

    def windows(self, spark: SparkSession, touched: DataFrame | None = None, more: DataFrame | None = None,
                days: tuple[date, date] | None = None) -> DataFrame:
        """The windows of the stored panes (and ``more`` of them), or of those that hold a touched pane.

        ``days`` are the first and last date of the touched panes; other folders are not read.
        """
        rows = self.panes.rows(spark).drop("batch_id")
        if days is not None:
            span = timedelta(days=1 + S.duration_seconds(self.size) // 86400)
            rows = rows.where(F.col("dt").between(days[0] - span, days[1] + span))
        if more is not None:
            rows = rows.unionByName(more.withColumn("dt", F.to_date("pane_start")))
        if touched is not None:
            starts = touched.select(F.explode(S.pane_window_starts(F.col("pane_start"), self.size, self.slide))
                                    .alias("window_start")).distinct()
            step, k = S.duration_seconds(self.slide), S.duration_seconds(self.size) // S.duration_seconds(self.slide)
            needed = starts.select(F.explode(F.transform(
                F.sequence(F.lit(0), F.lit(k - 1)),
                lambda i: F.timestamp_micros(F.unix_micros("window_start") + i.cast("bigint") * (step * 1_000_000))))
                .alias("pane_start")).distinct()
            rows = rows.join(needed, "pane_start", "left_semi")
        out = S.windows_from_panes(add_panes(rows), self.size, self.slide)
        if touched is not None:
            out = out.join(starts, "window_start", "left_semi")
        return out.select(C.to_ntz("window_start").alias("window_start"), C.to_ntz("window_end").alias("window_end"),
                          "route_id", "event_count", "avg_delay_seconds", "max_delay_seconds", "late_count")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Combine the panes of batches up to ``upto``; those that no later event can reach are dropped."""
        known = files.read_pointer(spark, os.path.join(self.path, "NEWEST"))
        oldest = None
        if known is not None and not self.correct_late:
            least = datetime.fromisoformat(known["newest"]) - self.delay - timedelta(seconds=S.duration_seconds(self.size))
            oldest = F.col("pane_start") > C.ts_literal(least)
        self.panes.compact(spark, upto, oldest)
        if files.exists(spark, self.late.path):
            self.late.compact(spark, upto)


class SpeedViewWriter:
    """Sink of the speed layer: upserts the windows of a batch and ranks them.

    The windows hold every route, so ranking needs no re-read of the view. They are
    joined with the baseline and written to the speed view and the top-N snapshot, each
    under the batch's number. ``baseline`` is called once per batch, so a
    newly published batch view is picked up by the next micro-batch (the live process
    cached it for ten minutes), all of one version. Every ``compact_every`` batches the tables are
    compacted; with ``expire`` rows whose TTL has passed go then.
    """

    def __init__(self, view_path: str, snapshot_path: str, panes: PaneWindows,
                 baseline: Callable[[SparkSession], DataFrame], n: int = C.TOP_N, threshold: float = C.ANOMALY_RATIO,
                 compact_every: int = 50, expire: bool = False, first: int = 0):
        self.first = first
        self.view, self.snapshots, self.panes = view_table(view_path), snapshot_table(snapshot_path), panes
        self.baseline, self.n, self.threshold = baseline, n, threshold
        self.compact_every, self.expire = compact_every, expire

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        spark, batch_id = events.sparkSession, self.first + batch_id
        windows = self.panes.add(events, batch_id)
        if windows is not None:
            windows = windows.persist()
            try:
                rows = S.speed_with_baseline(windows, self.baseline(spark), self.threshold)
                minutes = S.duration_seconds(self.panes.size) / 60
                self.view.write(rows.withColumns({
                    "window_size_minutes": F.lit(minutes), "ttl": C.ttl_of(F.col("window_end").cast("timestamp"))}), batch_id)
                self.snapshots.write(S.top_n_lists(S.top_n_snapshot(windows, self.n)), batch_id)
            finally:
                windows.unpersist()
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, upto: int) -> None:
        alive = F.col("ttl") > F.unix_timestamp(F.current_timestamp())
        end = F.col("window_end").cast("timestamp")
        self.view.compact(spark, upto, alive if self.expire else None)
        self.snapshots.compact(spark, upto, C.ttl_of(end) > F.unix_timestamp(F.current_timestamp()) if self.expire else None)
        self.panes.compact(spark, upto)


def start_speed_layer(events: DataFrame, view_path: str, snapshot_path: str, checkpoint: str,
                      baseline: Callable[[SparkSession], DataFrame], size: str = C.WINDOW_SIZE,
                      slide: str = C.WINDOW_SLIDE, watermark: str = "10 minutes",
                      trigger: Trigger | None = None, n: int = C.TOP_N,
                      threshold: float = C.ANOMALY_RATIO, pane_path: str | None = None,
                      correct_late: bool = False, compact_every: int = 50, expire: bool = False) -> StreamingQuery:
    """Events -> panes -> windows of the updated panes -> speed view upsert + top-N snapshot.

    ``size`` must be a multiple of ``slide``. The pane table defaults to a
    folder next to the checkpoint (it is state the job owns).
    """
    panes = PaneWindows(pane_path or os.path.join(checkpoint, "state"), size, slide, watermark, correct_late)
    writer = SpeedViewWriter(view_path, snapshot_path, panes, baseline, n, threshold, compact_every, expire,
                             first_batch(events.sparkSession, panes, checkpoint))
    return (events.writeStream.foreachBatch(writer)
            .option("checkpointLocation", os.path.join(checkpoint, "query"))
            .trigger(**(trigger or production_trigger())).start())


def first_batch(spark: SparkSession, panes: PaneWindows, checkpoint: str) -> int:
    """Number of a query's first batch: after the last one that its state has seen.

    Kept with the checkpoint, as a query that starts from a new position has a new
    checkpoint over an old state, and both count from 0.
    """
    at = os.path.join(checkpoint, "FIRST")
    known = files.read_pointer(spark, at)
    if known is None:
        seen = files.read_pointer(spark, os.path.join(panes.path, "NEWEST"))
        known = {"batch": 0 if seen is None else seen["batch"] + 1}
        files.write_pointer(spark, at, known)
    return known["batch"]


class WindowWriter:
    """Sink that keeps the statistics of all windows with data, open ones too, by upsert."""

    def __init__(self, path: str, panes: PaneWindows, compact_every: int = 50, first: int = 0):
        self.table, self.panes, self.compact_every, self.first = window_table(path), panes, compact_every, first

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        spark, batch_id = events.sparkSession, self.first + batch_id
        windows = self.panes.add(events, batch_id)
        if windows is not None:
            self.table.write(windows, batch_id)
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.table.compact(spark, batch_id)
            self.panes.compact(spark, batch_id)


WINDOW_COLUMNS = ("window_start", "window_end", "route_id", "event_count", "avg_delay_seconds", "max_delay_seconds",
                  "late_count")


def window_table(path: str) -> UpsertTable:
    return UpsertTable(path, T.StructType([VIEW[c] for c in WINDOW_COLUMNS]), ("route_id", "window_end"), "window_end")


def read_windows(spark: SparkSession, path: str, state_path: str, watermark: str) -> DataFrame:
    """Newest statistics of every window; ``is_final`` once the watermark has passed its end."""
    known = files.read_pointer(spark, os.path.join(state_path, "NEWEST"))
    rows = window_table(path).read(spark)
    if known is None:
        return rows.withColumn("is_final", F.lit(False))
    mark = datetime.fromisoformat(known["newest"]) - timedelta(seconds=S.duration_seconds(watermark))
    return rows.withColumn("is_final", F.col("window_end") <= C.to_ntz(C.ts_literal(mark)))


def start_windows(events: DataFrame, path: str, checkpoint: str, size: str = C.WINDOW_SIZE, slide: str | None = C.WINDOW_SLIDE,
                  watermark: str = "10 minutes", trigger: Trigger | None = None, correct_late: bool = False,
                  compact_every: int = 50, state_path: str | None = None) -> StreamingQuery:
    """Statistics of every window with data at each trigger (``slide=None``: tumbling windows)."""
    panes = PaneWindows(state_path or os.path.join(checkpoint, "state"), size, slide or size, watermark, correct_late)
    first = first_batch(events.sparkSession, panes, checkpoint)
    return (events.writeStream.foreachBatch(WindowWriter(path, panes, compact_every, first))
            .option("checkpointLocation", os.path.join(checkpoint, "query"))
            .trigger(**(trigger or production_trigger())).start())


class MicroBatchWriter:
    """Per delivered batch: route statistics against the baseline of 'now', and counters."""

    def __init__(self, stats_path: str, counters_path: str,
                 baseline: Callable[[SparkSession], DataFrame], now: Column | None = None,
                 threshold: float = C.ANOMALY_RATIO):
        self.stats_path, self.counters_path = stats_path, counters_path
        self.baseline, self.now, self.threshold = baseline, now, threshold

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        now = self.now if self.now is not None else F.current_timestamp()
        # every delivered line parsed once; reused by the statistics and the counters
        parsed = RW.speed_candidates(lines).persist()
        try:
            valid = C.speed_filter()
            recs = parsed.filter(valid).withColumn("event_ts", C.event_time_or("ingestion_time", now))
            stats = recs.groupBy("route_id").agg(*S.stat_columns())
            base = self.baseline(spark).filter(F.col("time_bucket") == C.time_bucket(now))
            ratio = C.anomaly_ratio("avg_delay_seconds", "baseline")
            out = stats.join(base.select("route_id", F.col("avg_delay_seconds").alias("baseline")),
                             "route_id", "left").select(
                F.lit(batch_id).cast("bigint").alias("batch_id"), "route_id",
                C.to_ntz(now).alias("window_end"), C.ttl_of(now).alias("ttl"), "event_count",
                C.half_even("avg_delay_seconds", 2).alias("avg_delay_seconds"),
                "max_delay_seconds", "late_count",
                C.half_even("baseline", 2).alias("batch_baseline_seconds"),
                C.half_even(ratio, 2).alias("anomaly_ratio"),
                C.is_anomaly(ratio, self.threshold).alias("is_anomaly"),
            )
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(self.stats_path))
            counters = parsed.agg(
                F.count(F.lit(1)).alias("processed"),
                F.count_distinct(F.when(valid, F.col("route_id"))).alias("routes_updated"),
            )
            (counters.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(self.counters_path))
        finally:
            parsed.unpersist()


def start_microbatch(lines: DataFrame, stats_path: str, counters_path: str, checkpoint: str,
                     baseline: Callable[[SparkSession], DataFrame], now: Column | None = None,
                     trigger: Trigger | None = None) -> StreamingQuery:
    writer = MicroBatchWriter(stats_path, counters_path, baseline, now)
    return (lines.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or production_trigger(60))).start())


# -- raw archive --------------------------------------------------------------------

LOG_COLUMNS = ("partition", "offset", "timestamp")
FILE_COLUMNS = ("file_name", "file_block_start", "file_modification_time")


def with_arrival(lines: DataFrame) -> DataFrame:
    """``value`` and what names its arrival: a log's own columns, or the file's name, block and modification time."""
    if set(LOG_COLUMNS) <= set(lines.columns):
        return lines.select(F.col("value").cast("string").alias("value"), *LOG_COLUMNS)
    return lines.select("value", *[F.col(f"_metadata.{c}").alias(c) for c in FILE_COLUMNS])


def arrival_of(arrived: DataFrame) -> tuple[Column, Column]:
    """(sequence, arrival time) of lines with their arrival.

    A file's lines are numbered in the order of their read: a replayed batch, which reads
    the same blocks, gives the same sequences, and equal lines get different ones.
    """
    if set(LOG_COLUMNS) <= set(arrived.columns):
        return F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")), F.col("timestamp")
    number = F.monotonically_increasing_id().bitwiseAND(F.lit(2 ** 33 - 1))       # within a task
    return (F.concat_ws(":", "file_name", F.col("file_block_start").cast("string"), number.cast("string")),
            F.col("file_modification_time"))


def archive_lines(lines: DataFrame, flushed: Column | None = None) -> DataFrame:
    """Decodable records (JSON objects) with arrival metadata and the flush-time partition columns.

    A log source carries ``partition``, ``offset`` and ``timestamp``: they name the
    record and its arrival. For a file source arrival is the file's modification
    time. The partition is the flush (processing) time, as the archive is laid out.
    """
    flushed = F.current_timestamp() if flushed is None else flushed
    if not set(FILE_COLUMNS) <= set(lines.columns):
        lines = with_arrival(lines)
    seq, arrival = arrival_of(lines)
    fields = F.concat(
        F.lit('"_kinesis_sequence":"'), seq, F.lit('","_kinesis_arrival":"'),
        F.date_format(arrival, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('"}'),
    )
    # the object's text up to its closing brace, and a comma unless it has no fields
    body = F.regexp_replace("value", r"\s*\}\s*$", "")
    value = F.concat(body, F.when(body.rlike(r"^\s*\{$"), F.lit("")).otherwise(F.lit(",")), fields)
    good = lines.filter(RW.is_record("value"))
    return good.select(
        value.alias("value"),
        F.year(flushed).alias("year"),
        F.lpad(F.month(flushed).cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth(flushed).cast("string"), 2, "0").alias("day"),
        F.lpad(F.hour(flushed).cast("string"), 2, "0").alias("hour"),
    )


def start_archive(lines: DataFrame, archive_path: str, checkpoint: str,
                  trigger: Trigger | None = None, bad_path: str | None = None) -> StreamingQuery:
    """JSON-lines archive partitioned ``year=/month=/day=/hour=`` by flush time; see ``ArchiveWriter``."""
    writer = ArchiveWriter(archive_path, os.path.join(checkpoint, "archive"), bad_path)
    return (with_arrival(lines).writeStream.foreachBatch(writer)
            .option("checkpointLocation", os.path.join(checkpoint, "query"))
            .trigger(**(trigger or production_trigger(60))).start())


class ArchiveWriter:
    """Sink of lines with their arrival: the archive, and the lines that are no records.

    A batch is flushed at one time, kept in ``state_path``, into a folder of its own
    below that hour, and its bad lines, with the reason and their place, go to
    ``<bad_path>/batch_id=``; a retried batch replaces both.
    """

    def __init__(self, path: str, state_path: str, bad_path: str | None = None):
        self.path, self.state_path, self.bad_path = path, state_path, bad_path

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark, at = lines.sparkSession, os.path.join(self.state_path, "FLUSHED")
        known = files.read_pointer(spark, at)
        if known is None or known["batch"] != batch_id:
            known = {"batch": batch_id, "at": datetime.now(timezone.utc).replace(tzinfo=None).isoformat()}
            files.write_pointer(spark, at, known)
        t = datetime.fromisoformat(known["at"])
        hour = os.path.join(self.path, t.strftime("year=%Y/month=%m/day=%d/hour=%H"))
        # the batch's folder is no partition column to readers
        archive_lines(lines, C.ts_literal(t)).select("value").write.mode("overwrite").text(
            os.path.join(hour, f"{t:%Y%m%d_%H%M%S}_batch-{batch_id}"))
        if self.bad_path:
            quarantined(lines).write.mode("overwrite").parquet(os.path.join(self.bad_path, f"batch_id={batch_id}"))


def quarantined(lines: DataFrame) -> DataFrame:
    """(value, reason, sequence, arrived): lines with their arrival that are no records."""
    seq, arrival = arrival_of(lines)
    parsed = F.try_parse_json("value")
    reason = (F.when(F.col("value").isNull(), "no payload").when(F.trim("value") == "", "empty line")
              .when(parsed.isNull(), "not JSON").otherwise("not an object"))
    return lines.where(~RW.is_record("value")).select("value", reason.alias("reason"), seq.alias("sequence"),
                                                      arrival.alias("arrived"))


def quarantine_counts(spark: SparkSession, bad_path: str) -> DataFrame:
    """(batch_id, reason, malformed) of the quarantined lines."""
    return (spark.read.parquet(bad_path).groupBy(F.col("batch_id").cast("bigint").alias("batch_id"), "reason")
            .agg(F.count(F.lit(1)).alias("malformed")))


class FanOut:
    """One read of the source for several sinks, each with its own ledger of finished batches.

    The batch is kept while the sinks take it one after another. If one fails, the
    query stops; when it is started again the batch comes again, and sinks that had
    finished it pass it over. A sink that failed half way replaces what it wrote.
    """

    def __init__(self, sinks: dict[str, Sink], ledger_path: str):
        self.sinks, self.ledger_path = sinks, ledger_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = {name: files.read_pointer(spark, self._at(name)) for name in self.sinks}
        open_ = [name for name in self.sinks if done[name] is None or done[name]["batch"] < batch_id]
        batch = batch.persist()
        try:
            for name in open_:
                self.sinks[name](batch, batch_id)
                files.write_pointer(spark, self._at(name), {"batch": batch_id})
        finally:
            batch.unpersist()

    def _at(self, name: str) -> str:
        return os.path.join(self.ledger_path, name)


def start_fan_out_once(lines: DataFrame, archive_path: str, view_path: str, snapshot_path: str, checkpoint_root: str,
                       baseline: Callable[[SparkSession], DataFrame], trigger: Trigger | None = None,
                       now: Column | None = None, size: str = C.WINDOW_SIZE, slide: str = C.WINDOW_SLIDE,
                       watermark: str = "10 minutes", bad_path: str | None = None,
                       sinks: dict[str, Sink] | None = None, **writer_args) -> StreamingQuery:
    """The raw archive and the speed layer from one read of the log, and any further ``sinks`` of its lines."""
    panes = PaneWindows(os.path.join(checkpoint_root, "speed", "state"), size, slide, watermark)
    speed = SpeedViewWriter(view_path, snapshot_path, panes, baseline, **writer_args)
    own = {"archive": ArchiveWriter(archive_path, os.path.join(checkpoint_root, "archive"), bad_path),
           "speed": lambda batch, batch_id: speed(RW.parse_speed_records(batch, now=now), batch_id)}
    return (with_arrival(lines).writeStream.foreachBatch(FanOut(own | (sinks or {}), os.path.join(checkpoint_root, "ledger")))
            .option("checkpointLocation", os.path.join(checkpoint_root, "query"))
            .trigger(**(trigger or production_trigger())).start())


def start_fan_out(lines: DataFrame, archive_path: str, view_path: str, snapshot_path: str,
                  checkpoint_root: str, baseline: Callable[[SparkSession], DataFrame],
                  trigger: Trigger | None = None, now: Column | None = None,
                  **window_args) -> tuple[StreamingQuery, StreamingQuery]:
    """One log feeds both consumers: the raw archive and the speed layer.

    Two independent streaming queries on the same source, each with its own
    checkpoint, so either can fail and restart without affecting the other.
    """
    archive = start_archive(lines, archive_path, os.path.join(checkpoint_root, "archive"),
                            trigger or production_trigger(60))
    records = RW.parse_speed_records(lines, now=now)
    speed = start_speed_layer(records, view_path, snapshot_path, os.path.join(checkpoint_root, "speed"),
                              baseline, trigger=trigger or production_trigger(), **window_args)
    return archive, speed


def run_to_completion(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query, without limit unless one is given; surface its failure."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
