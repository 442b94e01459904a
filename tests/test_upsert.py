"""Tables of micro-batches and their compaction, late panes, several sinks from one read."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators import batch as B
from headway.operators import speed as S
from headway.sources import files
from headway.sources import fixtures as X
from headway.sources import raw as RW
from headway.streaming import jobs as J
from headway.streaming.upsert import UpsertTable
from tests.conftest import SF_SMALL
from tests.test_streaming import _same

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.TimestampNTZType()),
                       T.StructField("x", T.LongType())])


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, at string, x long").withColumn("at", F.col("at").cast("timestamp_ntz"))


def got(table, spark):
    return sorted((r.k, r.x) for r in table.read(spark).collect())


def test_newest_batch_counts_and_a_retry_replaces_its_rows(spark):
    t = UpsertTable(tempfile.mkdtemp(prefix="hw-up-") + "/t", SCHEMA, ("k",), "at")
    assert got(t, spark) == []
    t.write(rows_of(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2)), 0)
    t.write(rows_of(spark, ("a", "2024-01-01", 9)), 1)
    t.write(rows_of(spark, ("a", "2024-01-01", 3)), 1)
    assert got(t, spark) == [("a", 3), ("b", 2)]
    t.compact(spark, 1)
    assert got(t, spark) == [("a", 3), ("b", 2)]
    t.write(rows_of(spark, ("a", "2024-01-01", 7)), 1)                 # retried after its compaction: no change
    assert got(t, spark) == [("a", 3), ("b", 2)]
    t.write(rows_of(spark, ("b", "2024-01-02", 5), ("c", "2024-01-01", 6)), 2)
    assert got(t, spark) == [("a", 3), ("b", 5), ("c", 6)]
    t.compact(spark, 2, F.col("x") > 3)
    assert got(t, spark) == [("b", 5), ("c", 6)]


def test_many_batches_leave_one_folder_a_date_and_a_bounded_listing(spark):
    path = tempfile.mkdtemp(prefix="hw-up-") + "/t"
    t, most = UpsertTable(path, SCHEMA, ("k",), "at"), 0
    for b in range(60):
        t.write(rows_of(spark, (f"k{b % 7}", f"2024-01-0{b % 3 + 1}", b)), b)
        if b % 10 == 9:
            t.compact(spark, b)
        most = max(most, sum(len(files.folders(spark, f"{path}/{d}")) for d in files.folders(spark, path) if d[:3] == "dt="))
    assert most <= 20                                                  # two spans of ten batches
    want = {f"k{b % 7}": b for b in range(60)}
    assert got(t, spark) == sorted(want.items())
    base = t.pointer(spark)["base"]
    assert files.folders(spark, f"{path}/_base/{base}") == ["dt=2024-01-01", "dt=2024-01-02", "dt=2024-01-03"]
    assert len(files.folders(spark, f"{path}/_base")) <= 2


def test_a_reader_of_the_pointer_before_still_finds_its_files(spark):
    t = UpsertTable(tempfile.mkdtemp(prefix="hw-up-") + "/t", SCHEMA, ("k",), "at")
    for b in range(4):
        t.write(rows_of(spark, ("a", "2024-01-01", b), (f"k{b}", "2024-01-01", b)), b)
        if b == 1:
            t.compact(spark, 1)
    old = t.read(spark)                                                # planned on the base up to 1 and two batches
    t.compact(spark, 3)
    assert sorted((r.k, r.x) for r in old.collect()) == got(t, spark) == [("a", 3), ("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)]


def events_in_parts(spark, d, n=8):
    ev = X.table(spark, SF_SMALL, "events").filter(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    for k in range(n):
        ev.filter(F.pmod("event_id", F.lit(n)) == k).coalesce(1).write.parquet(f"{d}/in/part{k}")
    return J.file_stream(spark, f"{d}/in", schema=ev.schema, max_files=1, recursive=True)


def history_view(s):
    return B.batch_view(B.route_statistics(B.clean_events(X.history_events(s, SF_SMALL))))


def test_speed_layer_with_compaction_equals_batch_twin_and_stays_small(spark):
    d = tempfile.mkdtemp(prefix="hw-compact-")
    src = events_in_parts(spark, d)
    q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt", history_view,
                            "6 hours", "1 hour", "30 days", J.REPLAY, compact_every=3)
    J.run_to_completion(q)
    windows = S.sliding_window_stats(X.live_events(spark, SF_SMALL), "6 hours", "1 hour")
    assert _same(J.read_speed_view(spark, f"{d}/view"), S.speed_with_baseline(windows, history_view(spark)))
    assert _same(J.read_snapshots(spark, f"{d}/top"), S.top_n_snapshot(windows))
    assert not files.exists(spark, f"{d}/ckpt/query/state")             # the pane table is all the state
    for day in [f for f in files.folders(spark, f"{d}/view") if f.startswith("dt=")]:
        assert len(files.folders(spark, f"{d}/view/{day}")) <= 6
    one = J.read_speed_view(spark, f"{d}/view", columns=("window_size_minutes", "ttl", "window_end")).first()
    assert one.window_size_minutes == 360.0 and one.ttl > 0


def test_expired_rows_go_with_compaction(spark):
    d = tempfile.mkdtemp(prefix="hw-expire-")
    src = events_in_parts(spark, d, 2)
    q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt", history_view,
                            "6 hours", "1 hour", "30 days", J.REPLAY, compact_every=2, expire=True)
    J.run_to_completion(q)
    assert J.read_speed_view(spark, f"{d}/view").count() == 0           # all of 2024 is past its hour
    assert J.read_snapshots(spark, f"{d}/top").count() == 0


def test_late_panes_are_reported_and_corrected_once(spark):
    d = tempfile.mkdtemp(prefix="hw-late-")
    base = [("R1", "2024-01-01 10:10:00", 30), ("R2", "2024-01-01 10:20:00", 90), ("R1", "2024-01-01 15:00:00", 10)]
    late = [("R1", "2024-01-01 10:40:00", 600), ("R2", "2024-01-01 15:10:00", 20), ("R3", "2024-01-01 09:00:00", 5)]

    def events(rows):
        return spark.createDataFrame(rows, "route_id string, t string, delay_seconds int").select(
            "route_id", "delay_seconds", F.lit("tfi_trip_updates").alias("source"), F.col("t").cast("timestamp").alias("event_ts"))

    def stats(df):
        return sorted((r.route_id, str(r.window_start), r.event_count, r.max_delay_seconds, r.late_count) for r in df.collect())

    for correct in (False, True):
        panes = J.PaneWindows(f"{d}/{correct}", "2 hours", "1 hour", "1 hour", correct_late=correct)
        out = J.WindowWriter(f"{d}/{correct}-out", panes)
        out(events(base), 0)
        out(events(late), 1)
        out(events(late), 1)                                            # retried
        assert {(r.route_id, r.n) for r in panes.late.read(spark).collect()} == {("R1", 1), ("R3", 1)}
        read = lambda: J.read_windows(spark, f"{d}/{correct}-out", f"{d}/{correct}", "1 hour").drop("is_final")
        every = stats(S.sliding_window_stats(events(base + late), "2 hours", "1 hour"))
        on_time = stats(S.sliding_window_stats(events(base + late[1:2]), "2 hours", "1 hour"))
        assert stats(read()) == (every if correct else on_time)
        if not correct:
            panes.correct(spark, J.window_table(f"{d}/{correct}-out"))
            assert stats(read()) == every
            assert panes.uncorrected(spark).count() == 0
            panes.correct(spark, J.window_table(f"{d}/{correct}-out"))   # nothing is left to add
            assert stats(read()) == every
        out(events([("R1", "2024-01-01 15:20:00", 1)]), 2)
        more = base + late + [("R1", "2024-01-01 15:20:00", 1)]
        assert stats(read()) == stats(S.sliding_window_stats(events(more), "2 hours", "1 hour"))


def test_a_new_checkpoint_over_an_old_state_goes_on_counting(spark):
    d = tempfile.mkdtemp(prefix="hw-again-")
    panes = J.PaneWindows(f"{d}/state", "2 hours", "1 hour", "1 hour")
    assert J.first_batch(spark, panes, f"{d}/c1") == 0
    files.write_pointer(spark, f"{d}/state/NEWEST", {"batch": 41, "before": None, "newest": "2024-01-01T00:00:00"})
    assert J.first_batch(spark, panes, f"{d}/c1") == 0 and J.first_batch(spark, panes, f"{d}/c2") == 42
    files.write_pointer(spark, f"{d}/state/NEWEST", {"batch": 50, "before": None, "newest": "2024-01-01T00:00:00"})
    assert J.first_batch(spark, panes, f"{d}/c2") == 42


@pytest.mark.parametrize("broken", ["archive", "speed", "third"])
def test_a_failing_sink_loses_and_doubles_nothing(spark, broken):
    d = tempfile.mkdtemp(prefix="hw-fan-")
    lines = X.raw_lines(spark, SF_SMALL)
    for k in range(4):
        lines.filter(F.pmod(F.xxhash64("value"), F.lit(4)) == k).coalesce(1).write.text(f"{d}/in/part{k}")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    taken, fail = [], {"left": 1}

    def third(batch, batch_id):
        taken.append((batch_id, batch.count()))

    def run():
        src = spark.readStream.format("text").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").load(f"{d}/in")
        return J.start_fan_out_once(src, f"{d}/raw", f"{d}/view", f"{d}/top", f"{d}/ckpt", history_view, J.REPLAY, now,
                                    "6 hours", "1 hour", "30 days", f"{d}/bad", {"third": third})

    whole = J.FanOut.__call__

    def killed(self, batch, batch_id):
        """The sink writes batch 2 and then fails, before the ledger has it."""
        inner = self.sinks[broken]

        def once(b, i):
            inner(b, i)
            if i == 2 and fail["left"]:
                fail["left"] = 0
                raise RuntimeError("killed")

        self.sinks = self.sinks | {broken: once}
        try:
            whole(self, batch, batch_id)
        finally:
            self.sinks = self.sinks | {broken: inner}

    J.FanOut.__call__ = killed
    try:
        with pytest.raises(Exception, match="killed"):
            J.run_to_completion(run())
        J.run_to_completion(run())
    finally:
        J.FanOut.__call__ = whole
    want = RW.malformed_records(lines).first()
    assert RW.read_raw_json(spark, f"{d}/raw").count() == want.decoded
    assert J.quarantine_counts(spark, f"{d}/bad").agg(F.sum("malformed")).first()[0] == want.malformed
    records = RW.parse_speed_records(lines, now=now)
    assert _same(J.read_speed_view(spark, f"{d}/view"),
                 S.speed_with_baseline(S.sliding_window_stats(records, "6 hours", "1 hour"), history_view(spark)))
    assert [i for i, _ in taken] == ([0, 1, 2, 2, 3] if broken == "third" else [0, 1, 2, 3])
    assert sum(dict(taken).values()) == lines.count()


def test_quarantined_lines_carry_reason_and_place(spark):
    d = tempfile.mkdtemp(prefix="hw-bad-")
    lines = ['{"a":1}', "[1]", "nope", "", "42", '{"a":']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{d}/in")
    rows = J.quarantined(spark.read.text(f"{d}/in").select("value", *[F.col(f"_metadata.{c}").alias(c) for c in J.FILE_COLUMNS]))
    assert sorted((r.value, r.reason) for r in rows.collect()) == [
        ("", "empty line"), ("42", "not an object"), ("[1]", "not an object"), ("nope", "not JSON"), ('{"a":', "not JSON")]
    assert rows.where("sequence is null or arrived is null").count() == 0


def test_archive_sequences_are_the_same_when_a_batch_is_read_again(spark):
    d = tempfile.mkdtemp(prefix="hw-seq-")
    spark.createDataFrame([('{"a":1}',)] * 50, "value string").repartition(3).write.text(f"{d}/in")
    seen, write = [], J.ArchiveWriter.__call__

    def twice(self, lines, batch_id):
        for _ in range(2):                                              # as a batch that is tried again
            write(self, lines, batch_id)
            rows = spark.read.text(f"{d}/raw").select("value").collect()
            seen.append(sorted(json.loads(r.value)["_kinesis_sequence"] for r in rows))

    J.ArchiveWriter.__call__ = twice
    try:
        J.run_to_completion(J.start_archive(spark.readStream.format("text").load(f"{d}/in"), f"{d}/raw", f"{d}/c", J.REPLAY))
    finally:
        J.ArchiveWriter.__call__ = write
    assert seen[0] == seen[1] and len(set(seen[0])) == 50
