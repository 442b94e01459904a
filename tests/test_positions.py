"""Start positions and bounds of streams, views published in one step, hour folders."""

import os
import tempfile
import threading
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from headway.operators import batch as B
from headway.operators import speed as S
from headway.plans.batch_job import run_batch_job, run_incremental_job
from headway.sources import files
from headway.sources import fixtures as X
from headway.sources import hours as H
from headway.sources import published as P
from headway.sources import raw as RW
from headway.streaming import jobs as J
from headway.streaming import positions as POS
from headway.streaming import replay as SR
from tests.conftest import SF_SMALL
from tests.test_streaming import _same


def put(path, name, *lines, age=0):
    os.makedirs(path, exist_ok=True)
    full = os.path.join(path, name)
    with open(full, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(full, (time.time() - age,) * 2)


def read_all(spark, d, start, ckpt, resume=True):
    rows = POS.lines_from(spark, f"{d}/in", "text", start, f"{d}/{ckpt}", resume)
    q = rows.writeStream.format("parquet").option("path", f"{d}/out-{ckpt}").option(
        "checkpointLocation", f"{d}/{ckpt}/query").trigger(availableNow=True).start()
    J.run_to_completion(q)
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{d}/out-{ckpt}").collect())


def test_latest_skips_what_came_before_and_a_restart_goes_on(spark):
    d = tempfile.mkdtemp(prefix="hw-start-")
    put(f"{d}/in", "a", "old", age=60)
    assert read_all(spark, d, "latest", "c1") == []
    time.sleep(1.1)
    put(f"{d}/in", "b", "between")
    assert read_all(spark, d, "latest", "c1") == ["between"]          # the same query goes on
    time.sleep(1.1)
    assert read_all(spark, d, "latest", "c2") == []                   # a second start skips what came between
    time.sleep(1.1)
    put(f"{d}/in", "c", "new")
    assert read_all(spark, d, "latest", "c2") == ["new"]
    assert read_all(spark, d, "earliest", "c3") == ["between", "new", "old"]
    assert read_all(spark, d, "latest", "c1") == ["between", "new"]


def test_latest_without_resume_skips_what_came_while_down(spark):
    d = tempfile.mkdtemp(prefix="hw-start-")
    put(f"{d}/in", "a", "old", age=60)
    assert read_all(spark, d, "latest", "c", resume=False) == []
    time.sleep(1.1)
    put(f"{d}/in", "b", "missed")
    time.sleep(1.1)
    assert read_all(spark, d, "latest", "c", resume=False) == []


def test_start_at_an_instant(spark):
    d = tempfile.mkdtemp(prefix="hw-start-")
    for name, age in (("a", 300), ("b", 100), ("c", 20)):
        put(f"{d}/in", name, name, age=age)
    at = datetime.now(timezone.utc) - timedelta(seconds=150)
    assert read_all(spark, d, at.isoformat(), "c1") == ["b", "c"]
    assert read_all(spark, d, at.replace(tzinfo=None).isoformat(), "c2") == ["b", "c"]


def test_positions_and_bounds_of_a_log():
    assert POS.log_options("latest", 500) == {"startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}
    assert POS.log_options("earliest", None) == {"startingOffsets": "earliest"}
    at = POS.log_options("2024-01-10T10:00:00+01:00", 100)
    assert at["startingTimestamp"] == "1704877200000" and at["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        POS.log_options("yesterday", None)
    with pytest.raises(ValueError, match="new checkpoint"):
        POS.lines_from(None, "topic", "kafka", resume=False)


def test_other_formats_start_with_their_own_options(spark):
    with pytest.raises(ValueError, match="own options"):
        POS.lines_from(spark, "", "rate", "latest")
    assert POS.lines_from(spark, "", "rate", options={"rowsPerSecond": "1"}).isStreaming


def test_bounded_reads_of_fifty_parts_equal_the_batch_twin(spark):
    d = tempfile.mkdtemp(prefix="hw-parts-")
    events = X.table(spark, SF_SMALL, "events").orderBy("ts").repartitionByRange(50, "ts")
    events.write.parquet(f"{d}/in")
    names = sorted(n for n in os.listdir(f"{d}/in") if n.endswith(".parquet"))
    for k, name in enumerate(names):                                        # they arrive in the order of their events
        os.utime(os.path.join(d, "in", name), (time.time() - 1000 + 10 * k,) * 2)
    src = POS.folder_stream(spark, f"{d}/in", per_read=7, fmt="parquet", schema=X.table(spark, SF_SMALL, "events").schema)
    q = J.start_windows(X.events_to_delay_events(src), f"{d}/out", f"{d}/ckpt", "6 hours", "1 hour", "1 hour", J.REPLAY,
                        compact_every=3)
    J.run_to_completion(q)
    assert len(q.recentProgress) >= 8
    twin = S.sliding_window_stats(X.delay_events(spark, SF_SMALL), "6 hours", "1 hour")
    out = J.read_windows(spark, f"{d}/out", f"{d}/ckpt/state", "1 hour")
    assert _same(out.drop("is_final"), twin)
    assert 0 < out.filter("not is_final").count() < out.filter("is_final").count()


def test_readers_never_see_two_versions_or_half_of_one(spark):
    root = tempfile.mkdtemp(prefix="hw-pub-")
    errors, seen, stop = [], set(), threading.Event()

    def publish(k):
        v = P.Version(spark, root)
        v.write("a", spark.range(k * 10, k * 10 + 3).withColumn("run", F.lit(k)))
        v.write("b", spark.range(5).withColumn("run", F.lit(k)))
        v.commit()

    def read():
        try:
            while not stop.is_set():
                files.read_pointer(spark, f"{root}/OTHER")
                at = P.version_root(spark, root)
                a = spark.read.parquet(f"{at}/a").collect()
                b = spark.read.parquet(f"{at}/b").collect()
                runs = {r.run for r in a + b}
                if len(runs) != 1 or len(a) != 3 or len(b) != 5:
                    errors.append((a, b))
                seen.update(runs)
        except Exception as e:                                          # noqa: BLE001 - reported below
            errors.append(e)

    publish(0)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 11):
            publish(k)
            for _ in range(50):                                         # the pointer alone, read while it is replaced
                files.write_pointer(spark, f"{root}/OTHER", {"k": k})
    finally:
        stop.set()
        reader.join()
    assert not errors and len(seen) > 1
    assert sorted(r.run for r in P.read_view(spark, f"{root}/a").collect()) == [10] * 3
    assert len([f for f in files.folders(spark, root) if f.startswith("version=")]) == P.KEEP


def test_a_failed_or_empty_run_leaves_the_views_in_place(spark):
    root = tempfile.mkdtemp(prefix="hw-pub-")
    events = X.delay_events(spark, SF_SMALL)
    run_batch_job(spark, "", root, raw=events)
    before = P.view_path(spark, f"{root}/batch_view")
    half = P.Version(spark, root)
    half.write("batch_view", spark.range(1))                              # never committed
    assert run_batch_job(spark, "", root, raw=events.limit(0)) is None
    assert P.view_path(spark, f"{root}/batch_view") == before
    paths = run_batch_job(spark, "", root, raw=events)
    assert P.view_path(spark, f"{root}/batch_view") == paths["batch_view"] != before
    plain = tempfile.mkdtemp(prefix="hw-plain-")
    spark.range(4).write.parquet(f"{plain}/view")
    assert P.read_view(spark, f"{plain}/view").count() == 4               # a table that is not published


def test_incremental_runs_equal_one_full_run(spark):
    archive = SR.hour_archive(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="hw-inc-")
    first, done = datetime(2024, 1, 1), 0
    for k in range(10):
        got = run_incremental_job(spark, archive, root, first + timedelta(days=3 * k, hours=7 * k))
        done += got["folders"] if got else 0
        if k == 4:
            assert run_incremental_job(spark, archive, root, first + timedelta(days=12)) is None     # nothing new
    rest = run_incremental_job(spark, archive, root, datetime(2025, 1, 1))
    assert done + rest["folders"] == len(H.hour_folders(spark, archive, datetime.max)) and done > 0
    direct = B.route_statistics(B.clean_events(RW.read_raw_json(spark, archive)))
    assert _same(P.read_view(spark, f"{root}/route_statistics").drop("generated_at"), direct)
    assert _same(P.read_view(spark, f"{root}/batch_view"), B.batch_view(direct))
    assert run_incremental_job(spark, archive, root, datetime(2025, 1, 1)) is None


def test_ranges_prune_folders_without_a_bound_on_lateness(spark):
    archive = SR.hour_archive(spark, SF_SMALL)
    ranges = tempfile.mkdtemp(prefix="hw-ranges-")
    since, until = datetime(2024, 1, 10, 6), datetime(2024, 1, 11, 6)
    whole = RW.read_raw_json(spark, archive, since, until)
    assert _same(H.read_between(spark, archive, ranges, since, until), whole)           # before any range is known
    assert H.update_ranges(spark, archive, ranges, datetime(2024, 1, 11)) > 0
    assert H.update_ranges(spark, archive, ranges, datetime(2024, 1, 11)) == 0
    assert _same(H.read_between(spark, archive, ranges, since, until), whole)           # later folders have none yet
    H.update_ranges(spark, archive, ranges, datetime.max)
    got = H.read_between(spark, archive, ranges, since, until)
    assert _same(got, whole) and got.count() > 0
    everything = len(spark.read.text(archive).inputFiles())
    assert len(got.inputFiles()) < everything / 5
    assert H.read_between(spark, archive, ranges).count() == RW.read_raw_json(spark, archive).count()
