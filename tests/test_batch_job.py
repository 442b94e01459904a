"""The batch job over a written archive equals the operators applied directly."""

import os
import tempfile

from pyspark.sql import functions as F

from headway.operators import batch as B
from headway.plans.batch_job import create_history_table, run_batch_job
from headway.sources import fixtures as X
from headway.sources import raw as RW
from headway.sources.published import read_view
from headway.streaming import replay as SR
from tests.conftest import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_job_over_archive(spark):
    archive = SR.archive(spark, SF_SMALL)            # also checks the archive can be scanned
    root = os.path.dirname(archive.inputFiles()[0])
    while not os.path.basename(root).startswith("raw"):
        root = os.path.dirname(root)
    out = tempfile.mkdtemp(prefix="hw-batch-")
    paths = run_batch_job(spark, root, out)
    assert paths is not None
    raw_all = RW.parse_raw_lines(X.raw_lines(spark, SF_SMALL))
    decodable = X.raw_lines(spark, SF_SMALL).filter(F.try_parse_json("value").isNotNull()).count()
    assert paths["input_counts"] == {"raw_records": decodable,
                                     "clean_records": B.clean_events(raw_all).count()}
    direct = B.clean_events(RW.parse_raw_lines(X.raw_lines(spark, SF_SMALL)))
    stats = spark.read.parquet(paths["route_statistics"])
    assert stats.select("generated_at").distinct().count() == 1
    assert _same(stats.drop("generated_at"), B.route_statistics(direct))
    top = spark.read.parquet(paths["top_delayed_routes"])
    assert [r.route_id for r in top.orderBy(F.desc("average_delay"), "route_id").collect()] == \
        [r.route_id for r in B.top_delayed_routes(direct).collect()]
    assert _same(top, B.top_delayed_routes(direct))
    view = spark.read.parquet(paths["batch_view"])
    assert _same(view, B.batch_view(B.route_statistics(direct)))
    create_history_table(spark, out, "hw_batch_delay_history")
    assert spark.table("hw_batch_delay_history").count() == stats.count()


def test_batch_job_empty_input(spark):
    empty = spark.createDataFrame([], X.events_to_delay_events(
        X.table(spark, SF_SMALL, "events")).schema)
    out = tempfile.mkdtemp(prefix="hw-batch-empty-")
    assert run_batch_job(spark, "", out, raw=empty) is None


def test_archive_partition_pruning(spark):
    from datetime import datetime, timedelta

    from headway.schemas import RAW_SCHEMA

    lines = X.raw_lines(spark, SF_SMALL)
    parsed = RW.parse_raw_lines(lines)
    t = F.try_to_timestamp("ingestion_time")
    d = tempfile.mkdtemp(prefix="hw-archive-")
    # an archive whose flush hour equals the event hour
    (lines.withColumn("t", F.try_to_timestamp(F.get_json_object("value", "$.ingestion_time")))
          .filter(F.col("t").isNotNull())
          .select("value", F.year("t").alias("year"), F.lpad(F.month("t").cast("string"), 2, "0").alias("month"),
                  F.lpad(F.dayofmonth("t").cast("string"), 2, "0").alias("day"),
                  F.lpad(F.hour("t").cast("string"), 2, "0").alias("hour"))
          .write.partitionBy("year", "month", "day", "hour").text(f"{d}/raw"))
    since, until = datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18)
    got = RW.read_raw_json(spark, f"{d}/raw", since, until, max_lag=timedelta(hours=1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(year" in plan
    want = parsed.filter((t >= F.lit("2024-01-10 06:00:00").cast("timestamp"))
                         & (t < F.lit("2024-01-12 18:00:00").cast("timestamp")))
    cols = [f.name for f in RAW_SCHEMA.fields]
    assert _same(got.select(*cols), want.select(*cols)) and want.count() > 0
    # only the hour folders of the range (plus one on each side) are read
    got.collect()                                   # runs this frame's own plan
    qe = got._jdf.queryExecution().executedPlan()
    final = qe.executedPlan() if qe.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else qe
    scan = final.collectLeaves().apply(0)
    files_read = scan.metrics().apply("numFiles").value()
    all_hours = len(got.inputFiles())
    assert 0 < files_read <= 2 * 24 + 14 < all_hours


def test_records_flushed_late_and_unparsable_times_are_kept(spark):
    from datetime import datetime

    d = tempfile.mkdtemp(prefix="hw-late-")
    rows = [('{"event_id":"a","ingestion_time":"2024-01-10T10:30:00"}', 15), ('{"event_id":"b","ingestion_time":"x"}', 11),
            ('{"event_id":"c","ingestion_time":"2024-01-10T12:30:00"}', 12), ('{"event_id":"d","ingestion_time":"2024-01-10T09:59:00"}', 10)]
    df = spark.createDataFrame(rows, "value string, hour int").withColumn("hour", F.lpad(F.col("hour").cast("string"), 2, "0"))
    df = df.select("value", F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("10").alias("day"), "hour")
    df.write.partitionBy("year", "month", "day", "hour").text(f"{d}/raw")
    got = RW.read_raw_json(spark, f"{d}/raw", datetime(2024, 1, 10, 10), datetime(2024, 1, 10, 11))
    assert sorted(r.event_id for r in got.collect()) == ["a", "b"]


def test_command_line_batch_and_query(spark, capsys):
    from headway.__main__ import main

    lines = X.raw_lines(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="hw-cli-")
    lines.write.text(f"{d}/raw")
    assert main(["batch", "--input", f"{d}/raw", "--output", f"{d}/views"]) == 0
    stats = read_view(spark, f"{d}/views/route_statistics")
    assert _same(stats.drop("generated_at"), B.route_statistics(B.clean_events(RW.parse_raw_lines(lines))))
    assert main(["query", "top_delayed_live", "--data", SF_SMALL, "--rows", "5"]) == 0
    assert "R01" in capsys.readouterr().out


def test_three_layers_through_their_jobs(spark):
    """Batch job -> batch view; speed layer -> speed view; serving merge over both tables."""
    from headway.__main__ import main
    from headway.plans import catalog as Q
    from headway.plans.serving_job import route_verdicts
    from headway.streaming import jobs as J

    d = tempfile.mkdtemp(prefix="hw-lambda-")
    paths = run_batch_job(spark, "", f"{d}/views", raw=X.history_events(spark, SF_SMALL))
    ev = X.table(spark, SF_SMALL, "events").filter(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    ev.write.parquet(f"{d}/live")
    src = J.file_stream(spark, f"{d}/live", schema=ev.schema)
    q = J.start_speed_layer(X.events_to_delay_events(src), f"{d}/view", f"{d}/top", f"{d}/ckpt",
                            lambda s: s.read.parquet(paths["batch_view"]), "6 hours", "1 hour", "1 hour",
                            J.REPLAY)
    J.run_to_completion(q)
    merged = route_verdicts(spark, f"{d}/view", paths["batch_view"], X.AS_OF)
    assert merged.count() > 0 and _same(merged, Q.QUERIES["serving_merge"](spark, SF_SMALL))
    one = route_verdicts(spark, f"{d}/view", paths["batch_view"], X.AS_OF, route_id="R05")
    assert _same(one, Q.QUERIES["route_detail"](spark, SF_SMALL))
    alive = route_verdicts(spark, f"{d}/view", paths["batch_view"], X.AS_OF, apply_ttl=True)
    assert alive.filter(F.col("speed_window_end") < F.lit("2024-01-28 11:00:01").cast("timestamp_ntz")).count() == 0
    assert main(["merge", "--batch-view", paths["batch_view"], "--view", f"{d}/view",
                 "--as-of", "2024-01-28T12:00:00", "--output", f"{d}/verdicts"]) == 0
    assert _same(spark.read.parquet(f"{d}/verdicts"), merged)


def test_command_line_streaming_jobs_once(spark):
    from headway.__main__ import main

    d = tempfile.mkdtemp(prefix="hw-cli-stream-")
    run_batch_job(spark, "", f"{d}/views", raw=X.history_events(spark, SF_SMALL))
    X.raw_lines(spark, SF_SMALL).write.text(f"{d}/lines")
    X.envelopes(spark, SF_SMALL).write.text(f"{d}/envelopes")
    assert main(["microbatch", "--input", f"{d}/envelopes", "--batch-view", f"{d}/views/batch_view",
                 "--stats", f"{d}/mb_stats", "--counters", f"{d}/mb_counters", "--checkpoint", f"{d}/mb_ckpt",
                 "--once"]) == 0
    counters = spark.read.parquet(f"{d}/mb_counters").agg(F.sum("processed")).first()[0]
    assert counters == X.table(spark, SF_SMALL, "events").count()
    assert main(["speed", "--input", f"{d}/envelopes", "--envelopes", "--batch-view", f"{d}/views/batch_view",
                 "--view", f"{d}/view", "--snapshots", f"{d}/top", "--checkpoint", f"{d}/sp_ckpt",
                 "--size", "6 hours", "--slide", "1 hour", "--watermark", "30 days", "--once"]) == 0
    assert spark.read.parquet(f"{d}/view").count() > 0
    assert main(["archive", "--input", f"{d}/lines", "--output", f"{d}/raw", "--checkpoint", f"{d}/ar_ckpt",
                 "--once"]) == 0
    decodable = X.raw_lines(spark, SF_SMALL).filter(F.try_parse_json("value").isNotNull()).count()
    assert RW.read_raw_json(spark, f"{d}/raw").count() == decodable
