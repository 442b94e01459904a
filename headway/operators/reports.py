"""Run-log reports: request latency percentiles, ingest throughput, batch speedup.

Exact order statistics are computed without putting a group into one task:
values are first collapsed map-side to (group, value, count) and to a histogram
of (group, value bucket); the running total over a group's few buckets finds the
bucket that holds each wanted rank, and only the values of those buckets are
numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import columns as C

BUCKET_MS = 1.0     # width of a histogram bucket of latencies


def exact_ranks(df: DataFrame, group: str, value: str, targets: DataFrame, width: float = BUCKET_MS) -> DataFrame:
    """Value at each wanted 1-based rank of its group.

    ``targets`` has columns (``group``, ``key``, ``r``): for each group the
    ranks to fetch, each under a label ``key``. Returns (group, key, value).
    NULL values are ignored (they have no rank).
    """
    bucket = F.floor(F.col(value) / F.lit(width))
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(
        F.count(F.lit(1)).alias("c")
    ).withColumn("b", bucket)
    upto = Window.partitionBy(group).orderBy("b")
    histogram = counts.groupBy(group, "b").agg(F.sum("c").alias("n")).withColumn("upto", F.sum("n").over(upto))
    wanted = histogram.join(targets, group).filter(
        (F.col("upto") - F.col("n") < F.col("r")) & (F.col("r") <= F.col("upto"))
    ).select(group, "b", "key", "r", (F.col("upto") - F.col("n")).alias("before"))
    inside = Window.partitionBy(group, "key").orderBy(value)
    cum = F.col("before") + F.sum("c").over(inside)
    hit = counts.join(wanted, [group, "b"]).withColumn("cum", cum)
    return hit.filter((F.col("cum") - F.col("c") < F.col("r")) & (F.col("r") <= F.col("cum"))).select(
        group, "key", value)


def latency_report(requests: DataFrame, group: str = "concurrency") -> DataFrame:
    """Per concurrency: requests, successful, failed, mean, median, p95, p99 (ms, 2 dp).

    Statistics are over successful requests with a latency. p95/p99 are
    nearest-index: the value at 0-based index min(int(n * p / 100), n - 1) of
    the sorted latencies; the median averages the two middle values when n is
    even.
    """
    good = F.col("success") & F.col("latency_ms").isNotNull()
    ok = requests.filter(good)
    stats = requests.groupBy(group).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(good).alias("successful"),
        F.avg(F.when(good, F.col("latency_ms"))).alias("mean"),
    )
    n = F.col("successful")
    targets = stats.filter(n > 0).select(
        group,
        F.explode(F.array(
            F.struct(F.lit("lo").alias("key"), F.floor((n + 1) / 2).alias("r")),
            F.struct(F.lit("hi").alias("key"), (F.floor(n / 2) + 1).alias("r")),
            F.struct(F.lit("p95").alias("key"), C.nearest_rank(n, 95).alias("r")),
            F.struct(F.lit("p99").alias("key"), C.nearest_rank(n, 99).alias("r")),
        )).alias("t"),
    ).select(group, "t.key", F.col("t.r").cast("bigint").alias("r"))
    picked = exact_ranks(ok, group, "latency_ms", targets).groupBy(group).pivot(
        "key", ["lo", "hi", "p95", "p99"]
    ).agg(F.first("latency_ms"))
    out = stats.join(picked, group, "left")
    return out.select(
        group,
        "requests",
        "successful",
        (F.col("requests") - F.col("successful")).alias("failed"),
        C.half_even("mean", 2).alias("avg_latency_ms"),
        C.half_even((F.col("lo") + F.col("hi")) / 2, 2).alias("p50_ms"),
        C.half_even("p95", 2).alias("p95_ms"),
        C.half_even("p99", 2).alias("p99_ms"),
    )


def throughput_report(runs: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Per target rate: records, successes, success rate (% 2 dp), achieved records/s.

    ``spans`` (target_rate, started_at, ended_at) is the log of whole runs, whose time
    includes the waits before the first and after the last record. Without it a
    run's elapsed time is the span between its first and last record.
    """
    span = (F.unix_micros(F.max("sent_at")) - F.unix_micros(F.min("sent_at"))) / 1e6
    agg = runs.groupBy("target_rate").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("success").alias("success"),
        span.alias("elapsed_s"),
    )
    if spans is not None:
        whole = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1e6
        agg = agg.drop("elapsed_s").join(
            spans.groupBy("target_rate").agg(F.sum(whole).alias("elapsed_s")), "target_rate", "left")
    return agg.select(
        "target_rate", "total_records", "success",
        C.half_even(F.col("success") / F.col("total_records") * 100, 2).alias("success_rate"),
        C.half_even(F.when(F.col("elapsed_s") > 0, F.col("success") / F.col("elapsed_s")), 2)
        .alias("actual_rps"),
    )


def speedup_report(runs: DataFrame, job: Sequence[str]) -> DataFrame:
    """Speedup and efficiency of each run against the first completed run.

    Runs are taken in partition order; the baseline is the elapsed time of the
    first COMPLETED run up to the current one. A run that did not complete, or
    that precedes any completed run, has speedup 0. efficiency = speedup / p.
    """
    w = Window.partitionBy(*job).orderBy("partitions").rowsBetween(Window.unboundedPreceding, 0)
    completed = F.col("state") == "COMPLETED"
    baseline = F.first(F.when(completed, F.col("time_seconds")), ignorenulls=True).over(w)
    speedup = F.when(completed & baseline.isNotNull(), baseline / F.col("time_seconds")).otherwise(0.0)
    eff = F.when(F.col("partitions") > 0, F.col("speedup") / F.col("partitions")).otherwise(0.0)
    return runs.withColumn("speedup", speedup).select(
        *job, "partitions", "state",
        C.half_even("time_seconds", 2).alias("time_seconds"),
        C.half_even("speedup", 3).alias("speedup"),
        C.half_even(eff, 3).alias("efficiency"),
    )
