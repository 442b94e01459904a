"""The batch layer as one job: raw archive -> route statistics, top routes, batch view.

The archive is scanned once. Events are reduced to a small mergeable table
(route x weekday x hour: exact sum, max, count) that is written with the
views; every published view is derived from that table, so neither
the second view nor the empty-input guard rescans the archive. All views of a run
become current in one step (``sources.published``); a run that failed leaves the
ones before in place.

The incremental job reads only the hour folders that no run has read yet, adds
their partials to those of the version before, and publishes both with the list of
folders read, so a folder counts once however often a run is repeated.
"""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.operators import batch as B
from headway.sources import hours as H
from headway.sources import raw as RW
from headway.sources.published import Version, view_path

PARTIALS, FOLDERS = "_route_bucket_partials", "_hour_folders"
VIEWS = ("route_statistics", "top_delayed_routes", "batch_view", "batch_delay_history")


def write_views(partials: DataFrame, version: Version, generated_at: str, top_n: int = B.TOP_ROUTES) -> dict[str, str]:
    """Every batch view from the bucket partials, in the version's folder."""
    stats = B.statistics_from_partials(partials)
    version.write("route_statistics", stats.withColumn("generated_at", F.lit(generated_at)))
    version.write("top_delayed_routes", B.top_routes_from_partials(partials, top_n))
    version.write("batch_view", B.batch_view(stats))
    version.write("batch_delay_history", B.batch_delay_history(stats))
    return {v: version.path(v) for v in VIEWS}


def _now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def run_batch_job(spark: SparkSession, input_path: str, output_path: str,
                  since: datetime | None = None, until: datetime | None = None,
                  raw: DataFrame | None = None) -> dict | None:
    """Run the batch layer; returns the written paths, or None for an empty input.

    ``raw`` may replace the archive scan (any frame with the raw record
    columns); otherwise ``input_path`` is read as the partitioned JSON archive,
    pruned to ``[since, until)`` when given. An empty input leaves the views as they are.
    """
    records = raw if raw is not None else RW.read_raw_json(spark, input_path, since, until)
    # Input counts ride along with the single scan (no extra count() job).
    seen = Observation("input_counts")
    kept = C.batch_filter()
    records = records.observe(seen, F.count(F.lit(1)).alias("raw_records"),
                              F.count_if(kept).alias("clean_records"))
    version = Version(spark, output_path)
    partials = version.write(PARTIALS, B.route_bucket_partials(B.clean_events(records)))
    try:
        counts = seen.get
    except (PySparkException, Py4JError):       # an input the optimizer proved empty reports no metrics
        counts = {}
    if not counts.get("clean_records") and partials.isEmpty():
        version.abandon()
        return None
    paths = write_views(partials, version, _now())
    version.commit()
    paths["input_counts"] = counts
    return paths


def run_incremental_job(spark: SparkSession, archive_path: str, output_path: str,
                        closed_before: datetime | None = None) -> dict | None:
    """Bring the views up to date with the archive's new hour folders; None if there is none.

    Only folders of hours before ``closed_before`` (now) are read, as the archive
    still writes to the current one. The views then equal those of a full run over
    all folders read so far. A view that a full run published has no list of
    folders and is computed anew.
    """
    version = Version(spark, output_path)
    known = version.previous(FOLDERS)
    closed = H.hour_folders(spark, archive_path, closed_before)
    if known is None:
        fresh, before = closed, None
    else:
        done = {r.folder for r in known.select("folder").collect()}     # a row for each hour
        fresh, before = [f for f in closed if f not in done], version.previous(PARTIALS)
    if not fresh:
        return None
    own = B.route_bucket_partials(B.clean_events(H.read_folders(spark, archive_path, fresh)))
    partials = version.write(PARTIALS, own if before is None else add_partials(before.unionByName(own)))
    read = H.folder_names(spark, fresh)
    version.write(FOLDERS, read if known is None else known.unionByName(read))
    paths = write_views(partials, version, _now())
    version.commit()
    return paths | {"folders": len(fresh)}


def add_partials(partials: DataFrame) -> DataFrame:
    """Partials of several inputs as one."""
    return partials.groupBy("route_id", "day_of_week", "hour_of_day").agg(
        F.sum("sum_delay").alias("sum_delay"), F.max("max_delay").alias("max_delay"),
        F.sum("observations").alias("observations"))


def create_history_table(spark: SparkSession, output_path: str,
                         name: str = "batch_delay_history") -> None:
    """External SQL table over the current history view (column names as the DDL expects).

    Create it again after a publication: a table keeps the version it was created over.
    """
    path = view_path(spark, f"{output_path.rstrip('/')}/batch_delay_history")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{path}'")
