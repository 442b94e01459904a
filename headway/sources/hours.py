"""Hour folders of the archive: their list, their event-time ranges, and reads of some of them.

The archive lies in ``year=/month=/day=/hour=`` by flush time, and a record may be
flushed long after its event. The table of ranges keeps the least and the greatest event
time of each closed hour folder, so a read between two instants lists only the folders that may
hold such records, without a bound on how late they came.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import columns as C
from headway.functions.columns import ts_literal
from headway.schemas import RAW_SCHEMA
from headway.sources import files
from headway.sources.published import Version, read_view, version_root
from headway.sources.raw import PARTITIONS

RANGES = "hour_ranges"


def hour_folders(spark: SparkSession, archive_path: str, closed_before: datetime | None = None) -> list[str]:
    """Hour folders (``year=/month=/day=/hour=``) of hours before ``closed_before`` (now), in order."""
    root = archive_path.rstrip("/")
    found = [""]
    for name in PARTITIONS:
        found = [f"{f}/{d}".lstrip("/") for f in found for d in files.folders(spark, f"{root}/{f}") if d.startswith(name + "=")]
    at = closed_before or datetime.now(timezone.utc).replace(tzinfo=None)
    open_ = at.replace(minute=0, second=0, microsecond=0)

    def hour(folder: str) -> datetime:
        return datetime(*[int(part.split("=")[1]) for part in folder.split("/")])

    return sorted((f for f in found if hour(f) < open_), key=hour)


def folder_names(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in folders], "folder string")


def read_folders(spark: SparkSession, archive_path: str, folders: list[str], schema=RAW_SCHEMA) -> DataFrame:
    """The records of some hour folders, with their partition columns."""
    root = archive_path.rstrip("/")
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("basePath", root)
    return reader.json([f"{root}/{f}" for f in folders])


def update_ranges(spark: SparkSession, archive_path: str, ranges_path: str, closed_before: datetime | None = None) -> int:
    """Add the ranges of closed hour folders that have none yet; the number added.

    ``first`` and ``last`` are the least and greatest event time; ``untimed`` counts the
    records without one, which every bounded read returns.
    """
    version = Version(spark, ranges_path)
    known = version.previous(RANGES)
    done = set() if known is None else {r.folder for r in known.select("folder").collect()}     # a row for each hour
    fresh = [f for f in hour_folders(spark, archive_path, closed_before) if f not in done]
    if not fresh:
        return 0
    ts = C.parse_event_time("ingestion_time")
    def two(c):
        return F.lpad(F.col(c).cast("string"), 2, "0")
    folder = F.concat(F.lit("year="), F.col("year").cast("string"), F.lit("/month="), two("month"),
                      F.lit("/day="), two("day"), F.lit("/hour="), two("hour"))
    own = (read_folders(spark, archive_path, fresh).groupBy(folder.alias("folder"))
           .agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count_if(ts.isNull()).alias("untimed")))
    # a folder without records has a range too, and is not read again
    own = folder_names(spark, fresh).join(own, "folder", "left").fillna(0, ["untimed"])
    version.write(RANGES, own if known is None else known.unionByName(own))
    version.commit()
    return len(fresh)


def read_between(spark: SparkSession, archive_path: str, ranges_path: str, since: datetime | None = None,
                 until: datetime | None = None, schema=RAW_SCHEMA) -> DataFrame:
    """Records with an event time in ``[since, until)``, and those without one; see ``raw.read_raw_json``.

    Folders whose range lies outside are not listed; those that have no range yet are.
    """
    folders = hour_folders(spark, archive_path, datetime.max)
    out: set[str] = set()
    if version_root(spark, ranges_path) is not None:
        inside = F.lit(True)
        if since is not None:
            inside &= F.col("last") >= ts_literal(since)
        if until is not None:
            inside &= F.col("first") < ts_literal(until)
        keep = F.coalesce(inside, F.lit(False)) | (F.col("untimed") > 0)
        out = {r.folder for r in read_view(spark, f"{ranges_path.rstrip('/')}/{RANGES}").where(~keep).select("folder").collect()}
    rows = read_folders(spark, archive_path, [f for f in folders if f not in out], schema)
    ts = C.parse_event_time("ingestion_time")
    if since is not None:
        rows = rows.where((ts >= ts_literal(since)) | ts.isNull())
    if until is not None:
        rows = rows.where((ts < ts_literal(until)) | ts.isNull())
    return rows
