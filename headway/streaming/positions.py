"""Where a stream starts, and how much one read may take.

``latest`` reads what arrives from now on, ``earliest`` all that is there, and an
instant what arrived from then on. A log (``kafka``) takes the position and the
bound as options of its source; its checkpoint decides once there is one. A folder
of files has no positions: an arrival is a file's modification time, and the scan
leaves out the files before the instant by it, unread. The resolved instant is kept beside the checkpoint, so a
restarted query goes on where it was; ``resume=False`` resolves it anew, which
skips the files that came while the query was down, as a process that always starts
from the newest record does.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.columns import ts_literal
from headway.sources import files

LATEST, EARLIEST = "latest", "earliest"
SPEED_READ, ARCHIVE_READ = 500, 100     # fixed values: records one read of a log's part may take
FILES_READ = 100                        # files one read of a folder may take


def instant_of(start: str) -> datetime | None:
    """The instant (UTC) of a position given as ISO-8601 text; None for latest and earliest."""
    if start in (LATEST, EARLIEST):
        return None
    t = datetime.fromisoformat(start)
    return t if t.tzinfo is None else t.astimezone(timezone.utc).replace(tzinfo=None)


def log_options(start: str, per_read: int | None) -> dict[str, str]:
    """Options of a Kafka source; ``per_read`` bounds the records of a micro-batch."""
    t = instant_of(start)
    out = {"startingOffsets": start} if t is None else {
        "startingTimestamp": str(round(t.replace(tzinfo=timezone.utc).timestamp() * 1000)),
        "startingOffsetsByTimestampStrategy": "latest"}         # nothing since then: from the end
    return out | ({"maxOffsetsPerTrigger": str(per_read)} if per_read else {})


def first_instant(spark: SparkSession, start: str, checkpoint: str | None, resume: bool = True) -> datetime | None:
    """The instant from which a folder is read (None: all of it), kept with the checkpoint."""
    at = os.path.join(checkpoint, "START") if checkpoint else None
    known = files.read_pointer(spark, at) if at and resume else None
    if known is not None:
        return datetime.fromisoformat(known["from"]) if known["from"] else None
    t = datetime.now(timezone.utc).replace(tzinfo=None) if start == LATEST else instant_of(start)
    if at:
        files.write_pointer(spark, at, {"from": t.isoformat() if t else None})
    return t


def folder_stream(spark: SparkSession, path: str, start: str = EARLIEST, checkpoint: str | None = None,
                  resume: bool = True, per_read: int | None = FILES_READ, fmt: str = "text", schema=None,
                  recursive: bool = False) -> DataFrame:
    """Files of a folder that arrived from ``start`` on."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if per_read:
        r = r.option("maxFilesPerTrigger", per_read)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    t = first_instant(spark, start, checkpoint, resume)
    if t is None:
        return r.load(path)
    return r.load(path).where(F.col("_metadata.file_modification_time") >= ts_literal(t))


def lines_from(spark: SparkSession, source: str, fmt: str = "text", start: str = EARLIEST, checkpoint: str | None = None,
               resume: bool = True, per_read: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """A stream of JSON lines in ``value`` from a folder (``text``), a topic (``kafka``) or any other format.

    A topic keeps ``partition``, ``offset`` and ``timestamp``. Other formats are loaded
    with the given options only, as they name positions in their own ways; ``start`` must then be earliest.
    """
    if fmt == "text":
        return folder_stream(spark, source, start, checkpoint, resume, per_read or FILES_READ)
    if fmt == "kafka" and not resume:
        raise ValueError("a topic starts anew with a new checkpoint folder")
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        given = {"subscribe": source} | log_options(start, per_read) | (options or {})
        rows = r.options(**given).load()
        return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")
    if start != EARLIEST:
        raise ValueError(f"pass the start position of {fmt!r} with its own options")
    return r.options(**(options or {})).load(source) if source else r.options(**(options or {})).load()
