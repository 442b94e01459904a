"""Session helpers: the settings every job in the package relies on.

All clocks in the engine are UTC; Spark's ``hour``/``date_format``/``window``
otherwise follow the session zone, so every entry point pins it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a production submit should also carry (spark-defaults or --conf).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, turns a join into
    # a broadcast only after the shuffle has measured the small side, and
    # splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size bound used for every broadcast decision (static and AQE).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "headway",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` is only for tests/bench; on a cluster spark-submit supplies it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (idempotent, cheap)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Read from the session (``spark.checkpoint.dir``), which on a cluster names
    a shared file system. Only a local-mode session without the setting (unit
    tests) gets a private temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder"
            )
        root = tempfile.mkdtemp(prefix="headway-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)


def materialize(df, name: str):
    """Write ``df`` once to a fresh table below the checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing the
    inputs) and lets several consumers share one computation. The read-back
    table also carries its true size for the planner's broadcast decision.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.parquet(path)
