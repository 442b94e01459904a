"""Tables that micro-batches add to by key, and their compaction.

A batch's rows go to ``<path>/dt=/batch_id=`` with dynamic partition overwrite, so a retried batch replaces its own rows. The rows of a key are
combined when read: the newest batch's row counts, or the rows are added up,
as the table's ``combine`` says.

Compaction combines all rows up to a batch into one table below
``<path>/base/upto=<batch>/dt=`` (one folder for each date), leaves out what has expired, and
then replaces the pointer ``<path>/CURRENT`` in one step. Readers take the base that
the pointer names and the batches after it. What the pointer before that named
is kept until the next compaction, for readers that are still on it.

There is one writer: the streaming query that owns the table (or a maintenance run while
it is stopped). A batch retried after it was compacted changes nothing, as
its number is not after the base.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.sources import files


def newest(key: tuple[str, ...], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Combine: the row of the newest batch, a map-side-combined aggregate."""
    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*key).agg(F.max_by(F.struct(*values), "batch_id").alias("r")).select(
            *key, *[F.col(f"r.{c}").alias(c) for c in values])

    return combine


class UpsertTable:
    """Rows of ``schema`` by ``key``; ``time_col`` gives the date folder."""

    def __init__(self, path: str, schema: T.StructType, key: tuple[str, ...], time_col: str,
                 combine: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.schema, self.key, self.time_col = path.rstrip("/"), schema, key, time_col
        self.columns = schema.fieldNames()
        self.combine = combine or newest(key, [c for c in self.columns if c not in key])
        self.stored = T.StructType([*schema.fields, T.StructField("dt", T.DateType()),
                                    T.StructField("batch_id", T.LongType())])

    def pointer(self, spark: SparkSession) -> dict:
        return files.read_pointer(spark, os.path.join(self.path, "_CURRENT")) or {"upto": -1, "base": None}

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Rows of one micro-batch, one for each key; a retry overwrites them."""
        # few files for each date: small parts are put together, large ones split
        (rows.select(*self.columns, F.to_date(self.time_col).alias("dt"), F.lit(batch_id).cast("long").alias("batch_id"))
             .hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt", "batch_id").parquet(self.path))

    def rows(self, spark: SparkSession) -> DataFrame:
        """Stored rows that count, with ``dt`` and ``batch_id`` (the base has its last batch's)."""
        at = self.pointer(spark)
        parts = []
        if files.exists(spark, self.path):
            parts.append(spark.read.schema(self.stored).parquet(self.path).where(F.col("batch_id") > at["upto"]))
        if at["base"]:
            base = T.StructType(self.stored.fields[:-1])
            parts.append(spark.read.schema(base).parquet(os.path.join(self.path, "_base", at["base"]))
                         .withColumn("batch_id", F.lit(at["upto"]).cast("long")))
        if not parts:
            return spark.createDataFrame([], self.stored)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """One row for each key. ``where`` may use ``dt`` (folders are pruned) and the key's columns."""
        rows = self.rows(spark)
        return self.combine(rows if where is None else rows.where(where)).select(*self.columns)

    def compact(self, spark: SparkSession, upto: int, alive: Column | None = None, more: DataFrame | None = None,
                mark: dict | None = None) -> None:
        """One folder for each date with the rows up to batch ``upto`` for which ``alive`` holds.

        ``more`` are rows to be combined as if they came right after that batch, and ``mark`` is
        kept with the pointer, so both take effect in the same step.
        """
        at = self.pointer(spark)
        if upto < at["upto"] or (upto == at["upto"] and more is None):
            return
        rows = self.rows(spark).where(F.col("batch_id") <= upto)
        if more is not None:
            rows = rows.unionByName(more.select(*self.columns, F.to_date(self.time_col).alias("dt"),
                                                F.lit(upto + 1).cast("long").alias("batch_id")))
        rows = self.combine(rows).select(*self.columns)
        if alive is not None:
            rows = rows.where(alive)
        base = f"upto={upto}-{uuid.uuid4().hex[:8]}"
        (rows.withColumn("dt", F.to_date(self.time_col)).hint("rebalance", "dt")
             .write.partitionBy("dt").parquet(os.path.join(self.path, "_base", base)))
        files.write_pointer(spark, os.path.join(self.path, "_CURRENT"), at | {"upto": upto, "base": base} | (mark or {}))
        # readers may still be on the pointer before, never on the one before that
        for old in files.folders(spark, os.path.join(self.path, "_base")):
            if old not in (base, at["base"]):
                files.drop_folder(spark, os.path.join(self.path, "_base", old))
        for dt in files.folders(spark, self.path):
            if not dt.startswith("dt="):
                continue
            day = os.path.join(self.path, dt)
            batches = files.folders(spark, day)
            gone = [b for b in batches if int(b.split("=")[1]) <= at["upto"]]
            for b in gone:
                files.drop_folder(spark, os.path.join(day, b))
            if len(gone) == len(batches):
                files.drop_folder(spark, day)
