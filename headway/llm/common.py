"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The files outlive a lost executor, and several consumers share one computation.
    """
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of whole texts that one Arrow batch holds at most.
TEXT_ROWS = 1_000


def in_text_batches(df: DataFrame) -> DataFrame:
    """``df``, for Arrow functions on whole texts: lowers the session's batch size to TEXT_ROWS."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= TEXT_ROWS:
        df.sparkSession.conf.set(name, str(TEXT_ROWS))
    return df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(col: str = "text") -> Column:
    """The text column with NULL as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_key(col: str = "text") -> Column:
    """64-bit key of a text; with the document id it identifies a row's content."""
    return F.xxhash64(F.lit(7), text_of(col))


#: Largest component after scaling: squared distances of 64 of them still fit 64 bits.
MAX_COMPONENT = 2 ** 26


def scaled_vectors(df: DataFrame, vector_col: str, scale: int, to: str = "v") -> DataFrame:
    """Rows whose vector holds neither NULL nor non-finite components; ``to`` is floor(scale * x) of each.

    A component beyond MAX_COMPONENT after scaling ends the job with a message, as
    64-bit distances could not hold its square.
    """
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    far = F.exists(v, lambda e: (e > MAX_COMPONENT) | (e < -MAX_COMPONENT))
    return df.where(x.isNotNull() & ~F.coalesce(bad, F.lit(True))).withColumn(
        to, F.when(far, F.raise_error(F.lit(f"a component exceeds {MAX_COMPONENT} after scaling")))
        .otherwise(v).cast("array<int>"))


def vector_rows(column, width: int):
    """(rows, width) int64 array of an Arrow list column without NULLs."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
