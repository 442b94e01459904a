"""Vector code compression: product codes by an integer Walsh-Hadamard transform.

A vector is cut into equal parts, each part position has a codebook, and a part's
code is the index of its nearest entry. Parts and entries are padded with zeros to
a power of two, p, and transformed; the transform multiplies squared distances by p,
so the scaled squared differences can be added up coefficient by coefficient, the
slow ones (few sign changes) first, which carry most of the distance. An entry
whose sum exceeds the full sum of the entry that looked nearest on the first
coefficient is dropped before the rest is read. All sums are integers; the last
sum divided by p is the squared distance, without rounding.

Each round reads the vectors' table once and returns the sums of a task's parts for
each entry; the driver holds the codebooks alone (parts x entries x width).

Defined results: rows whose vector is NULL or holds a NULL or non-finite component
are dropped; so are vectors that cannot be cut alike, those of another length than
that of the smallest id, or of a length that is no positive multiple of the parts.
A NULL id is encoded but starts no entry; repeated rows count as often as they
occur (equal ids in the order of their vectors); fewer ids than entries give a
shorter codebook; an empty table, or one without any id, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import scaled_vectors, stored, vector_rows


def transform_matrix(p: int) -> np.ndarray:
    """Walsh-Hadamard matrix of size p, a power of two, rows by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < p:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Transform of the last axis, padded with zeros."""
    width = parts.shape[-1]
    p = 1 << (width - 1).bit_length()
    return parts @ transform_matrix(p)[:, :width].T


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row and the scaled squared distance; both transformed."""
    n, k = len(x), len(entries)
    row, entry = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total = (x[row, 0] - entries[entry, 0]) ** 2
    guess = total.reshape(n, k).argmin(1)
    limit = ((x - entries[guess]) ** 2).sum(1)
    for j in range(1, x.shape[1]):
        keep = total <= limit[row]
        row, entry = row[keep], entry[keep]
        total = total[keep] + (x[row, j] - entries[entry, j]) ** 2
    by = np.lexsort((entry, total, row))
    first = by[np.unique(row[by], return_index=True)[1]]
    return entry[first], total[first]


class Codebooks:
    """Entries (parts, entries, width) and their transform."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.transform = entries, transformed(entries)
        self.parts, _, self.width = entries.shape

    def encode(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, parts) and squared distances (rows, parts)."""
        x = transformed(v.reshape(len(v), self.parts, self.width))
        found = [nearest(x[:, i], self.transform[i]) for i in range(self.parts)]
        return np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1) // x.shape[-1]


def entry_sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, s0, s1, ...): a task's parts by their nearest entry."""
    known = rows.sparkSession.sparkContext.broadcast(books)
    parts, k, width = books.entries.shape
    names = ["part", "entry", "n", *(f"s{i}" for i in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = known.value
        sums, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = vector_rows(batch.column(0), parts * width)
            codes, _ = b.encode(v)
            for i in range(parts):
                np.add.at(sums[i], codes[:, i], v[:, i * width:(i + 1) * width])
                n[i] += np.bincount(codes[:, i], minlength=k)
        part, entry = np.nonzero(n)
        columns = [part, entry, n[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names=names)

    return (rows.select("v").mapInArrow(run, ", ".join(f"{c} long" for c in names))
            .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]))


def learn(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks | None:
    """Codebooks after the rounds; the parts of the rows with the smallest ids come first."""
    first = rows.where(F.col("id").isNotNull()).orderBy("id", "v").limit(entries).collect()
    if not first:
        return None
    at = np.array([r["v"] for r in first], np.int64)
    books = Codebooks(at.reshape(len(at), parts, -1).swapaxes(0, 1))
    for _ in range(rounds):
        new = books.entries.copy()
        for r in entry_sums(rows, books).collect():
            new[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(books.width)]
        books = Codebooks(new)
    return books


def compress(df: DataFrame, id_col: str, vector_col: str, parts: int, entries: int, rounds: int, scale: int,
             keep: tuple[str, ...] = ()) -> tuple[DataFrame, np.ndarray | None]:
    """((id, *keep, codes, error), entries): codes by part, and the squared distances' sum."""
    own = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    cut = scaled_vectors(df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"), *own), "x", scale)
    names = [f"k{i}" for i in range(len(keep))]
    back = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    rows = stored(cut.select("id", "v", *names), "codes-rows")
    one = rows.where(F.col("id").isNotNull()).orderBy("id", "v").select(F.size("v")).first()
    size = one[0] if one else 0
    rows = rows.where((F.size("v") == size) & F.lit(size > 0 and size % parts == 0))
    books = learn(rows, parts, entries, rounds)
    if books is None:
        return rows.limit(0).select("id", *back, F.array().cast("array<int>").alias("codes"),
                                    F.lit(0).cast("long").alias("error")), None
    known = df.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = known.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, far = b.encode(vector_rows(batch.column(1), b.parts * b.width))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1), pa.int32()), b.parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], lists.cast(pa.list_(pa.int32())), pa.array(far.sum(1))],
                names=["id", *names, "codes", "error"])

    kinds = "".join(f", {n} {rows.schema[n].dataType.simpleString()}" for n in names)
    coded = rows.mapInArrow(run, f"id long{kinds}, codes array<int>, error long")
    return coded.select("id", *back, "codes", "error"), books.entries
