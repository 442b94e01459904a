"""Exact k-means by Shallot search on integer vectors.

Each vector remembers its nearest and its second-nearest centroid, an upper bound
on the distance to the first and a lower bound on that to all others. After the
centroids moved, the bounds are widened by their drift; a vector whose upper bound
stays below its lower bound, or below half the way to the next centroid, keeps its
cluster unseen. Any other starts from the closer of its two centroids and scans
that one's neighbours in order of distance, within a ball of its distance to the
start plus that to the second-nearest found so far, which shrinks as better ones
are met. Bounds are floating point, rounded outwards; the survivors are compared
by integer squared distances, so results are exact, ties to the smaller number.

Every round reads the rows' table of the round before and writes its own; Spark
sums the clusters' components, and only the centroids (clusters x components)
come to the driver.

Defined results: vectors that are NULL, of another length, or hold a NULL or a
non-finite component take no part; a NULL id takes part but is never a first
centroid; repeated rows count as often as they occur; fewer rows than clusters
give a cluster for each row with an id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import scaled_vectors, stored, vector_rows

SLACK = 1e-12               # relative rounding of the bounds, far above that of a square root
STATE = "id long, v array<int>, near int, second int, upper double, lower double, distance long"


def at_most(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(float)) * (1 - SLACK)


def at_least(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(float)) * (1 + SLACK)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


class Centroids:
    """Centroids with their neighbours in order of distance and their last drift."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        k = len(at)
        apart = np.stack([squared(at, np.broadcast_to(c, at.shape)) for c in at])
        np.fill_diagonal(apart, -1)                             # a centroid is its own first neighbour
        self.order = np.argsort(apart, axis=1, kind="stable")
        np.fill_diagonal(apart, 0)
        self.gap = at_most(np.take_along_axis(apart, self.order, 1))
        self.half = self.gap[:, 1] / 2 if k > 1 else np.full(1, np.inf)
        self.moved = at_least(squared(at, at if before is None else before))
        # the farthest move of any other centroid
        first = int(np.argmax(self.moved))
        self.others = np.full(k, self.moved[first])
        self.others[first] = np.delete(self.moved, first).max(initial=0.0)

    def search(self, v, near, second, upper, lower):
        """Nearest and second-nearest centroid of each row, with the new bounds."""
        near, second, k = near.copy(), second.copy(), len(self.at)
        upper = (upper + self.moved[near]) * (1 + SLACK)
        lower = lower * (1 - SLACK) - self.others[near] if k > 1 else np.full(len(v), np.inf)
        rows = np.nonzero(~(upper < np.maximum(lower, self.half[near])))[0]
        own = squared(v[rows], self.at[near[rows]])
        upper[rows] = at_least(own)
        open_ = ~(upper[rows] < np.maximum(lower[rows], self.half[near[rows]]))
        rows, own = rows[open_], own[open_]
        if not len(rows) or k == 1:
            return near, second, upper, lower
        x, a, b = v[rows], near[rows], second[rows]
        other = squared(x, self.at[b])
        swap = (other < own) | ((other == own) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        own, other = np.where(swap, other, own), np.where(swap, own, other)
        start, met, reach = a.copy(), b.copy(), at_least(own)
        live = np.arange(len(rows))
        for j in range(1, k):
            s = start[live]
            live = live[self.gap[s, j] <= reach[live] + at_least(other[live])]
            if not len(live):
                break
            c = self.order[start[live], j]
            fresh = c != met[live]
            i, c = live[fresh], c[fresh]
            d = squared(x[i], self.at[c])
            first = (d < own[i]) | ((d == own[i]) & (c < a[i]))
            next_ = ~first & ((d < other[i]) | ((d == other[i]) & (c < b[i])))
            f, g = i[first], i[next_]
            b[f], other[f] = a[f], own[f]
            a[f], own[f] = c[first], d[first]
            b[g], other[g] = c[next_], d[next_]
        near[rows], second[rows] = a, b
        upper[rows], lower[rows] = at_least(own), at_most(other)
        return near, second, upper, lower


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k rows with the smallest hashes of the seed and their id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.where(F.col("id").isNotNull()).orderBy(name, "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64)


def assign(state: DataFrame, centroids: Centroids, width: int) -> DataFrame:
    known = state.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = known.value
        for batch in batches:
            if not batch.num_rows:
                continue
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            v = vector_rows(get["v"], width)
            near, second, upper, lower = c.search(v, *(get[n].to_numpy() for n in ("near", "second", "upper", "lower")))
            yield pa.RecordBatch.from_arrays(
                [get["id"], get["v"], pa.array(near, pa.int32()), pa.array(second, pa.int32()), pa.array(upper),
                 pa.array(lower), pa.array(squared(v, c.at[near]))], names=batch.schema.names)

    return state.mapInArrow(run, STATE)


def moved(state: DataFrame, at: np.ndarray) -> np.ndarray:
    """Centroids after the floor of the mean of their rows; empty ones stay."""
    sums = [F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(at.shape[1])]
    out = at.copy()
    for r in state.groupBy("near").agg(F.count("*").alias("n"), *sums).collect():
        out[r["near"]] = [r[f"s{i}"] // r["n"] for i in range(at.shape[1])]
    return out


def cluster(df: DataFrame, id_col: str, vector_col: str, width: int, k: int, rounds: int, scale: int,
            seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance), centroids): ``rounds`` rounds of k-means and a last assignment.

    ``distance`` is the squared distance to the row's centroid.
    """
    vectors = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    rows = stored(scaled_vectors(vectors, "x", scale).where(F.size("v") == width).select("id", "v"), "shallot-rows")
    at = first_centroids(rows, k, seed)
    if not len(at):
        return rows.limit(0).selectExpr("id", "0 cluster", "0L distance"), np.empty((0, width), np.int64)
    state = rows.selectExpr("id", "v", "0 near", f"{min(1, len(at) - 1)} second",
                            "double('infinity') upper", "0d lower", "0L distance")
    before = None
    for r in range(rounds + 1):
        state = stored(assign(state, Centroids(at, before), width), f"shallot-round{r}")
        if r < rounds:
            before, at = at, moved(state, at)
    return state.select("id", F.col("near").alias("cluster"), "distance"), at
