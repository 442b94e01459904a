"""Exact top-k search by Fagin's threshold algorithm.

Vectors are dealt into blocks; each block keeps one sorted list per dimension.
For a query the lists are walked from the end that its sign favours, every row
met is scored in full, and the walk stops once the bound (the score of a row
with the values at the current depth of every list) is below the k-th score.
The blocks' k best rows are merged to the k best of all.

Defined results: vectors that are NULL, empty or hold a NULL or a non-finite
component take no part, nor do rows without an id; a query meets vectors of its
own length only; ties go to the smaller id; a repeated query row counts once, a
repeated candidate row as often as it occurs; fewer than k candidates give all
of them. Components must stay below 2**25 after scaling (scores are 64-bit).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VECTOR_BLOCK = 2048         # rows per block of sorted lists
QUERY_BLOCK = 4096          # queries per block
FIRST_DEPTH = 32            # list entries of the first round; doubles from round to round


def walk(vectors: np.ndarray, ids: np.ndarray, order: np.ndarray, query: np.ndarray, own: int, k: int):
    """Positions and scores of a block's k best rows for one query."""
    n = len(vectors)
    up, down = np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
    if not len(up) and not len(down):
        up = np.array([0])
    seen = ids == own
    best, score = np.empty(0, np.int64), np.empty(0, np.int64)
    depth, step = 0, FIRST_DEPTH
    while depth < n:
        to = min(n, depth + step)
        met = np.zeros(n, bool)
        met[order[n - to:n - depth, up]] = True
        met[order[depth:to, down]] = True
        new = np.nonzero(met & ~seen)[0]
        seen |= met
        best, score = np.concatenate([best, new]), np.concatenate([score, vectors[new] @ query])
        first = np.lexsort((ids[best], -score))[:k]
        best, score = best[first], score[first]
        bound = (query[up] * vectors[order[n - to, up], up]).sum() + \
            (query[down] * vectors[order[to - 1, down], down]).sum()
        if len(best) == k and score[-1] > bound:        # at equality an unseen row could win a tie
            break
        depth, step = to, step * 2
    return best, score


def search_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(vectors) and len(queries):
        ids, v = vectors["id"].to_numpy(np.int64), np.stack(vectors["v"].to_numpy()).astype(np.int64)
        order = np.argsort(v, axis=0, kind="stable")
        for own, q in zip(queries["id"], queries["v"]):
            best, score = walk(v, ids, order, np.asarray(q, np.int64), own, k)
            out["query_id"].append(np.full(len(best), own, np.int64))
            out["vec_id"].append(ids[best])
            out["score"].append(score)
    return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()})


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) of the rows that take part; v holds floor(scale * component)."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v")))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10,
          vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k candidates of highest inner product.

    Both inputs are (id, v). Each vector goes to one block per query block and
    each query to every vector block, so a task holds two bounded blocks.
    """
    candidates = candidates.withColumn("dim", F.size("v"))
    queries = queries.distinct().withColumn("dim", F.size("v"))
    n_vectors = max(1, -(-candidates.count() // vector_block))
    n_queries = max(1, -(-queries.count() // query_block))
    vecs = (candidates.withColumn("vb", F.pmod(F.xxhash64("id", "v"), F.lit(n_vectors)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1)))))
    qs = (queries.withColumn("qb", F.pmod(F.xxhash64("id", "v"), F.lit(n_queries)).cast("int"))
          .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_vectors - 1).cast("long")))))
    found = (vecs.groupBy("dim", "vb", "qb").cogroup(qs.groupBy("dim", "vb", "qb"))
             .applyInPandas(lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
