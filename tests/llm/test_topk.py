import numpy as np
from pyspark.sql import functions as F

from headway.llm import topk


def brute(rows, k):
    out = {}
    for q, v in {(i, tuple(x)) for i, x in rows if i % 100 == 0}:
        hits = sorted((-int(np.dot(v, x)), i) for i, x in rows if i != q and len(x) == len(v))[:k]
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(hits)]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def test_equals_brute_force_with_ties_zero_vectors_and_small_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).tolist()) for i in range(400)]
    rows[100] = (100, [0] * 6)
    rows[200] = (200, rows[201][1])
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = found(topk.top_k(df, df.where(F.col("id") % 100 == 0), 10, vector_block=64, query_block=2))
    assert got == brute(rows, 10)


def test_stops_early_when_one_row_stands_out():
    v = np.vstack([np.full((1, 4), 1000), np.random.default_rng(1).integers(0, 5, (5000, 4))])
    ids, order = np.arange(len(v)), np.argsort(v, axis=0, kind="stable")
    best, score = topk.walk(v, ids, order, np.array([1, 1, 1, 1]), -1, 1)
    assert ids[best].tolist() == [0] and score.tolist() == [4000]


def test_bad_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, float("nan")]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]),
            (5, []), (6, [0.25, -0.1]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0])]
    df = topk.quantised(spark.createDataFrame(rows, "vec_id long, e array<float>"), "vec_id", "e", 1024)
    assert sorted((r.id, list(r.v)) for r in df.collect()) == [
        (0, [1024, 2048]), (6, [256, -103]), (7, [1024, 2048, 3072])]
    assert found(topk.top_k(df, df.where("id = 0"), 10)) == {0: [(1, 6, 256 * 1024 - 103 * 2048)]}


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1, 0]), (0, [1, 0]), (1, [2, 0]), (1, [2, 0])]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    assert found(topk.top_k(df, df.where("id = 0"), 10)) == {0: [(1, 1, 2), (2, 1, 2)]}
    assert topk.top_k(df.limit(0), df.limit(0), 10).collect() == []
