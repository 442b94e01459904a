import hashlib

import numpy as np
import pytest

from headway.llm import shallot
from headway.llm.common import MAX_COMPONENT
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


def brute(rows, width, k, rounds, scale):
    """Plain integer k-means in Python."""
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    at = [v for _, v in named[:k]]
    for r in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)) for _, v in kept]
        if r < rounds:
            for n in range(len(at)):
                own = [v for (_, v), (_, c) in zip(kept, near) if c == n]
                if own:
                    at[n] = [sum(x) // len(own) for x in zip(*own)]
    order = lambda r: (r[0] is not None, r)                                 # noqa: E731
    return sorted([(i, c, d) for (i, _), (d, c) in zip(kept, near)], key=order), at


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is not None, r))


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, e array<float>, near string, v int")


def test_equals_plain_k_means(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 1, (9, 6))
    rows = [(i, (middles[i % 9] + rng.normal(0, 0.2, 6)).tolist()) for i in range(400)]
    for k, rounds in ((7, 5), (1, 2), (2, 3), (16, 0)):
        got, at = shallot.cluster(table(spark, rows), "vec_id", "e", 6, k, rounds, 64)
        want, centres = brute(rows, 6, k, rounds, 64)
        assert at.tolist() == centres
        assert found(got) == want


def test_ties_repeats_nulls_and_bad_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(120)]      # many ties
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, rows[5][1])]
    bad = [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None, 0.0, 0.0]),
           (204, [float("nan"), 0.0, 0.0, 0.0]), (205, [float("inf"), 0.0, 0.0, 0.0])]
    got, at = shallot.cluster(table(spark, rows + bad), "vec_id", "e", 4, 8, 4, 1)
    want, centres = brute(rows, 4, 8, 4, 1)
    assert at.tolist() == centres and found(got) == want


def test_fewer_rows_than_clusters_and_empty_tables(spark):
    rows = [(1, [0.5, 0.0]), (2, [3.0, 1.0]), (None, [3.0, 1.2])]
    got, at = shallot.cluster(table(spark, rows), "vec_id", "e", 2, 16, 2, 4)
    want, centres = brute(rows, 2, 16, 2, 4)
    assert at.tolist() == centres and found(got) == want
    got, at = shallot.cluster(table(spark, rows).limit(0), "vec_id", "e", 2, 16, 2, 4)
    assert found(got) == [] and len(at) == 0
    assert found(shallot.cluster(table(spark, [(None, [1.0, 1.0])]), "vec_id", "e", 2, 16, 2, 4)[0]) == []


def test_component_beyond_the_exact_range_is_an_error(spark):
    with pytest.raises(Exception, match="exceeds"):
        shallot.cluster(table(spark, [(1, [float(MAX_COMPONENT * 4), 0.0])]), "vec_id", "e", 2, 2, 1, 1)


def test_bounds_spare_most_distances_and_stay_exact():
    rng = np.random.default_rng(7)
    v = (rng.normal(0, 1, (12, 8))[rng.integers(0, 12, 3000)] * 400 + rng.normal(0, 30, (3000, 8))).astype(np.int64)
    at, before, state = v[:12].copy(), None, (np.zeros(3000, int), np.ones(3000, int), np.full(3000, np.inf), np.zeros(3000))
    seen = []
    for _ in range(6):
        c = shallot.Centroids(at, before)
        plain = ((v[:, None] - at[None]) ** 2).sum(2)
        calls, one = [], shallot.squared
        shallot.squared = lambda a, b: calls.append(len(a)) or one(a, b)
        try:
            state = c.search(v, *state)
        finally:
            shallot.squared = one
        seen.append(sum(calls))
        assert (state[0] == plain.argmin(1)).all()
        others = np.where(np.arange(12) == state[0][:, None], np.inf, plain).min(1)
        assert (state[2] >= np.sqrt(plain.min(1))).all() and (state[3] <= np.sqrt(others)).all()
        before, at = at, np.stack([v[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else at[j]
                                   for j in range(12)])
    assert seen[-1] < 0.5 * 3000 * 12


def test_registered_query_equals_its_sql(spark):
    assert compare(spark, SF_SMALL, ["op11_shallot_clusters"], verbose=False)["op11_shallot_clusters"].startswith("OK")
