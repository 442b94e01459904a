import numpy as np

from headway.llm import vector_codes as vc
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


def brute(rows, parts, entries, rounds):
    """Plain product codes of integer vectors in Python."""
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v in rows]
    first = sorted((i, v) for i, v in rows if i is not None)[:entries]
    books = [[v[p * w:(p + 1) * w] for _, v in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for x in cut:
                own.setdefault(near(x[p], books[p])[1], []).append(x[p])
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for (i, _), x in zip(rows, cut):
        got = [near(x[p], books[p]) for p in range(parts)]
        out.append((i, [e for _, e in got], sum(d for d, _ in got)))
    return sorted(out, key=str), books


def found(df):
    return sorted([(r["id"], list(r["codes"]), r["error"]) for r in df.collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, 5, "c", "z") for i, v in rows],
                                 "vec_id long, e array<double>, v int, codes string, k0 string")


def test_equals_plain_codes(spark):
    rng = np.random.default_rng(1)
    for width, parts, entries, rounds in ((12, 4, 5, 4), (10, 2, 16, 3), (4, 4, 3, 2), (8, 1, 6, 0)):
        rows = [(i, rng.integers(-9, 9, width).tolist()) for i in range(150)]
        got, books = vc.compress(table(spark, rows), "vec_id", "e", parts, entries, rounds, 1)
        want, plain = brute(rows, parts, entries, rounds)
        assert books.tolist() == plain and found(got) == want


def test_ties_repeats_nulls_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(0, 2, 6).tolist()) for i in range(60)]          # many ties
    rows += [(0, rows[0][1]), (0, [1, 1, 1, 1, 1, 1]), (None, rows[1][1])]
    bad = [(90, None), (91, []), (92, [1] * 9), (93, [1.0, float("nan"), 0, 0, 0, 0]), (94, [float("-inf")] * 6)]
    got, books = vc.compress(table(spark, rows + bad), "vec_id", "e", 3, 4, 3, 1)
    want, plain = brute(rows, 3, 4, 3)
    assert books.tolist() == plain and found(got) == want


def test_few_rows_empty_tables_and_kept_columns(spark):
    rows = [(2, [1, 5]), (1, [3, 3])]
    got, books = vc.compress(table(spark, rows), "vec_id", "e", 2, 16, 2, 1, keep=("codes", "k0"))
    assert got.columns == ["id", "codes", "k0", "codes", "error"]
    want, plain = brute(rows, 2, 16, 2)
    assert books.tolist() == plain and sorted((r[0], r[1], r[2], list(r[3]), r[4]) for r in got.collect()) == [
        (i, "c", "z", c, d) for i, c, d in want]
    for none in (table(spark, rows).limit(0), table(spark, [(None, [1, 2])]), table(spark, [(1, [1, 2, 3])])):
        got, books = vc.compress(none, "vec_id", "e", 2, 16, 2, 1)
        assert books is None and got.collect() == [] and got.columns == ["id", "codes", "error"]


def test_floor_goes_down_and_scale_is_applied(spark):
    got, books = vc.compress(table(spark, [(1, [-0.1, 0.9999]), (2, [-0.00001, 2.0])]), "vec_id", "e", 1, 1, 1, 4096)
    first = [-410, 4095]
    assert books.tolist() == [[[(-410 - 1) // 2, (4095 + 8192) // 2]]] and first[0] == -410


def test_transform_keeps_scaled_distances_and_orders_by_sign_changes():
    for p in (1, 2, 4, 8, 16):
        h = vc.transform_matrix(p)
        assert (h @ h.T == p * np.eye(p)).all()
        assert ((h[:, 1:] != h[:, :-1]).sum(1) == np.arange(p)).all()
    a, b = np.random.default_rng(3).integers(-2**26, 2**26, (2, 20, 5))
    assert (((vc.transformed(a) - vc.transformed(b)) ** 2).sum(1) == 8 * ((a - b) ** 2).sum(1)).all()


def test_nearest_drops_entries_early_without_loss():
    rng = np.random.default_rng(4)
    x, e = rng.integers(-50, 50, (500, 8)), rng.integers(-50, 50, (16, 8))
    got, d = vc.nearest(vc.transformed(x), vc.transformed(e))
    plain = ((x[:, None] - e[None]) ** 2).sum(2)
    assert (got == plain.argmin(1)).all() and (d == 8 * plain.min(1)).all()


def test_registered_query_equals_its_sql(spark):
    assert compare(spark, SF_SMALL, ["op13_hadamard_codes"], verbose=False)["op13_hadamard_codes"].startswith("OK")
