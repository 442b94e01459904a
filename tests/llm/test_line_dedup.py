import random

from headway.llm import line_dedup as X
from headway.llm.common import table
from headway.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def within_one(a, b):
    """Word edit distance at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or len(a) < X.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(rows):
    """Texts after removal, by comparing each line with all earlier different lines."""
    earlier, out = [], {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        kept, had = [], False
        for line in (text or "").split("\n"):
            w = tuple(line.split())
            had |= bool(w)
            gone = w and any(w == e or within_one(w, e) for e in earlier)
            if w and w not in earlier:
                earlier.append(w)
            if not gone:
                kept.append(line)
        out[i] = None if text is None else "" if had and not any(k.split() for k in kept) else "\n".join(kept)
    return out


def run(df):
    return {r.doc_id: r.text for r in X.dedup_lines(df).collect()}


LONG = "one two three four five six seven eight nine ten"


def test_small_cases(spark, docs_of):
    w = LONG.split()
    rows = [(1, f"short line\n\n{LONG}\n \n"), (2, f"short line\nshort lines\n{LONG}"),
            (3, " ".join(w[:4] + ["X"] + w[5:]) + "\nkept"), (4, " ".join(w[1:]) + "\nkept too"),
            (5, LONG + " eleven"), (6, "\n"), (7, ""), (8, None), (9, " ".join(w[:4] + ["X", "Y"] + w[6:])),
            (10, LONG), (None, "first of all\nx"), (11, " first of all\t"), (12, "first  of all"), (13, "x" * 70_000 + " y" * 3_000),
            (14, "first  of all ")]
    got = run(docs_of(rows))
    assert got == brute(rows)
    assert got[4] == "kept too" and got[5] == "" and got[8] is None and got[6] == "\n" and got[10] == ""


def test_white_space_within_lines_makes_no_difference(spark, docs_of):
    w = LONG.split()
    rows = [(1, f"a  b\n{LONG}"), (2, "a b\n\f \x0b\nkept"), (3, "\ta\t\tb\r\nkept too"), (4, "  ".join(w)),
            (5, "\t ".join(w[:4] + ["X"] + w[5:]) + "\r"), (6, " \f".join(w[1:])), (7, " \t\n"), (8, "a b c")]
    got = run(docs_of(rows))
    assert got == brute(rows)
    assert got[2] == "\f \x0b\nkept" and got[3] == "kept too" and got[4] == got[5] == got[6] == ""


def test_equals_brute_force_on_random_lines(spark, docs_of):
    rng = random.Random(11)
    words = "a b c d e f".split()
    base = [[rng.choice(words) for _ in range(rng.randint(6, 14))] for _ in range(25)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(1, 4)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(x))
                x[k:k + 1] = rng.choice([[], [rng.choice(words)], [x[k], rng.choice(words)]])
            lines.append(" ".join(x))
        rows.append((i, "\n".join(lines)))
    assert run(docs_of(rows)) == brute(rows)


def test_large_group_of_near_lines_keeps_the_earliest(spark, docs_of):
    w = LONG.split()
    got = run(docs_of([(i, " ".join(w[:5] + [f"w{i}"] + w[6:])) for i in range(500)]))
    assert [i for i, t in got.items() if t] == [0]


def test_one_of_many_texts_without_or_with_one_id_keeps_a_line(spark, docs_of):
    w = LONG.split()
    rows = [(i, f"license\n{LONG}\nbody {i} {k}") for k in range(40) for i in (None, 7)]
    rows += [(None, "license\n" + " ".join(w[:4] + [f"X{k}"] + w[5:]) + f"\nnear {k}") for k in range(20)]
    docs = docs_of(rows + rows[:3])
    once = sorted((r.doc_id or 0, r.text, r.n_kept) for r in X.dedup_lines(docs).collect())
    # copies of a row keep the same lines
    kept = [x for x in set(once) if x[2] > 1]
    assert len(once) == len(rows) + 3 and all(i == 0 for i, _, _ in kept)
    lines = [line for _, t, _ in set(once) for line in t.split("\n")]
    assert lines.count("license") == 1 and sum(line.startswith("one two three") for line in lines) == 1
    assert len(lines) == len(rows) + 2
    assert sorted((r.doc_id or 0, r.text, r.n_kept) for r in X.dedup_lines(docs.repartition(7, "text")).collect()) == once


def test_repeated_rows_clashing_columns_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "a b"), (1, "a b"), (2, "a b\nc")]).withColumnRenamed("source", "n_lines")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_kept) for r in X.dedup_lines(docs).collect())
    assert got == [(1, "a b", 1, 1), (1, "a b", 1, 1), (2, "c", 2, 1)]
    assert X.dedup_lines(docs.limit(0)).collect() == []


def test_registered_query_equals_brute_force_and_runs_no_python(spark):
    docs = table(spark, SF, "documents")
    df = QUERIES["op9_line_dedup"](spark, SF)
    assert {r.doc_id: r.text for r in df.collect()} == brute([(r.doc_id, r.text) for r in docs.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_internal_names_clash_with_no_column(spark):
    extra = ("_gone", "_t", "_id0", "id0", "t", "pos", "line", "h1", "place", "near", "first")
    df = spark.createDataFrame([(1, "a b", *extra), (2, "a b\nc", *extra)],
                               "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    got = sorted((r.doc_id, r.text, *[r[c] for c in extra]) for r in X.dedup_lines(df).collect())
    assert got == [(1, "a b", *extra), (2, "c", *extra)]
