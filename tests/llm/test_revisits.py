import random

from pyspark.sql import functions as F

from headway.llm import revisits as X
from headway.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(outcome, response id) of each revisit by looking at every earlier response."""
    out = {}
    for rid, url, kind, status, date, headers in rows:
        if kind != "revisit":
            continue
        full = [(d, i, h) for i, u, k, s, d, h in rows
                if k == "response" and s == 200 and u is not None and u == url and d is not None
                and date is not None and (d, i) < (date, rid)]
        if not full:
            out[rid] = ("no_response", None, None)
            continue
        d, i, h = max(full, key=lambda x: x[:2])
        own, theirs = headers or {}, h or {}
        if "etag" in own and "etag" in theirs:
            ok = own["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/")
        elif "last-modified" in own and "last-modified" in theirs:
            ok = own["last-modified"] == theirs["last-modified"]
        else:
            ok = None
        merged = own if ok is False else theirs | {k: v for k, v in own.items() if k in X.PERMITTED}
        out[rid] = ({True: "resolved", False: "mismatch", None: "unvalidated"}[ok], i, merged)
    return out


def test_equals_brute_force_with_hot_url_ties_nulls_and_repeats(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        url = "h.example/hot" if i % 2 else rng.choice(["h.example/a", "h.example/b", None])
        kind, status = rng.choice([("response", 200), ("response", 404), ("revisit", 304), ("revisit", 304)])
        headers = {k: v for k, v in {"etag": rng.choice(["1", "W/1", "2", None]), "last-modified": rng.choice(["x", "y", None]),
                                     "server": "s", "cache-control": str(i)}.items() if v}
        rows.append((i, url, kind, status, rng.choice([rng.randrange(400), None]) if i % 50 == 0 else rng.randrange(400),
                     headers if i % 31 else None))
    schema = "record_id long, uri string, type string, status int, date long, headers map<string,string>"
    uri = F.concat(F.lit("https://"), "uri")
    df = spark.createDataFrame(rows, schema).withColumn("uri", uri).withColumn("payload_digest", F.col("record_id").cast("string"))
    df = df.withColumn("url", F.lit("clash"))
    for width in (10, 3600):
        got = X.resolve(df.unionByName(df.where("record_id % 9 = 0 and type = 'revisit'")), width).collect()
        expected = brute(rows)
        assert {r.record_id for r in got} == set(expected) and len(got) >= len(expected)
        for r in got:
            outcome, i, headers = expected[r.record_id]
            assert (r.outcome, r.response_id) == (outcome, i)
            if headers is not None:
                assert r.headers == headers
            assert r.payload_digest == (str(i) if outcome in ("resolved", "unvalidated") else None)
    assert X.resolve(df.limit(0)).collect() == []


def test_canonical_urls(spark):
    urls = ["http://WWW.h.example:80/a/?b=2&a=1&utm_source=x#f", "https://m.h.example/a?a=1&b=2", "https://h.example", "x", None, "",
            "https://h.example:80/a", "http://h.example:443", "two.example/b#c", "one.example/a", "dns:h.example", "ftp://www.h.example/a/"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(X.canonical_url(F.col("u"))).collect()]
    assert got == ["h.example/a?a=1&b=2", "h.example/a?a=1&b=2", "h.example", "x", None, "",
                   "h.example:80/a", "h.example:443", "two.example/b", "one.example/a", "dns:h.example", "ftp://h.example/a"]


def test_uris_without_a_scheme_or_empty_ones_do_not_meet(spark):
    rows = [(1, "one.example/a", "response", 200, 10, {"etag": "1"}, "digest"), (2, "two.example/b", "revisit", 304, 20, {"etag": "1"}, None),
            (3, "one.example/a#x", "revisit", 304, 30, {"etag": "1"}, None), (4, "", "response", 200, 1, {"etag": "1"}, "empty"),
            (5, "", "revisit", 304, 9, {"etag": "1"}, None)]
    got = {r.record_id: (r.outcome, r.response_id) for r in X.resolve(spark.createDataFrame(rows, X.RECORD)).collect()}
    assert got == {2: ("no_response", None), 3: ("resolved", 1), 5: ("no_response", None)}


def test_registered_query_equals_sql(spark):
    res = compare(spark, SF, ["op10_revisit_resolution", "op7_threshold_top_k"], verbose=False)
    assert all(r.startswith("OK") for r in res.values()), res
    assert set(ORACLE) <= set(QUERIES)
