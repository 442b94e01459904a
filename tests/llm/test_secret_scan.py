import hashlib
import random
import re

from headway.llm import secret_scan as X
from headway.llm.common import table
from headway.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(text):
    """Spans of every rule by scanning with the plain regexes, no index."""
    out = []
    for order, r in enumerate(X.RULES):
        for m in re.finditer(r.regex, text or "", re.ASCII):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), order, m.end(), r.kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def base_digest(spans):
    kinds = tuple(r.kind for r in X.BASE)
    return hashlib.sha256(",".join(s for s in spans if s.split(":")[0] in kinds).encode()).hexdigest()


CASES = [None, "", "no secret here", "password=abcdef", 'PassWord" : "abc123+/=_.-x"', "token=short tokens: longenough",
         "secret=token:abcdefgh", "api_key='k' apikey = 123456", "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 12, "AKIA" + "A" * 15,
         "0" * 23, "f" * 24, "éñ😀 " + "ab" * 20 + " token=éabcdef", "x" * 100_000 + "passwd:zzzzzz" + "f0" * 50_000,
         "ghp_" + "a" * 36 + " xoxb-1234567890 AIza" + "b" * 35, "-----BEGIN RSA PRIVATE KEY-----",
         "eyJaaaaaaaaaa.eyJbbbbbbbbbb.cccccccccc", "token=abcdef\ntoken=abcdef", "TOKEN==========", "secret:::secret=zzzzzz",
         "password=" + "c3" * 20]


def found(df):
    return {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in df.collect()}


def expected(text):
    s = brute(text)
    return (*(sum(x.startswith(k + ":") for x in s) for k in ("assign", "access", "hex")), base_digest(s), ",".join(s))


def test_trigram_queries():
    q = {r.kind: X.trigram_query(r.regex) for r in X.RULES}
    assert q["hex"] == []
    assert q["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in q["assign"] and len(q["assign"]) == 6
    assert len(q["github"]) == 5 and all(q[k] for k in q if k != "hex")


def test_each_rule_needs_its_trigrams():
    for r in X.RULES:
        for text in filter(None, CASES):
            for m in re.finditer(r.regex, text, re.ASCII):
                query, low = X.trigram_query(r.regex), m.group().lower()
                assert not query or any(all(t in low for t in clause) for clause in query)


def test_cases_nulls_repeats_and_clashing_columns(spark, docs_of, tmp_path):
    rows = list(enumerate(CASES)) + [(3, CASES[3]), (None, CASES[3])]
    docs_of(rows).withColumnRenamed("source", "spans").write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["op3_trigram_secrets"](spark, str(tmp_path))
    assert df.count() == len(rows)
    got = found(df)
    for i, text in rows:
        assert got[i] == expected(text), (i, text[:60] if text else text)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark, docs_of):
    assert X.scan(docs_of([])).collect() == []


def test_registered_query_equals_full_scan(spark):
    got = found(QUERIES["op3_trigram_secrets"](spark, SF))
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    assert all(got[d.doc_id] == expected(d.text) for d in docs)
    assert sum(g[0] for g in got.values()) > 0


def test_many_matches_in_one_text(spark):
    rng = random.Random(5)
    parts = ["AKIA" + "B" * 16, "0123456789abcdef01234567", "token=abcdefgh", "é😀", "secret: x1y2z3", "plain", "f" * 30]
    for n in (X.RUN - 1, X.RUN, X.RUN + 1, 2 * X.RUN, 5000):
        text = " ".join(rng.choices(parts, k=n))
        row = X.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        assert [f"{s.kind}:{s.start}:{s.end}" for s in row.spans] == brute(text)
    only = "0123456789abcdef01234567 " * (3 * X.RUN)
    row = X.scan(spark.createDataFrame([(1, only)], "doc_id long, text string")).first()
    assert [s.start for s in row.spans] == list(range(0, len(only), 25))
