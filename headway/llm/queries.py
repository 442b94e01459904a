"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (
    bpe, chosen_path, decontaminate, html_text, licenses, line_dedup, revisits, secret_scan, shallot, surrogates, topk,
    toxicity, vector_codes,
)
from headway.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Key of the registered query; a deployment passes its own secret.
SURROGATE_KEY = b"registered-query"


def op1_pii_surrogates(spark, sf_dir):
    return surrogates.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the ids and of the decoded text of each document."""
    enc = bpe.encode_decode(docs.select("doc_id", "text"), default_vocabulary())
    return enc.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_bpe_forced_boundary(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"))


def _same(kind: str):
    return lambda k: F.when(k == kind, k)


def op3_trigram_secrets(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secret_scan.BASE]))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _same(r.kind)))).cast("long").alias(f"n_{r.kind}")
              for r in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("spans")).alias("spans"))


def op4_latent_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_host_path_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_toxic_segments(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("segments").alias("n_segments"))


def op7_threshold_top_k(spark, sf_dir):
    v = topk.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    return topk.top_k(v, v.where(F.col("id") % 100 == 0), 10)


def op8_chosen_path_join(spark, sf_dir):
    return chosen_path.class_table(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_revisit_resolution(spark, sf_dir):
    found = revisits.resolve(revisits.records_of(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_text(F.col("headers")))


def op11_shallot_clusters(spark, sf_dir):
    rows, centroids = shallot.cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                      width=64, k=16, rounds=3, scale=64)
    # a row for each of the 16 clusters
    total = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = spark.createDataFrame([(c, t, sum(total.values()), names[c]) for c, t in total.items()],
                                "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(own), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_license_templates(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


#: Rows of a label meet its total in so many groups where the totals are too many to be broadcast.
LABEL_SALTS = 16


def op13_hadamard_codes(spark, sf_dir):
    coded, entries = vector_codes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                           parts=8, entries=16, rounds=6, scale=4096, keep=("label",))
    coded = stored(coded.withColumn("salt", F.pmod(F.xxhash64("id", "codes"), F.lit(LABEL_SALTS)).cast("int")), "codes")
    total = (coded.groupBy("label").agg(F.sum("error").alias("label_error"))
             .select(F.col("label").alias("of"), "label_error",
                     F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("part")))
    name = "" if entries is None else ",".join(map(str, entries.reshape(-1).tolist()))
    return coded.join(total, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part"))).select(
        F.col("id").alias("vec_id"),
        F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "").alias("code"),
        "error", "label_error", F.lit(hashlib.sha256(name.encode()).hexdigest()).alias("codebooks_sha256"))


QUERIES: dict[str, Query] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_bpe_forced_boundary": op2_bpe_forced_boundary,
    "op3_trigram_secrets": op3_trigram_secrets,
    "op4_latent_decontamination": op4_latent_decontamination,
    "op5_host_path_text": op5_host_path_text,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_threshold_top_k": op7_threshold_top_k,
    "op8_chosen_path_join": op8_chosen_path_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_revisit_resolution": op10_revisit_resolution,
    "op11_shallot_clusters": op11_shallot_clusters,
    "op12_license_templates": op12_license_templates,
    "op13_hadamard_codes": op13_hadamard_codes,
}

def finite_sql(scale: int) -> str:
    """Rows that take part, with their integer components."""
    return f"""SELECT vec_id, label, [cast(floor({scale} * cast(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"""


def floor_sql(total: str, n: str) -> str:
    """Exact floor of a quotient with a positive divisor."""
    return f"cast(({total} - (({total} % {n}) + {n}) % {n}) // {n} AS BIGINT)"


SQUARED = "list_sum([(a[1] - a[2]) * (a[1] - a[2]) FOR a IN list_zip({0}, {1})])"


def clusters_sql(width: int, k: int, rounds: int, scale: int) -> str:
    """The rounds of op11, unrolled."""
    steps = [f"""WITH w AS ({finite_sql(scale)}),
r AS (SELECT row_number() OVER () AS i, vec_id, v FROM w WHERE len(v) = {width}),
c0 AS (SELECT cast(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
       FROM (SELECT sha256('1:' || vec_id) AS h, v FROM r WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""]
    for n in range(rounds + 1):
        distance = SQUARED.format("r.v", f"c{n}.v")
        steps.append(f"""a{n} AS (SELECT i, min_by(c, d * {k} + c) AS c, min(d) AS d
  FROM (SELECT r.i, c, cast({distance} AS HUGEINT) AS d FROM r, c{n}) GROUP BY i)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT c, p, sum(x) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range({width})) AS p FROM r JOIN a{n} USING (i)) GROUP BY c, p)""")
            steps.append(f"""c{n + 1} AS (SELECT c, coalesce(m, c{n}.v) AS v FROM c{n}
  LEFT JOIN (SELECT c, list({floor_sql('s', 'n')} ORDER BY p) AS m FROM s{n} GROUP BY c) USING (c))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, c AS cluster, cast(d AS BIGINT) AS distance, cast(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       cast(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN r USING (i) JOIN c{rounds} USING (c)
"""


def codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """The rounds of op13, unrolled."""
    steps = [f"""WITH w AS ({finite_sql(scale)}),
size AS (SELECT len(v) AS n FROM w WHERE vec_id IS NOT NULL ORDER BY vec_id, v LIMIT 1),
r AS (SELECT row_number() OVER () AS i, vec_id, label, v, n // {parts} AS width FROM w, size
      WHERE len(v) = n AND n % {parts} = 0),
p AS (SELECT i, p, v[p * width + 1:(p + 1) * width] AS x FROM r, (SELECT unnest(range({parts})) AS p)),
first AS (SELECT i, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM r WHERE vec_id IS NOT NULL
          ORDER BY vec_id, v LIMIT {entries}),
b0 AS (SELECT p, e, x FROM p JOIN first USING (i))"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS (SELECT i, p, min_by(e, d * {entries} + e) AS e, min(d) AS d
  FROM (SELECT i, p.p, e, cast({SQUARED.format('p.x', f'b{n}.x')} AS HUGEINT) AS d FROM p JOIN b{n} ON p.p = b{n}.p)
  GROUP BY i, p)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT p, e, k, sum(x) AS s, count(*) AS n
  FROM (SELECT p, e, unnest(x) AS x, unnest(range(len(x))) AS k FROM p JOIN a{n} USING (i, p)) GROUP BY p, e, k)""")
            steps.append(f"""b{n + 1} AS (SELECT p, e, coalesce(m, b{n}.x) AS x FROM b{n}
  LEFT JOIN (SELECT p, e, list({floor_sql('s', 'n')} ORDER BY k) AS m FROM s{n} GROUP BY p, e) USING (p, e))""")
    return ",\n".join(steps) + f""",
o AS (SELECT i, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, cast(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY i)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM o JOIN r USING (i)
"""


def licenses_sql() -> str:
    """All blocks against all templates."""
    rows = ", ".join(f"({t.block}, '{t.label}', {t.words!r}, {t.least}, {t.marks.split()!r}::VARCHAR[])" for t in licenses.TEMPLATES)
    spoken = " ".join(f"WHEN '{p}' THEN '{label}'" for p, label in licenses.PHRASES)
    phrases = ", ".join(f"({p.split()!r})" for p, _ in licenses.PHRASES)
    return rf"""
WITH t(size, label, sought, least, marks) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS i, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
ph(words) AS (VALUES {phrases}),
spot AS (SELECT i, words, unnest(list_filter(range(len(w)), lambda x: w[x + 1:x + len(words)] = words)) AS k FROM d, ph
       WHERE list_has_all(w, words)),
base AS (SELECT i, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word,
                list(DISTINCT CASE array_to_string(words, ' ') {spoken} END) AS own FROM spot GROUP BY i),
b AS (SELECT i, size, list_distinct(w[k * size + 1:(k + 2) * size]) AS held
      FROM (SELECT i, w, size, unnest(range((len(w) + size - 1) // size)) AS k
            FROM d, (SELECT DISTINCT size FROM t))),
m AS (SELECT i, label, len(list_intersect(held, sought)) / len(sought) AS share FROM b JOIN t USING (size)
      WHERE len(list_intersect(held, sought)) >= least AND list_has_all(held, marks)),
f AS (SELECT i, list(DISTINCT label) AS labels, max(share) AS share FROM m GROUP BY i)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(own, labels))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (i) LEFT JOIN f USING (i)
"""


ORACLE: dict[str, str] = {
    "op11_shallot_clusters": clusters_sql(width=64, k=16, rounds=3, scale=64),
    "op12_license_templates": licenses_sql(),
    "op13_hadamard_codes": codes_sql(parts=8, entries=16, rounds=6, scale=4096),
    "op7_threshold_top_k": """
WITH v AS (
  SELECT vec_id, [cast(floor(1024 * cast(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         cast(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, cast(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op10_revisit_resolution": r"""
WITH base AS (
  SELECT page_id AS i, url, 1704067200 + page_id * 60 AS t0, cast(length(html) AS VARCHAR) AS size,
         '"' || substr(md5(html), 1, 16) || '"' AS tag, sha256(html) AS digest
  FROM pages WHERE page_id IS NOT NULL),
resp AS (
  SELECT i * 8 AS record_id, url AS uri, t0 AS date, tag AS etag, cast(t0 - 86400 AS VARCHAR) AS lm, size, digest
  FROM base WHERE url IS NOT NULL),
rev AS (
  SELECT i * 8 + k AS record_id,
         CASE k WHEN 1 THEN regexp_replace(url, '^http:', 'https:') WHEN 2 THEN url || '#again'
                ELSE regexp_replace(url, '^([a-z]+://)', '\1www.') END AS uri,
         t0 + k * k * 1000 - CASE WHEN i % 13 = 0 THEN 1000000 ELSE 0 END AS date,
         CASE WHEN i % 7 = 0 THEN NULL WHEN i % 11 = 0 THEN '"stale"' WHEN k = 2 THEN 'W/' || tag ELSE tag END AS etag,
         CASE WHEN k <> 3 THEN cast(t0 - 86400 AS VARCHAR) END AS lm, k
  FROM base, (SELECT unnest([1, 2, 3]) AS k) WHERE k <= i % 4),
u AS (
  SELECT *, regexp_replace(uri, '#.*$', '') AS plain FROM (
    SELECT record_id, uri, date, etag, lm, size, digest, NULL AS k FROM resp
    UNION ALL SELECT record_id, uri, date, etag, lm, NULL, NULL, k FROM rev)),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[A-Za-z]+://([^/?]*)', 1)), '^(www|m)\.', ''),
                          CASE WHEN lower(plain) LIKE 'https:%' THEN ':443$' ELSE ':80$' END, '')
         || regexp_replace(regexp_extract(plain, '^[A-Za-z]+://[^/?]*([^?]*)', 1), '/+$', '')
         || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS url
  FROM (SELECT *, [p FOR p IN string_split(regexp_extract(plain, '\?(.*)$', 1), '&')
                   IF p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')] AS q FROM u)),
j AS (
  SELECT *, last_value(CASE WHEN k IS NULL THEN {'id': record_id, 'date': date, 'etag': etag, 'lm': lm, 'size': size, 'digest': digest} END
                       IGNORE NULLS) OVER (PARTITION BY url ORDER BY date, record_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM c),
o AS (
  SELECT *, CASE WHEN r IS NULL OR url IS NULL THEN 'no_response'
                 WHEN coalesce(replace(etag, 'W/', '') = r.etag, lm = r.lm) THEN 'resolved'
                 WHEN NOT coalesce(replace(etag, 'W/', '') = r.etag, lm = r.lm) THEN 'mismatch' ELSE 'unvalidated' END AS outcome
  FROM j WHERE k IS NOT NULL)
SELECT record_id, date, url, outcome, CASE WHEN url IS NOT NULL THEN r.id END AS response_id,
       CASE WHEN outcome IN ('resolved', 'unvalidated')
            THEN 'cache-control: max-age=' || k || chr(10) || 'content-length: ' || r.size || chr(10) || 'content-type: text/html'
                 || chr(10) || 'date: ' || date || chr(10) || 'etag: ' || coalesce(etag, r.etag) || chr(10) || 'last-modified: ' || r.lm
                 || chr(10) || 'server: httpd'
            ELSE 'cache-control: max-age=' || k || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || date
                 || coalesce(chr(10) || 'etag: ' || etag, '') || coalesce(chr(10) || 'last-modified: ' || lm, '')
                 || chr(10) || 'server: proxy' END AS headers,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN r.digest END AS payload_digest
FROM o
""",
}
