import random

import numpy as np
import pytest

from headway.llm import decontaminate as X
from headway.llm.common import table
from headway.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    common = "the of and to in is it".split()
    return [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def fixture():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(12, 60))) for i in range(30)]
    docs, leaks = [], set()
    for d in range(150):
        text = prose(rng, rng.randint(1, 300))
        if d % 5 == 0:
            i, item = rng.choice(items)
            item = list(item)
            if d % 10 == 0:                     # a paraphrase: every sixth word replaced
                item = [w if k % 6 else f"z{k}" for k, w in enumerate(item)]
            at = rng.randint(0, len(text))
            text[at:at] = item
            leaks.add((d, i))
        docs.append((d, " ".join(text)))
    return [(i, " ".join(t)) for i, t in items], docs, leaks


def brute_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(20))
def test_common_subsequence_equals_dynamic_programming(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 90))] for _ in range(2))
    assert X.common_length(a, b) == brute_length(a, b)


def test_finds_all_leaks_and_no_other(spark, docs_of, fixture):
    items, docs, leaks = fixture
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = X.matches(docs_of(docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks
    kept = {r.doc_id for r in X.clean_documents(docs_of(docs), bench).collect()}
    assert kept == {i for i, _ in docs} - {d for d, _ in leaks}


def test_candidates_hold_brute_force_pairs(spark, fixture):
    """Recall of the cosine search against all pairs that the decision would accept."""
    items, docs, leaks = fixture
    vocabulary = sorted({w for _, t in items for w in X.words(t)})
    ids = {w: i for i, w in enumerate(vocabulary)}
    idf = np.array([np.log(150 / (1 + sum(w in X.words(t) for _, t in docs))) + 0.01 for w in vocabulary])
    terms = X.randomised_svd(spark.createDataFrame(items, "item_id long, text string").repartition(4), ids, idf, 30)
    space = X.Space([(i, t, None) for i, t in items], ids, idf, terms)
    texts = [np.array([ids.get(w, -1) for w in X.words(t)], np.int64) for _, t in docs]
    found = {(d, space.item_id[i]) for d, i, _, _ in zip(*map(np.ndarray.tolist, space.candidates(texts)))}
    assert len(leaks & found) >= 0.9 * len(leaks)


def test_search_of_more_passages_than_dimensions_holds_brute_force_pairs(spark):
    """Recall of the planted leaks that the rule for all windows accepts somewhere, in a truncated space."""
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randint(15, 59))) for i in range(2 * X.RANK + 44)]
    docs, planted = [], set()
    for d in range(80):
        text, (i, item) = prose(rng, rng.randint(200, 400)), rng.choice(items)
        at, share = rng.randint(0, len(text)), (0, 0.15, 0.3, 0.38)[d % 4]
        text[at:at] = [f"z{k}" if rng.random() < share else w for k, w in enumerate(item)]
        docs.append(text)
        planted.add((d, i))
    ids = {w: k for k, w in enumerate(sorted({w for _, t in items for w in t}))}
    idf = np.array([np.log(81 / (1 + sum(w in t for t in map(set, docs)))) + 0.01 for w in ids])
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string").repartition(4)
    space = X.Space([(i, " ".join(t), None) for i, t in items], ids, idf, X.randomised_svd(bench, ids, idf, X.RANK))
    texts = [np.array([ids.get(w, -1) for w in t], np.int64) for t in docs]
    want = {(d, i) for d, i in planted for at in range(0, len(texts[d]), X.WINDOW // 2)
            if space.decide(texts[d], i, at)[2] and space.decide_compact(texts[d], i, at)[0]}
    found = {(d, i) for d, i, *_ in space.found(texts)}
    assert len(want) > 60 and len(want & found) >= 0.9 * len(want)


def test_leak_below_a_nearer_window_of_the_document_is_found(spark, docs_of, fixture):
    """Another window has the higher cosine (the passage backwards) or none holds the passage in one stretch."""
    rng = random.Random(4)
    items = fixture[0]
    w = items[0][1].split()
    leak = [x if k % 4 else f"z{k}" for k, x in enumerate(w)]
    decoy = w[::-1] * 2
    far = prose(rng, 400)
    spread = [x for word in w for x in (word, *prose(rng, 9))]
    docs = [(1, decoy + far + leak), (2, leak + far + decoy + far + leak), (3, decoy + far), (4, spread),
            (5, far + decoy + far + w + far + decoy)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = X.matches(docs_of([(i, " ".join(t)) for i, t in docs]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 0), (2, 0), (5, 0)]
    assert {r.doc_id: r.lcs for r in got}[5] == 1.0


def test_window_with_other_passages_words_is_searched():
    """A window of cosine 0.44: 8 of the passage's 12 words and 20 words of other passages."""
    items = [(0, [f"a{k}" for k in range(12)], None)] + [(i, [f"b{i}x{k}" for k in range(12)], None) for i in range(1, 21)]
    ids = {w: k for k, w in enumerate(w for _, t, _ in items for w in t)}
    space = X.Space([(i, " ".join(t), a) for i, t, a in items], ids, np.ones(len(ids)), np.eye(len(ids)))
    doc = [w if k % 3 else f"z{k}" for k, w in enumerate(items[0][1])] + [t[0] for _, t, _ in items[1:]]
    got = space.found([np.array([ids.get(w, -1) for w in doc], np.int64)])
    assert [(d, i) for d, i, *_ in got] == [(0, 0)] and 0.43 < got[0][2] < 0.44


def test_svd_equals_exact_svd_of_low_rank(spark, fixture):
    items, _, _ = fixture
    ids = {w: i for i, w in enumerate(sorted({w for _, t in items for w in X.words(t)}))}
    idf = np.ones(len(ids))
    terms = X.randomised_svd(spark.createDataFrame(items, "item_id long, text string").repartition(5), ids, idf, 30)
    a = np.zeros((len(items), len(ids)))
    for row, (_, t) in zip(a, items):
        at, x = X.weighted(t, ids, idf)
        row[at] = x
    assert np.allclose(np.linalg.norm(a @ terms, axis=1), 1, atol=1e-6)


def test_blocks_nulls_and_empty_tables(spark, docs_of, fixture, monkeypatch):
    items, docs, leaks = fixture
    monkeypatch.setattr(X, "BLOCK_ITEMS", 16)
    some = docs[:30] + [(900, None), (901, ""), (0, docs[0][1]), (None, docs[5][1])]
    bench = spark.createDataFrame(items + [(77, None), (78, "too short"), (79, "")], "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id) for r in X.matches(docs_of(some), bench).collect())
    want = [x for x in leaks if x[0] < 30]
    assert got == sorted(want + [x for x in want if x[0] == 0] + [(-1, i) for d, i in want if d == 5])
    assert X.matches(docs_of([]), bench).collect() == []
    assert X.matches(docs_of(some), bench.limit(0)).collect() == []
    assert X.clean_documents(docs_of(some), bench.limit(0)).count() == len(some)


def test_answer_column_decides_paraphrases(spark, docs_of):
    rng = random.Random(2)
    item = prose(rng, 40)
    text = " ".join(w if k % 3 else f"q{k}" for k, w in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item), " ".join(item[1::3])), (2, " ".join(item), "else")],
                                  "item_id long, text string, answer string")
    got = X.matches(docs_of([(5, text)]), bench, answer_col="answer").collect()
    assert [r.item_id for r in got] == [1]


def test_registered_query_equals_search_for_whole_passages(spark):
    docs, items = table(spark, SF, "documents").collect(), table(spark, SF, "benchmark").collect()
    flat = {r.item_id: " ".join(X.words(r.text)) for r in items}
    want = {(d.doc_id, i) for d in docs for i, t in flat.items() if t in " ".join(X.words(d.text))}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op4_latent_decontamination"](spark, SF).collect()}
    assert want and got == want


def test_clean_documents_keeps_columns_named_like_its_own(spark, fixture):
    items, docs, leaks = fixture
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {d for d, _ in leaks}
    rows = [(i, t, f"mine {i}", "id") for i, t in docs[:20]]
    got = X.clean_documents(spark.createDataFrame(rows, "doc_id long, text string, _t string, item_id string"), bench).collect()
    assert sorted((r.doc_id, r._t, r.item_id) for r in got) == sorted((i, f"mine {i}", "id") for i, _, _, _ in rows if i not in bad)


def test_one_rule_holds_for_every_window(spark, docs_of, fixture):
    """A leak's verdict does not depend on what else the document holds."""
    rng = random.Random(9)
    items = fixture[0]
    w = items[0][1].split()
    stretched = [x for k, word in enumerate(w) for x in ((word, *prose(rng, 2)) if k % 2 else (word,))]
    far, nearer = prose(rng, 300), w[::-1] + w[::-1]
    rows = [(1, stretched), (2, nearer + far + stretched), (3, stretched + far + nearer), (4, nearer + far)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.lcs for r in X.matches(docs_of([(i, " ".join(t)) for i, t in rows]), bench).where("item_id = 0").collect()}
    assert set(got) in ({1, 2, 3}, set()) and len(set(got.values())) <= 1


def test_short_passages_are_found_as_runs(spark, docs_of):
    bench = spark.createDataFrame([(1, "What is it?"), (2, "What is it?"), (3, "one"), (4, "!!"), (5, None), (6, "it what")],
                                  "item_id long, text string")
    docs = docs_of([(1, "so WHAT is, it"), (2, "what was is it"), (3, "One of them"), (4, None), (5, ""), (6, "is it what")])
    got = sorted((r.doc_id, r.item_id, r.lcs) for r in X.matches(docs, bench).collect())
    assert got == [(1, 1, 1.0), (1, 2, 1.0), (3, 3, 1.0), (6, 6, 1.0)]
    assert sorted(r.doc_id for r in X.clean_documents(docs, bench).collect()) == [2, 4, 5]


def test_many_blocks_are_searched_in_few_passes(spark, docs_of, fixture, monkeypatch):
    items, docs, leaks = fixture
    monkeypatch.setattr(X, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(X, "GROUP_BLOCKS", 3)
    passes, one = [], X.search
    monkeypatch.setattr(X, "search", lambda *a: passes.append(len(a[1])) or one(*a))
    counted, count = [], X.document_frequencies
    monkeypatch.setattr(X, "document_frequencies", lambda *a: counted.append(1) or count(*a))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in X.matches(docs_of(docs[:25]), bench).collect())
    assert got == sorted(x for x in leaks if x[0] < 25)
    assert len(counted) == 1 and len(passes) == -(-len(items) // 15) and max(passes) <= 3
