"""The pipeline equals its stages' brute-force versions, one after the other."""

import corpus_pipeline as P
import pytest

from headway.llm import decontaminate, toxicity
from headway.llm.common import table
from headway.llm.queries import default_vocabulary
from tests.conftest import SF_SMALL
from tests.llm.test_chosen_path import brute as brute_classes
from tests.llm.test_line_dedup import brute as brute_lines


@pytest.fixture(scope="module")
def result(spark):
    return P.run(spark, SF_SMALL).collect()


def test_equals_brute_force_stages(spark, result):
    from tokenizers import Tokenizer

    docs = table(spark, SF_SMALL, "documents")
    model = toxicity.fit(docs, table(spark, SF_SMALL, "labels"))
    heads = model.heads

    def toxic(text):
        words = toxicity.WORD.findall((text or "").lower())
        best = max((s for _, _, s in toxicity.text_segments(words, model, heads)), default=0.0)
        return model.probability(best, len(words)) >= 0.5

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = [(i, t) for i, t in rows if not toxic(t)]
    lines = brute_lines(kept)
    kept = [(i, lines[i]) for i, t in kept if lines[i] or not (t or "").strip()]
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i][0] == i]
    items = [" ".join(decontaminate.words(r.text)) for r in table(spark, SF_SMALL, "benchmark").collect()]
    kept = [(i, t) for i, t in kept if not any(x in " ".join(decontaminate.words(t)) for x in items)]
    library = Tokenizer.from_file(default_vocabulary())
    library.no_truncation()
    library.no_padding()
    assert sorted(r.doc_id for r in result) == sorted(i for i, _ in kept)
    got = {r.doc_id: list(r.ids) for r in result}
    assert all(got[i] == library.encode(t or "", add_special_tokens=False).ids for i, t in kept)


def test_stages_keep_the_columns_and_take_odd_tables(spark, docs_of, tmp_path):
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "bpe"]
    docs = docs_of([(1, None), (2, ""), (None, "some text of a few words"), (3, "x " * 20_000), (3, "x " * 20_000)])
    for name, stage in P.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF_SMALL)
            if name != "bpe":
                assert out.dtypes == docs.dtypes
            assert out.count() <= rows.count()
    ids = {r.doc_id for r in P.STAGES[2][1](spark, docs, SF_SMALL).collect()}
    assert ids == {1, 2, 3, None}


def test_registered_without_sql():
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is P.run and P.ORACLE_SQL is None
    assert "pipeline" not in E.oracle_sql()
    ops = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in ops) == list(range(1, 14))
