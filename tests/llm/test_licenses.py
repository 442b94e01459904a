import random
import re

from headway.llm import licenses
from headway.llm.licenses import Template
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, phrases, templates):
    """All blocks against all templates."""
    words = WORD.findall(lowered(text))
    places, base, own, share = [], set(), set(), 0.0
    for phrase, label in phrases:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    for t in templates:
        sought = set(WORD.findall(lowered(t.text)))
        size = 8
        while size < len(WORD.findall(lowered(t.text))):
            size *= 2
        for start in range(0, len(words), size):
            held = set(words[start:start + 2 * size])
            part = len(held & sought) / len(sought)
            if 5 * len(held & sought) >= 4 * len(sought) and set(t.marks.split()) <= held:
                own.add(t.label)
                share = max(share, part)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if places else share)


def check(spark, texts, phrases=licenses.PHRASES, templates=licenses.TEMPLATES):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, row string, words int")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(df, phrases=phrases, templates=templates).collect()}
    assert got == {i: brute(t, phrases, templates) for i, t in enumerate(texts)}
    return got


def test_notices_of_real_licenses(spark):
    body = " ".join(f"word{i}" for i in range(500))
    texts = [f"{body}\n{t.text}\n{body}" for t in licenses.TEMPLATES]
    texts += [body, f"{body} Released under the XYZ License. {body}", "Licensed under CC BY-SA 4.0."]
    got = check(spark, texts)
    for i, t in enumerate(licenses.TEMPLATES):
        assert t.label in got[i][5].split(",") and got[i][6] == 1.0
    assert got[len(licenses.TEMPLATES) + 1][5] == "" and got[len(licenses.TEMPLATES) + 2][5] == "cc-by-sa"


def test_random_texts_at_the_threshold(spark):
    rng = random.Random(2)
    templates = [Template(f"t{k}", " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)), "a" if k % 3 == 0 else "")
                 for k, n in enumerate((3, 5, 8, 9, 16, 17, 30))]
    templates = [t for t in templates if set(t.marks.split()) <= set(t.words)]
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", weights=range(1, 27), k=rng.randrange(120))) for _ in range(150)]
    texts += [" ".join(w for w in rng.choice(templates).text.split() if rng.random() < 0.85) for _ in range(100)]
    got = check(spark, texts, [("a b", "ab"), ("z z", "zz"), ("z y", "ab")], templates)
    assert len({g[5] for g in got.values()}) > 5


def test_phrases_overlap_and_words_are_split_as_stated(spark):
    texts = ["MIT License mit-license MITLICENSE mit\tlicense", "mit license mit license", "amit license", "mit licenses",
             "General\nPublic  License general public general public license", "MIT LİCENSE", "Émit license mit license",
             "\U0001f600 mit license", "mit\x00license"]
    got = check(spark, texts)
    assert got[0][1:4] == (3, 0, 5) and got[1][1:4] == (2, 0, 2) and got[4][1:4] == (2, 0, 5) and got[6][1] == 0


def test_null_empty_long_and_repeated_texts(spark):
    notice = "Released under the MIT License. "
    got = check(spark, [None, "", " \n", "!!", notice, notice, notice * 20_000, "x" * 300_000, "the of to " * 50_000])
    assert got[0] == (0, 0, None, None, "", "", 0.0) and got[6][1] == 20_000
    rows = spark.createDataFrame([(None, notice), (None, notice), (7, notice), (7, notice)], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in licenses.scan(rows).where("labels = 'mit'").collect()) == ["7", "7", "None", "None"]
    assert licenses.scan(rows.limit(0)).collect() == []
    assert licenses.scan(rows, templates=[]).first()["labels"] == "mit"


def test_registered_query_equals_its_sql(spark):
    assert compare(spark, SF_SMALL, ["op12_license_templates"], verbose=False)["op12_license_templates"].startswith("OK")
