import random

import pytest

from headway.llm import bpe
from headway.llm.queries import default_vocabulary
from tests.conftest import SF_SMALL

CASES = ["a\x1cb !\xa0x\x1dy", "<|endoftext|>x<|startoftext|>", "ΑΣ Σ İstanbul ﬁ ½ é ́ a b c",
         "I'Ll don't 'S ''s x'tyy", "日本語 テスト 😀👍🏽 \x85 ​﻿", "q" * 500 + "é" * 300, "a\tb\x0bc\x0cd\n",
         "<|EndOfText|> <|endoftext|", "<|endoftext|><|endoftext|> \x1c<|endoftext|>",
         " \U0001e900 Ǆ ŉ ẞ", "", " \n ", "̈́ ʹ x`", "zqxj" * 5000, "AKIA99 éèç ñrr"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_equals_library_on_odd_texts(library):
    enc = bpe.Encoder(default_vocabulary())
    ids = enc.encode(CASES)
    for text, i, decoded in zip(CASES, ids.to_pylist(), enc.decode(ids).to_pylist()):
        assert (i, decoded) == expected(library, text), repr(text)


def test_cuts_are_certain():
    enc = bpe.Encoder(default_vocabulary())
    assert enc.joined[ord("t"), ord("h")]
    assert not enc.joined.all()
    bodies = [t.removesuffix("</w>") for t in enc.token.to_pylist() if t not in enc.special]
    inside = {t[i:i + 2] for t in bodies for i in range(len(t) - 1)}
    assert enc.joined.sum() == len(inside)
    assert all(enc.joined[ord(a), ord(b)] for a, b in inside)


def test_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 3)
    enc = bpe.Encoder(default_vocabulary())
    for text in ["one two three four five", "six two one", "<|endoftext|> one"]:
        ids = enc.encode([text])
        assert (ids.to_pylist()[0], enc.decode(ids).to_pylist()[0]) == expected(library, text)


def test_random_texts_equal_library(library):
    rng = random.Random(3)
    alphabets = ["".join(map(chr, range(256))), "aàéîõüßÿªº²½'sStTrReEvVmMlLdD 1.", "the \n\x85\xa0\x1c\u2003 İ\u0307\u0328\u0301iéKÅ",
                 "".join(map(chr, range(0x100, 0x500))) + " ", "日本語😀 a'll\u200d", "abcde  <|endoftext|>"]
    texts = ["".join(rng.choices(rng.choice(alphabets), k=rng.randrange(60))) for _ in range(6000)]
    texts += [a + b for a, b in zip(texts, reversed(texts))]
    enc = bpe.Encoder(default_vocabulary())
    for at in range(0, len(texts), 1500):
        part = texts[at:at + 1500]
        ids = enc.encode(part)
        for text, i, decoded in zip(part, ids.to_pylist(), enc.decode(ids).to_pylist()):
            assert (i, decoded) == expected(library, text), repr(text)


def test_memory_is_bounded_and_given_back(library, monkeypatch):
    enc = bpe.Encoder(default_vocabulary())
    least = enc.size
    monkeypatch.setattr(bpe, "CACHE_BYTES", 60_000)
    for k in range(40):
        words = [f"w{k * j}é" for j in range(100)] + ["der", "日本" * (k + 1)]
        ids = enc.encode([" ".join(words), "plain"])
        assert ids.to_pylist()[0] == expected(library, " ".join(words))[0]
        assert enc.size == sum(map(len, enc.ids)) + sum(map(len, enc.ids.values())) + bpe.ENTRY_BYTES * len(enc.ids)
        assert enc.size < 120_000
    assert "plain" in enc.ids
    enc.forget()
    assert enc.size == least


def test_table_with_nulls_repeats_and_clashing_columns(spark, library, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "The THE the"), (3, "The THE the"), (None, CASES[2])])
    got = bpe.encode_decode(docs.withColumnRenamed("source", "ids"), default_vocabulary()).collect()
    assert len(got) == 5
    for r in got:
        assert (list(r.ids), r.decoded) == expected(library, r.text)
    assert bpe.encode_decode(docs.limit(0), default_vocabulary()).collect() == []


def test_registered_query_equals_library(spark, library):
    import hashlib

    from headway.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op2_bpe_forced_boundary"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, decoded = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
