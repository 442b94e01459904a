"""Benchmark decontamination by latent semantic retrieval.

The benchmark's passages are TF-IDF vectors, with document frequencies counted
over the whole corpus; a distributed randomised SVD (range finder with power
iterations, partial products summed by Spark) gives their latent space. Every
document is cut into half-overlapping windows, each window is projected, and its
cosine with every benchmark passage picks candidates. Each of them is decided on
the stretches of a window's and the passage's length around its own window: in one of
them the longest common subsequence must hold ``SURE`` of the passage's words, or
``PARAPHRASE`` of them if the answer (the passage's own answer column, else its last
third) is there as well. Over more words, common ones make short passages up by
chance. The same rule holds for every window; a document and passage are reported once, with the
window of the longest subsequence.

A benchmark over ``BLOCK_ITEMS`` passages is worked off in blocks, each with its
own space, and ``GROUP_BLOCKS`` of them are searched in one pass over the documents, so what a
task holds is bounded, and the words of all are counted in one pass.

Defined results: a NULL or empty text is never contaminated; a passage
of fewer than ``MIN_WORDS`` words matches where its words stand in a row (as a common
word does nearly everywhere), one without words nowhere; repeated rows are judged alike;
a NULL id is kept as such; extra columns take no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import unused

WINDOW = 32                 # words of a window; windows start every half window
RANK = 128                  # latent dimensions
OVERSAMPLE = 8
POWER = 2                   # power iterations
MIN_COSINE = 0.40
SURE = 0.8
PARAPHRASE = 0.6
ANSWER = 0.5
MIN_WORDS = 8
BLOCK_ITEMS = 2_000
GROUP_BLOCKS = 8            # blocks that one pass over the documents searches
DOCS_AT_ONCE = 200
PAIRS_AT_ONCE = 20_000      # of documents and passages

WORD = re.compile(r"\w+")
FOUND = "cosine double, lcs double, answer double"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """Documents with each word of the vocabulary, and all documents; over the whole corpus."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, n = Counter(), 0
        for batch in batches:
            for text in batch[text_col]:
                counts.update(known.value.intersection(words(text)))
                n += 1
        counts[""] = n
        yield pd.DataFrame({"w": list(counts), "n": list(counts.values())})

    # at most a row for each word of the block's vocabulary
    got = {r.w: r.n for r in docs.select(text_col).mapInPandas(run, "w string, n long")
           .groupBy("w").agg(F.sum("n").alias("n")).collect()}
    return got, got.pop("", 0)


def weighted(text: str, ids: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term ids and normalised TF-IDF weights."""
    at, tf = np.unique([ids[w] for w in words(text) if w in ids], return_counts=True)
    at = at.astype(int)
    x = tf * idf[at]
    return at, x / max(1e-12, np.linalg.norm(x))


def randomised_svd(items: DataFrame, ids: dict[str, int], idf: np.ndarray, rank: int, seed: int = 17) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages' TF-IDF matrix.

    The passages stay distributed; each step sums the tasks' partial products by
    term, and only terms x rank numbers reach the driver.
    """
    r = rank + OVERSAMPLE
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(idf), r)))[0]
    r = basis.shape[1]

    def product(basis: np.ndarray, gram: bool) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for text in batch["text"]:
                    at, x = weighted(text, ids, idf)
                    y = x @ basis[at]
                    for j, row in zip(range(r) if gram else at.tolist(), np.outer(y if gram else x, y)):
                        total[j] = total[j] + row if j in total else row
            yield pd.DataFrame({"j": np.array(list(total), np.int32), "v": pd.Series(list(total.values()), dtype=object)})

        sums = F.array(*[F.sum(F.col("v")[i]) for i in range(r)])
        rows = items.select("text").mapInPandas(run, "j int, v array<double>").groupBy("j").agg(sums.alias("v")).collect()
        out = np.zeros((r if gram else len(idf), r))
        for row in rows:
            out[row.j] = row.v
        return out

    for _ in range(1 + POWER):
        basis = np.linalg.qr(product(basis, False))[0]
    value, vector = np.linalg.eigh(product(basis, True))
    best = np.argsort(-value)[:rank]
    return basis @ vector[:, best]


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit for each element of ``a``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Space:
    """A block's passages in their latent space."""

    def __init__(self, items: list[tuple[int, str, str | None]], ids: dict[str, int], idf: np.ndarray, terms: np.ndarray):
        self.ids, self.item_id = ids, [i for i, _, _ in items]
        self.item = [[ids[w] for w in words(t)] for _, t, _ in items]
        self.answer = [Counter([ids.get(w, -1) for w in words(a)]) if a and words(a) else Counter(x[-(-2 * len(x) // 3):])
                       for x, (_, _, a) in zip(self.item, items)]
        self.count = [Counter(x) for x in self.item]
        self.size = np.array([len(x) for x in self.item])
        # distinct words of each passage and how often it has them, filled up with the term of no word
        self.own_word = np.full((len(items), max(map(len, self.count))), -1)
        self.own_times = np.zeros(self.own_word.shape, np.float32)
        for i, count in enumerate(self.count):
            self.own_word[i, :len(count)], self.own_times[i, :len(count)] = list(count), list(count.values())
        self.term = np.vstack([terms * idf[:, None], np.zeros((1, terms.shape[1]))]).astype(np.float32)
        vectors = np.stack([weighted(t, ids, idf)[1] @ terms[weighted(t, ids, idf)[0]] for _, t, _ in items])
        self.vector = (vectors / np.maximum(1e-12, np.linalg.norm(vectors, axis=1, keepdims=True))).astype(np.float32)

    def candidates(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, passage, cosine and first word of each window at the least cosine or above."""
        half = WINDOW // 2
        blocks = [max(1, -(-len(d) // half)) for d in docs]
        first = np.cumsum([0, *blocks])
        padded = np.full(int(first[-1] + 1) * half, -1)     # -1 is a term of weight nought
        for d, b in zip(docs, first.tolist()):
            padded[b * half:b * half + len(d)] = d
        padded = padded.reshape(-1, half)
        dense = self.term[padded[:, 0]]
        for j in range(1, half):
            dense += self.term[padded[:, j]]
        window = dense[:-1].copy()
        inner = np.ones(len(window), bool)
        inner[first[1:] - 1] = False                    # the last half window of a document stands alone
        window[inner] += dense[1:][inner]
        length = np.linalg.norm(window, axis=1, keepdims=True)
        cosine = (window / np.maximum(length, 1e-12)) @ self.vector.T
        w, item = np.nonzero(cosine >= MIN_COSINE)
        doc = np.searchsorted(first, w, "right") - 1
        return doc, item, cosine[w, item], (w - first[doc]) * half

    def possible(self, docs: list[np.ndarray], doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether each document holds enough of the passage's words at all, each as often as the passage does."""
        present = np.zeros((len(docs), len(self.term)), np.float32)
        for d, ids in enumerate(docs):
            present[d, ids] = 1                         # the last term is no word of a passage
        present[:, -1] = 0
        out = np.empty(len(doc), bool)
        for at in range(0, len(doc), PAIRS_AT_ONCE):
            d, i = doc[at:at + PAIRS_AT_ONCE], item[at:at + PAIRS_AT_ONCE]
            held = (present[d[:, None], self.own_word[i]] * self.own_times[i]).sum(1)
            out[at:at + PAIRS_AT_ONCE] = held >= PARAPHRASE * self.size[i]
        return out

    def found(self, docs: list[np.ndarray]) -> list[tuple[int, int, float, float, float]]:
        """(document, passage, cosine, lcs, answer) of the best accepted window of each document and passage."""
        doc, item, cosine, at = self.candidates(docs)
        pair, of = np.unique(doc * len(self.item) + item, return_inverse=True)
        keep = self.possible(docs, pair // len(self.item), pair % len(self.item))[of]
        best: dict[int, tuple[float, float, float]] = {}
        for p, c, a in zip(pair[of[keep]].tolist(), cosine[keep].tolist(), at[keep].tolist()):
            d, i = divmod(p, len(self.item))
            lcs, answer, bad = self.decide(docs[d], i, a)
            if bad and (lcs, answer, c) > best.get(p, (0.0, 0.0, 0.0)):
                bad, lcs, answer = self.decide_compact(docs[d], i, a)
                if bad:
                    best[p] = max(best.get(p, (0.0, 0.0, 0.0)), (lcs, answer, c))
        return [(*divmod(p, len(self.item)), c, lcs, answer) for p, (lcs, answer, c) in sorted(best.items()) if lcs]

    def overlap(self, i: int, present: set[int]) -> int:
        """Words of the passage that are among those present, each as often as it stands in the passage."""
        return sum([k for x, k in self.count[i].items() if x in present])

    def decide(self, doc: np.ndarray, i: int, at: int) -> tuple[float, float, bool]:
        """Shares of the passage and of its answer found anywhere near the window: at least those of any stretch."""
        n = len(self.item[i])
        return self.judge(i, doc[max(0, at - n):at + WINDOW + n])

    def decide_compact(self, doc: np.ndarray, i: int, at: int) -> tuple[bool, float, float]:
        """The best verdict and shares among the stretches of a window and a passage's length around the window."""
        n = len(self.item[i])
        first, size = max(0, at - n), WINDOW + n
        last = max(first, min(len(doc), at + WINDOW + n) - size)
        return max((bad, lcs, answer) for lcs, answer, bad in (self.judge(i, doc[s:s + size]) for s in range(first, last + 1)))

    def judge(self, i: int, stretch: np.ndarray) -> tuple[float, float, bool]:
        item, n = self.item[i], len(self.item[i])
        near = [x for x in stretch.tolist() if x >= 0]
        # a subsequence has no more of the passage's words than stand there at all
        if self.overlap(i, set(near)) < PARAPHRASE * n:
            return 0.0, 0.0, False
        lcs = common_length(item, near) / n
        have = Counter(near)
        need = self.answer[i]
        answer = sum(min(k, have[x]) for x, k in need.items()) / max(1, sum(need.values()))
        return lcs, answer, n >= MIN_WORDS and (lcs >= SURE or (lcs >= PARAPHRASE and answer >= ANSWER))


class Runs:
    """Passages of fewer than MIN_WORDS words, which count as found where their words stand in a row."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item_id: dict[tuple[str, ...], list[int]] = {}
        for i, text in items:
            self.item_id.setdefault(tuple(words(text)), []).append(i)
        self.sizes = sorted({len(run) for run in self.item_id})

    def found(self, text: list[str]) -> list[int]:
        hit: set[tuple[str, ...]] = set()
        for n in self.sizes:
            hit.update(run for run in zip(*[text[k:] for k in range(n)]) if run in self.item_id)
        return [i for run in hit for i in self.item_id[run]]


def block_space(items: DataFrame, frequency: dict[str, int], n: int) -> Space:
    """The latent space of one block of the benchmark."""
    rows = [(r.item_id, r.text, r.answer) for r in items.collect()]       # about BLOCK_ITEMS rows
    vocabulary = sorted({w for _, t, _ in rows for w in words(t)})
    ids = {w: i for i, w in enumerate(vocabulary)}
    idf = np.array([np.log((n + 1) / (frequency.get(w, 0) + 1)) + 0.01 for w in vocabulary])
    return Space(rows, ids, idf, randomised_svd(items, ids, idf, min(RANK, len(rows), len(ids))))


def search(docs: DataFrame, spaces: list[Space], runs: Runs, id_col: str, text_col: str, item_col: str) -> DataFrame:
    """(document id, item id, cosine, lcs, answer): one pass over the documents for several blocks."""
    known = docs.sparkSession.sparkContext.broadcast((spaces, runs))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, runs = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                split = [words(t.as_py()) for t in part.column(1)]
                out = []
                for space in spaces:
                    get = space.ids.get
                    texts = [np.fromiter(map(get, text, repeat(-1)), np.int64, len(text)) for text in split]
                    out += [(part.column(0)[d].as_py(), space.item_id[i], *scores) for d, i, *scores in space.found(texts)]
                if runs.sizes:
                    out += [(part.column(0)[d].as_py(), i, 1.0, 1.0, 1.0) for d, text in enumerate(split) for i in runs.found(text)]
                cols = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], part.schema.field(0).type), pa.array(cols[1], pa.int64()),
                     *[pa.array(c, pa.float64()) for c in cols[2:]]],
                    names=[id_col, item_col, "cosine", "lcs", "answer"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, `{item_col}` long, {FOUND}")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None) -> DataFrame:
    """(document id, item id, cosine, lcs, answer) of every contaminated document and passage.

    The words of all blocks are counted in one pass over the documents, and GROUP_BLOCKS blocks are
    searched in one pass, which bounds what a task holds.
    """
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"),
        (F.col(answer_col) if answer_col else F.lit(None)).cast("string").alias("answer"))
    size = F.regexp_count("text", F.lit(r"[\p{L}\p{N}_]+"))
    short = Runs([(r.item_id, r.text) for r in items.where((size > 0) & (size < MIN_WORDS)).select("item_id", "text").collect()])
    items = items.where(size >= MIN_WORDS)
    blocks = -(-items.count() // BLOCK_ITEMS)
    # hashed blocks vary in size; a few more of them keep each near the bound
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    if blocks:
        text_words = items.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("w"))
        vocabulary = frozenset(r.w for r in text_words.distinct().collect())      # of the benchmark
        frequency, n = document_frequencies(docs, text_col, vocabulary)
    out = []
    for first in range(0, max(1, blocks), GROUP_BLOCKS):
        spaces = [block_space(items.where(mine == b), frequency, n) for b in range(first, min(blocks, first + GROUP_BLOCKS))
                  if not items.where(mine == b).isEmpty()]
        out.append(search(docs, spaces, short if first == 0 else Runs([]), id_col, text_col, item_col))
    return reduce(DataFrame.unionByName, out)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones; each row is judged by its own text."""
    key, = unused(docs, "_t")
    keyed = docs.withColumn(key, F.xxhash64(F.lit(7), F.coalesce(text_col, F.lit(""))))
    bad = matches(keyed, benchmark, key, text_col).select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
