"""Toxicity by maximum-scoring segments over token log-odds.

Fitting: tokens of all documents, of toxic and of clean labelled documents are
counted as word beginnings of four to six characters (short words whole). With
the corpus counts as Dirichlet prior, each beginning gets the log-odds of toxic
against clean and its z-score; the significant positive ones form the lexicon,
and every other token carries the (negative) log-odds of not being in it.

Scoring: one linear scan finds all maximal segments of a text's token scores.
By extreme-value theory the number of chance segments of score S or more in n
clean tokens is E = K n exp(-lambda S); K and lambda are fitted to the segments
of clean labelled documents. A text's score is 1 / (1 + E / level) of its best
segment, where the level parts the labelled documents with fewest errors.

Defined results: a NULL or empty text, or one without a positive segment, has
score 0 and no segments; repeated rows score alike; documents without a label
are only scored; a document id with several labels counts as toxic if one of
them is 1; without any toxic or any clean label all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from headway.llm.common import in_text_batches, stored, text_key

FIT_ROWS = 500_000          # bound on the labelled rows a model is fitted on (smallest hashes of the id)
PRIOR_WEIGHT = 0.1          # tokens of the corpus prior for each token of the toxic texts
MIN_Z = 2.0
MIN_ODDS = 2.0              # least log-odds of the lexicon
MIN_DOCS = 3                # distinct toxic texts a beginning must occur in
MIN_CLEAN = 30              # chance segments needed to fit lambda; else it is 1
BEGINNINGS = (4, 5, 6)
LEVEL_STEPS = 4             # steps of log E, for each unit, among which the level is chosen
FLUSH_BYTES = 96 << 20      # of distinct words a task holds before it passes its counts on
WORD_BYTES = 250            # of a word of at most 100 characters in a counter
OUT_ROWS = 50_000           # counts passed on at a time
FOLDS = 5

WORD = re.compile(r"\w+")

SEGMENTS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("score", T.DoubleType())]))


def beginnings(word: str) -> list[str]:
    """Features of a word, the longest last; a whole short word is marked by its end."""
    out = [word[:k] for k in BEGINNINGS if len(word) > k]
    return out + [word + "$"] if len(word) <= BEGINNINGS[-1] else out


@dataclass(frozen=True)
class Model:
    """Log-odds of the lexicon's beginnings, of any other token, and the chance law."""

    lexicon: dict[str, float]
    other: float
    k: float = 1.0
    lam: float = 1.0
    level: float = 0.01     # chance segments at which a text is as likely toxic as not

    @property
    def heads(self) -> frozenset[str]:
        return frozenset(f.removesuffix("$")[:BEGINNINGS[0]] for f in self.lexicon)

    def word_score(self, word: str) -> float:
        for f in reversed(beginnings(word)):
            if f in self.lexicon:
                return self.lexicon[f]
        return self.other

    def probability(self, score: float, tokens: int) -> float:
        if score <= 0:
            return 0.0
        return 1 / (1 + math.exp(min(700.0, max(-700.0, self.log_chance(score, tokens) - math.log(self.level)))))

    def log_chance(self, score: float, tokens: int) -> float:
        """Log of the expected number of chance segments of that score or more."""
        return math.log(self.k * max(1, tokens)) - self.lam * score


def maximal_segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), left to right.

    ``hits`` are the tokens with a score of their own; the tokens between them
    have the score ``other`` (not positive), so a run of them moves the running total once.
    """
    total, at = 0.0, 0
    found: list[tuple[int, int, float, float]] = []       # first, last, total before, total after
    for i, s in hits:
        total += other * (i - at)
        at = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        first, left = i, before
        j = len(found)
        while True:
            while j and found[j - 1][2] >= left:           # left neighbour that starts lower
                j -= 1
            if not j or found[j - 1][3] >= total:
                break
            first, left = found[j - 1][0], found[j - 1][2]  # extend to it
            j -= 1
            del found[j:]
        found.append((first, i, left, total))
    return [(a, b, r - lft) for a, b, lft, r in found]


def text_segments(words: list[str], model: Model, heads: frozenset[str]) -> list[tuple[int, int, float]]:
    k = BEGINNINGS[0]
    near = [i for i, w in enumerate(words) if w[:k] in heads]
    hits = [(i, s) for i in near if (s := model.word_score(words[i])) != model.other]
    return maximal_segments(hits, model.other) if hits else []


def held_out(fold: int = 0) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == fold


def labelled(docs: DataFrame, labels: DataFrame, fold: int = 0) -> DataFrame:
    """(doc_id, toxic) to learn from: outside the held-out fold, at most FIT_ROWS, one for each text."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(fold))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))
    return (with_labels(docs, known, "inner").groupBy(text_key().alias("t"))
            .agg(F.min(F.struct("doc_id", "toxic")).alias("first")).select("first.*"))


def with_labels(docs: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """The known labels are at most FIT_ROWS rows of 12 bytes, hence the broadcast."""
    return in_text_batches(docs).select("doc_id", "text").join(F.broadcast(known), "doc_id", how)


def count_beginnings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of the beginnings in a task's texts."""
    corpus, toxic, clean, in_docs = Counter(), Counter(), Counter(), Counter()

    def flush() -> Iterator[pd.DataFrame]:
        counts = []
        for words in (corpus, toxic, clean):
            own: Counter = Counter()
            for w, n in words.items():
                for f in beginnings(w):
                    own[f] += n
            counts.append(own)
            words.clear()
        rows = ((f, n, counts[1][f], counts[2][f], in_docs[f]) for f, n in counts[0].items())
        while part := list(islice(rows, OUT_ROWS)):
            yield pd.DataFrame(part, columns=["f", "corpus", "toxic", "clean", "docs"])
        in_docs.clear()

    held = 0
    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"]):
            if not text:
                continue
            found = WORD.findall(text.lower())
            held -= WORD_BYTES * len(corpus)
            corpus.update(found)
            held += WORD_BYTES * len(corpus) + sum(n for n in map(len, found) if n > 100)
            if label == 1:
                toxic.update(found)
                in_docs.update({f for w in set(found) for f in beginnings(w)})
            elif label == 0:
                clean.update(found)
            if held > FLUSH_BYTES:
                yield from flush()
                held = 0
    yield from flush()


def fit_lexicon(docs: DataFrame, known: DataFrame) -> Model:
    """Significant beginnings by log-odds with the corpus counts as Dirichlet prior."""
    sides = ("corpus", "toxic", "clean")
    counts = stored(with_labels(docs, known, "left")
                    .mapInPandas(count_beginnings, "f string, corpus long, toxic long, clean long, docs long")
                    .groupBy("f").agg(*[F.sum(c).alias(c) for c in (*sides, "docs")]), "toxicity-counts")
    whole = F.col("f").endswith("$")
    one_each = F.when(whole, F.length("f") <= BEGINNINGS[0] + 1).otherwise(F.length("f") == BEGINNINGS[0])
    n = counts.where(one_each).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sides]).first()
    if not n["toxic"] or not n["clean"]:
        return Model({}, 0.0)
    weight = PRIOR_WEIGHT * n["toxic"]
    prior = F.col("corpus") / F.lit(float(n["corpus"])) * F.lit(weight)

    def odds(side: str) -> Column:
        own = F.col(side) + prior
        return F.log(own / (F.lit(n[side] + weight) - own))

    scored = counts.where((F.col("toxic") > 0) & (F.col("docs") >= MIN_DOCS)).select(
        "f", "toxic", "clean", (odds("toxic") - odds("clean")).alias("delta"),
        F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)).alias("sd"))
    # bounded by the labelled sample: beginnings of at least MIN_DOCS of its toxic texts
    found = scored.where((F.col("delta") >= MIN_ODDS) & (F.col("delta") >= MIN_Z * F.col("sd"))).collect()
    if not found:
        return Model({}, 0.0)
    # tokens of the lexicon, each once: a beginning that another one begins adds nothing
    names = {r.f for r in found}
    top = [r for r in found if not any(r.f[:k] in names for k in BEGINNINGS if k < len(r.f.removesuffix("$")))]
    rest = [(1 - min(0.999, sum(r[s] for r in top) / n[s])) for s in ("toxic", "clean")]
    return Model({r.f: r.delta for r in found}, min(-1e-6, math.log(rest[0] / rest[1])))


def best_segments(model: Model):
    floor = min(model.lexicon.values())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heads = model.heads
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = WORD.findall((text or "").lower())
                scores = [s for _, _, s in text_segments(words, model, heads)]
                rows.append((toxic, len(words), max(scores, default=0.0), len(scores),
                             sum(max(0.0, s - floor) for s in scores)))
            yield pd.DataFrame(rows, columns=["toxic", "tokens", "best", "many", "over"])

    return run


def fit_chance(docs: DataFrame, known: DataFrame, model: Model) -> Model:
    """K and lambda from the segments of clean labelled texts (an exponential tail above the
    least score), and the level that parts toxic from clean labelled texts with fewest errors."""
    if not model.lexicon:
        return model
    found = stored(with_labels(docs, known, "inner").mapInPandas(
        best_segments(model), "toxic int, tokens long, best double, many long, over double"), "toxicity-segments")
    got = (found.where("toxic = 0")
           .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "many", "over")]).first())
    lam = got.many / got.over if got.many >= MIN_CLEAN and got.over > 0 else 1.0
    k = (got.many + 0.5) / max(1, got.tokens) * math.exp(lam * min(model.lexicon.values()))
    step = F.floor((F.log(F.lit(k) * F.greatest("tokens", F.lit(1))) - F.lit(lam) * F.col("best")) * LEVEL_STEPS)
    steps = sorted((r.step, r.toxic, r.clean) for r in found.where("best > 0").groupBy(step.alias("step")).agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect())
    # errors if the texts up to each step count as toxic
    right, cuts = 0, []
    for i, (at, toxic, clean) in enumerate(steps):
        right += toxic - clean
        after = steps[i + 1][0] if i + 1 < len(steps) else at + 2 * LEVEL_STEPS
        cuts.append((right, (at + 1 + after) / 2 / LEVEL_STEPS))
    best = max(cuts, default=(0, 0.0))
    return Model(model.lexicon, model.other, k, lam, math.exp(best[1]) if best[0] > 0 else model.level)


def fit(docs: DataFrame, labels: DataFrame, fold: int = 0) -> Model:
    known = stored(labelled(docs, labels, fold), "toxicity-labels")
    return fit_chance(docs, known, fit_lexicon(docs, known))


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score",
          segments_col: str = "segments") -> DataFrame:
    """``df`` with its toxicity (0 to 1) and its toxic passages (code points, end exclusive, score).

    Input columns named like an output column are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in (score_col, segments_col)]
    schema = T.StructType([*kept, T.StructField(score_col, T.DoubleType()), T.StructField(segments_col, SEGMENTS)])
    names = [f.name for f in kept]
    known = df.sparkSession.sparkContext.broadcast(model)

    def one(text: str | None, model: Model, heads: frozenset[str]):
        words = WORD.findall((text or "").lower())
        segments = text_segments(words, model, heads)
        if not segments:
            return 0.0, []
        best = max(s for _, _, s in segments)
        at = [m.span() for m in WORD.finditer(text)]
        if len(at) != len(words):               # lower-casing changed the words' number
            at = [m.span() for m in WORD.finditer(text.lower())]
        passages = [{"start": at[a][0], "end": at[b][1], "score": s} for a, b, s in segments
                    if model.probability(s, len(words)) >= 0.5]
        return model.probability(best, len(words)), passages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        heads = model.heads
        for batch in batches:
            got = [one(t.as_py(), model, heads) for t in batch.column(batch.schema.get_field_index(text_col))]
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            arrays += [pa.array([g[0] for g in got], pa.float64()),
                       pa.array([g[1] for g in got], to_arrow_type(SEGMENTS))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, score_col, segments_col])

    return in_text_batches(df).mapInArrow(run, schema)
