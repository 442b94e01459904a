"""Line deduplication by a deletion-neighbourhood join, in DataFrame operations only.

A line is its words between runs of white space. The edit bound is one word
inserted, deleted or replaced, for lines of at least ``MIN_WORDS`` words (shorter
ones match only exactly). The variants of a line are itself and itself less one
word. Two lines are within the bound if a variant of one equals the
other, or if both less the word at the same place are equal. Variants are joined
by hashed keys, pairs are verified word by word, and a line stays only if no
earlier line (by document id, then place, then text key) equals it or is within the
bound of it.

A variant's key is the exclusive or of its words' hashes with their places, so all
variants of a line come from running sums over its words. Variants are emitted
only for lines that can have a neighbour: of two lines within one edit, the first
half or the rest of the words is equal, so a line that shares neither half with
any other is left out without loss. Such lines are fetched through a bitmap of
their hashes of at most ``MAX_BITS`` bits; it only spares moving other lines.

No group is gathered and no pairs of a group are listed: each key keeps its
earliest line, and the others are compared with that one. The texts are cut into
lines twice: for the table of all lines' keys, and for the words of the candidates.

Defined results: blank lines are never removed; a NULL or empty text stays as it
is; a document all of whose non-blank lines are removed gets an empty text and
``n_kept`` 0; a NULL id is the earliest id; of different texts with one id (or none),
one keeps a line that they hold at the same place; rows with equal id and text keep the
same lines; other columns pass through, and input columns named like an output column
are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import stored, text_key, text_of, unused

MIN_WORDS = 8
WHITE = " \t\r\f\x0b"       # white space within a line
MAX_BITS = 2 ** 26          # bound on the broadcast bitmap: a million words of 16 bytes
BITS_A_LINE = 16
WORD_BITS = 64
ROW = ("id0", "t")          # a document's id (never NULL) and text key
LINE = ("h1", "h2")         # 128-bit key of a line
HALVES = ("a1", "a2", "b1", "b2")


def row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col), F.lit(-2 ** 63)).alias("id0"), text_key(text_col).alias("t")]


def squeezed(line: Column) -> Column:
    """The line with each run of white space as one space."""
    runs = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in ("  ", *WHITE[1:])])
    return F.when(runs, F.regexp_replace(line, r"\s+", " ")).otherwise(line)


def place_of() -> Column:
    """Order of a line among all: 64 bits of id, 31 of its position, the upper 32 of the text key (below 10 ** 38)."""
    def shifted(c: Column, bits: int) -> Column:
        return (c * F.lit(2 ** bits).cast("decimal(10,0)")).cast("decimal(38,0)")

    upper = F.shiftrightunsigned("t", 32).cast("decimal(10,0)")
    return (shifted(shifted(F.col("id0").cast("decimal(20,0)"), 31) + F.col("pos"), 32) + upper).cast("decimal(38,0)")


def lower_key() -> Column:
    """The rest of the text key, which parts lines of one place."""
    return F.col("t").bitwiseAND(F.lit(2 ** 32 - 1))


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each non-blank line: row, position, text and key."""
    return (docs.select(*row_key(id_col, text_col), F.posexplode(F.split(text_of(text_col), "\n")).alias("pos", "line"))
            .where(F.call_function("btrim", F.col("line"), F.lit(WHITE)) != "")   # cheaper than the line's words
            .withColumn("line", F.trim(squeezed(F.col("line"))))
            .select(*ROW, "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")))


def half_keys(words: Column) -> list[Column]:
    """Keys of the halves that a neighbour shares, for pairs whose shorter line has n, then n - 1 words."""
    n, out = F.size(words), []
    for shorter in (n, n - 1):
        first = F.floor(shorter / 2).cast("int")
        able = shorter >= MIN_WORDS
        out += [F.when(able, F.xxhash64(shorter, F.lit(0), F.slice(words, F.lit(1), first))),
                F.when(able, F.xxhash64(shorter, F.lit(1), F.slice(words, n - shorter + first + 1, shorter - first)))]
    return [c.alias(name) for c, name in zip(out, HALVES)]


def repeated_lines(keys: DataFrame) -> DataFrame:
    """(h1, h2, first, rest): the lines that stand at several places, with the place and lower text key of the earliest."""
    return (keys.select(*LINE, place_of().alias("place"), lower_key().alias("rest")).groupBy(*LINE)
            .agg(F.min("place").alias("first"), F.min_by("rest", "place").alias("rest"), F.count("*").alias("n"))
            .where("n > 1").drop("n"))


def near_candidates(keys: DataFrame) -> DataFrame:
    """(h1): hashes of the lines that share a half with another line."""
    half = keys.select("h1", F.explode(F.array_compact(F.array(*HALVES))).alias("half"))
    shared = stored(half.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("half"),
                    "lines-shared")
    return in_bitmap(half, shared, "half").distinct().join(shared, "half").select("h1").distinct()


def in_bitmap(rows: DataFrame, hashes: DataFrame, key: str = "h1") -> DataFrame:
    """Rows whose ``key`` may be among ``hashes``: a bitmap of bounded size drops most of the others."""
    bits = min(MAX_BITS, max(WORD_BITS, 1 << (BITS_A_LINE * hashes.count()).bit_length()))
    at = F.pmod(F.col(key), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % WORD_BITS).cast("int"))
    words = hashes.groupBy(F.floor(at / WORD_BITS).alias("place_of_word")).agg(F.bit_or(bit).alias("word"))
    return (rows.withColumn("place_of_word", F.floor(at / WORD_BITS)).join(F.broadcast(words), "place_of_word")
            .where(F.col("word").bitwiseAND(bit) != 0).drop("place_of_word", "word"))


def words_of(line: Column) -> Column:
    return F.split(line, " ")


def whole_key(words: Column) -> Column:
    return F.aggregate(F.transform(words, lambda w, i: F.xxhash64(w, i)), F.lit(0).cast("long"),
                       lambda acc, h: acc.bitwiseXOR(h))


def variants(candidates: DataFrame) -> DataFrame:
    """(h1, size, v, cut): key of each line less the word at place ``cut``."""
    words = (candidates.repartition(*LINE).withColumn("w", words_of(F.col("line")))
             .select(*LINE, F.size("w").alias("n"), F.posexplode("w").alias("i", "w"))
             .select(*LINE, "n", "i", F.xxhash64("w", "i").alias("same"), F.xxhash64("w", F.col("i") - 1).alias("moved")))
    line = Window.partitionBy(*LINE)
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same, moved = F.bit_xor("same").over(upto), F.bit_xor("moved").over(upto)
    key = same.bitwiseXOR(F.col("same")).bitwiseXOR(moved).bitwiseXOR(F.bit_xor("moved").over(line))
    return words.select("h1", (F.col("n") - 1).alias("size"), key.alias("v"), F.col("i").alias("cut"))


def less(line: Column, cut: Column) -> Column:
    """Words of the line without the one at ``cut`` (-1: all)."""
    w = words_of(line)
    return F.when(cut < 0, w).otherwise(F.concat(F.slice(w, F.lit(1), F.greatest(cut, F.lit(0))), F.slice(w, cut + 2, F.size(w))))


def earlier(first: str, line: str, than_first: str, than_line: str) -> Column:
    return (F.col(first) < F.col(than_first)) | ((F.col(first) == F.col(than_first)) & (F.col(line) < F.col(than_line)))


def near_lines(candidates: DataFrame, cut: DataFrame) -> DataFrame:
    """(h1, h2) of the candidates that are within one edit of an earlier line."""
    key = ["size", "v", "cut"]
    shared = cut.join(cut.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), key)
    member = shared.join(candidates, "h1").select(*key, *LINE, "first", "line")
    earliest = member.groupBy(*key).agg(F.min(F.struct("first", "line")).alias("m"))
    replaced = (member.join(earliest, key)
                .select(*LINE, "line", "cut", "first", F.col("m.first").alias("of"), F.col("m.line").alias("other"),
                        F.col("cut").alias("other_cut")))
    w = words_of(F.col("line"))
    whole = candidates.select(F.size(w).alias("size"), whole_key(w).alias("v"), F.struct(*LINE, "first", "line").alias("whole"))
    meets = cut.join(whole, ["size", "v"]).join(candidates, "h1").select(
        "cut", "whole", F.struct(*LINE, "first", "line").alias("long"))
    # the later of the two is the redundant one; the line itself decides between lines of one place
    longer = meets.where(earlier("whole.first", "whole.line", "long.first", "long.line")).select(
        "long.h1", "long.h2", "long.line", "cut", "long.first", F.col("whole.first").alias("of"),
        F.col("whole.line").alias("other"), F.lit(-1).alias("other_cut"))
    shorter = meets.where(earlier("long.first", "long.line", "whole.first", "whole.line")).select(
        "whole.h1", "whole.h2", "whole.line", F.lit(-1).alias("cut"), "whole.first", F.col("long.first").alias("of"),
        F.col("long.line").alias("other"), F.col("cut").alias("other_cut"))
    pairs = replaced.unionByName(longer).unionByName(shorter)
    equal = less(F.col("line"), F.col("cut")) == less(F.col("other"), F.col("other_cut"))
    return pairs.where(earlier("of", "other", "first", "line") & equal).select(*LINE).distinct()


def removed_places(lines: DataFrame) -> DataFrame:
    """(id0, t, pos) of all lines that an earlier line makes redundant."""
    keys = stored(lines.select(*ROW, "pos", *LINE, words_of(F.col("line")).alias("words"))
                  .select(*ROW, "pos", *LINE, *half_keys(F.col("words"))), "lines-keys")
    picked = stored(near_candidates(keys), "lines-picked")
    # copies of a line meet before the join; an inner one, as a semi join would be moved below the bitmap
    candidates = stored(in_bitmap(lines.select(*LINE, place_of().alias("place"), "line"), picked)
                        .groupBy(*LINE, "line").agg(F.min("place").alias("first")).join(picked, "h1")
                        .where(F.size(words_of(F.col("line"))) >= MIN_WORDS)
                        .select(*LINE, "line", "first"), "lines-candidates")
    near = near_lines(candidates, stored(variants(candidates), "lines-variants"))
    # lines that stand somewhere else, earlier or nearly alike; the others stay unseen
    found = repeated_lines(keys).withColumn("near", F.lit(False)).unionByName(
        near.withColumn("near", F.lit(True)), allowMissingColumns=True)
    decided = stored(found.groupBy(*LINE).agg(*[F.max(c).alias(c) for c in ("first", "rest", "near")]), "lines-decided")
    later = (F.col("first") != place_of()) | (F.col("rest") != lower_key())
    return (in_bitmap(keys.select(*ROW, "pos", *LINE), decided.select("h1")).join(decided, [*LINE])
            .where(F.col("near") | later).select(*ROW, "pos"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without redundant lines, with n_lines (non-blank ones before) and n_kept (after)."""
    old = [c for c in docs.columns if c not in ("n_lines", "n_kept")]
    docs = docs.select(*old)
    id_name, key, gone = unused(docs, "_id0", "_t", "_gone")
    removed = (removed_places(lines_of(docs, id_col, text_col)).groupBy(*ROW)
               .agg(F.collect_set("pos").alias(gone))       # at most a document's lines
               .withColumnsRenamed({"id0": id_name, "t": key}))
    id0, t = row_key(id_col, text_col)
    both = docs.select(*old, id0.alias(id_name), t.alias(key)).join(removed, [id_name, key], "left")
    full = F.size(F.filter(F.split(text_of(text_col), "\n"), lambda x: x.rlike(r"\S"))).cast("long")
    both = (both.withColumn("n_lines", full)
            .withColumn("n_kept", F.col("n_lines") - F.coalesce(F.size(gone), F.lit(0))))
    left = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
    out = [F.when(F.col(gone).isNull(), F.col(c)).when(F.col("n_kept") == 0, F.lit("")).otherwise(left).alias(c)
           if c == text_col else F.col(c) for c in old]
    return both.select(*out, "n_lines", "n_kept")
