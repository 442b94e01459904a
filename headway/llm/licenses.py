"""License scans: an exact set-similarity join of text blocks with license templates.

Base labels stand for phrases whose words follow each other in the text. The
join adds labels of its own: templates are sentences of license texts, a text is
cut into overlapping blocks (see below), and a template is found in a block that
holds at least THRESHOLD of the template's distinct words, and all of its marks.

The words of the templates are put in one global order, rarest first, by the
number of documents that hold them. Of a template with m distinct words, o of
which must be met, the first m - o + 1 form its prefix: a block that holds enough
of them holds one of the prefix, and so does the block's own prefix of n - o + 1 words
hold a word of the template. Blocks without a prefix word, or with fewer than o
template words (length filter), never leave their task; the others are joined
with the templates on the words of both prefixes, a pair whose remaining words
cannot reach o is dropped (positional filter), and the rest is verified by
intersection. Only a pair's first common word decides it, so each pair is verified
once. The filters lose nothing: the result is that of comparing all blocks with all templates.

Blocks: templates of up to c words, c being 8, 16, 32 or 64 (the next power of two),
meet blocks of 2c words at every multiple of c, so that each run of c words stands
whole in a block. Equal blocks of a text are joined once.

Defined results: a NULL text is the empty text; texts without words have no blocks;
a text of any length is read whole; repeated rows and NULL ids each give a row; an
empty table gives no rows; other columns are not read. ``first_word`` and
``last_word`` are NULL without a base phrase. ``score`` is 1 with a base phrase,
else the largest share of a template's words found in a block that meets it, else 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored

THRESHOLD = (4, 5)          # share of a template's distinct words
LEAST_BLOCK = 8
BROADCAST_BYTES = 8 << 20   # the templates' index is broadcast up to this size, beyond it Spark decides
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


@dataclass(frozen=True)
class Template:
    """A sentence of a license; ``marks`` are words that a block must hold in any case."""

    label: str
    text: str
    marks: str = ""

    @property
    def words(self) -> list[str]:
        return sorted({w.decode() for w in words_of(self.text.encode())})

    @property
    def least(self) -> int:
        return -(-len(self.words) * THRESHOLD[0] // THRESHOLD[1])

    @property
    def block(self) -> int:
        """Words up to which a run stands whole in a block; blocks are twice as long."""
        n = len(words_of(self.text.encode()))
        return max(LEAST_BLOCK, 1 << (n - 1).bit_length())


#: Phrases and labels of the contract.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Sentences of published license texts and notices.
TEMPLATES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files (the Software), to deal in the Software without restriction"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or "
                    "substantial portions of the Software"),
    Template("mit", "Released under the MIT License", "mit"),
    Template("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                       "with the License", "apache"),
    Template("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                       "is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation", "general"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                     "Lesser General Public License as published by the Free Software Foundation", "lesser"),
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                     "Affero General Public License as published by the Free Software Foundation", "affero"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                    "promote products derived from this software without specific prior written permission"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                    "is hereby granted, provided that the above copyright notice and this permission notice appear"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla"),
    Template("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                    "License", "eclipse"),
    Template("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the "
                     "authors be held liable for any damages arising from the use of this software"),
    Template("boost", "Distributed under the Boost Software License, Version 1.0", "boost"),
    Template("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             "creative commons attribution"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc nc"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc sa"),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc nd"),
]


def words_of(raw: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased: runs of ASCII letters, digits and all that is not ASCII."""
    return raw.translate(TABLE).split()


def place_counts(words: list[bytes], phrases: list[bytes]) -> tuple[list[int], int | None, int | None]:
    """Places of each phrase, the smallest and the largest word they start at."""
    text = b" " + b" ".join(words) + b" "
    counts, ends = [], []
    for p in phrases:
        sought, n, word, at = b" " + p + b" ", 0, 0, 0
        found = text.find(sought)
        while found >= 0:
            word += text.count(b" ", at, found)
            at, n = found, n + 1
            ends += [word] if n == 1 else []
            last = word
            found = text.find(sought, found + 1)
        counts.append(n)
        ends += [last] if n else []
    return counts, min(ends, default=None), max(ends, default=None)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def word_frequency(docs: DataFrame, text_col: str, templates: list[Template]) -> dict[str, int]:
    """Number of documents that hold each word of the templates."""
    sought = {w.encode() for t in templates for w in t.words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = dict.fromkeys(sought, 0)
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                for w in sought.intersection(words_of(raw)):
                    n[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in n]), pa.array(n.values(), pa.int64())],
                                         names=["word", "n"])

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return {r["word"]: r["total"] for r in counts.groupBy("word").agg(F.sum("n").alias("total")).collect()}


class Sought:
    """What a task needs to cut a text into blocks and keep those that may hold a template."""

    def __init__(self, templates: list[Template], rank: dict[str, int]):
        self.rank = {w.encode(): r for w, r in rank.items()}
        self.least: dict[int, int] = {}             # fewest words to be met, by block size
        self.prefix: dict[int, set[int]] = {}       # words in the prefix of some template
        for t in templates:
            order = sorted(rank[w] for w in t.words)
            self.least[t.block] = min(self.least.get(t.block, t.least), t.least)
            self.prefix.setdefault(t.block, set()).update(order[:len(order) - t.least + 1])

    def blocks(self, words: list[bytes]) -> list[dict]:
        """Distinct blocks with their template words in global order."""
        get = self.rank.get
        known = [(i, r) for i, w in enumerate(words) if (r := get(w)) is not None]
        out = []
        for size, prefix in self.prefix.items():
            near = {b for i, r in known if r in prefix for b in (i // size, i // size - 1) if b >= 0}
            held: dict[int, set[int]] = {b: set() for b in near}
            for i, r in known if near else ():
                b = i // size
                if b in held:
                    held[b].add(r)
                if b - 1 in held:
                    held[b - 1].add(r)
            seen = {tuple(sorted(h)) for h in held.values() if len(h) >= self.least[size]}
            out += [{"size": size, "words": list(h)} for h in sorted(seen)]
        return out


def cut(docs: DataFrame, id_col: str, text_col: str, phrases: list[tuple[str, str]], sought: Sought) -> DataFrame:
    """One row for each document: base phrases, and the blocks that may hold a template."""
    spoken = [p.encode() for p, _ in phrases]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, n_words long, counts array<long>, first_word long, last_word long, "
              "blocks array<struct<size:int,words:array<int>>>")
    blocks = pa.list_(pa.struct([("size", pa.int32()), ("words", pa.list_(pa.int32()))]))
    known = docs.sparkSession.sparkContext.broadcast(sought)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for raw in text_bytes(batch.column(1)):
                words = words_of(raw)
                got.append((len(words), *place_counts(words, spoken), known.value.blocks(words)))
            columns = list(zip(*got)) or [()] * 5
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), blocks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["id", "n_words", "counts", "first_word", "last_word", "blocks"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def template_index(spark, templates: list[Template], rank: dict[str, int]) -> DataFrame:
    """A row for each prefix word of each template."""
    rows = []
    for t in templates:
        order = sorted(rank[w] for w in t.words)
        marks = [rank[w] for w in t.marks.split()]
        rows += [(t.block, r, i, t.label, order, t.least, marks) for i, r in enumerate(order[:len(order) - t.least + 1])]
    index = spark.createDataFrame(rows, "size int, word int, i int, label string, sought array<int>, least int, "
                                        "marks array<int>")
    small = sum(64 + 4 * len(r[4]) + len(r[3]) for r in rows) <= BROADCAST_BYTES
    return F.broadcast(index) if small else index


def found_labels(cut_docs: DataFrame, index: DataFrame, least: dict[int, int]) -> DataFrame:
    """(row, own, share): labels of the templates that a row's blocks meet, and the largest share."""
    fewest = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("size"))
    pairs = (cut_docs.select("row", F.explode("blocks").alias("b")).select("row", "b.size", "b.words")
             .select("*", F.posexplode(F.slice("words", 1, F.size("words") - fewest + 1)).alias("j", "word"))
             .join(index, ["size", "word"])
             .where(1 + F.least(F.size("sought") - 1 - F.col("i"), F.size("words") - 1 - F.col("j")) >= F.col("least"))
             .withColumn("common", F.array_intersect("words", "sought"))
             .where((F.size("common") >= F.col("least")) & (F.col("common")[0] == F.col("word"))
                    & (F.size(F.array_except("marks", "common")) == 0)))
    return pairs.groupBy("row").agg(F.collect_set("label").alias("own"),
                                    F.max(F.size("common") / F.size("sought")).alias("share"))


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases: list[tuple[str, str]] | None = None, templates: list[Template] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row."""
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    n = word_frequency(docs, text_col, templates)
    words = {w for t in templates for w in t.words}
    rank = {w: i for i, w in enumerate(sorted(words, key=lambda w: (n.get(w, 0), w)))}
    sought = Sought(templates, rank)
    rows = stored(cut(docs, id_col, text_col, phrases, sought)
                  .withColumn("row", F.monotonically_increasing_id()), "license-blocks")
    base = F.array_compact(F.array(*[F.when(F.get("counts", F.lit(i)) > 0, F.lit(label))
                                     for i, (_, label) in enumerate(phrases)]).cast("array<string>"))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    found = found_labels(rows, template_index(spark, templates, rank), sought.least) if templates else None
    if found is None:
        rows = rows.withColumns({"own": F.array().cast("array<string>"), "share": F.lit(None).cast("double")})
    else:
        rows = rows.join(found, "row", "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").alias(id_col), "n_words", total.alias("n_base"), "first_word", "last_word",
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.when(total > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
