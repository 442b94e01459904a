"""N-gram Jaccard join by chosen paths.

Each document is its set of five-word shingles; equal sets are one node. In
each run a node follows the shingles whose hash under the run is below
1 / (b * size): two sets of similarity b or more share one on average, so after
``RUNS`` runs a pair is missed with probability exp(-RUNS). Nodes with a path in
common are a bucket. A bucket over ``LIMIT`` nodes is split once more on sampled
shared shingles (``CHILDREN`` expected in common), where a pair is missed with up to
exp(-RUNS * (1 - exp(-CHILDREN))); what is still large is compared in pairs of
chunks, so no task holds more than two of them.

A bucket compares its nodes by brute force: sizes, then sketches (one-permutation
minima, whose bound lies six standard deviations below the threshold), then the
exact sets. A pair that shares several buckets is counted in the first only. Each
bucket returns a row for each node: its number of links found there and the
smallest node that it is connected to; components follow from those.

Words are the runs of letters, digits and underscores of the lower-cased text;
a text of one to four words is a single shingle.

Defined results: a NULL or empty text, or one without words, is a class of its
own without links; repeated rows are copies of each other; a NULL id is the
smallest id; extra columns take no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored, text_key, text_of, unused

WORDS = 5
SIMILARITY = 0.8
RUNS = 10                   # a pair at the threshold is missed with probability exp(-10) in buckets that are not split
CHILDREN = 2.0              # expected common paths of the second level
LIMIT = 256                 # nodes of a bucket that is not split further
CHUNK = 512                 # nodes of a large bucket compared at a time
BINS = 128                  # minima of a sketch
PAIRS_AT_ONCE = 100_000     # sketch comparisons held in memory
COLUMNS_AT_ONCE = 16_384    # shingles of an incidence matrix held in memory

WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)            # odd, hence invertible modulo 2**64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
SIGNED = "id0 long, t long, node binary, size int, sketch binary, paths array<struct<p:long,c:array<long>>>"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=64)
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, b, np.uint64))]) for b in (BASE, BASE_INVERSE))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    found = WORD.findall((text or "").lower())
    if not found:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(" ".join(found).encode("utf-8", "surrogatepass"), np.uint8)
    up, down = powers(max(10, int(len(raw)).bit_length()))
    total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])])
    space = np.nonzero(raw == 32)[0]
    start, end = np.concatenate([[0], space + 1]), np.concatenate([space, [len(raw)]])
    n = min(words, len(start))
    start, end = start[:len(start) - n + 1], end[n - 1:]
    return np.unique(mix((total[end] - total[start]) * down[start]))


def sketch_of(s: np.ndarray) -> bytes:
    """Low byte (1 to 255) of the least hash of each bin; 0 for an empty bin."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    at = np.searchsorted(s, edges)
    some = np.diff(np.append(at, len(s))) > 0
    return np.where(some, s[np.minimum(at, len(s) - 1)] % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()


def below(size: int, factor: float) -> np.uint64:
    return np.uint64(min(2 ** 64 - 1, int(factor * 2.0 ** 64 / (SIMILARITY * size))))


def choose(s: np.ndarray, seeds: np.ndarray, factor: float) -> list[np.ndarray]:
    """For each seed, the paths that the set follows from it."""
    limit, out, step = below(len(s), factor), [], max(1, 2_000_000 // len(s))
    for a in range(0, len(seeds), step):
        h = mix(s[None, :] ^ seeds[a:a + step, None])
        out += [mix(row[row < limit] ^ seed) for row, seed in zip(h, seeds[a:a + step])]
    return out


def sign(text: str | None) -> tuple[bytes, int, bytes, list[dict]] | None:
    s = shingles(text)
    if not len(s):
        return None
    node = np.array([mix(s ^ BASE).sum(), mix(s ^ BASE_INVERSE).sum()], np.uint64).tobytes()
    seeds = mix(np.arange(1, RUNS + 1, dtype=np.uint64))
    first = np.unique(np.concatenate(choose(s, seeds, 1.0)))
    second = choose(s, first, CHILDREN) if len(first) else []
    paths = [{"p": p, "c": c.view(np.int64).tolist()} for p, c in zip(first.view(np.int64).tolist(), second)]
    return node, len(s), sketch_of(s), paths


def row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col), F.lit(-2 ** 63)).alias("id0"), text_key(text_col).alias("t")]


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Node, size, sketch and paths of each row that has words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id0", pa.int64()), ("t", pa.int64()), ("node", pa.binary()), ("size", pa.int32()),
                            ("sketch", pa.binary()),
                            ("paths", pa.list_(pa.struct([("p", pa.int64()), ("c", pa.list_(pa.int64()))])))])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                part = batch.slice(at, 500)
                for i, t, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    if (got := sign(text.as_py())) is not None:
                        rows.append(dict(zip(schema.names, (i, t, *got))))
                yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select(*row_key(id_col, text_col), text_of(text_col).alias("text")).mapInArrow(run, SIGNED)


def in_groups(key: list[str], of: Callable[[pa.Table], dict | None], schema: pa.Schema):
    """Calls ``of`` with the rows of each key of a partition that is sorted by the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def results(table: pa.Table, last: bool):
            cols = [table.column(k).to_numpy() for k in key]
            new = np.zeros(max(0, table.num_rows - 1), bool)
            for c in cols:
                new |= c[1:] != c[:-1]
            edges = [0, *(np.nonzero(new)[0] + 1).tolist(), table.num_rows]
            done = len(edges) - 1 if last else len(edges) - 2
            for a, b in zip(edges[:done], edges[1:done + 1]):
                if (got := of(table.slice(a, b - a))) is not None:
                    yield pa.RecordBatch.from_pydict(got, schema)
            return table.slice(edges[done]) if done < len(edges) - 1 else None

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            first, end = held[0], batch.num_rows - 1
            if any(first.column(batch.schema.get_field_index(k))[0] != batch.column(
                    batch.schema.get_field_index(k))[end] for k in key):
                rest = yield from results(pa.Table.from_batches(held).combine_chunks(), False)
                held = rest.to_batches() if rest is not None else []
        if held:
            yield from results(pa.Table.from_batches(held).combine_chunks(), True)

    return run


KEY = ["bucket", "bi", "bj"]


def open_pairs(g: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, and the pairs (i < j) that can be similar by size and meet in no earlier bucket."""
    size = g.column("size").to_numpy()
    m, own = len(size), g.column("own").combine_chunks()
    who = np.repeat(np.arange(m), own.value_lengths().to_numpy())
    earlier = own.flatten().to_numpy()
    bucket = g.column("bucket")[0].as_py()
    who, earlier = who[earlier < bucket], earlier[earlier < bucket]
    ids, at, n = np.unique(earlier, return_inverse=True, return_counts=True)
    met = np.zeros((m, m), bool)
    if len(ids) and (n > 1).any():
        many = np.nonzero(n > 1)[0]
        column = np.full(len(ids), -1)
        column[many] = np.arange(len(many))
        use = column[at] >= 0
        u = np.zeros((m, len(many)), np.float32)
        u[who[use], column[at[use]]] = 1
        met = (u @ u.T) > 0
    able = np.minimum(size[:, None], size[None, :]) >= SIMILARITY * np.maximum(size[:, None], size[None, :])
    if g.column("bi")[0] != g.column("bj")[0]:
        ch = g.column("ch").to_numpy()
        able &= ch[:, None] != ch[None, :]
    i, j = np.nonzero(np.triu(able & ~met, 1))
    return size, i, j


def sketched(g: pa.Table) -> dict | None:
    """The nodes of a bucket that have a partner by their sketches."""
    if g.num_rows < 2:
        return None
    _, i, j = open_pairs(g)
    sk = np.frombuffer(b"".join(g.column("sketch").to_pylist()), np.uint8).reshape(g.num_rows, BINS)
    keep = np.zeros(g.num_rows, bool)
    for a in range(0, len(i), PAIRS_AT_ONCE):
        x, y = sk[i[a:a + PAIRS_AT_ONCE]], sk[j[a:a + PAIRS_AT_ONCE]]
        used = np.count_nonzero((x | y) > 0, axis=1)
        same = np.count_nonzero((x == y) & (x > 0), axis=1)
        near = same >= SIMILARITY * used - 6 * np.sqrt(SIMILARITY * (1 - SIMILARITY) * used)
        keep[i[a:a + PAIRS_AT_ONCE][near]] = True
        keep[j[a:a + PAIRS_AT_ONCE][near]] = True
    if not keep.any():
        return None
    return {c: g.column(c).combine_chunks().filter(pa.array(keep)) for c in [*KEY, "ch", "node"]}


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sets' intersection sizes."""
    m = len(sets)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    ids, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(n > 1, np.cumsum(n > 1) - 1, -1)[at]
    who, column = who[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    total = np.zeros((m, m), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS_AT_ONCE):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS_AT_ONCE])
        u = np.zeros((m, min(COLUMNS_AT_ONCE, int(column[hi - 1]) - a + 1)), np.float32)
        u[who[lo:hi], column[lo:hi] - a] = 1
        total += u @ u.T
    return total


def verified(g: pa.Table) -> dict | None:
    """For each linked node of a bucket: its links' weight and the smallest node connected to it."""
    if g.num_rows < 2:
        return None
    size, i, j = open_pairs(g)
    values = g.column("set").combine_chunks()
    flat, ends = values.flatten().to_numpy(), np.cumsum([0, *values.value_lengths().to_pylist()])
    common = shared_counts([flat[a:b] for a, b in zip(ends[:-1], ends[1:])])[i, j]
    link = common >= SIMILARITY * (size[i] + size[j] - common) - 1e-6
    i, j = i[link], j[link]
    if not len(i):
        return None
    copies = g.column("copies").to_numpy()
    weight = np.bincount(i, copies[j], g.num_rows) + np.bincount(j, copies[i], g.num_rows)
    nodes = g.column("node").to_pylist()
    rank = np.empty(len(nodes), np.int64)
    order = sorted(range(len(nodes)), key=nodes.__getitem__)
    rank[order] = np.arange(len(nodes))
    label = rank.copy()
    while True:                                     # the least rank spreads along the links
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[np.array(order)[label]]
        if (label == old).all():
            break
    linked = np.nonzero(weight)[0].tolist()
    return {"node": [nodes[x] for x in linked], "links": weight[linked].astype(np.int64).tolist(),
            "root": [nodes[order[label[x]]] for x in linked]}


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a bucket together; a large bucket is dealt into chunks and each pair of chunks is a group."""
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = rows.withColumn("ch", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return rows.withColumn("bi", F.least("ch", "other")).withColumn("bj", F.greatest("ch", "other")).drop("other", "n")


def grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*KEY).sortWithinPartitions(*KEY)


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, n, node) of the buckets with several nodes."""
    first = nodes.select("node", F.explode("paths").alias("path")).select("node", "path.p", "path.c")
    n1 = first.groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    both = first.join(n1, "p")
    second = both.where(F.col("n") > LIMIT).select(F.explode("c").alias("bucket"), "node")
    n2 = second.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return (both.where(F.col("n") <= LIMIT).select(F.col("p").alias("bucket"), "n", "node")
            .unionByName(second.join(n2, "bucket").select("bucket", "n", "node")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component. Edges are (node, root)."""
    both = stored(edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
                  .distinct(), "paths-edges")
    label = both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("root"))
    label = stored(label, "paths-label")
    while True:
        near = (both.select("node", F.col("root").alias("other"))
                .join(label.select(F.col("node").alias("other"), F.col("root").alias("l")), "other")
                .groupBy("node").agg(F.min("l").alias("l")))
        step = label.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "l").alias("root"))
        jump = label.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = stored(step.join(jump, "root", "left")
                     .select("node", "old", F.least("root", "further").alias("root")), "paths-label")
        changed = new.where(F.col("old") != F.col("root")).limit(1).count()
        label = new.select("node", "root")
        if not changed:
            return label


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id0, t, class_id0, class_t, n_links) of each row: key, key of its class's first row, similar other rows."""
    marks = stored(signed(docs, id_col, text_col), "paths-signed")
    nodes = stored(marks.groupBy("node").agg(
        F.min(F.struct("id0", "t")).alias("first"), F.count("*").alias("copies"),
        *[F.first(c).alias(c) for c in ("size", "sketch", "paths")]), "paths-nodes")
    own = (buckets(nodes).groupBy("node").agg(F.collect_list(F.struct("bucket", "n")).alias("own"))
           .join(nodes.select("node", "size", "copies", "sketch", "first"), "node"))
    own = stored(own, "paths-own")
    rows = dealt(own.select("node", "size", "sketch", F.col("own.bucket").alias("mine"), F.explode("own").alias("b"))
                 .select("node", "size", "sketch", F.col("mine").alias("own"), "b.bucket", "b.n"))
    found = stored(grouped(rows).mapInArrow(
        in_groups(KEY, sketched, pa.schema([("bucket", pa.int64()), ("bi", pa.int32()), ("bj", pa.int32()),
                                            ("ch", pa.int32()), ("node", pa.binary())])),
        "bucket long, bi int, bj int, ch int, node binary"), "paths-found")
    needed = found.select("node").distinct().join(own.select("node", "size", "copies", "first",
                                                             F.col("own.bucket").alias("own")), "node")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_py()).view(np.int64) for t in part.column(part.schema.get_field_index("text"))]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in ("node", "size", "copies", "own")],
                     pa.array(sets, pa.list_(pa.int64()))], names=["node", "size", "copies", "own", "set"])

    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("text"))
    sets = (needed.select("node", "size", "copies", "own", "first.*").join(texts, ["id0", "t"])
            .select("node", "size", "copies", "own", "text")
            .mapInArrow(with_sets, "node binary, size int, copies long, own array<long>, set array<long>")
            .dropDuplicates(["node"]))
    links = stored(grouped(found.join(sets, "node")).mapInArrow(
        in_groups(KEY, verified, pa.schema([("node", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])),
        "node binary, links long, root binary"), "paths-links")
    roots = components(links.where(F.col("node") != F.col("root")).select("node", "root"))
    linked = (links.groupBy("node").agg(F.sum("links").alias("links"))
              .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    classes = (nodes.select("node", "first", "copies").join(linked, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    least = classes.groupBy("root").agg(F.min("first").alias("least"))
    by_node = classes.join(least, "root").select(
        "node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    every = docs.select(*row_key(id_col, text_col))
    member = marks.select("id0", "t", "node").distinct().join(by_node, "node").select("id0", "t", "least", "links")
    return every.join(member, ["id0", "t"], "left").select(
        "id0", "t", F.coalesce("least.id0", "id0").alias("class_id0"), F.coalesce("least.t", "t").alias("class_t"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def class_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links) of each row: the class is named by its smallest id."""
    null = F.lit(-2 ** 63)
    return jaccard_classes(docs, id_col, text_col).select(
        F.when(F.col("id0") != null, F.col("id0")).alias(id_col),
        F.when(F.col("class_id0") != null, F.col("class_id0")).alias("class_id"), "n_links")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one of the smallest id (of several, the smallest text key)."""
    names = unused(docs, "_id0", "_t")
    stay = (jaccard_classes(docs, id_col, text_col)
            .where((F.col("id0") == F.col("class_id0")) & (F.col("t") == F.col("class_t")))
            .select(F.col("id0").alias(names[0]), F.col("t").alias(names[1])).distinct())
    id0, t = row_key(id_col, text_col)
    return (docs.select("*", id0.alias(names[0]), t.alias(names[1])).join(stay, names, "left_semi")
            .dropDuplicates(names).drop(*names))
