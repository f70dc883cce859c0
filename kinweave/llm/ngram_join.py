"""N-gram Jaccard join: documents whose sets of word shingles are similar, and the components of those links.

The method is a count-vector R-tree: a document's shingles are hashed into
groups, the counts by group are a point, the overlap of two documents is
bounded by the sum of the smaller coordinates, and pairs that pass the bound are
verified on their sets. One tree can't be spread over a cluster, so the groups
also say which documents must be compared at all:

1. Documents with equal sets are one class; only one of each goes on.
2. Similarity t leaves two linked sets at most D differing shingles, a number
   that follows from the size of the smaller. If the shingles are hashed into
   D + 1 groups, some group has the same shingles in both. A document's keys are
   the hashes of its groups; linked documents share a key. Sizes are divided into
   classes; a document also has the keys of the class below if a partner may be
   there. Equal groups that are empty tell nothing, so there are some groups
   more than D + 1: a document with D + 1 groups that aren't empty shares one of
   them with each partner. One with fewer gets the keys of another hash function
   as well (of the last one, the empty groups too), so that no link is lost.
3. The documents of a key form a cell, with its smallest document as the pivot.
   Each (document, pivot) is judged once, whatever the number of its keys: by the
   bound of their points, then, if it allows a link, by their sets.
4. A document that isn't linked to a pivot may be linked to others of its cells.
   It is compared with all documents of that pivot: blocks of points are R-trees,
   searched by the bound. Documents that no other can be linked to go (nearly all
   of those that share no more than a passage). The sets of the rest are searched
   in the same way; pairs that pass are verified in the task, unless they are
   connected already.

Documents that are both linked to the pivot are connected by it, so that a group
of n copies gives n links, not n^2. Cells are never collected: pivots are
minima, which combine before the shuffle, and blocks have a fixed size. Sets are
read for documents that may be linked, all else moves points of 256 counts.

Sets are of 64-bit hashes. Defined edge cases: null and blank texts have empty
sets and link with nothing, not even each other; a text of fewer words than a
shingle is one shingle; repeated rows of a doc_id and text each get a row with
the same component; different texts under one doc_id are different documents,
whose components may have the same number; a null doc_id takes part like any
number (its component is null only if all its members' are, and of a group it
stays only then); other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

SHINGLE = 3
#: Similarity in percent from which documents link.
PERCENT = 90
#: Growth of the size classes, and the hash functions tried before empty groups count.
CLASS_GROWTH, ROUNDS = 1.35, 4
#: Groups of the count vectors, documents of an R-tree block of points, shingles of those of a block of sets, and children of a node.
GROUPS, POINTS, BLOCK, FANOUT = 256, 16_384, 2_000_000, 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, hashes: dict, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes. bytes.lower() and bytes.split() treat exactly A-Z and the six ASCII white spaces."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([hashes[w] for w in words], np.uint64)
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        out = _mix(out * _ODD + h[k : k + n])
    return np.unique(out)


def _limits(percent: int) -> list[int]:
    """First sizes of the classes: 1 and on, up to 2^40."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * CLASS_GROWTH)))
    return out


def _differing(smaller: int, percent: int) -> int:
    """Most differing shingles of two linked sets of which the smaller has so many: the union has at most 100 / percent of them."""
    return smaller * (100 - percent) // percent


@lru_cache(maxsize=1000)
def _groups(smallest: int, differing: int) -> int:
    """Groups among which a set of this size or more nearly always fills differing + 1; at most twice as many."""
    for g in range(differing + 1, 2 * differing + 2, max(1, differing // 50)):
        empty = g * math.exp(-smallest / g)
        if g - empty - 3 * math.sqrt(empty) >= differing + 1:
            return g
    return differing + 1


def keys(s: np.ndarray, percent: int, limits: list[int]) -> np.ndarray:
    """The keys of one set."""
    n = len(s)
    own = int(np.searchsorted(limits, n, "right")) - 1
    out = []
    for level in (own, own - 1):
        # of the class below, the largest set that may be a partner
        if level < 0 or level < own and 100 * (limits[own] - 1) < percent * n:
            continue
        differing = _differing(limits[level + 1] - 1, percent)
        if differing == 0:  # such sets must be equal, and those are one class already
            continue
        groups = _groups(limits[level], differing)
        for r in range(ROUNDS):
            seed = np.uint64(level * ROUNDS + r + 1)
            x = _mix(s + np.uint64(int(seed) * int(_ODD) % (1 << 64)))
            g = (x >> np.uint64(11)) % np.uint64(groups)
            order = np.argsort(g, kind="stable")
            g, x = g[order], x[order]
            starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            sums = np.add.reduceat(_mix(x ^ _ODD), starts)
            out.append(_mix(sums + _mix(g[starts] + (seed << np.uint64(32)))))
            if len(starts) > differing:
                break
            if r == ROUNDS - 1:
                out.append(_mix(np.setdiff1d(np.arange(groups, dtype=np.uint64), g[starts]) + (seed << np.uint64(32))))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set in two signed numbers."""
    digest = xxhash.xxh3_128_intdigest(s.tobytes())
    return (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)


def _sets(size: int):
    """a, b (the class), s for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            found = [shingle_set(t.as_py(), hashes, size) for t in batch.column(0)]
            classes = [_digest(s) for s in found]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in classes], pa.int64()), pa.array([b for _, b in classes], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["a", "b", "s"])

    return run


def _classes(size: int, percent: int):
    """doc_id, key, n_shingles, class (a 128-bit digest of the set in two numbers), keys, point."""
    limits = _limits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            ns, a, b, found, points = [], [], [], [], []
            for t in batch.column(2):
                s = shingle_set(t.as_py(), hashes, size)
                digest = _digest(s)
                ns.append(len(s))
                a.append(digest[0])
                b.append(digest[1])
                found.append(keys(s, percent, limits).view(np.int64) if len(s) else np.empty(0, np.int64))
                points.append(_packed(counts(s)))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ns, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(points, pa.binary())], ["doc_id", "key", "n", "a", "b", "keys", "point"])

    return run


def counts(s: np.ndarray) -> np.ndarray:
    """The point of a set: its shingles by group."""
    return np.bincount((_mix(s) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def _packed(point: np.ndarray) -> bytes:
    """A point in the narrowest numbers that hold all its counts: one byte each for nearly all texts."""
    return point.astype(np.uint8 if point.max() < 1 << 8 else np.uint16 if point.max() < 1 << 16 else np.int32).tobytes()


def _points(column) -> np.ndarray:
    rows = column.to_pylist()
    kinds = {GROUPS: np.uint8, 2 * GROUPS: np.uint16, 4 * GROUPS: np.int32}
    if all(len(r) == GROUPS for r in rows):
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, GROUPS)
    return np.array([np.frombuffer(r, kinds[len(r)]) for r in rows], np.int32)


def _bounded(percent: int):
    """rep, pivot, n, point of each pair, and may: whether the bound allows the link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bound = np.minimum(_points(batch.column("point")), _points(batch.column("other"))).sum(1, dtype=np.int64)
            n = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            may = (100 + percent) * bound >= percent * n
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("pivot"), batch.column("n"), batch.column("point"), pa.array(may)], ["rep", "pivot", "n", "point", "may"])

    return run


class RTree:
    """Points packed in the order of their size and first coordinates, with the largest coordinates (and sizes) of each node."""

    def __init__(self, points: np.ndarray):
        points = points.astype(np.int32, copy=False)
        sizes = points.sum(1)
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes // 8)) if len(points) else np.empty(0, int)
        self.levels = [points[self.order]]
        self.sizes = [(sizes[self.order], sizes[self.order])]
        while len(self.levels[-1]) > FANOUT:
            starts = np.arange(0, len(self.levels[-1]), FANOUT)
            self.sizes.append((np.minimum.reduceat(self.sizes[-1][0], starts), np.maximum.reduceat(self.sizes[-1][1], starts)))
            self.levels.append(np.maximum.reduceat(self.levels[-1], starts, axis=0))

    def search(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the points whose overlap with this one may be percent of the union."""
        n, top = int(point.sum()), len(self.levels) - 1
        at = np.arange(len(self.levels[top]))
        for level in range(top, -1, -1):
            low, high = self.sizes[level][0][at], self.sizes[level][1][at]
            bound = np.minimum(self.levels[level][at], point).sum(1)
            # overlap / (n + size - overlap) >= t, for the smallest size of the node
            at = at[((100 + percent) * bound >= percent * (n + low)) & (100 * high >= percent * n) & (100 * n >= percent * low)]
            if level:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[level - 1])]
        return self.order[at]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _survivors(percent: int):
    """Of one block of a pivot's points: the documents that ask and have another they may be linked to, and those others."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = table.filter(pc.invert(table["asks"]))
        asking = table.filter(table["asks"])
        ids = own["rep"].to_numpy()
        tree, hit, found = RTree(_points(own["point"])), np.zeros(len(ids), bool), []
        for rep, point in zip(asking["rep"].to_numpy(), _points(asking["point"]), strict=True):
            at = tree.search(point, percent)
            at = at[ids[at] != rep]
            if len(at):
                hit[at] = True
                found.append(rep)
        reps = np.union1d(ids[hit], np.array(found, np.int64))
        return pa.table({"pivot": pa.array([key[0].as_py()] * len(reps), pa.int64()), "rep": pa.array(reps, pa.int64())})

    return run


def _blocks(own: DataFrame, asking: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of own and asking for each pair of a block of the one and a block of the other, by the pivot's numbers of blocks."""
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = own.join(blocks, "pivot").withColumn("block", part("blocks")).withColumn("ask", every("asking")).withColumn("asks", F.lit(False))
    asking = asking.join(blocks, "pivot").withColumn("block", every("blocks")).withColumn("ask", part("asking")).withColumn("asks", F.lit(True))
    return own.unionByName(asking).drop("blocks", "asking")


def _by_block(df: DataFrame, run, schema: str) -> DataFrame:
    """run for each pair of blocks. The rows are dealt by all three keys: rows that a join has dealt by their pivot would count as grouped, and all blocks of a common pivot would stay in one task."""
    keys = ["pivot", "block", "ask"]
    return df.repartition(*keys).groupBy(*keys).applyInArrow(run, schema)


def _search(percent: int):
    """Of one block of a pivot's documents: links of those that aren't linked to the pivot. Connected pairs are not verified again."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = table.filter(pc.invert(table["asks"]))
        asking = table.filter(table["asks"])
        ids, sets = own["doc_id"].to_pylist(), [np.asarray(x.values).view(np.uint64) for x in own["s"]]
        tree = RTree(np.array([counts(s) for s in sets], np.int32).reshape(-1, GROUPS))
        root: dict = {}

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        links = []
        for doc, values in zip(asking["doc_id"].to_pylist(), asking["s"], strict=True):
            s = np.asarray(values.values).view(np.uint64)
            for k in tree.search(counts(s), percent):
                if ids[k] != doc and find(ids[k]) != find(doc) and similar(s, sets[k], percent):
                    links.append((doc, ids[k]))
                    root[find(doc)] = find(ids[k])
        return pa.table({"x": pa.array([a for a, _ in links], pa.int64()), "y": pa.array([b for _, b in links], pa.int64())})

    return run


def links(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links): doc_id, key (of the text), n_shingles, a, b for each row of docs; a, b, rep (a number for each set that isn't empty) and first (its smallest doc_id); and x, y, links between reps that connect all that are linked."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.col("text"))
    found = materialize(d.mapInArrow(_classes(size, percent), "doc_id long, key string, n long, a long, b long, keys array<long>, point binary"), "ngram-documents")
    members = materialize(found.select("doc_id", "key", F.col("n").alias("n_shingles"), "a", "b"), "ngram-members")
    # the number is a surrogate: one doc_id may have several texts, and null is no key
    sets = found.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("point").alias("point"))
    sets = materialize(sets.withColumn("rep", F.monotonically_increasing_id()), "ngram-classes")
    discard(found)
    classes = materialize(sets.select("a", "b", "rep", "first"), "ngram-reps")
    # dealt once for the pivots and the join; with the conditions here, none is added to one side, which would deal the rows twice
    cells = sets.select("rep", F.explode("keys").alias("key")).where("key is not null and rep is not null").repartition("key")
    pivots = cells.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("m")).where("m > 1").drop("m")
    pairs = materialize(cells.join(pivots, "key").where("rep <> pivot").select("rep", "pivot").distinct(), "ngram-pairs")
    points = pairs.join(sets.select("rep", "n", "point"), "rep").join(sets.select(F.col("rep").alias("pivot"), F.col("n").alias("m"), F.col("point").alias("other")), "pivot")
    bounded = materialize(points.mapInArrow(_bounded(percent), "rep long, pivot long, n long, point binary, may boolean"), "ngram-bounded")
    discard(sets, pairs)
    near = bounded.where("may").select("pivot", "rep")
    # of those that the bound keeps from their pivot: which may be linked to others of it
    blocks = bounded.groupBy("pivot").agg(F.count("*").alias("rows"), F.count_if(~F.col("may")).alias("f")).where("f > 0 and rows > 1")
    blocks = blocks.select("pivot", F.ceil(F.col("rows") / POINTS).alias("blocks"), F.ceil(F.col("f") / POINTS).alias("asking"))
    points = _blocks(bounded.select("pivot", "rep", "point"), bounded.where("not may").select("pivot", "rep", "point"), blocks)
    further = _by_block(points, _survivors(percent), "pivot long, rep long")
    left = materialize(near.union(further).distinct().join(bounded, ["pivot", "rep"]).select("pivot", "rep", "n", "may"), "ngram-left")
    discard(bounded)
    wanted = left.select("rep").union(left.where("may").select("pivot")).distinct()
    wanted = materialize(classes.join(wanted, "rep"), "ngram-wanted")
    # the sets of documents that may be linked to another, once more from their texts; of a doc_id there may be other texts too
    asked = d.where("doc_id is null").unionByName(d.join(wanted.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    read = asked.select("text").mapInArrow(_sets(size), "a long, b long, s array<long>").dropDuplicates(["a", "b"])
    held = materialize(read.join(wanted, ["a", "b"]).select("rep", "s"), "ngram-sets")
    discard(wanted)
    both = F.size(F.array_intersect("s", "t"))
    star = left.where("may").select("rep", "pivot").join(held, "rep").join(held.select(F.col("rep").alias("pivot"), F.col("s").alias("t")), "pivot")
    star = materialize(star.where(100 * both >= percent * (F.size("s") + F.size("t") - both)).select("rep", "pivot"), "ngram-star")
    judged = materialize(left.join(star.withColumn("linked", F.lit(True)), ["rep", "pivot"], "left").select("pivot", "rep", "n", F.col("linked").isNull().alias("asks")), "ngram-judged")
    discard(left)
    blocks = judged.groupBy("pivot").agg(F.count("*").alias("rows"), F.sum("n").alias("m"), F.sum(F.when(F.col("asks"), F.col("n"))).alias("f")).where("f > 0 and rows > 1")
    blocks = blocks.select("pivot", F.ceil(F.col("m") / BLOCK).alias("blocks"), F.ceil(F.col("f") / BLOCK).alias("asking"))
    searched = _blocks(judged.select("pivot", "rep"), judged.where("asks").select("pivot", "rep"), blocks).join(held, "rep").select("pivot", "block", "ask", F.col("rep").alias("doc_id"), "asks", "s")
    further = _by_block(searched, _search(percent), "x long, y long")
    out = materialize(star.select(F.col("rep").alias("x"), F.col("pivot").alias("y")).union(further).distinct(), "ngram-links")
    discard(held, star, judged)
    return members, classes, out


def connected(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each component of the links x, y. First each node's smaller neighbours are linked to the smallest of them, which leaves few more links than nodes; then labels spread to neighbours and jump to their label's label, which halves distances."""
    down = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    # a node's smaller neighbours are linked to the smallest of them instead of all to the node
    stars = down.join(down.groupBy("x").agg(F.min("y").alias("least")), "x")
    fewer = stars.select("x", F.col("least").alias("y")).union(stars.select(F.col("y").alias("x"), F.col("least").alias("y"))).distinct()
    fewer = materialize(fewer.where("x <> y"), "links")
    both = fewer.union(fewer.select("y", "x"))
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.min("x")).alias("label")), "labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "y"), "y").select(F.col("x").alias("node"), "label").union(labels).groupBy("node").agg(F.min("label").alias("label"))
        jumped = told.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", F.least("label", "next").alias("label"))
        new = materialize(jumped, "labels")
        same = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").isEmpty()
        discard(labels)
        labels = new
        if same:
            discard(fewer)
            return labels


def text_key(text: Column) -> Column:
    return F.coalesce(F.md5(text), F.lit(""))


def _grouped(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """doc_id, key, n_shingles, group (a number for each component, null for empty sets) and first, the smallest doc_id in it, for each row of docs."""
    members, classes, found = links(docs, percent, size)
    labels = connected(found).join(classes.select(F.col("rep").alias("node"), "first"), "node")
    firsts = labels.groupBy("label").agg(F.min("first").alias("least"))
    labels = labels.select("node", "label").join(firsts, "label")
    classes = classes.join(labels, classes.rep == labels.node, "left")
    # all classes of one component have the same least, which may be null
    classes = classes.select("a", "b", F.coalesce("label", "rep").alias("group"), F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("least")).alias("first"))
    return members.join(classes, ["a", "b"], "left").select("doc_id", "key", "n_shingles", "group", "first")


def components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    return _grouped(docs, percent, size).select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One document of each component, all columns: the one with the smallest doc_id, null only if all are, and of several texts under it the smallest hash. Of repeated rows all are equal; one stays."""
    of = materialize(_grouped(docs, percent, size), "ngram-groups")
    least = of.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x")).select("x.doc_id", "x.key")
    stay = least.union(of.where("group is null").select("doc_id", "key").distinct()).toDF("_id", "_text")
    keyed = docs.withColumn("_key", text_key(F.col("text")))
    out = keyed.join(stay, keyed.doc_id.cast("long").eqNullSafe(stay._id) & (keyed._key == stay._text), "left_semi")
    return out.dropDuplicates(["doc_id", "_key"]).drop("_key")


ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i+{SHINGLE}-1], ' '))) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, md5(unnest(s)) AS g FROM s),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b USING (g) WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON reach.r = both_ways.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
