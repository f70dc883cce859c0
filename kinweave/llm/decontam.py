"""Benchmark decontamination: a BM25 inverted index of the test items, block-max WAND, and a check of question and answer.

Test items are indexed once; every passage of every training document is a
query. An item's weights are BM25's, divided by its own total, so that a score
is the share of the item that the passage holds and one threshold fits all
items. Each term has a list of postings and, by block of items, the largest
weight. A passage is two neighbouring half passages.

A passage's terms are put in the order of their lists' largest weights. Up to the
pivot, where the sum of these reaches the threshold, no item can be found by such
terms alone, so only the lists from the pivot on are read. Their block maxima, with
what the lists before the pivot can add at most, bound each block; then the block
maxima of those lists too; blocks below the threshold are skipped (block-max WAND, for many
passages at once), and the postings of the others are scored. All pairs at
or above the threshold are then verified word by word: five-word shingles that
item and passage share mark the item's words, and enough of the question and of
the answer must be marked. Parts of similar length have lists of their own, as a
word weighs more in a short item.

An item has a question and an answer: columns of these names, or else the
last sentence of `text` is the answer and what precedes it the question. Items
longer than half a passage are indexed in parts.

Items are tokenised and document frequencies counted by Spark, and kept as tables.
The index is broadcast in shards of about SHARD_WORDS words of items, one at a
time; documents are read once a shard.

Defined edge cases: null and empty texts hold nothing; an item without words is
never found; with no items nothing is; an item of fewer than five words is one
shingle; different items under one item_id (null is one too) are each searched and
give one row a document; repeated rows of a doc_id count once in the result; other
columns are ignored by scan() and kept by clean().
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

SHINGLE = 5
#: Words of half a passage; passages overlap by half.
HALF = 64
#: Parts of a block, and words of the items of a shard.
BLOCK, SHARD_WORDS = 8, 4_000_000
#: Texts searched at once, and passages and list entries held at once.
TEXTS, PASSAGES, ENTRIES = 64, 2_048, 4_000_000
K1, B = 1.2, 0.75
#: Share of an item's BM25 weight that a passage must hold to be verified.
RETRIEVED = 0.5
#: Share of the words, in percent, that must be marked.
QUESTION_PERCENT, ANSWER_PERCENT = 80, 50

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_answer(text: str | None) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, SENTENCE.split((text or "").strip())) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def marked(item: list[str], passage: list[str]) -> np.ndarray:
    """Which words of the item lie in a shingle that the passage has too."""
    n = min(SHINGLE, len(item))
    held = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    out = np.zeros(len(item), bool)
    for i in range(len(item) - n + 1):
        if tuple(item[i : i + n]) in held:
            out[i : i + n] = True
    return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1 of all i, in order."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Lists:
    """Postings of some parts, sorted by term and part, with block maxima by term and block."""

    def __init__(self, term: np.ndarray, part: np.ndarray, weight: np.ndarray, terms: int, parts: np.ndarray):
        self.parts, self.blocks = parts, -(-len(parts) // BLOCK)
        order = np.lexsort((part, term))
        term, part, self.weight = term[order], part[order], weight[order]
        self.key = term * len(parts) + part
        in_block = term * self.blocks + part // BLOCK
        starts = np.flatnonzero(np.r_[True, in_block[1:] != in_block[:-1]])
        self.block_key, self.block_most = in_block[starts], np.maximum.reduceat(self.weight, starts)
        self.begin = np.searchsorted(self.block_key, np.arange(terms + 1) * self.blocks)
        self.most = np.zeros(terms)
        np.maximum.at(self.most, term, self.weight)

    @staticmethod
    def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[i] == wanted, values[i], 0.0)

    def search(self, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(passages, parts) that reach the threshold, for different pairs of passage and term."""
        least, most = RETRIEVED - 1e-6, self.most[term]
        total = np.bincount(passage, most)
        held = (most > 0) & (total[passage] >= least)
        passage, term, most = passage[held], term[held], most[held]
        if not len(term):
            return
        order = np.lexsort((most, passage))
        passage, term, most = passage[order], term[order], most[order]
        first = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        sums = np.cumsum(most)
        sums -= np.repeat(sums[first] - most[first], np.diff(np.r_[first, len(term)]))
        read = sums >= least  # from the pivot on
        entries = np.cumsum(np.where(read, self.begin[term + 1] - self.begin[term], 0))
        # slices of whole passages
        at = 0
        while at < len(first):
            lo = first[at]
            to = max(at + 1, int(np.searchsorted(entries[np.r_[first[1:], len(term)] - 1], (entries[lo - 1] if lo else 0) + ENTRIES, "right")))
            hi = first[to] if to < len(first) else len(term)
            yield self._slice(passage[lo:hi], term[lo:hi], most[lo:hi], read[lo:hi], least)
            at = to

    def _slice(self, passage, term, most, read, least):
        names, passage = np.unique(passage, return_inverse=True)
        sizes = self.begin[term[read] + 1] - self.begin[term[read]]
        entry = _ranges(self.begin[term[read]], sizes)
        pair, which = np.unique(np.repeat(passage[read], sizes) * self.blocks + self.block_key[entry] % self.blocks, return_inverse=True)
        bound = np.bincount(which, self.block_most[entry], len(pair))
        skipped = np.bincount(passage[~read], most[~read], len(names))
        good = bound + skipped[pair // self.blocks] >= least
        pair, bound = pair[good], bound[good]
        # the block maxima of the lists before the pivot
        pair, bound = self._add(pair, bound, self.blocks, passage[~read], term[~read], len(names), self.block_key, self.block_most, least)
        if not len(pair):
            return names[:0], self.parts[:0]
        part = ((pair % self.blocks) * BLOCK)[:, None] + np.arange(BLOCK)
        whole = (pair // self.blocks)[:, None] * len(self.parts) + part
        whole = whole[part < len(self.parts)]
        whole, _ = self._add(whole, np.zeros(len(whole)), len(self.parts), passage, term, len(names), self.key, self.weight, least)
        return names[whole // len(self.parts)], self.parts[whole % len(self.parts)]

    def _add(self, pair, score, width, passage, term, passages, keys, values, least):
        """The pairs (passage * width + place) that reach the threshold when the values of their passage's terms there are added. `passage` is sorted."""
        begin = np.searchsorted(passage, np.arange(passages + 1))
        out = []
        sizes = begin[pair // width + 1] - begin[pair // width]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(pair):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ENTRIES, "right")))
            p, n = pair[at:to], sizes[at:to]
            t = term[_ranges(begin[p // width], n)]
            which = np.repeat(np.arange(len(p)), n)
            total = score[at:to] + np.bincount(which, self._at(keys, values, t * width + (p % width)[which]), len(p))
            good = total >= least
            out.append((p[good], total[good]))
            at = to
        return (np.concatenate([p for p, _ in out]), np.concatenate([x for _, x in out])) if out else (pair, score)


class Index:
    """A shard: the items as numbers of their terms, and postings of their parts."""

    def __init__(self, items: list[tuple[int, list[str], list[str]]], df: dict[str, int], n: int, mean: float):
        self.terms = {t: k for k, t in enumerate(sorted({t for _, q, a in items for t in (*q, *a)}))}
        number = lambda words: [self.terms[t] for t in words]
        self.items = [(i, number(q), number(a)) for i, q, a in items]
        self.item_of: list[int] = []
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        names = list(self.terms)
        for i, (_, q, a) in enumerate(self.items):
            whole = q + a
            for at in range(0, len(whole), HALF):
                part = whole[at : at + HALF]
                tf = Counter(part)
                own = np.array([np.log(1 + (n - df.get(names[t], 1) + 0.5) / (df.get(names[t], 1) + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(part) / mean)) for t, f in tf.items()])
                found.append((len(part), np.fromiter(tf, np.int64), own / own.sum()))
                self.item_of.append(i)
        self.lists = []
        order = sorted(range(len(found)), key=lambda k: (found[k][0], k))
        layer = lambda k: found[k][0].bit_length()
        for size in sorted({layer(k) for k in order}):
            parts = np.array([k for k in order if layer(k) == size])
            term = np.concatenate([found[k][1] for k in parts])
            place = np.repeat(np.arange(len(parts)), [len(found[k][1]) for k in parts])
            self.lists.append(Lists(term, place, np.concatenate([found[k][2] for k in parts]), len(self.terms), parts))

    def search(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(text, half, part) of each passage, by its first half, and part that reach the threshold. A text is an array of term numbers, -1 for other words."""
        passages, begins, pairs = 0, [], []

        def flush():
            if pairs and self.lists:
                p, t = np.divmod(np.unique(np.concatenate(pairs)), len(self.terms))
                for lists in self.lists:
                    for found, parts in lists.search(p, t):
                        for x, part in zip(found.tolist(), parts.tolist(), strict=True):
                            k = int(np.searchsorted([b for b, _, _ in begins], x, "right")) - 1
                            yield begins[k][1], begins[k][2] + x - begins[k][0], part

        for k, ids in enumerate(texts):
            halves = -(-len(ids) // HALF)
            for low in range(0, max(1, halves - 1), PASSAGES):  # passages low .. of this text
                n = min(PASSAGES, max(1, halves - 1) - low)
                if passages + n > PASSAGES and pairs:
                    yield from flush()
                    passages, begins, pairs = 0, [], []
                own = ids[low * HALF : (low + n + 1) * HALF]
                half = np.arange(len(own)) // HALF
                known = own >= 0
                for h in (half, half - 1):
                    good = known & (h >= 0) & (h < n)
                    pairs.append((passages + h[good]) * len(self.terms) + own[good])
                begins.append((passages, k, low))
                passages += n
        yield from flush()

    def find_all(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """Of each text: item_id -> (word at which the first verified passage begins, percent of the question, percent of the answer marked)."""
        get = self.terms.get
        words = [np.array([get(x, -1) for x in words_of(t)], np.int64) for t in texts]
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for text, half, part in sorted(set(self.search(words))):
            item_id, question, answer = self.items[self.item_of[part]]
            if item_id in found[text]:
                continue
            whole = question + answer
            around = len(whole) if len(whole) > HALF else 0  # of a long item the other parts stand near
            at = max(0, half * HALF - around)
            hit = marked(whole, words[text][at : (half + 2) * HALF + around].tolist())
            q = 100 * int(hit[: len(question)].sum()) // max(1, len(question))
            a = 100 * int(hit[len(question) :].sum()) // len(answer) if answer else 100
            if q >= QUESTION_PERCENT and a >= ANSWER_PERCENT:
                found[text][item_id] = (half * HALF, q, a)
        return found

    def find(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        return self.find_all([text])[0]


def _tokenised(both: bool):
    """item_id, question, answer (words), parts, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[1:]]
            split = [(words_of(q), words_of(a)) for q, a in zip(*cols, strict=True)] if both else [question_answer(t) for t in cols[0]]
            sizes = [len(q) + len(a) for q, a in split]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array([x[k] for x in split], pa.list_(pa.string())) for k in (0, 1)], pa.array([-(-n // HALF) for n in sizes], pa.int64()), pa.array(sizes, pa.int64())], ["item_id", "question", "answer", "parts", "words"])

    return run


def indexes(items: DataFrame) -> Iterator[Index]:
    """The shards of the index, with statistics of all items."""
    cols = ["question", "answer"] if {"question", "answer"} <= set(items.columns) else ["text"]
    table = items.select("item_id", *cols).mapInArrow(_tokenised(len(cols) == 2), "item_id long, question array<string>, answer array<string>, parts long, words long").where("words > 0")
    table = materialize(table, "benchmark-items")
    parts, length = table.agg(F.coalesce(F.sum("parts"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    if not parts:
        discard(table)
        return
    shards = -(-length // SHARD_WORDS)
    table = table.withColumn("shard", F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(shards)))
    part = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda k: F.array_distinct(F.slice(F.concat("question", "answer"), (k * HALF + 1).cast("int"), HALF))))
    terms = table.select("shard", part.alias("t")).select("shard", F.explode("t").alias("term")).groupBy("shard", "term").agg(F.count("*").alias("n"))
    terms = materialize(terms, "benchmark-terms")
    df = terms.groupBy("term").agg(F.sum("n").alias("df"))
    for k in range(shards):  # of a bounded size each
        own = terms.where(F.col("shard") == k).select("term").join(df, "term").toArrow()
        rows = table.where(F.col("shard") == k).select("item_id", "question", "answer").collect()
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        yield Index([tuple(r) for r in rows], dict(zip(own["term"].to_pylist(), own["df"].to_pylist(), strict=True)), parts, length / parts)
    discard(table, terms)


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("at_word", pa.int64()), ("question_percent", pa.int64()), ("answer_percent", pa.int64())])
ROWS = "doc_id long, item_id long, at_word long, question_percent long, answer_percent long"


def _scan(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows = [(d, i, *x) for d, found in zip(part.column(0).to_pylist(), index.value.find_all(part.column(1).to_pylist()), strict=True) for i, x in found.items()]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=FOUND)

    return run


def scan(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, at_word, question_percent, answer_percent for each document and item that it holds."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], ROWS)
    for index in indexes(items):
        shared = spark.sparkContext.broadcast(index)
        out = out.unionByName(materialize(d.mapInArrow(_scan(shared), ROWS), "benchmark-found"))
        shared.unpersist()
    return out.groupBy("doc_id", "item_id").agg(F.min(F.struct("at_word", "question_percent", "answer_percent")).alias("x")).select("doc_id", "item_id", "x.*")


def _clean(index, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                yield part.filter(pa.array([not found for found in index.value.find_all(part.column(column).to_pylist())], pa.bool_()))

    return run


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, all columns; no shuffle."""
    last = None
    for index in indexes(items):
        if last:  # one shard is held at a time
            docs = materialize(docs, "benchmark-clean")
            last.unpersist()
        last = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(_clean(last, docs.columns.index("text")), docs.schema)
    return docs
