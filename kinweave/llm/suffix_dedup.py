"""Suffix-array dedup: removes bytes of passages that also start earlier, keeping the first.

A byte goes if it is covered by a string of LENGTH bytes that occurs at an
earlier start too, in the order of (doc_id, start): that is, by the longest
previous factor of a position, if it has LENGTH or more bytes. The longest
previous factor of a suffix is its longest common prefix with one of two others:
the nearest in suffix order, before and behind it, that start at a smaller
position (previous and next smaller positions).

No machine holds the suffixes of a whole corpus, so they are dealt out by
content, into buckets of which each has a suffix array of its own. The anchor of
a window of LENGTH bytes is its smallest K-gram by hash, the leftmost of equals;
equal windows have equal anchors at equal places. Runs of windows with one anchor
are a segment (LENGTH to 2 LENGTH - K bytes, about 35 windows), and the segments
with one anchor are a bucket: two suffixes with LENGTH bytes in common are in the
same one.

1. Documents with the bytes of an earlier document are removed whole and leave.
2. Anchors that occur once in the corpus leave (a count that combines early).
3. The segments that are left are fetched from their texts. All but the first
   of equal segments are covered whole: equal suffixes, the first is the smallest.
4. Of each bucket of different segments the suffixes are sorted, the common
   prefixes of neighbours measured, previous and next smaller positions found, and
   factors of LENGTH or more kept. Tasks read sorted partitions, a bucket at a time.
   Of a bucket of more than GROUP segments no task could hold the suffix array; it
   is cut into its intervals of suffixes with LENGTH bytes in common. The smallest
   position of such an interval has no previous factor in it, each other has one,
   and a minimum combines early. Both ways give the same bytes.
5. The spans found are joined to the texts.

Defined edge cases: a null or empty text has 0 bytes; a text under LENGTH bytes
keeps all; rows with a null doc_id have no place in the order: they keep all and
aren't earlier than others; repeated rows of a doc_id and text are one document
and each get its result; different texts under one doc_id follow each other in
the order of a hash; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, materialize

LENGTH, K = 100, 32
#: Bytes of a text worked on at once, as a power of two.
CHUNK_BITS = 20
#: Most different segments of an anchor that have one suffix array.
GROUP = 1_000
#: Bits of a position for the start within a text; those above number the different texts of a doc_id.
START_BITS = 40

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class Anchors:
    """Segments of texts; the powers are made once a task."""

    def __init__(self):
        n = (1 << CHUNK_BITS) + 1
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def _chunk(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[K:] - sums[:-K]) * self.down[: n - K + 1]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        low = np.uint64((1 << CHUNK_BITS) - 1)
        v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        w = LENGTH - K + 1  # K-grams of a window
        pad = np.full(-len(v) % w, np.uint64(_MASK))
        rows = np.concatenate([v, pad]).reshape(-1, w)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - LENGTH + 1
        at = (np.minimum(after[:windows], before[w - 1 : w - 1 + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        return h[at[first]], first, np.r_[first[1:], windows] - first + LENGTH - 1

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of each segment the anchor's hash, and start << 8 | bytes."""
        keys, places, step = [], [], (1 << CHUNK_BITS) - LENGTH
        for at in range(0, max(1, len(text) - LENGTH + 1), step):
            data = np.frombuffer(text, np.uint8)[at : at + step + LENGTH - 1]
            if len(data) >= LENGTH:
                k, first, size = self._chunk(data)
                keys.append(k.view(np.int64))
                places.append((first + at) << 8 | size)
        return (np.concatenate(keys), np.concatenate(places)) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *found])))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = Anchors()
    for batch in batches:
        found = [anchors.of((t.as_py() or "").encode()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _lists([k for k, _ in found]), _lists([p for _, p in found])], ["doc_id", "base", "keys", "places"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t in batch.column(1):
            b = (t.as_py() or "").encode()
            d = xxhash.xxh3_128_intdigest(b)
            rows.append(((d >> 64) - (1 << 63), (d & _MASK) - (1 << 63), len(b)))
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", "base", "a", "b", "n"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments that are asked for, with their bytes and a 128-bit hash of them."""
    schema = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        columns: list[list] = [[] for _ in schema]
        for doc, text, base, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            data = (text.as_py() or "").encode()
            for key, place in ((x["key"], x["place"]) for x in asked):
                piece = data[place >> 8 : (place >> 8) + (place & 255)]
                d = xxhash.xxh3_128_intdigest(piece)
                for c, x in zip(columns, (key, (d >> 64) - (1 << 63), (d & _MASK) - (1 << 63), doc, base + (place >> 8), piece), strict=True):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


SPAN = pa.schema([("doc_id", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])


def _spans(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=SPAN)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (x.bit_length() + 7) // 8


def previous_factors(segments: list[bytes]) -> list[tuple[int, int, int]]:
    """(segment, offset, factor) of each suffix of LENGTH or more bytes whose longest previous factor has LENGTH or more. Segments stand in the order of their positions; a factor ends with its segment."""
    places = [(k, i) for k, s in enumerate(segments) for i in range(len(s) - LENGTH + 1)]
    suffixes = [segments[k][i:] for k, i in places]
    order = sorted(range(len(places)), key=suffixes.__getitem__)  # the suffix array; equal suffixes by position
    sorted_suffixes = [suffixes[p] for p in order]
    # common prefixes of neighbours; shorter ones than LENGTH end the search for smaller positions and need no exact number
    prefixes = [0, *(common_prefix(a, b) if a[:LENGTH] == b[:LENGTH] else 0 for a, b in zip(sorted_suffixes, sorted_suffixes[1:], strict=False))]
    factors = [0] * len(places)

    def smaller(at: range, prefix) -> None:
        """Common prefixes with the nearest smaller position behind us on the way through `at`; prefix(i) is that of i and the one before on this way."""
        stack: list[tuple[int, int]] = []  # position, common prefix with the smaller position below it
        for i in at:
            p, n = order[i], prefix(i)
            if n < LENGTH:
                stack.clear()
                n = 0
            while stack and stack[-1][0] > p:
                n = min(n, stack.pop()[1])
            if not stack:
                n = 0
            elif n > factors[p]:
                factors[p] = n
            stack.append((p, n))

    n = len(order)
    smaller(range(n), prefixes.__getitem__)
    smaller(range(n - 1, -1, -1), lambda i: prefixes[i + 1] if i + 1 < n else 0)
    return [(*places[p], f) for p, f in enumerate(factors) if f >= LENGTH]


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, doc_id, start), each of another content: the factors of each key's bucket as spans."""

    def found(rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int]]:
        if len(rows) > 1:
            last = None
            for k, offset, factor in previous_factors([r[2] for r in rows]):
                doc, start = rows[k][0], rows[k][1] + offset
                if last and last[0] == doc and last[1] <= start <= last[2]:
                    last = (doc, last[1], max(last[2], start + factor))
                else:
                    if last:
                        yield last
                    last = (doc, start, start + factor)
            if last:
                yield last

    now, bucket = None, []
    for batch in batches:
        out = []
        for key, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if key != now:
                out += found(bucket)
                now, bucket = key, []
            bucket.append(row)
        yield _spans(out)
    yield _spans(list(found(bucket)))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, start, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for i in range(len(data) - LENGTH + 1):
                d = xxhash.xxh3_128_intdigest(data[i : i + LENGTH])
                rows.append(((d >> 64) - (1 << 63), (d & _MASK) - (1 << 63), doc, start + i))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "doc_id", "start"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, base, spans, copy (an earlier document has the same bytes) -> the result's columns and the text left."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    for batch in batches:
        rows = []
        for doc, text, base, spans, copy in zip(batch.column(0).to_pylist(), batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            data = (text.as_py() or "").encode()
            merged: list[list[int]] = [[0, len(data)]] if copy and len(data) >= LENGTH else []
            for s in sorted((s["from"] - base, s["to"] - base) for s in (spans or []) if not copy):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            ends = [0, *(x for s in merged for x in s), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            rows.append((doc, len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def based(docs: DataFrame) -> DataFrame:
    """doc_id, text, base for each row of docs: the different texts of one doc_id begin 2^START_BITS positions apart."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(11))
    several = d.where("doc_id is not null").select("doc_id", key.alias("key")).groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("doc_id")
    several = materialize(several, "dedup-several")
    if several.isEmpty():
        discard(several)
        return d.withColumn("base", F.lit(0).cast("long"))
    texts = d.select("doc_id", key.alias("key")).join(several, "doc_id", "left_semi").distinct()
    texts = texts.withColumn("base", F.shiftleft(F.row_number().over(Window.partitionBy("doc_id").orderBy("key")).cast("long") - 1, START_BITS))
    texts = materialize(texts.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "base"), "dedup-texts")
    return d.join(texts, (d.doc_id == texts._d) & (key == texts._k), "left").select(d.doc_id, d.text, F.coalesce("base", F.lit(0).cast("long")).alias("base"))


def spans(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies, spans) of based() documents: doc_id, base of documents with the bytes of an earlier one, and doc_id, base, from, to of other spans that also start earlier. Spans may overlap."""
    d = d.where("doc_id is not null")
    digests = d.mapInArrow(_digests, "doc_id long, base long, a long, b long, n long").where(F.col("n") >= LENGTH)
    document = F.struct("doc_id", "base")
    firsts = digests.groupBy("a", "b").agg(F.min(document).alias("first"), F.max(document).alias("last")).where("first <> last").select("a", "b", "first")
    firsts = materialize(firsts, "dedup-firsts")
    copies = materialize(digests.join(firsts, ["a", "b"]).where(document != F.col("first")).select("doc_id", "base").distinct(), "dedup-copies")
    alone = d.join(copies, ["doc_id", "base"], "left_anti").select("doc_id", "text", "base")
    found = materialize(alone.mapInArrow(_anchors, "doc_id long, base long, keys array<long>, places array<long>"), "dedup-anchors")
    shared = materialize(found.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "dedup-shared")
    rows = found.select("doc_id", "base", F.inline(F.arrays_zip("keys", "places"))).toDF("doc_id", "base", "key", "place")
    asked = rows.join(shared, "key").groupBy("doc_id", "base").agg(F.collect_set(F.struct("key", "place")).alias("asked"))
    asked = materialize(asked, "dedup-asked")
    discard(firsts, found, shared)
    segments = materialize(d.join(asked, ["doc_id", "base"]).select("doc_id", "text", "base", "asked").mapInArrow(_cut, "key long, a long, b long, doc_id long, start long, bytes binary"), "dedup-segments")
    discard(asked)
    place = F.struct("doc_id", "start")
    unique = segments.groupBy("key", "a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("bytes").alias("bytes"))
    unique = materialize(unique.select("key", "a", "b", "first", (F.col("first") != F.col("last")).alias("repeated"), "bytes"), "dedup-unique")
    repeated = unique.where("repeated").select("key", "a", "b", "first")
    whole = segments.select("key", "a", "b", "doc_id", "start", F.length("bytes").alias("n")).join(repeated, ["key", "a", "b"]).where(place != F.col("first")).select("doc_id", F.col("start").alias("from"), (F.col("start") + F.col("n")).alias("to"))
    whole = materialize(whole, "dedup-whole")
    discard(segments)
    groups = materialize(unique.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "dedup-groups")
    small = unique.join(groups.where(F.col("n") <= GROUP), "key", "left_semi").select("key", "first.doc_id", "first.start", "bytes")
    factors = small.repartition("key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(_factors, "doc_id long, from long, to long")
    factors = materialize(factors, "dedup-factors")
    large = unique.join(groups.where(F.col("n") > GROUP), "key", "left_semi").select("first.doc_id", "first.start", "bytes")
    windows = materialize(large.mapInArrow(_windows, "a long, b long, doc_id long, start long"), "dedup-windows")
    discard(unique, groups)
    earliest = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    late = windows.join(earliest, ["a", "b"]).where(place != F.col("first")).select("doc_id", F.col("start").alias("from"), (F.col("start") + LENGTH).alias("to"))
    late = materialize(late, "dedup-late")
    discard(windows)
    base = F.shiftleft(F.shiftright("from", START_BITS), START_BITS).alias("base")
    return copies, whole.unionByName(factors).unionByName(late).select("doc_id", base, "from", "to")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left) for each row of docs."""
    d = based(docs)
    copies, found = spans(d)
    zero = F.lit(0).cast("long")
    by_doc = found.groupBy("doc_id", "base").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    by_doc = materialize(by_doc.unionByName(copies.select("doc_id", "base", F.array(F.struct(zero.alias("from"), zero.alias("to"))).alias("spans"))), "dedup-by-document")
    joined = d.join(by_doc, ["doc_id", "base"], "left").select("doc_id", "text", "base", "spans", F.coalesce(F.col("spans")[0]["to"] == 0, F.lit(False)).alias("copy"))
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(list_transform(range(0, len(h) // 2 - {LENGTH - 1}), lambda i: struct_pack(i := i, m := md5(substr(h, CAST(2 * i + 1 AS INTEGER), {2 * LENGTH})))), recursive := true) FROM d),
x AS (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM w),
p AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS q FROM x WHERE k > 1),
g AS (SELECT doc_id, i, sum(CASE WHEN q IS NULL OR i > q + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM p),
s AS (SELECT doc_id, g, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY ALL),
l AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS after, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM s),
k AS (SELECT doc_id, string_agg(substr(h, CAST(2 * after + 1 AS INTEGER), CAST(2 * (a - after) AS INTEGER)), '' ORDER BY a) || substr(any_value(h), CAST(2 * max(b) + 1 AS INTEGER)) AS kept, sum(b - a) AS n_removed, count(*) AS n_spans FROM l JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
