"""Byte-level BPE: encoding whole texts by a rank file, and decoding.

Texts of up to CHUNK characters are encoded where they are. Longer ones are cut
into chunks that overlap; the chunks are pre-tokenised in parallel, each from
its own start. The pattern never looks back, so where a boundary of one chunk
is also a boundary of the next, both agree from there on: that is where they
are stitched. A chunk that shares no boundary with its successor inside the
overlap (a single run of letters, say) is joined with it. The pieces between
stitches are then encoded in parallel, each match of the pattern separately,
and put in order. Decoding concatenates the bytes of the ids.

The rank file is read by the driver and broadcast: a vocabulary has a fixed
size of about 1 MB (checked against MOST_RANK_BYTES).

Defined edge cases: a null text is the empty text: no ids; repeated rows each
get their own row, also when they share a doc_id; a null doc_id stays null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Characters of a chunk, and how far it reaches into the next.
CHUNK, OVERLAP = 32_768, 1_024
MOST_RANK_BYTES = 16 << 20


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    size = max(table.values(), default=-1) + 1
    as_bytes, as_text = [b""] * size, [""] * size
    for token, i in table.items():
        as_bytes[i], as_text[i] = token, str(i)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}), as_bytes, as_text


class Vocabulary:
    """A rank file and its pattern, as the executors get them."""

    def __init__(self, spark, path: str, pattern: str):
        ranks = open(path, "rb").read()  # noqa: SIM115
        if len(ranks) > MOST_RANK_BYTES:
            raise ValueError(f"{path} has {len(ranks)} bytes; at most {MOST_RANK_BYTES} are broadcast")
        self.ranks, self.pattern = spark.sparkContext.broadcast(ranks), pattern

    def codec(self):
        return _codec(self.ranks.value, self.pattern)


def boundaries(text: str, pattern: str) -> list[int]:
    """Where matches begin, and the end of the text. The pattern matches every character."""
    return [m.start() for m in regex.finditer(pattern, text)] + [len(text)]


def safe_boundaries(text: str, pattern: str) -> list[int]:
    """Boundaries of a chunk at which a text may be cut. Not the last two, as the end of the chunk cuts its last match short, and
    none behind white space, of which a match takes more where the text ends than where it goes on."""
    return [b for b in boundaries(text, pattern)[:-2] if b and not text[b - 1].isspace()]


def stitches(chunks: list[tuple[int, int, list[int]]], overlap: int) -> list[tuple[int, int]]:
    """Pieces (from, to) of a text from its chunks (start, end, safe boundaries), all counted in the text."""
    out, begin, current = [], 0, chunks[0]
    for nxt in chunks[1:]:
        common = sorted(set(current[2]) & set(nxt[2]) & set(range(nxt[0], nxt[0] + overlap)))
        if common:
            out.append((begin, common[0]))
            begin, current = common[0], nxt
        else:
            current = (current[0], nxt[1], [])  # no boundary of it is known to be right
    return [*out, (begin, chunks[-1][1])]


#: Rows worked on at once: a batch has up to 10,000 texts, whose ids as Python numbers would take hundreds of MB.
ROWS = 200


def _plain(vocabulary: Vocabulary, then):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, as_bytes, as_text = vocabulary.codec()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield then(batch.slice(at, ROWS), encoding, as_bytes, as_text)

    return run


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"


def _digests(batch, encoding, as_bytes, as_text):
    rows = []
    for text in batch.column("text"):
        ids = encoding.encode_ordinary(text.as_py() or "")
        decoded = b"".join([as_bytes[i] for i in ids])
        rows.append((len(ids), hashlib.sha256(",".join([as_text[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(), len(decoded)))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])


def _ids(batch, encoding, as_bytes, as_text):
    """Raises where the ids don't decode to the bytes of the text."""
    found = [np.array(encoding.encode_ordinary(t.as_py() or ""), np.int32) for t in batch.column("text")]
    ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
    sizes = []
    for t, x in zip(batch.column("text"), found, strict=True):
        decoded = b"".join([as_bytes[i] for i in x.tolist()])
        if decoded != (t.as_py() or "").encode():
            raise ValueError("the ids of a text decode to other bytes")
        sizes.append(len(decoded))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("from"), ids, pa.array([len(x) for x in found], pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "piece", "ids", "n_tokens", "n_bytes"])


def _chunks(batches):
    """row (a name for each row), doc_id, start, text: overlapping chunks."""
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            row, t = uuid.uuid4().hex, text.as_py()
            for start in range(0, len(t), CHUNK):
                yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc_id, "start": start, "text": t[start : start + CHUNK + OVERLAP]}], pa.schema([("row", pa.string()), ("doc_id", pa.int64()), ("start", pa.int64()), ("text", pa.string())]))


def _ends(pattern: str):
    """Of each chunk the boundaries near its start and near its end, counted in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, start, text in zip(batch.column("row").to_pylist(), batch.column("start").to_pylist(), batch.column("text").to_pylist(), strict=True):
                near = [start + b for b in safe_boundaries(text, pattern) if b < OVERLAP or b >= CHUNK]
                rows.append({"row": row, "start": start, "end": start + len(text), "near": near})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("row", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("near", pa.list_(pa.int64()))]))

    return run


def _stitched(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    rows = sorted((r["start"], r["end"], r["near"]) for r in table.to_pylist())
    pieces = stitches(rows, OVERLAP)
    return pa.table({"row": [key[0].as_py()] * len(pieces), "from": pa.array([p[0] for p in pieces], pa.int64()), "to": pa.array([p[1] for p in pieces], pa.int64())})


def _cut(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The text of one piece from the chunks that it lies in."""
    rows, out = sorted(table.to_pylist(), key=lambda r: r["start"]), []
    at, end = rows[0]["from"], rows[0]["to"]
    for r in rows:
        out.append(r["text"][at - r["start"] : end - r["start"]])
        at += len(out[-1])
    return pa.table({"row": [key[0].as_py()], "doc_id": pa.array([rows[0]["doc_id"]], pa.int64()), "from": pa.array([key[1].as_py()], pa.int64()), "text": ["".join(out)]})


def long_pieces(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """row, doc_id, from, text: the pieces of long texts."""
    chunks = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_chunks, "row string, doc_id long, start long, text string").repartition("row", "start"), "bpe-chunks")
    ends = chunks.select("row", "start", "text").mapInArrow(_ends(vocabulary.pattern), "row string, start long, end long, near array<long>")
    pieces = ends.groupBy("row").applyInArrow(_stitched, "row string, from long, to long")
    reach = F.explode(F.sequence(F.floor(F.greatest(F.col("from") - OVERLAP, F.lit(0)) / CHUNK), F.floor((F.col("to") - 1) / CHUNK)))
    near = pieces.withColumn("k", reach).withColumn("start", F.col("k") * CHUNK).join(chunks, ["row", "start"]).select("row", "doc_id", "start", "text", "from", "to")
    return near.groupBy("row", "from").applyInArrow(_cut, "row string, doc_id long, from long, text string")


def _stream(batches):
    """Rows sorted by (row, from): one digest a text, a piece at a time."""
    now = None

    def done():
        return pa.RecordBatch.from_pylist([{"doc_id": now[1], "n_tokens": now[2], "ids_sha256": now[3].hexdigest(), "decoded_sha256": now[4].hexdigest(), "n_bytes": now[5]}], pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_bytes", pa.int64())]))

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now[0] != r["row"]:
                if now is not None:
                    yield done()
                now = [r["row"], r["doc_id"], 0, hashlib.sha256(), hashlib.sha256(), 0]
            if r["n"]:
                now[3].update((b"," if now[2] else b"") + r["ids"].encode())
            now[2] += r["n"]
            now[4].update(r["decoded"])
            now[5] += len(r["decoded"])
    if now is not None:
        yield done()


def _encoded(batch, encoding, as_bytes, as_text):
    found = [encoding.encode_ordinary(t.as_py() or "") for t in batch.column("text")]
    return pa.RecordBatch.from_arrays([
        batch.column("row"), batch.column("doc_id"), batch.column("from"), pa.array([len(x) for x in found], pa.int64()),
        pa.array([",".join([as_text[i] for i in x]) for x in found], pa.string()), pa.array([b"".join([as_bytes[i] for i in x]) for x in found], pa.binary()),
    ], ["row", "doc_id", "from", "n", "ids", "decoded"])


def _split(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts of up to CHUNK characters (and null), and the longer ones."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    return d.where(size <= CHUNK), d.where(size > CHUNK)


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes for each row of docs."""
    short, long = _split(docs)
    one = short.mapInArrow(_plain(vocabulary, _digests), DIGEST)
    pieces = long_pieces(long, vocabulary).mapInArrow(_plain(vocabulary, _encoded), "row string, doc_id long, from long, n long, ids string, decoded binary")
    return one.unionByName(pieces.repartition("row").sortWithinPartitions("row", "from").mapInArrow(_stream, DIGEST))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, piece (where the piece begins in the text), ids, n_tokens, n_bytes (of what they decode to, which is compared with the text). A text's ids are those of its pieces in order; most texts are one piece."""
    short, long = _split(docs)
    pieces = short.select("doc_id", F.lit(0).cast("long").alias("from"), "text").unionByName(long_pieces(long, vocabulary).select("doc_id", "from", "text"))
    return pieces.mapInArrow(_plain(vocabulary, _ids), "doc_id long, piece long, ids array<int>, n_tokens long, n_bytes long")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, piece, bytes for rows of encode(). A piece may end inside a character; whole texts don't."""

    def run(batch, encoding, as_bytes, as_text):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("piece"), pa.array([b"".join([as_bytes[i] for i in x]) for x in batch.column("ids").to_pylist()], pa.binary())], ["doc_id", "piece", "bytes"])

    return encoded.select("doc_id", "piece", "ids").mapInArrow(_plain(vocabulary, run), "doc_id long, piece long, bytes binary")
