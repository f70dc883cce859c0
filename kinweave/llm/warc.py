"""WARC archives: a writer of response and revisit records, and a reader that verifies record boundaries by their chain.

Writing. Each row becomes one record; of rows with equal payloads the one with
the largest id is the response and the others are revisits of it, without a
payload. Files are written by Spark's own text writer with the record end as
line separator, so that its committer guards against lost executors.

Reading. Spark's text source splits the files at the record magic, in parallel
and at any split boundary. A magic may stand inside a payload, so each fragment
is only a candidate. For each split a task emits the candidates with the offset
that follows by their own Content-Length. From the offset at which the chain
enters a split its exit is known for every candidate; pointer jumping over
these (entry, exit) pairs from offset 0 of each file finds the true entries in
log2(splits of a file) rounds, and only records on the chain are kept. Records
whose payload holds a magic span fragments; they are put together again from
the fragments between their offset and the next.

A candidate whose length reaches beyond its file isn't one. Sizes and digests are
those of the bytes read; a response whose digest isn't the one in its header
raises. A revisit holds no payload: its size is that of the response that it
refers to, which must have the digest that the revisit states.

Memory: a task holds the metadata of one split and one record's payload.

Defined edge cases: a null html is an empty payload; repeated rows (equal ids
and payloads) are one response each; a null id gives a record with an empty
Kinweave-Id, is never a revisit, and reads as null; an empty table gives no files
and no rows.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import delete_path, discard, fresh_path, materialize

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Records of a split whose payload is larger than a block of this size are found by the blocks they cover.
BLOCK = 1 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digits: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 5 digits are 4 letters."""
    letter = lambda v, shift: F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    part = lambda i: F.conv(F.substring(hex_digits, 5 * i + 1, 5), 16, 10).cast("int")
    return F.concat(*[letter(part(i), shift) for i in range(8) for shift in (15, 10, 5, 0)])


def _bytes(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes a record for each row of pages (page_id, url, html). Payloads of fewer than min_bytes bytes are never revisits."""
    d = pages.select("page_id", "url", "html").withColumn("bytes", F.octet_length(F.coalesce("html", F.lit("")))).withColumn("digest", base32(F.sha1(_bytes(F.col("html")))))
    groups = d.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeats = materialize(groups, "warc-repeats")  # the planner then knows its size
    target = F.when((F.col("bytes") >= min_bytes) & (F.col("first") != F.col("page_id")), F.col("first"))
    d = d.join(repeats, "digest", "left").withColumn("refers_to", target)
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    head = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"), F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">\r\nContent-Type: text/html; charset=utf-8"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nKinweave-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.when(F.col("refers_to").isNull(), "").otherwise(F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nKinweave-Refers-To: "), F.col("refers_to").cast("string"))),
        F.lit("\r\nContent-Length: "), F.when(F.col("refers_to").isNull(), F.col("bytes")).otherwise(0).cast("string"), F.lit("\r\n\r\n"),
    )
    d.select(F.concat(head, F.when(F.col("refers_to").isNull(), F.coalesce("html", F.lit(""))).otherwise("")).alias("value")).write.option("lineSep", END).text(path)
    discard(repeats)


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """value (binary), file, split (its first byte), file_size: what stands between magics, in order within a split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("file_size"))


def _parse(value: bytes, most: int) -> dict | None:
    """The header fields of a record whose block has at most `most` bytes; None if this is no such record."""
    head, found, _ = value.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, rest = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = rest.strip()
    length = fields.get(b"content-length", b"")
    # the number of digits first: int() refuses very long ones
    length = length.lstrip(b"0") or length[:1]
    if not length.isdigit() or len(length) > len(str(most)) or int(length) > most:
        return None
    return fields | {b"head": len(head) + 4, b"length": int(length)}


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


CANDIDATE = pa.schema([("file", pa.string()), ("split", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("head", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("id", pa.string()), ("refers", pa.string()), ("stated", pa.string()), ("digest", pa.string())])


def _candidates(batches):
    """For each fragment: its offset within the bytes of its split, and the header fields if it reads as a record. The digest is there if the payload lies within the fragment."""
    place, at, magic = None, 0, len(MAGIC)
    for batch in batches:
        out = []
        for value, file, split, most in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if (file, split) != place:
                place, at = (file, split), 0
            v = value.as_py()
            f = _parse(v, most) if v else None
            row = dict.fromkeys(CANDIDATE.names) | {"file": file, "split": split, "at": at, "size": len(v)}
            if f:
                text = lambda k: f.get(k, b"").decode("utf-8", "replace")  # noqa: B023, E731
                end = f[b"head"] + f[b"length"]
                row |= {"head": f[b"head"], "length": f[b"length"], "type": text(b"warc-type"), "id": text(b"kinweave-id"), "refers": text(b"kinweave-refers-to"), "stated": text(b"warc-payload-digest").removeprefix("sha1:"), "digest": digest_of(v[f[b"head"] : end]) if end <= len(v) else None}
            out.append(row)
            at += len(v) + magic
        yield pa.RecordBatch.from_pylist(out, CANDIDATE)


def _exits(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each candidate of one split: the first offset of its chain that lies outside the split. Offsets are of the magic."""
    at, step = table["start"].to_pylist(), table["next"].to_pylist()
    exits: dict[int, int | None] = {}
    for a, n in sorted(zip(at, step, strict=True), reverse=True):  # successors come first
        exits[a] = None if n is None else exits.get(n, n)
    return pa.table({"file": pa.array([key[0].as_py()] * len(at)), "entry": pa.array(list(exits), pa.int64()), "exit": pa.array(list(exits.values()), pa.int64())})


def _walk(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The records of one split that the chain passes, from the entries known to be on it."""
    rows = {r["start"]: r for r in table.to_pylist()}
    kept, now = [], min((r["entry"] for r in rows.values() if r["entry"] is not None), default=None)
    while now in rows and rows[now]["next"] is not None:
        kept.append(rows[now])
        now = rows[now]["next"]
    return pa.Table.from_pylist(kept, table.schema).drop(["entry"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, start, next, type, id, refers, length (bytes of the payload that the archive holds), stated (the digest in the header), digest (of that payload) for each record on the chain of its file."""
    found = materialize(fragments(spark, path).mapInArrow(_candidates, _ddl(CANDIDATE)), "warc-candidates")
    magic = len(MAGIC)
    # a split's fragments begin where those of the splits before it end
    sizes = found.groupBy("file", "split").agg(F.sum(F.col("size") + magic).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    bases = sizes.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0).cast("long")).alias("base"))
    # a fragment at 0 is what stands before the first magic; the others stand behind the magic that begins at their offset less its length
    placed = found.join(bases, ["file", "split"]).withColumn("start", F.col("base") + F.col("at") - magic)
    placed = placed.withColumn("next", F.when(F.col("start") >= 0, F.col("start") + magic + F.col("head") + F.col("length") + len(END)))
    placed = materialize(placed.select("file", "split", "start", "size", "head", "length", "next", "type", "id", "refers", "stated", "digest"), "warc-placed")
    candidates = placed.where("next is not null")
    jumps = materialize(candidates.groupBy("file", "split").applyInArrow(_exits, "file string, entry long, exit long"), "warc-jumps")
    reached = candidates.where("start = 0").select("file", F.col("start").alias("entry"))
    n, old = reached.count(), -1
    while n != old:
        further = reached.join(jumps, ["file", "entry"]).select("file", F.col("exit").alias("entry")).join(jumps.select("file", "entry"), ["file", "entry"], "left_semi")
        reached = materialize(reached.union(further).distinct(), "warc-reached")
        old, n = n, reached.count()
        if n != old:
            on = jumps.alias("a").join(jumps.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.exit") == F.col("b.entry")), "left")
            jumps = materialize(on.select("a.file", "a.entry", F.coalesce("b.exit", "a.exit").alias("exit")), "warc-jumps")
    entered = candidates.join(reached.select("file", F.col("entry").alias("start"), F.col("entry")), ["file", "start"], "left")
    entered = entered.select("file", "split", "start", "next", "head", "length", "type", "id", "refers", "stated", "digest", "entry")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entered.schema if f.name != "entry")
    chain = materialize(entered.groupBy("file", "split").applyInArrow(_walk, schema), "warc-chain")
    whole = chain.where("digest is not null")
    cut = chain.where("digest is null")
    if not cut.isEmpty():
        whole = whole.unionByName(_put_together(fragments(spark, path), placed, bases, cut))
    return whole.select("file", "start", "next", "type", "id", "refers", "length", "stated", "digest")


def _put_together(pieces: DataFrame, placed: DataFrame, bases: DataFrame, cut: DataFrame) -> DataFrame:
    """The digests of records whose payload holds magics, from all fragments between their start and the next record."""
    numbered = pieces.mapInArrow(_offsets, "file string, split long, at long, value binary").join(bases, ["file", "split"]).withColumn("from", F.col("base") + F.col("at") - len(MAGIC))
    spans = cut.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("next") - 1) / BLOCK))))
    held = numbered.withColumn("block", F.floor(F.col("from") / BLOCK)).join(spans.select("file", "block", "start", "next", "head", "length"), ["file", "block"])
    held = held.where((F.col("from") >= F.col("start")) & (F.col("from") < F.col("next"))).select("file", "start", "from", "value", "head", "length")
    digests = held.groupBy("file", "start").applyInArrow(_joined, "file string, start long, digest string")
    return cut.drop("digest").join(digests, ["file", "start"])


def _offsets(batches):
    place, at, magic = None, 0, len(MAGIC)
    for batch in batches:
        offsets = []
        for size, file, split in zip(pc.binary_length(batch.column(0)).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (file, split) != place:
                place, at = (file, split), 0
            offsets.append(at)
            at += size + magic
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(offsets, pa.int64()), batch.column(0)], ["file", "split", "at", "value"])


def _joined(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    parts = table.sort_by("from")
    body = MAGIC.encode().join(parts["value"].to_pylist())
    head, length = parts["head"][0].as_py(), parts["length"][0].as_py()
    return pa.table({"file": [key[0].as_py()], "start": pa.array([key[1].as_py()], pa.int64()), "digest": [digest_of(body[head : head + length])]})


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages to archives, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write(pages, path, min_bytes)
    found = materialize(records(spark, path), "warc-records")
    delete_path(spark, path)
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    found = found.select(number("id").alias("page_id"), "length", "stated", "digest", F.col("type").alias("record_type"), number("refers").alias("refers_to"))
    responses = found.where("record_type = 'response'")
    digest = F.when(F.col("stated") == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload of another digest than stated, id "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))))
    first = responses.select("page_id", F.col("length").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")
    # a payload that very many revisits refer to is one row here, and Spark splits the other side
    targets = responses.select(F.col("page_id").alias("refers_to"), F.col("digest").alias("stated"), F.col("length").alias("payload_bytes")).distinct()
    revisits = found.where("record_type = 'revisit'").drop("length", "digest").join(targets, ["refers_to", "stated"], "left")
    known = F.coalesce("payload_bytes", F.raise_error(F.lit("a revisit refers to no response of its digest")).cast("long"))
    return first.unionByName(revisits.select("page_id", known.alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('{BASE32}', ((CAST('0x' || substr(x, CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER) >> s) & 31) + 1, 1)), '')), '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM m
"""
