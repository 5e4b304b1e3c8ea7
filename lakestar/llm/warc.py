"""WARC archives as a table of record chunks, written, read back and checked as a stream.

A record's payload is cut into chunks of bounded size; a chunk is a row (record id, chunk number, the
bytes, the digest of the payload up to its end). Nothing after the cut holds a whole payload: the
writer sends every chunk to the archive as a record of its own (WARC 1.1 segmentation: the first has
the record's type, the others are `continuation`), and the reader checks the chunks in order with one
running digest per record.

Archives are written and read by Spark's own text files, so any store that Spark reaches will do, and
a lost task is simply run again. A file is cut into records at the line of the next record's version;
the writer ends a chunk inside any payload that holds such a line, so a payload never looks like a
record. Files are compressed, each as large as what one task writes.

Of records with equal payloads of at least `least` bytes the one with the smallest id is a response,
the others are revisits, which carry the digest and the id of that response instead of the payload.

Defined results: every row is a record, repeated rows too, with a name of its own: the id, the digest of the
payload and a number that no other row has. A null payload is an empty one. A row without an id is a
response, as it cannot be smaller than another. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a chunk at most, and the smallest payload that a revisit stands for.
CHUNK, LEAST = 1 << 20, 100
END, VERSION = "\r\n\r\n", "WARC/1.1\r\n"
BOUNDARY = (END + VERSION).encode()


def cuts(payload: memoryview, size: int | None = None) -> Iterator[memoryview]:
    """Chunks of a UTF-8 payload: whole characters, and no chunk holds the boundary of records."""
    at = 0
    while True:
        end = min(at + (size or CHUNK), len(payload))
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end -= 1
        # With the line ends around it a chunk must not read as a boundary either; one is cut in two
        # after its first eight bytes, four of which are line ends that may not be the payload's.
        found = (END.encode() + bytes(payload[at:end]) + END.encode()).find(BOUNDARY)
        if found >= 0:
            end = at + found + 4
        yield payload[at:end]
        at = end
        if at >= len(payload):
            return


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        payloads = batch.column(2).cast(pa.binary())
        for i, (id, origin, first, copy) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)))):
            view = memoryview(payloads[i].as_buffer())
            if first is not None:
                rows.append((id, origin, copy, 0, True, "", origin, len(view), first))
                continue
            running, done = hashlib.sha256(), 0
            for number, piece in enumerate(cuts(view)):
                running.update(piece)
                done += len(piece)
                text = str(piece, "utf-8")
                rows.append((id, origin, copy, number, done == len(view), text, running.hexdigest(), done, None))
                held += len(piece)
                if held > 4 * CHUNK:
                    yield _rows(rows)
                    rows, held = [], 0
        if rows:
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["id", "origin", "copy", "chunk", "last", "payload", "digest", "bytes", "first"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def named(records: DataFrame, id: str = "page_id", payload: str = "html") -> DataFrame:
    """`id`, `origin` (what tells payloads of one id apart: their digest) and `payload`."""
    whole = F.coalesce(F.col(payload), F.lit(""))
    rows = records.select(F.col(id).cast("long").alias("id"), whole.alias("payload"))
    return rows.select("id", F.sha2(F.col("payload").cast("binary"), 256).alias("origin"), "payload")


def chunk_table(records: DataFrame) -> DataFrame:
    """`named` records as chunks: `id`, `origin`, `copy` (what tells equal rows apart), `chunk`, `last`, `payload`,
    and, of the payload up to here, `digest` and `bytes`. A record with `first`, the id of an equal one, is a single row without
    payload that has the digest and the bytes of the whole."""
    kinds = "id long, origin string, copy long, chunk long, last boolean, payload string, digest string, bytes long, first long"
    copy = F.monotonically_increasing_id().alias("copy")
    return records.select("id", "origin", "payload", "first", copy).mapInArrow(_chunked, kinds)


def _page(id: Column) -> Column:
    """What rows of equal id and payload have in common."""
    return F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("none")), F.col("origin"))


def record_name(chunk: Column) -> Column:
    name = F.concat_ws(":", F.lit("urn:record"), _page(F.col("id")), F.col("copy").cast("string"), chunk.cast("string"))
    return F.concat(F.lit("<"), name, F.lit(">"))


def target(id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), _page(id))


def write_warc(
    records: DataFrame, path: str, id: str = "page_id", payload: str = "html", least: int = LEAST
) -> None:
    """Writes the archive of `records` to the folder `path`."""
    records = named(records, id, payload)
    # Rows of equal digest: the smallest id is the response. Only digests that repeat matter.
    narrow = records.select("id", "origin").where(F.octet_length("payload") >= least)
    firsts = narrow.groupBy("origin").agg(F.min("id").alias("first"), F.max("id").alias("other"))
    firsts = firsts.where("first < other").drop("other")
    again = narrow.join(firsts, "origin").where("id <> first").distinct()

    marked = records.join(again, ["id", "origin"], "left")
    chunks = chunk_table(marked)
    whole, again = F.lit(0), F.col("first").isNotNull()

    def fields(*pairs) -> Column:
        lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")) for name, value in pairs]
        return F.concat(F.lit(VERSION), *lines, F.lit("\r\n"))

    kind = F.when(F.col("chunk") == 0, F.lit("response")).otherwise(F.lit("continuation"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    segment = F.concat(
        fields(
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_name(F.col("chunk"))),
            ("WARC-Target-URI", target(F.col("id"))),
            ("WARC-Segment-Origin-ID", record_name(whole)),
            ("WARC-Segment-Number", F.col("chunk") + 1),
            ("WARC-Segment-Last", F.col("last")),
            ("WARC-Prefix-Digest", digest),
            ("WARC-Prefix-Length", F.col("bytes")),
            ("Content-Length", F.octet_length("payload")),
        ),
        F.col("payload"),
    )
    revisit = fields(
        ("WARC-Type", F.lit("revisit")),
        ("WARC-Record-ID", record_name(whole)),
        ("WARC-Target-URI", target(F.col("id"))),
        ("WARC-Refers-To-Target-URI", target(F.col("first"))),
        ("WARC-Payload-Digest", digest),
        ("WARC-Payload-Length", F.col("bytes")),
        ("Content-Length", whole),
    )
    lines = chunks.select(F.when(again, revisit).otherwise(segment).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of an archive: `id`, `origin`, `copy`, `type`, `chunk`, `last`, `payload`, and, as the headers
    state them, `digest`, `bytes` and `refers_to`."""
    lines = spark.read.option("lineSep", BOUNDARY.decode()).text(path).where("value <> ''")
    split = lines.select(
        F.substring_index("value", END, 1).alias("head"),
        F.col("value").substr(F.instr("value", END) + len(END), F.length("value")).alias("rest"),
    )

    def field(name: str, pattern: str = r"([^\r]*)") -> Column:
        found = F.regexp_extract("head", rf"(?:^|\n){name}: {pattern}", 1)
        return F.when(found != "", found)

    size = field("Content-Length").cast("long")
    # The last record of a file still has the line ends that follow it.
    payload = F.when(F.octet_length("rest") == size, F.col("rest")).otherwise(
        F.expr(f"left(rest, length(rest) - {len(END)})")
    )
    record = r"<urn:record:(-?\d+|none):"
    return split.select(
        F.nullif(field("WARC-Record-ID", record), F.lit("none")).cast("long").alias("id"),
        field("WARC-Record-ID", record.replace("(", "(?:") + r"([0-9a-f]*)").alias("origin"),
        field("WARC-Record-ID", r"[^\r]*:(\d+):\d+>").cast("long").alias("copy"),
        field("WARC-Type").alias("type"),
        (F.coalesce(field("WARC-Segment-Number").cast("long"), F.lit(1)) - 1).alias("chunk"),
        F.coalesce(field("WARC-Segment-Last") == "true", F.lit(True)).alias("last"),
        payload.alias("payload"),
        field("WARC-(?:Prefix|Payload)-Digest", "sha256:([0-9a-f]+)").alias("digest"),
        field("WARC-(?:Prefix|Payload)-Length").cast("long").alias("bytes"),
        field("WARC-Refers-To-Target-URI", r"urn:page:(-?\d+):").cast("long").alias("refers_to"),
    )


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs along the chunks of each record, in order, with one digest and one count."""
    key, running, done, number = None, hashlib.sha256(), 0, 0
    for batch in batches:
        out: list[tuple] = []
        payloads = batch.column("payload").cast(pa.binary())
        names = ("id", "origin", "copy", "type", "chunk", "last", "digest", "bytes", "refers_to")
        rows = zip(*(batch.column(c).to_pylist() for c in names))
        for i, (id, origin, copy, kind, chunk, last, digest, size, refers) in enumerate(rows):
            if kind == "revisit":
                out.append((id, size, digest, "revisit", refers))
                continue
            if (id, origin, copy) != key:
                key, running, done, number = (id, origin, copy), hashlib.sha256(), 0, 0
            piece = memoryview(payloads[i].as_buffer())
            running.update(piece)
            done += len(piece)
            if chunk != number or done != size or running.hexdigest() != digest:
                raise ValueError(f"record {id}: chunk {chunk} is missing, doubled or damaged")
            number += 1
            if last:
                out.append((id, done, digest, "response", None))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "bytes", "digest", "type", "refers_to"]
        )


def check_warc(chunks: DataFrame) -> DataFrame:
    """One row per record of `read_warc`: `id`, `bytes`, `digest`, `type`, `refers_to`; every digest
    is computed anew from the chunks, and a chunk that does not fit is an error."""
    kinds = "id long, bytes long, digest string, type string, refers_to long"
    # Records of one chunk need no other row; only the chunks of longer ones are brought together.
    single = F.expr("chunk = 0 and last")
    record = ["id", "origin", "copy"]
    several = chunks.where(~single).repartition(*record).sortWithinPartitions(*record, "chunk")
    return chunks.where(single).mapInArrow(_checked, kinds).union(several.mapInArrow(_checked, kinds))
