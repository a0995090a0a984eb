"""Operator 6: WARC archives, written and read as streams of payload chunks.

Writing: equal payloads of a minimum size keep one ``response`` record, the others
become ``revisit`` records.  Which is decided on digests alone, so the pages meet the
decision in one join and go to the archives from there.  Every task writes its own
gzip-member-per-record archive under the shared folder, in blocks, under a name that
no other attempt uses; the files of attempts that were not kept are never named in
the result and so never read.

Reading: an archive becomes rows ``(record, chunk number, bytes)`` of bounded size,
each carrying the SHA-1 of the payload so far, so no reader ever holds a record.
Python is used for the byte format; payload digests for the decision are built-in.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, small_batches, stash, table

BLOCK = 1 << 16
CRLF = b"\r\n"


def filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def decisions(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``digest, n_bytes, winner``: for each payload that several records share, the record that holds it."""
    return (
        pages.where(F.octet_length("payload") >= min_bytes)
        .groupBy(F.sha2("payload", 256).alias("digest"))
        .agg(F.max("record_id").alias("winner"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("digest", "winner")
    )


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 1000) -> DataFrame:
    """Write ``record_id, uri, payload`` (string or binary) rows; returns the written table ``path, records``.

    Null payloads are empty.  Of equal payloads of ``min_bytes`` or more the one with
    the largest record id is the response; the others are revisits of it, which
    have no payload of their own but carry its digest and length.  Null record ids are
    written as records of their own with an empty id and never merged.
    """
    pages = small_batches(pages).select(
        F.col("record_id").cast("long"), F.col("uri").cast("string"), F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload")
    )
    shared = stash(decisions(pages.where(F.col("record_id").isNotNull()), min_bytes), "warc-shared")
    own = F.concat(F.lit("own "), F.xxhash64("record_id", "uri").cast("string"))  # matches nothing, and spreads these rows
    key = F.when((F.octet_length("payload") >= min_bytes) & F.col("record_id").isNotNull(), F.sha2("payload", 256)).otherwise(own)
    dealt = (
        pages.withColumn("digest", key)
        .join(shared, "digest", "left")
        .select(
            "record_id", "uri", "payload",
            F.when(F.col("winner") != F.col("record_id"), F.col("winner")).alias("refers_to"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        path, out, records = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("record_id", "uri", "payload", "refers_to"))):
                if out is None:
                    out = fs.open_output_stream(path)
                rid, uri, payload, refers = row[0].as_py(), row[1].as_py(), memoryview(row[2].as_buffer()), row[3].as_py()
                write_record(out, rid, uri, payload, refers)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

    return stash(dealt.mapInArrow(run, "path string, records long"), "warc-files")


def write_record(out, rid: int | None, uri: str | None, payload: memoryview, refers: int | None) -> None:
    """One gzip member: headers, blank line, the payload in blocks (none for a revisit), two line ends."""
    sha = hashlib.sha1()
    for a in range(0, len(payload), BLOCK):
        sha.update(payload[a : a + BLOCK])
    name = lambda i: f"<urn:record:{'' if i is None else i}>"
    head = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": name(rid),
        "WARC-Target-URI": " ".join((uri or "").split()),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{sha.hexdigest()}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": str(len(payload) if refers is None else 0),
    }
    if refers is not None:
        head["WARC-Refers-To"] = name(refers)
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    out.write(z.compress(("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode()))
    if refers is None:
        for a in range(0, len(payload), BLOCK):
            out.write(z.compress(payload[a : a + BLOCK]))
    out.write(z.compress(CRLF + CRLF))
    out.write(z.flush())


class Reader:
    """Decompressed bytes of an archive of many gzip members, a block at a time."""

    def __init__(self, stream):
        self.stream, self.z, self.have, self.raw = stream, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(BLOCK)
                if not self.raw:
                    return False
            got = self.z.decompress(self.raw, BLOCK)
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            else:
                self.raw = self.z.unconsumed_tail
            if got:
                self.have += got
                return True

    def line(self) -> bytes | None:
        while (at := self.have.find(CRLF)) < 0:
            if not self.more():
                return None
        out, self.have = self.have[:at], self.have[at + 2 :]
        return out

    def body(self, n: int, chunk: int) -> Iterator[bytes]:
        while n:
            while len(self.have) < min(n, chunk) and self.more():
                pass
            got, self.have = self.have[: min(n, chunk)], self.have[min(n, chunk) :]
            if not got:
                raise EOFError("archive ends inside a record")
            n -= len(got)
            yield got


CHUNKS = (
    "record_id long, record_type string, refers_to long, uri string, payload_length long, payload_digest string, "
    "chunk_no long, chunk binary, digest_so_far string, is_last boolean"
)


def read_warc(files: DataFrame, folder: str, chunk_bytes: int = 1 << 20) -> DataFrame:
    """The chunked record table of the archives named by ``files.path``.

    One row per chunk of at most ``chunk_bytes``; a record without payload has one row
    with an empty chunk.  ``digest_so_far`` is the SHA-1 of the payload up to and with
    this chunk, so on a response's last chunk it must equal ``payload_digest``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        rows, held = [], 0
        schema = pa.schema([
            ("record_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("payload_length", pa.int64()),
            ("payload_digest", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("digest_so_far", pa.string()), ("is_last", pa.bool_()),
        ])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with fs.open_input_stream(path) as stream:
                    for row in chunks(Reader(stream), chunk_bytes):
                        rows.append(row)
                        held += len(row[7])
                        if held >= 1 << 22 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    lanes = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(lanes).mapInArrow(run, CHUNKS)


def chunks(reader: Reader, chunk_bytes: int) -> Iterator[tuple]:
    number = lambda s: int(x) if s and (x := s[len("<urn:record:") : -1]) else None
    while (line := reader.line()) is not None:
        if not line.startswith(b"WARC/"):
            raise ValueError("no record starts here")
        head = {}
        while line := reader.line():
            k, _, v = line.decode().partition(": ")
            head[k] = v
        n, sha, no = int(head["Content-Length"]), hashlib.sha1(), 0
        fixed = (
            number(head["WARC-Record-ID"]), head["WARC-Type"], number(head.get("WARC-Refers-To")), head["WARC-Target-URI"],
            int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"),
        )
        for chunk in reader.body(n, chunk_bytes) if n else [b""]:
            sha.update(chunk)
            n -= len(chunk)
            yield (*fixed, no, chunk, sha.hexdigest(), n == 0)
            no += 1
        reader.line(), reader.line()


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest columns read back from the archives; of a revisit, from the record it refers to in its own headers."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("record_id"), F.col("url").alias("uri"), F.col("html").alias("payload"))
    folder = f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    back = read_warc(write_warc(pages, folder), folder).where("is_last")
    return back.select(
        F.col("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.when(F.col("record_type") == "response", F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  max(page_id) OVER (PARTITION BY html) AS winner FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND winner <> page_id THEN winner END AS refers_to
FROM d
"""
}
