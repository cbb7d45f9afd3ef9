"""WARC archives of individually compressed records with a Zstandard dictionary.

Each archive starts with a skippable frame that holds the dictionary, built from the records that
follow; each record is a frame of its own, compressed with it.  Pages with equal payloads are stored
once: the one with the largest id as a response, the others as revisits that refer to it.

Archives go through Spark's own text writer, one row to a file, and come back through its binary
reader, so they lie wherever Spark can write and a lost task leaves nothing behind.  The line end
that the text writer adds is an empty skippable frame, which Zstandard readers pass over.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: The skippable frame that carries a dictionary, all such frames (the last four bits
#: are free), an empty one as text, and the WARC version line.
DICTIONARY_MAGIC, SKIPPABLE_MAGIC, EMPTY_FRAME, VERSION = 0x184D2A5D, 0x184D2A50, "P*M\x18\0\0\0\0", b"WARC/1.1"
#: Payload bytes of an archive, size of a dictionary, and from which size equal payloads are revisits.
ARCHIVE_BYTES, DICTIONARY_BYTES, REVISIT_BYTES = 16 << 20, 64 << 10, 1000

_READ = 1 << 14

_FIELDS = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, target_uri string, stored_bytes long"


def _record(page: str | None, url: str | None, html: bytes, refers_to: str | None) -> bytes:
    digest = hashlib.sha1(html).hexdigest()
    body = b"" if refers_to is not None else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + html
    lines = [
        VERSION,
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: <urn:uuid:" + str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page}|{digest}")).encode() + b">",
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"X-Payload-Length: " + str(len(html)).encode(),
        b"Content-Type: application/http; msgtype=response",
    ]
    if page is not None:
        lines.append(b"X-Page-ID: " + page.encode())
    if url is not None:
        lines.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        lines += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"X-Refers-To-Page: " + refers_to.encode()]
    lines.append(b"Content-Length: " + str(len(body)).encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the records of an archive; their joined beginnings where they are too few
    or too alike for training."""
    if len(records) >= 16:
        try:
            return zstandard.train_dictionary(size, records, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(x[:2048] for x in records)[-size:]


def write_archive(records: list[bytes]) -> bytes:
    """The bytes of one archive."""
    known = build_dictionary(records)
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(known)) if known else zstandard.ZstdCompressor(level=3)
    head = struct.pack("<II", DICTIONARY_MAGIC, len(known)) + known
    return head + b"".join(packer.compress(x) for x in records)


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, body and stored size of each record; damage raises ValueError."""
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    size = struct.unpack("<I", data[4:8])[0]
    known, at = data[8 : 8 + size], 8 + size
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known)) if known else zstandard.ZstdDecompressor()
    while at < len(data):
        if len(data) - at >= 8 and struct.unpack("<I", data[at : at + 4])[0] & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            at += 8 + struct.unpack("<I", data[at + 4 : at + 8])[0]
            continue
        step, got, start = opener.decompressobj(), [], at
        while not step.eof:  # a frame does not say where it ends
            if at >= len(data):
                raise ValueError("a record is cut off")
            got.append(step.decompress(data[at : at + _READ]))
            at += _READ
        at = min(at, len(data)) - len(step.unused_data)
        raw = b"".join(got)
        head, _, body = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        if lines[0] != VERSION:
            raise ValueError("not a WARC record")
        fields = dict(x.decode().split(": ", 1) for x in lines[1:])
        yield fields, body[: int(fields["Content-Length"])], at - start


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([write_archive(records)], pa.binary())], ["archive"])

    held, size = [], 0
    for batch in batches:
        for page, url, html, refers in zip(*(batch.column(i) for i in range(4))):
            body = (html.as_py() or "").encode()
            if held and size + len(body) > ARCHIVE_BYTES:
                yield closed(held)
                held, size = [], 0
            held.append(_record(page.as_py(), url.as_py(), body, refers.as_py()))
            size += len(body)
    if held:
        yield closed(held)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, content) of the archives in a folder."""
    return spark.read.format("binaryFile").load(folder).select("path", "length", "content")


def write_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record for each page into archives in ``folder``, a path of any file system that
    Spark writes to; returns them as ``archives`` does.

    Null html counts as empty.  Payloads of under 1000 bytes are always responses.  Of equal larger
    payloads the one with the largest id is the response; a null id is the smallest, and of several
    rows with that id (ties, repeated rows) each is a response.  A very long page is one record.  An
    empty table writes no archive; other columns, whatever their names, are not written.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha2(F.col("html").cast("binary"), 256)))
    first = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.max("page").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = C.to_table(first.select(F.col("digest").alias("_digest"), "first"), "warc-first")
    # small pages have no digest and match nothing: a key of their own keeps them apart
    rows = rows.withColumn("digest", F.coalesce("digest", F.xxhash64("page", "url").cast("string")))
    joined = rows.join(first, F.col("digest") == F.col("_digest"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    out = joined.select(F.col("page").cast("string"), "url", "html", refers.alias("refers_to")).mapInArrow(_archives, "archive binary")
    with C.tidy(spark):
        out.select(F.col("archive").cast("string")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)
    C.free(first)
    return archives(spark, folder)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _FIELDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))):
            rows = []
            for fields, body, used in read_archive(data):
                kind = fields["WARC-Type"]
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                if kind == "response":
                    payload = body.partition(b"\r\n\r\n")[2]
                    if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                        raise ValueError(f"{path}: a payload differs from its digest")
                rows.append((fields.get("X-Page-ID"), size, digest, kind, fields.get("X-Refers-To-Page"), fields.get("WARC-Target-URI"), used))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)


def read_pages(found: DataFrame, id_type: str = "long") -> DataFrame:
    """One row for each record of ``archives``, checked against its digest: ids as ``id_type``, null
    where a record has none.  Repeated records each give a row, an empty file none; damage raises
    ValueError, wherever it is.  An archive is read in one piece, so its size bounds the memory.
    """
    rows = found.where("length > 0").select("path", "content").mapInArrow(_reader, _FIELDS)
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))
