"""WARC archives: monolithic gzip in, one gzip member a record and an offset index out."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import octets, rows_of
from velotide.llm.shared import create_folder, new_name, open_sink, open_source
from velotide.sources.scratch import materialize, scratch_path

# Payloads smaller than this are never replaced by a reference.
LEAST_REVISITED = 100
# Uncompressed bytes after which a task starts a new file.
FILE_BYTES = 256 << 20
_LEVEL = 4
_DATE = "1970-01-01T00:00:00Z"
_URN = "urn:velotide:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 18
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, length: int) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        head.insert(3, f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def inflated(source, chunk: int = _READ) -> Iterator[bytes]:
    """The bytes of a gzip file of any number of members, inflated once, piece by piece."""
    unzip = zlib.decompressobj(31)
    while data := source.read(chunk):
        while data:
            piece = unzip.decompress(data, 1 << 22)
            if piece:
                yield piece
            data = unzip.unconsumed_tail
            if unzip.eof:
                data = unzip.unused_data
                unzip = zlib.decompressobj(31)
    if piece := unzip.flush():
        yield piece


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a WARC stream; no more than one and a piece are held."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = re.search(rb"\r\ncontent-length:\s*(\d+)", held[: end + 2], re.I)
                if not found:
                    raise ValueError("a record has no Content-Length")
                need = end + 4 + int(found[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the stream ends within a record")


def annotated(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, length, digest, refers_to`` of every page.

    Of pages with equal payloads of at least LEAST_REVISITED bytes the smallest
    page_id is the original, and the others refer to it.  A null html is an
    empty payload.  Rows without a page_id are always responses.
    """
    body = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", octets("html").alias("payload"))
    sized = body.withColumn("length", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    groups = sized.filter(F.col("length") >= LEAST_REVISITED).groupBy("digest").agg(
        F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")
    )
    repeated = materialize(groups.filter("n > 1").drop("n"), "repeated-payloads")
    return sized.join(repeated, "digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") > F.col("original"), F.col("original"))
    )


def write_monolithic(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of ``annotated`` pages, each file one gzip stream: ``(path, records)``."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = None
        names = ("page_id", "url", "payload", "length", "digest", "refers_to")
        for columns in rows_of(batches, *names):
            for page_id, url, payload, length, digest, refers_to in zip(*columns, strict=True):
                if sink is None:
                    path, count, size = new_name(folder, "pages", ".warc.gz"), 0, 0
                    sink, zipper = open_sink(path), zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                data = record(page_id, url, payload, digest, refers_to, length)
                sink.write(zipper.compress(data))
                count, size = count + 1, size + len(data)
                if size >= FILE_BYTES:
                    sink.write(zipper.flush())
                    sink.close()
                    sink = None
                    yield _row(path=path, records=count)
        if sink is not None:
            sink.write(zipper.flush())
            sink.close()
            yield _row(path=path, records=count)

    return pages.mapInArrow(written, "path string, records long")


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([columns])


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Each file of ``archives(path)`` with a gzip member for every record, and an index beside it.

    A file is inflated once, as a stream.  The index has a JSON line for every
    record: offset and length of its member, type, record id, address, digest.
    Returns ``(path, index, records)``.
    """

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (paths,) in rows_of(batches, "path"):
            for old in paths:
                path = new_name(folder, "members", ".warc.gz")
                count = offset = 0
                with open_source(old) as source, open_sink(path) as sink, open_sink(f"{path}.index") as index:
                    for data in records(inflated(source)):
                        zipper = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                        member = zipper.compress(data) + zipper.flush()
                        sink.write(member)
                        fields, _ = parsed(data)
                        entry = {
                            "offset": offset,
                            "length": len(member),
                            "type": fields["warc-type"],
                            "id": fields["warc-record-id"],
                            "uri": fields.get("warc-target-uri"),
                            "digest": fields.get("warc-payload-digest"),
                        }
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset += len(member)
                        count += 1
                yield _row(path=path, index=f"{path}.index", records=count)

    return archives.select("path").mapInArrow(rewritten, "path string, index string, records long")


def index_entries(path: str) -> list[dict]:
    with open_source(path) as source:
        return [json.loads(line) for line in source.read().splitlines()]


def read_member(source, entry: dict) -> bytes:
    """One record by its index entry, without reading those before it."""
    source.seek(entry["offset"])
    return zlib.decompress(source.read(entry["length"]), 31)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of ``archives(path, index)`` through its index.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``;
    the digest of a response is computed from the payload and must be the one in
    its header, that of a revisit is in its header, as is the payload's length.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)))

    def number(text: str | None) -> int | None:
        digits = text.strip("<>").removeprefix(_URN) if text else "None"
        return None if digits == "None" else int(digits)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, indexes in rows_of(batches, "path", "index"):
            for path, index in zip(paths, indexes, strict=True):
                rows = []
                with open_source(path) as source:
                    for entry in index_entries(index):
                        fields, block = parsed(read_member(source, entry))
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        if fields["warc-type"] == "response":
                            if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"{fields['warc-record-id']} in {path} is damaged")
                        rows.append((number(fields["warc-record-id"]), length, digest, fields["warc-type"], number(fields.get("warc-refers-to"))))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return archives.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame) -> DataFrame:
    """Pages written to monolithic archives, normalised, and read back: see ``read_archives``."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    create_folder(folder)
    whole = materialize(write_monolithic(annotated(pages), folder), "archives")
    files = max(1, whole.count())
    members = materialize(normalise(whole.repartition(files), folder), "members")
    return read_archives(members.repartition(files))
