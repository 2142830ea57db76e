"""WARC archives of pages, and a normaliser for archives gzipped as one stream.

``write_archives`` writes one record per page into archives of about ``ARCHIVE_BYTES`` of payload, each
gzipped as a whole. Such a file can only be read from its beginning. ``normalise`` inflates each file
once, as a stream, writes every record again as a gzip member of its own and beside the file an index
of the members' offsets (one line per record: offset, length, record id). ``read_records`` reads records
by that index.

Records: of pages with equal payloads of at least ``LEAST_SHARED`` bytes, the one with the smallest
page_id is a response with the payload, the others are revisits that refer to it; smaller payloads are
always responses. A revisit keeps the HTTP head, whose Content-Length is that of the payload. NULL html
is an empty payload, a NULL url leaves out the target. Rows with the same smallest page_id are all
responses. Rows without page_id are revisits of a page that has one, and else responses. Payloads come
whole, one record at a time in a task's memory.

Files go to the folder all executors share, through Arrow's file systems. A task's files have names of
their own, and only those that a finished task reports are read, so a repeated or lost task does no harm.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from coverbay.llm.shared import materialise, shared_folder, stored

ARCHIVE_BYTES = 64 << 20
LEAST_SHARED = 100
LEVEL = 6
MOST_TASKS = 10_000
_READ = 1 << 20

_ID = "<urn:x-page:%s>"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def typed(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is NULL for responses."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = rows.where(F.octet_length("html") >= LEAST_SHARED)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # payloads are shuffled only if the repeated digests are too many to broadcast
    joined = rows.join(stored(first.select("digest", "first")), "digest", "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    block = (_HTTP % len(payload)).encode() + (payload if refers_to is None else b"")
    name = _ID % page_id if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_ID % refers_to}", f"WARC-Profile: {_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> dict[str, str]:
    """The lines of a record's head, names in lower case."""
    lines = data.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if value}


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or more members."""
    inflate = zlib.decompressobj(31)
    for piece in pieces:
        while piece:
            out = inflate.decompress(piece, _READ)
            if out:
                yield out
            piece = inflate.unconsumed_tail
            if inflate.eof:
                piece, inflate = inflate.unused_data.lstrip(b"\0"), zlib.decompressobj(31)


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record in a stream of uncompressed bytes."""
    held = bytearray()

    def upto(size: int) -> None:
        while len(held) < size:
            more = next(chunks, None)
            if more is None:
                raise ValueError("the archive ends inside a record")
            held.extend(more)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            more = next(chunks, None)
            if more is None:
                if bytes(held).strip():
                    raise ValueError("the archive ends inside a head")
                return
            held.extend(more)
        head = headers(bytes(held[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        upto(size)
        yield head, bytes(held[:size])
        del held[:size]


def _pieces(stream) -> Iterator[bytes]:
    while piece := stream.read(_READ):
        yield piece


def _manifest(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["path", "records"])


def new_folder(spark) -> str:
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    return folder


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages to archives of one gzip stream each; returns their (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done, sink, size, count = [], None, 0, 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(column.to_pylist() for column in batch.columns)):
                if sink is None:
                    path = f"{name}-{len(done)}.warc.gz"
                    raw = files.open_output_stream(f"{root}/{path}", compression=None)
                    sink, size, count = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=LEVEL, mtime=0), 0, 0
                payload = html.encode()
                sink.write(record(page_id, url, payload, digest, refers_to))
                size, count = size + len(payload), count + 1
                if size >= archive_bytes:
                    sink.close(), raw.close()
                    done.append((f"{folder}/{path}", count))
                    sink = None
        if sink is not None:
            sink.close(), raw.close()
            done.append((f"{folder}/{path}", count))
        yield _manifest(done)

    return materialise(typed(pages).mapInArrow(run, "path string, records long"))


def _spread(manifest: DataFrame) -> DataFrame:
    """One archive per task, as far as that is sensible."""
    return manifest.repartition(max(1, min(manifest.count(), MOST_TASKS)))


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrites archives (path) with a gzip member per record; returns (path, records), the index at path + .idx."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            done = []
            for source in batch.column(0).to_pylist():
                name = f"members-{uuid.uuid4().hex}.warc.gz"
                origin, path = fs.FileSystem.from_uri(source)
                index, offset = [], 0
                with origin.open_input_stream(path, compression=None) as stream, files.open_output_stream(f"{root}/{name}", compression=None) as out:
                    for head, whole in records(inflated(_pieces(stream))):
                        member = gzip.compress(whole, level, mtime=0)
                        out.write(member)
                        index.append(f"{offset} {len(member)} {head['warc-record-id']}\n")
                        offset += len(member)
                with files.open_output_stream(f"{root}/{name}.idx", compression=None) as out:
                    out.write("".join(index).encode())
                done.append((f"{folder}/{name}", len(index)))
            yield _manifest(done)

    return materialise(_spread(archives.select("path")).mapInArrow(run, "path string, records long"))


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_records(archives: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html) of normalised archives.

    Each record is read by its offset alone. A response whose payload doesn't have the digest it
    states raises ValueError. html is NULL for revisits.
    """
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]

    def parsed(member: bytes) -> tuple:
        head, whole = next(records(iter([gzip.decompress(member)])))
        block = whole[whole.index(b"\r\n\r\n") + 4 : -4]
        http, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(headers(http)["content-length"]), head["warc-payload-digest"].removeprefix("sha256:")
        response = head["warc-type"] == "response"
        if response and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
            raise ValueError(f"{head['warc-record-id']}: the payload isn't the one stated")
        html = payload.decode() if response else None
        return _page(head["warc-record-id"]), head.get("warc-target-uri"), size, digest, head["warc-type"], _page(head.get("warc-refers-to")), html

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(name)
                with files.open_input_stream(f"{path}.idx", compression=None) as stream:
                    lines = stream.read().decode().splitlines()
                rows, held = [], 0
                with files.open_input_file(path) as source:
                    for line in lines:
                        offset, length, _ = line.split(" ", 2)
                        rows.append(parsed(source.read_at(int(length), int(offset))))
                        held += rows[-1][2]
                        if held >= 8 * _READ:
                            yield _rows(rows)
                            rows, held = [], 0
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    return _spread(archives.select("path")).mapInArrow(run, schema)
