"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole records, and a footer in
the seekable format: a skippable frame that lists the compressed and the plain size of every frame.
Any Zstandard reader decompresses the file as a whole; with the footer a reader fetches the one
frame that has a record. The index maps record identifiers to bundle, frame and offset in the frame.

Of records with equal payloads one is the response, the others refer to it. Who it is comes from an
aggregate over digests, so payloads themselves never move for that.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.chunks import byte_values
from civiclake.sources.scratch import stage

#: Plain bytes from which a frame is closed, and compressed bytes from which a bundle is closed.
FRAME, BUNDLE = 1 << 18, 64 << 20
LEVEL = 3
#: Payload bytes from which the reader hands a batch on.
BATCH = 4 << 20
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, payload_digest string, record_type string, refers_to long, bundle string, frame int, offset long, length long"


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()  # 160 bits: no padding


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"


def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit without it."""
    target = quote(url or f"page:{page_id}", safe=":/?#[]@!$&'()*+,;=%~")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        head.append("Content-Type: application/http; msgtype=response")
        body += payload
    else:
        head += [
            "Content-Type: application/http; msgtype=response",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
        if refers_url:
            head.append(f"WARC-Refers-To-Target-URI: {quote(refers_url, safe=':/?#[]@!$&()*+,;=%~')}")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    return fields, block.partition(b"\r\n\r\n")[2]


class Writer:
    """One bundle in memory: records into frames, frames into a file with a seek table."""

    def __init__(self, frame: int = FRAME):
        self.limit, self.frames, self.plain, self.held = frame, [], [], io.BytesIO()
        self.size = 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset in it of the added record."""
        place = len(self.frames), self.held.tell()
        self.held.write(data)
        if self.held.tell() >= self.limit:
            self._close()
        return place

    def _close(self) -> None:
        plain = self.held.getvalue()
        if plain:
            self.frames.append(self.compressor.compress(plain))
            self.plain.append(len(plain))
            self.size += len(self.frames[-1])
        self.held = io.BytesIO()

    def finish(self) -> bytes:
        self._close()
        table = b"".join(struct.pack("<II", len(f), n) for f, n in zip(self.frames, self.plain, strict=True))
        table += struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", _SKIPPABLE, len(table)) + table


def seek_table(file, size: int) -> list[tuple[int, int]]:
    """Start and compressed size of each frame, read from the footer of an open file."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE or flags:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    entries, start, frames = file.read(8 * count), 0, []
    for compressed, _ in struct.iter_unpack("<II", entries):
        frames.append((start, compressed))
        start += compressed
    return frames


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system and a path in it; a folder may be a plain path or any URI that Arrow knows."""
    if folder.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


def _put(files: pyarrow.fs.FileSystem, path: str, data: bytes) -> None:
    """Whole or not at all: written under another name, then renamed."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as file:
        file.write(data)
    files.move(part, path)


def _write(folder: str, frame: int, bundle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        files.create_dir(base, recursive=True)
        writer, rows = Writer(frame), []

        def close() -> pa.RecordBatch:
            # A name nobody else takes: a task that runs again leaves its old file out of the index.
            name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            _put(files, os.path.join(base, name), writer.finish())
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            page, digest, kind, refers, number, offset, length = (pa.array(c, k) for c, k in zip(columns, kinds, strict=True))
            return pa.RecordBatch.from_arrays(
                [page, digest, kind, refers, pa.array([name] * len(rows)), number, offset, length],
                ["page_id", "payload_digest", "record_type", "refers_to", "bundle", "frame", "offset", "length"],
            )

        for batch in batches:
            urls = batch.column("url").to_pylist()
            pages, digests, refers, refers_urls = (
                batch.column(c).to_pylist() for c in ("page_id", "digest", "refers_to", "refers_url")
            )
            for page, url, data, digest, other, other_url in zip(
                pages, urls, byte_values(batch.column("html")), digests, refers, refers_urls, strict=True
            ):
                own = record(page, url, data or b"", digest, other, other_url)
                number, offset = writer.add(own)
                rows.append((page, digest, "response" if other is None else "revisit", other, number, offset, len(own)))
                if writer.size >= bundle:
                    yield close()
                    writer, rows = Writer(frame), []
        if rows:
            yield close()

    return run


def write_bundles(
    pages: DataFrame, folder: str, *, least_bytes: int = 0, frame: int = FRAME, bundle: int = BUNDLE
) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) below `folder`; return the index.

    Of records with equal payloads of at least `least_bytes` bytes the one with the largest page_id
    is the response; the others are revisits of it. Smaller payloads are all responses. A null html
    is an empty payload. Rows that repeat the largest page_id are all responses. Rows with a null
    page_id cannot be named and raise an error. Other columns are ignored; an empty table makes no
    bundle. `folder` must be one that all executors share. The index is written beside the bundles.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    digest = F.sha1(html)
    page = F.when(F.col("page_id").isNull(), F.raise_error(F.lit("a page has no page_id"))).otherwise(F.col("page_id"))
    keyed = pages.select(page.cast("long").alias("page_id"), "url", html.alias("html"), digest.alias("hex"))
    first = (
        pages.where(F.octet_length(html) >= least_bytes)
        .groupBy(digest.alias("hex"))
        .agg(F.max_by("url", "page_id").alias("refers_url"), F.max("page_id").cast("long").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Only names move: the rows of repeated payloads, keyed by page.
    repeats = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("hex"))
        .join(first, "hex")
        .where("page_id <> response")
        .select("page_id", "hex", "response", "refers_url")
        .dropDuplicates(["page_id", "hex"])
    )
    rows = keyed.join(repeats, ["page_id", "hex"], "left").select(
        "page_id", "url", "html", _base32("hex").alias("digest"), F.col("response").alias("refers_to"), "refers_url"
    )
    return stage(rows.mapInArrow(_write(folder, frame, bundle), INDEX), "bundle-index")


def _base32(name: str):
    """Upper-case base 32 of 40 hexadecimal digits: eight groups of five bits in each ten digits."""
    bits = F.concat(*(F.lpad(F.conv(F.substring(name, at, 10), 16, 2), 40, "0") for at in range(1, 41, 10)))
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digit = [F.substring(letters, F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)]
    return F.concat(*digit)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        opened, name, table, frame, plain = None, None, [], None, b""
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
            )

        for batch in batches:
            rows, held = [], 0
            for bundle, number, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if bundle != name:
                    if opened:
                        opened.close()
                    path = os.path.join(base, bundle)
                    opened, name, frame = files.open_input_file(path), bundle, None
                    table = seek_table(opened, opened.size())
                if number != frame:
                    start, size = table[number]
                    opened.seek(start)
                    plain, frame = zstandard.ZstdDecompressor().decompress(opened.read(size)), number
                fields, payload = parse(plain[offset : offset + length])
                refers = fields.get("X-Refers-To-Page-ID")
                rows.append(
                    (
                        int(fields["X-Page-ID"]),
                        int(fields["X-Payload-Length"]),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        fields["WARC-Type"],
                        int(refers) if refers else None,
                        payload if fields["WARC-Type"] == "response" else None,
                    )
                )
                held += len(payload)
                if held >= BATCH:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    return run


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that `index` names (any rows of what `write_bundles` returned), fetched by seeking.

    Rows of a frame are read together; a bundle's rows may be spread over several tasks.
    """
    places = index.select("bundle", "frame", "offset", "length")
    return (
        places.repartition("bundle", F.floor(F.col("frame") / 16))
        .sortWithinPartitions("bundle", "frame", "offset")
        .mapInArrow(_read(folder), RECORDS)
    )


def verified(records: DataFrame) -> DataFrame:
    """Records without payloads; a response whose payload has not the digest and size it names fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, size, digest, payload in zip(
                *(batch.column(c).to_pylist() for c in ("page_id", "payload_bytes", "payload_digest", "payload")), strict=True
            ):
                if payload is not None and (len(payload) != size or payload_digest(payload) != digest):
                    raise ValueError(f"page {page} came back changed")
            yield batch.drop_columns(["payload"])

    return records.mapInArrow(run, RECORDS.removesuffix(", payload binary"))
