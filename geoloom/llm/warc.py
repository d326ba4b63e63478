"""WARC archives in Zstandard, written and read back.

An archive starts with a skippable frame that holds the dictionary of all its other frames,
and has one frame for each record. Of records with equal payloads the one with the largest
id is written whole, the others as revisits of it. Archives are written by the tasks that
hold the records, under names that no other attempt uses; a manifest that Spark commits
says which of them count, so a lost executor leaves no doubt. They are read as streams, a
frame at a time, and every record's version, headers, lengths and digest are validated.

Defined results
* null payload: the empty payload. Null address: the record has no target address.
* null id: such a record is a response unless a row with an id has the same payload.
* very large payload: one record, held whole by the task that writes or reads it.
* ties, equal id and payload in several rows: each is a record; those with the largest id are
  responses, so repeated rows of it are several responses.
* empty table: no archive, empty result. Other columns are ignored.
* fewer samples than a dictionary can be made from: archives without a dictionary frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, fresh_path, quoted, stash, with_row_key

#: Fixed values of the formats.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Record ids carry the page's id.
ID_PREFIX = "urn:x-page:"
#: Bytes read at once, and compressed bytes after which the next archive begins.
READ_BYTES, ARCHIVE_BYTES = 1 << 18, 64 << 20
#: The dictionary: its size, and the bound on pages and on bytes of each that train it.
DICTIONARY_BYTES, DICTIONARY_PAGES, DICTIONARY_PAGE_BYTES = 32 << 10, 400, 16 << 10
#: Compressed bytes that one task reads back.
TASK_BYTES = 128 << 20
MANIFEST = "path string, records long, bytes long"


class InvalidRecord(ValueError):
    """An archive or record that breaks the format; the text says where."""


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The uncompressed record of a page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        # header lines end at control characters, so these are percent-encoded
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>")]
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes, where: str) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name.strip() != name:
            raise InvalidRecord(f"{where}: header line {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out


def _number(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise InvalidRecord(f"{where}: Content-Length is {value!r}")
    return int(value)


def _page(value: str, where: str) -> int | None:
    if not (value.startswith(f"<{ID_PREFIX}") and value.endswith(">")):
        raise InvalidRecord(f"{where}: record id {value[:60]!r}")
    number = value[len(ID_PREFIX) + 1 : -1]
    return int(number) if number else None


def parse(raw: bytes, where: str) -> tuple[int | None, int, str, str, int | None, bytes | None, str | None]:
    """Validate a record. Returns page id, bytes and hex digest of the full payload, type,
    the page it refers to, its payload (None for a revisit) and its address."""
    first, line_end, rest = raw.partition(b"\r\n")
    head, gap, body = rest.partition(b"\r\n\r\n")
    if first != VERSION or not line_end or not gap:
        raise InvalidRecord(f"{where}: no {VERSION.decode()} header")
    fields = _fields(head, where)
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest"):
        if name not in fields:
            raise InvalidRecord(f"{where}: {name} is missing")
    size = _number(fields, where)
    if len(body) != size + 4 or body[size:] != b"\r\n\r\n":
        raise InvalidRecord(f"{where}: the block has not the {size} bytes that its header states")
    http, gap, payload = body[:size].partition(b"\r\n\r\n")
    status, _, http_head = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/1."):
        raise InvalidRecord(f"{where}: no HTTP header")
    whole = _number(_fields(http_head, where), where)
    scheme, _, encoded = fields["warc-payload-digest"].partition(":")
    if scheme != "sha1":
        raise InvalidRecord(f"{where}: digest {scheme!r}")
    digest = base64.b32decode(encoded).hex()
    kind = fields["warc-type"]
    page, url = _page(fields["warc-record-id"], where), fields.get("warc-target-uri")
    if kind == "revisit":
        if payload or fields.get("warc-profile") != PROFILE:
            raise InvalidRecord(f"{where}: a revisit with a payload or of another profile")
        return page, whole, digest, kind, _page(fields.get("warc-refers-to", ""), where), None, url
    if kind != "response":
        raise InvalidRecord(f"{where}: type {kind!r}")
    if len(payload) != whole or hashlib.sha1(payload).hexdigest() != digest:
        raise InvalidRecord(f"{where}: the payload does not match its length and digest")
    return page, whole, digest, kind, None, payload, url


def frames(stream, where: str) -> Iterator[bytes]:
    """The records of an archive, decoded frame by frame."""
    data = stream.read(READ_BYTES)
    dictionary = None
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + size:
            more = stream.read(READ_BYTES)
            if not more:
                raise InvalidRecord(f"{where}: the dictionary frame is cut short")
            data += more
        raw, data = data[8 : 8 + size], data[8 + size :]
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # it may be compressed itself
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    count = 0
    while data or (data := stream.read(READ_BYTES)):
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise InvalidRecord(f"{where}, record {count}: {e}") from e
            if frame.eof:
                data = frame.unused_data
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise InvalidRecord(f"{where}, record {count}: the frame is cut short")
        yield b"".join(parts)
        count += 1


def train_dictionary(pages: DataFrame, payload_col: str = "html") -> bytes | None:
    """A dictionary from a bounded number of pages; None if they are too few."""
    rows = pages.filter(F.octet_length(payload_col) > 0).select(F.substring(quoted(payload_col).cast("binary"), 1, DICTIONARY_PAGE_BYTES).alias("b")).limit(DICTIONARY_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r.b) for r in rows], k=256, d=8).as_bytes() if len(rows) >= 16 else None
    except zstandard.ZstdError:
        return None


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, keeper``: ``keeper`` is the page that a revisit refers to.

    What is grouped and joined by digest are row keys and digests of large payloads, stored
    once; payloads meet the list of revisits by their row keys, which no two rows share."""
    table, key = with_row_key(pages, "keyed-pages")
    payload = F.coalesce(quoted(payload_col).cast("binary"), F.lit(b""))
    slim = table.select(F.col(key).alias("row_key"), quoted(id_col).cast("long").alias("page_id"), F.when(F.octet_length(payload) >= least_bytes, F.unhex(F.sha1(payload))).alias("digest"))
    slim, slim_path = stash(slim.filter("digest is not null"), "payload-digests")
    again = slim.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "keeper")
    revisits, _ = stash(slim.join(again, "digest").filter("not page_id <=> keeper and keeper is not null").select("row_key", "keeper"), "revisits")
    discard(pages.sparkSession, slim_path)
    base = table.select(F.col(key).alias("row_key"), quoted(id_col).cast("long").alias("page_id"), quoted(url_col).cast("string").alias("url"), payload.alias("payload"))
    return base.join(revisits, "row_key", "left").select("page_id", "url", "payload", "keeper")


def write(pages: DataFrame, folder: str, dictionary: bytes | None, date: str = "2020-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write rows of ``page_id, url, payload, keeper`` as archives in ``folder`` (a URI that
    all executors reach). Returns the stored manifest: path, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
        out, name, records, size, made = None, "", 0, 0, []
        for batch in batches:
            for page, url, payload, keeper in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    name, records, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = fs.open_output_stream(name, compression=None)
                    if dictionary:
                        size += out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                size += out.write(packer.compress(record(page, url, payload, keeper, keeper is not None, date)))
                records += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    made.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            made.append((name, records, size))
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return stash(pages.select("page_id", "url", "payload", "keeper").mapInArrow(run, MANIFEST), "warc-manifest")[0]


def read(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and with ``with_payload`` url and payload (null for revisits).
    A record that is not valid, or a count that differs, fails the read."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload", "url"] * with_payload
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary(), pa.string()] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size, count = [], 0, 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for raw in frames(stream, path):
                        rows.append(parse(raw, f"{path}, record {count}"))
                        count, size = count + 1, size + len(raw)
                        if size > 8 << 20 or len(rows) == 4096:
                            yield packed(rows)
                            rows, size = [], 0
                if count != records:
                    raise InvalidRecord(f"{path}: {count} records, the manifest has {records}")
                yield packed(rows)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary, url string" * with_payload
    made = manifest.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    # by a number, which adaptive execution keeps: the manifest is small whatever it lists
    tasks = min(made.n, max(manifest.sparkSession.sparkContext.defaultParallelism, -(-(made.bytes or 0) // TASK_BYTES)))
    return manifest.select("path", "records").repartition(max(1, tasks)).mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives and read them back."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    manifest = write(with_revisits(pages, least_bytes=least_bytes), folder, train_dictionary(pages))
    return read(manifest, folder)
