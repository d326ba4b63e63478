import hashlib
import io
import struct

import pytest
import zstandard

from geoloom.llm import warc

BIG, BIG2 = "<p>é large</p>" * 200, "<p>another</p>" * 300
PAGES = [
    (1, "http://a.example/x y\r\nz", BIG, "k"), (2, "http://a.example/2", BIG, "k"), (3, None, BIG, "k"), (4, "http://b.example", "small", "k"), (5, "http://b.example", "small", "k"),
    (6, "http://c.example", None, "k"), (7, "http://c.example", "", "k"), (None, "http://d.example", BIG, "k"), (None, "http://d.example", BIG2, "k"), (9, "http://e.example", "x" * 700_000, "k"),
    (3, "http://again.example", BIG, "k"), *((100 + i, f"http://f.example/{i}", f"<html>page {i}</html>" * (i + 1), "k") for i in range(40)),
]
SCHEMA = "page_id long, url string, html string, payload string"


def test_round_trip(spark):
    got = warc.round_trip(spark.createDataFrame(PAGES, SCHEMA).repartition(3)).collect()
    assert len(got) == len(PAGES)
    want = []
    for i, _, html, _ in PAGES:
        raw = (html or "").encode()
        keeper = max((j for j, _, h, _ in PAGES if (h or "") == (html or "") and j is not None), default=None)
        revisit = len(raw) >= 1000 and keeper is not None and i != keeper
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_payloads_and_format(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    dictionary = warc.train_dictionary(pages)
    assert dictionary
    manifest = warc.write(warc.with_revisits(pages), f"file://{tmp_path}/w", dictionary)
    back = warc.read(manifest, f"file://{tmp_path}/w", with_payload=True).collect()
    assert all((r.payload is None) == (r.record_type == "revisit") and (r.payload is None or len(r.payload) == r.payload_bytes) for r in back)
    assert {r.url for r in back if r.page_id == 1} == {"http://a.example/x%20y%0D%0Az"} and {r.url for r in back if r.page_id == 3} == {None, "http://again.example"}
    paths = [r.path for r in manifest.collect()]
    raw = open(paths[0], "rb").read()
    assert struct.unpack("<II", raw[:8]) == (0x184D2A5D, len(dictionary))
    # one frame per record, and no frame without the dictionary
    first = zstandard.frame_content_size(raw[8 + len(dictionary) :])
    assert first == len(next(warc.frames(io.BytesIO(raw), "a")))
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(raw[8 + len(dictionary) :])


def archive(*records, dictionary=None, compress_dictionary=False):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=trained)
    stored = zstandard.compress(dictionary) if compress_dictionary else dictionary
    head = struct.pack("<II", 0x184D2A5D, len(stored)) + stored if dictionary else b""
    return head + b"".join(packer.compress(r) for r in records)


@pytest.mark.parametrize("how", ["none", "raw", "compressed"])
@pytest.mark.parametrize("step", [9, 1 << 18])
def test_frames(monkeypatch, how, step):
    monkeypatch.setattr(warc, "READ_BYTES", step)
    records = [warc.record(i, "http://x", b"payload %d" % i, None, False, "2020-01-01T00:00:00Z") for i in range(5)]
    raw = archive(*records, dictionary=None if how == "none" else b"some words that payloads use " * 30, compress_dictionary=how == "compressed")
    assert list(warc.frames(io.BytesIO(raw), "a")) == records
    with pytest.raises(warc.InvalidRecord, match="cut short"):
        list(warc.frames(io.BytesIO(raw[:-3]), "a"))


GOOD = warc.record(5, "http://x", b"<html>", None, False, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize(("old", "new"), [
    (b"WARC/1.1", b"WARC/9"), (b"WARC-Type: response", b"WARC-Type: other"), (b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b""), (b"Content-Length: 6", b"Content-Length: 7"),
    (b"<html>", b"<HTML>"), (b"\r\n\r\n", b"\n"), (b"WARC-Record-ID: <urn:x-page:5>", b"WARC-Record-ID: 5"), (b"WARC-Type: response", b"WARC-Type response"), (b"HTTP/1.1", b"FTP"), (b"<html>", b"<html>x"),
])
def test_invalid(old, new):
    assert warc.parse(GOOD, "a")[:4] == (5, 6, hashlib.sha1(b"<html>").hexdigest(), "response")
    with pytest.raises(ValueError):
        warc.parse(GOOD.replace(old, new), "a")


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
