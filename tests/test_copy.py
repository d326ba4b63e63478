import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions import copy_text
from geoloom.schemas import TABLES
from geoloom.sources import copy_dump

from . import dumps


def unescape(s: str) -> str:
    """A state machine over the characters."""
    out, i = bytearray(), 0
    while i < len(s):
        if s[i] != "\\":
            out += s[i].encode()
            i += 1
            continue
        c = s[i + 1]
        if c in "01234567" and len(s) >= i + 4 and all(x in "01234567" for x in s[i + 1 : i + 4]):
            out.append(int(s[i + 1 : i + 4], 8) & 255)
            i += 4
        elif c == "x" and i + 2 < len(s) and s[i + 2] in "0123456789abcdefABCDEF":
            n = 2 if i + 3 < len(s) and s[i + 3] in "0123456789abcdefABCDEF" else 1
            out.append(int(s[i + 2 : i + 2 + n], 16))
            i += 2 + n
        else:
            out += copy_text.ESCAPES.get(c, c).encode()
            i += 2
    return out.decode()


def test_unescape(spark):
    rng = random.Random(5)
    parts = ["a", "é", "\U0001f600", "\\\\", "\\n", "\\t", "\\r", "\\b", "\\f", "\\v", "\\q", "\\101", "\\303\\251", "\\x41", "\\x9z", "n", "7", " "]
    cases = ["", "plain", *("".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(500))]
    got = spark.createDataFrame([(c,) for c in cases], "s string").select("s", copy_text.unescape(F.col("s")).alias("u")).collect()
    assert [(r.s, r.u) for r in got] == [(c, unescape(c)) for c in cases]
    long = "x\\n" * 50_000
    assert spark.createDataFrame([(long,)], "s string").select(copy_text.unescape(F.col("s"))).first()[0] == "x\n" * 50_000


@pytest.mark.parametrize("bad", ["a\\", "\\\\\\"])
def test_dangling_backslash(spark, bad):
    with pytest.raises(Exception, match="backslash"):
        spark.createDataFrame([(bad,)], "s string").select(copy_text.unescape(F.col("s"))).collect()


@pytest.mark.parametrize(("kind", "field", "strict", "compat"), [
    ("long", "12", 12, 12), ("long", "12x", "not a", 12), ("long", "\\N", "not a", 0), ("int", "-7", -7, -7),
    ("boolean", "t", True, True), ("boolean", "true", "not a", True), ("string", "\\N", "null in", "N"),
    ("member_type", "Way", "Way", "Way"), ("member_type", "W", "not a", "Way"), ("member_type", "", "not a", "Node"),
    ("string", "a\\x41b", "aAb", "ab"), ("string", "a\\000b", "a", "a"),
])
def test_decode(spark, kind, field, strict, compat):
    for mode, want in ((False, strict), (True, compat)):
        df = spark.createDataFrame([(field,)], "f string").select(copy_text.decode(F.col("f"), kind, False, mode))
        if isinstance(want, str) and " " in want:
            with pytest.raises(Exception, match=want):
                df.collect()
        else:
            assert df.first()[0] == want


def test_decode_times_and_nulls(spark):
    decode = lambda v, **k: str(spark.createDataFrame([(v,)], "f string").select(copy_text.decode(F.col("f"), **k)).first()[0])
    assert decode("2010-01-02 03:04:05.742365", kind="timestamp", nullable=False) == "2010-01-02 03:04:05"
    assert decode("\\N", kind="int", nullable=True) == "None"
    assert decode("", kind="int", nullable=True, compat=True) == "None"
    for bad in ("2003-12-31 23:59:59", "2140-02-07 06:28:16", "2010-01-02"):
        with pytest.raises(Exception, match="time|timestamp"):
            decode(bad, kind="timestamp", nullable=False)


def test_header():
    assert copy_dump.parse_header('COPY public.nodes (node_id, "timestamp", "a ""b""") FROM stdin;\n') == ("nodes", ["node_id", "timestamp", 'a "b"'])
    with pytest.raises(copy_dump.DumpError):
        copy_dump.parse_header("COPY nodes FROM stdin;")


@pytest.mark.parametrize("chunk", [7, 64, 8 << 20])
def test_every_table(spark, tmp_path, monkeypatch, chunk):
    path = tmp_path / "dump.sql"
    path.write_bytes(dumps.text().encode())
    monkeypatch.setattr(copy_dump, "CHUNK", chunk)
    raw, found = path.read_bytes(), []
    for split in (13, 100, 1 << 20):  # the lines that open and end blocks, whatever the ranges
        lines = [x for s in range(0, len(raw), split) for x in copy_dump._lines(str(path), s, min(len(raw), s + split), len(raw))]
        found.append(lines)
    assert found[0] == found[1] == found[2] and len(found[0]) == 2 * len(dumps.TABLES) and all(raw[at:].startswith(line + b"\n") for at, line in found[0])
    blocks = copy_dump.index_blocks(spark, str(path), split=97 if chunk < 100 else 1 << 20)
    for name, (columns, rows) in dumps.TABLES.items():
        block = copy_dump.found_block(blocks, str(path), name)
        assert path.read_bytes()[block.start : block.stop] == "".join(r + "\n" for r in rows).encode(), name
        for split in (1, 10, 1000):
            reader = copy_dump.CopyReader(block, split)
            assert [v.as_py() for p in reader.partitions() for b in reader.read(p) for v in b.column(0)] == rows, (name, split)


def test_read_table(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_bytes(dumps.text().encode())
    rows = copy_dump.read_table(spark, str(path), "changesets", split_bytes=40).orderBy("id").collect()
    assert [r.id for r in rows] == [-4, 10, 11, 12]
    assert (rows[1].uid, rows[1].min_lon, rows[2].max_lat) == (1, -15, None)
    tags = copy_dump.read_table(spark, str(path), "changeset_tags").collect()
    assert {r.k: r.v for r in tags} == {"comment": "a\tb\\n\n\x01c", "Z": "1"}
    assert [f.name for f in copy_dump.read_table(spark, str(path), "nodes").schema] == [c.name for c in TABLES["nodes"].columns]


def test_broken_dumps(spark, tmp_path):
    path = tmp_path / "dump.sql"
    whole = dumps.text({"users": dumps.TABLES["users"]})
    path.write_bytes(whole.encode())
    with pytest.raises(copy_dump.DumpError, match="table nodes: no COPY header"):
        copy_dump.read_table(spark, str(path), "nodes")
    path.write_bytes(whole.split("\n3\t")[0].encode())
    with pytest.raises(copy_dump.DumpError, match="cut short"):
        copy_dump.read_table(spark, str(path), "users")
    assert [r.id for r in copy_dump.read_table(spark, str(path), "users", compat=True).collect()] == [1]
    path.write_bytes(whole.replace("display_name", "other").encode())
    with pytest.raises(copy_dump.DumpError, match="lacks columns: display_name"):
        copy_dump.read_table(spark, str(path), "users")
    path.write_bytes(whole.replace("2\tbob\tf\tz", "2\tbob").encode())
    with pytest.raises(Exception, match="wrong number of fields"):
        copy_dump.read_table(spark, str(path), "users").collect()
