import bz2
import gzip
import struct
import zlib
from xml.etree import ElementTree

import pyarrow as pa
import pytest

from geoloom.plans import products, staging
from geoloom.sinks import blocks, fixed
from geoloom.sources import blocks as block_source
from geoloom.sources import copy_dump

from . import dumps


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Every product of the small dump."""
    folder = tmp_path_factory.mktemp("built")
    (folder / "dump.sql").write_bytes(dumps.text().encode())
    outputs = {name: str(folder / name) for name in products.PRODUCTS}
    products.build(spark, products.Options(str(folder / "dump.sql"), str(folder / "staged"), outputs, generator="test"))
    return folder


def xml_of(built, name):
    return ElementTree.fromstring(bz2.decompress((built / name).read_bytes()))


def test_current_xml_bytes(built):
    assert bz2.decompress((built / "xml").read_bytes()).decode() == """<?xml version="1.0" encoding="UTF-8"?>
<osm license="http://opendatacommons.org/licenses/odbl/1-0/" copyright="OpenStreetMap and contributors" version="0.6" generator="test" attribution="http://www.openstreetmap.org/copyright" timestamp="2010-01-06T00:00:00Z">
 <bound box="-90,-180,90,180" origin="http://www.openstreetmap.org/api/0.6"/>
 <changeset id="10" created_at="2010-01-01T00:00:00Z" closed_at="2010-01-02T00:00:00Z" open="false" user="ann &quot;a&quot; &lt;x&gt;" uid="1" min_lat="1.0000000" min_lon="-0.0000015" max_lat="2.0000000" max_lon="3.0000000" num_changes="4" comments_count="3">
  <tag k="Z" v="1"/>
  <tag k="comment" v="a&#9;b\\n&#10;?c"/>
 </changeset>
 <changeset id="11" created_at="2010-01-03T00:00:00Z" open="true" num_changes="1" comments_count="0"/>
 <changeset id="12" created_at="2010-01-04T00:00:00Z" closed_at="2010-01-05T00:00:00Z" open="false" user="cy" uid="3" num_changes="0" comments_count="1"/>
 <node id="0" lat="0.0000005" lon="0.0000006" timestamp="2010-01-04T00:00:00Z" version="1" changeset="12" user="cy" uid="3"/>
 <node id="1" lat="51.5000000" lon="-0.1000000" timestamp="2010-01-01T00:00:01Z" version="1" changeset="10" user="ann &quot;a&quot; &lt;x&gt;" uid="1">
  <tag k="z" v="1"/>
  <tag k="é" v="2"/>
  <tag k="\ufffd" v="3"/>
  <tag k="\U0001f600" v="4"/>
 </node>
 <way id="7" timestamp="2010-01-01T00:00:05Z" version="1" changeset="10" user="ann &quot;a&quot; &lt;x&gt;" uid="1">
  <nd ref="10"/>
  <nd ref="12"/>
  <nd ref="7"/>
 </way>
 <relation id="8" timestamp="2010-01-01T00:00:06Z" version="1" changeset="10" user="ann &quot;a&quot; &lt;x&gt;" uid="1">
  <member type="node" ref="1" role="stop"/>
  <member type="way" ref="7" role=""/>
  <tag k="type" v="route"/>
 </relation>
</osm>
"""


def test_history_xml(built):
    nodes = [(n.get("id"), n.get("version"), n.get("visible"), n.get("lat"), len(n)) for n in xml_of(built, "history-xml").iter("node")]
    assert nodes == [("0", "1", "true", "0.0000005", 0), ("1", "1", "true", "51.5000000", 4), ("2", "1", "true", "0.0000001", 1), ("2", "2", "false", None, 0)]


def test_anonymous_is_full_without_users(built):
    for name in ("xml", "history-xml", "changesets", "changeset-discussions"):
        full, bare = xml_of(built, name), xml_of(built, f"{name}-no-userinfo")
        assert not any("uid" in x.attrib or "user" in x.attrib for x in bare.iter())
        for x in full.iter():
            x.attrib.pop("uid", None)
            x.attrib.pop("user", None)
        assert ElementTree.tostring(full) == ElementTree.tostring(bare)


def test_discussions(built):
    root = xml_of(built, "changeset-discussions")
    assert not list(root.iter("node"))
    first, _, last = root.iter("changeset")
    assert [(c.get("uid"), c.get("date"), c.findtext("text")) for c in first.iter("comment")] == [("1", "2010-01-01T12:00:00Z", "first"), ("3", "2010-01-02T00:00:00Z", "second & <last>")]
    assert last.get("comments_count") == "1" and len(last.find("discussion")) == 0
    assert not list(xml_of(built, "changesets").iter("discussion"))


# --- a decoder of the block format ------------------------------------------------------


def fields(raw: bytes):
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            b = raw[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    out = []
    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            out.append((tag >> 3, varint()))
        else:
            n = varint()
            out.append((tag >> 3, raw[at : at + n]))
            at += n
    return out


def one(raw, field, default=None):
    return next((v for f, v in fields(raw) if f == field), default)


def numbers(raw, signed=False):
    out, n, shift = [], 0, 0
    for b in raw or b"":
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(n >> 1 ^ -(n & 1) if signed else n)
            n = shift = 0
    return out


def sums(values):
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def blocks_of(path):
    raw, at, out = path.read_bytes(), 0, []
    while at < len(raw):
        n = struct.unpack(">I", raw[at : at + 4])[0]
        head = raw[at + 4 : at + 4 + n]
        size = one(head, 3)
        blob = raw[at + 4 + n : at + 4 + n + size]
        data = zlib.decompress(one(blob, 3))
        assert len(data) == one(blob, 2)
        out.append((one(head, 1).decode(), data))
        at += 4 + n + size
    return out


def dense_nodes(block):
    strings = [s.decode() for f, s in fields(one(block, 1)) if f == 1]
    dense = one(one(block, 2), 2)
    info = one(dense, 5)
    get = lambda raw, f, signed=True: numbers(one(raw, f), signed)
    tags, row = [], []
    for i in get(dense, 10, False):
        if i:
            row.append(strings[i])
        else:
            tags.append(row)
            row = []
    uid, sid = sums(get(info, 4)), sums(get(info, 5))
    return list(zip(sums(get(dense, 1)), get(info, 1, False), sums(get(info, 2)), sums(get(info, 3)), uid, [strings[s] for s in sid], sums(get(dense, 8)), sums(get(dense, 9)), get(info, 6, False) or [1] * len(uid), tags, strict=True)), sid


def test_blocks(built):
    head, nodes, ways, relations = blocks_of(built / "history-blocks")
    assert [k for k, _ in (head, nodes, ways, relations)] == ["OSMHeader", "OSMData", "OSMData", "OSMData"]
    assert [v.decode() for f, v in fields(head[1]) if f in (4, 5)] == ["OsmSchema-V0.6", "HistoricalInformation", "DenseNodes", "Has_Metadata", "Sort.Type_then_ID"]
    assert one(head[1], 16) == b"test" and one(head[1], 32) == 1262736000
    ann = 'ann "a" <x>'
    rows, _ = dense_nodes(nodes[1])
    assert rows == [
        (0, 1, 1262563200, 12, 3, "cy", 5, 6, 1, []),
        (1, 1, 1262304001, 10, 1, ann, 515000000, -1000000, 1, ["z", "1", "é", "2", "\ufffd", "3", "\U0001f600", "4"]),
        (2, 1, 1262476800, 11, 0, "", 1, 2, 1, ["n", "v"]),
        (2, 2, 1262476801, 11, 0, "", 0, 0, 0, []),
    ]
    way = one(one(ways[1], 2), 3)
    assert numbers(one(way, 8), True) == [10, 2, -5]
    relation = one(one(relations[1], 2), 4)
    assert (numbers(one(relation, 9), True), numbers(one(relation, 10))) == ([1, 6], [0, 1])


def test_anonymous_blocks(built):
    rows, sid = dense_nodes(blocks_of(built / "blocks-no-userinfo")[1][1])
    # the empty name is a string of its own, after the delimiter's
    assert {r[4] for r in rows} == {0} and {r[5] for r in rows} == {""} and set(sid) == {1}
    assert [r[0] for r in rows] == [0, 1]


def test_plain_nodes(spark, built):
    tables = staging.staged(spark, str(built / "staged"))
    nodes = products.elements(tables, "node", products.PRODUCTS["history-blocks"])
    made = blocks.encode("node", nodes, history=True, full=True, dense=False).collect()
    group = b"".join(one(zlib.decompress(one(bytes(r.block)[4 + struct.unpack(">I", bytes(r.block)[:4])[0] :], 3)), 2) for r in sorted(made, key=lambda r: r.id))
    found = [(one(n, 1) >> 1, one(one(n, 4), 6, 1)) for f, n in fields(group) if f == 1]
    assert found == [(0, 1), (1, 1), (2, 1), (2, 0)]


def test_block_boundaries_do_not_matter(spark, built, monkeypatch):
    tables = staging.staged(spark, str(built / "staged"))
    nodes = products.elements(tables, "node", products.PRODUCTS["history-blocks"]).orderBy("id", "version").select("*").collect()
    monkeypatch.setitem(fixed.GROUP_SIZE, "node", 2)
    monkeypatch.setattr(fixed, "BLOCK_SHARE", fixed.MAX_BLOCK)
    batch = blocks._encoder_rows("node", products.elements(tables, "node", products.PRODUCTS["history-blocks"])).orderBy("id", "version").toArrow().combine_chunks().to_batches()[0]
    for cut in (1, 2, 4):
        encoder, made = blocks.BlockEncoder("node", True, True, True), []
        for at in range(0, len(nodes), cut):
            made += [b for _, b in encoder.add(batch.slice(at, cut))]
        assert encoder.finish() is None and len(made) == len(nodes) // min(cut, 2)
        ids = [row[0] for b in made for row in dense_nodes(zlib.decompress(one(b[4 + struct.unpack(">I", b[:4])[0] :], 3)))[0]]
        assert ids == [0, 1, 2, 2]


def test_missing_changeset(spark, built):
    tables = dict(staging.staged(spark, str(built / "staged")))
    tables["changesets"] = tables["changesets"].filter("id <> 11")
    assert "user" in products.elements(tables, "node", products.PRODUCTS["history-xml"]).filter("changeset_id = 11").columns
    assert products.elements(tables, "node", products.PRODUCTS["history-xml"]).filter("changeset_id = 11 and user is not null").count() == 0
    with pytest.raises(Exception, match="no changeset 11"):
        products.elements(tables, "node", products.PRODUCTS["history-blocks"]).collect()
    products.elements(tables, "node", products.PRODUCTS["history-blocks-no-userinfo"]).collect()


def test_resume(spark, built, tmp_path):
    marker = built / "staged" / "users.complete"
    before = {p: p.stat().st_mtime_ns for p in (built / "staged" / "users").iterdir()}
    staging.stage_table(spark, "no such dump", "users", str(built / "staged"), resume=True)
    assert marker.exists() and before == {p: p.stat().st_mtime_ns for p in (built / "staged" / "users").iterdir()}


def test_empty_dump(spark, tmp_path):
    (tmp_path / "dump.sql").write_text(dumps.text(empty=True))
    out = {"changesets": str(tmp_path / "c"), "blocks": str(tmp_path / "b")}
    products.build(spark, products.Options(str(tmp_path / "dump.sql"), str(tmp_path / "staged"), out, generator="test"))
    root = ElementTree.fromstring(bz2.decompress((tmp_path / "c").read_bytes()))
    assert root.get("timestamp") == "" and [x.tag for x in root] == ["bound"]
    assert [k for k, _ in blocks_of(tmp_path / "b")] == ["OSMHeader"]


def test_long_values(spark, tmp_path):
    body = "x" * 70_000
    tables = dict(dumps.TABLES) | {"changeset_comments": (dumps.TABLES["changeset_comments"][0], [f"10\t2010-01-02 00:00:00\t3\t{body}\\x0b\tt"])}
    (tmp_path / "dump.sql").write_text(dumps.text(tables))
    products.build(spark, products.Options(str(tmp_path / "dump.sql"), str(tmp_path / "staged"), {"changeset-discussions": str(tmp_path / "d")}))
    root = ElementTree.fromstring(bz2.decompress((tmp_path / "d").read_bytes()))
    assert root.find(".//text").text == body + "?"


def test_options():
    with pytest.raises(ValueError, match="at least one"):
        products.Options("d", "s", {})
    with pytest.raises(ValueError, match="no such product"):
        products.Options("d", "s", {"nope": "x"})
    with pytest.raises(ValueError, match="a dump"):
        products.Options("", "s", {"xml": "x"})
    assert products.Options("d", "s", {"xml": "x"}, meta={"author": "me"}).meta["author"] == "me"


def test_command_line(tmp_path):
    from geoloom.__main__ import parse

    (tmp_path / "meta").write_text("# literals\nmeta-author = someone\nmeta-source = a place = here\n")
    got = parse(["--dump-file", "d", "--history-blocks-no-userinfo", "h", "--xml", "x", "--dense-nodes", "false", "--meta-file", str(tmp_path / "meta"), "--meta-source", "there"])
    assert got.outputs == {"xml": "x", "history-blocks-no-userinfo": "h"} and not got.dense_nodes
    assert (got.meta["author"], got.meta["source"]) == ("someone", "there")
    for bad in (["--dump-file", "d"], ["--xml", "x"]):
        with pytest.raises(SystemExit):
            parse(bad)


def test_large_relations_close_a_block():
    row = {"id": 1, "version": 1, "seconds": 0, "changeset_id": 1, "visible": True, "user": None, "uid": None, "tags": [{"k": "a", "v": "b"}], "members": [{"member_id": i, "member_role": "", "code": 0} for i in range(30_000)]}
    encoder = blocks.BlockEncoder("relation", False, False, True)
    batch = pa.Table.from_pylist([row | {"id": i} for i in range(150)])
    for name, kind in (("user", pa.string()), ("uid", pa.int64())):
        batch = batch.set_column(batch.column_names.index(name), name, pa.nulls(150, kind))
    batch = batch.combine_chunks().to_batches()[0]
    made = [b for _, b in encoder.add(batch)]
    made.append(encoder.finish())
    raw = [zlib.decompress(one(b[4 + struct.unpack(">I", b[:4])[0] :], 3)) for b in made]
    assert len(made) >= 3 and all(len(r) < fixed.MAX_BLOCK // 2 for r in raw)
    back = [e for r in raw for e in block_source.elements_of(r)]
    assert [e["id"] for e in back] == list(range(150)) and all(len(e["members"]) == 30_000 and e["members"][9]["member_id"] == 9 for e in back)


def test_packed_varints():
    values = [0, 1, 127, 128, 300, 1 << 40, -1, -(1 << 40)]
    raw = blocks.packed(3, values, signed=True)
    assert numbers(one(raw, 3), True) == values
    assert blocks.packed(3, []) == b""


def test_blocks_read_back(spark, built):
    """What is read back from the blocks is what the product shows, dense or not."""
    tables = staging.staged(spark, str(built / "staged"))
    rows = {(r.kind, r.id, r.version): r for r in block_source.read(spark, str(built / "history-blocks")).collect()}
    assert {k for k, *_ in rows} == {"node", "way", "relation"}
    for kind in ("node", "way", "relation"):
        shown = products.elements(tables, kind, products.PRODUCTS["history-blocks"]).collect()
        assert len(shown) == sum(k == kind for k, *_ in rows)
        for r in shown:
            got = rows[kind, r.id, r.version]
            assert (got.changeset_id, got.visible, got.uid, got.user) == (r.changeset_id, r.visible, r.uid, r.user)
            assert got.tags == (r.tags if r.visible else [])
            if kind == "node":
                assert (got.latitude, got.longitude) == ((r.latitude, r.longitude) if r.visible else (0, 0))
            elif kind == "way":
                assert got.refs == r.refs
            else:
                assert [(("Node", "Way", "Relation")[m.code], m.member_id, m.member_role) for m in got.members] == [tuple(m) for m in r.members]
    assert block_source.header(str(built / "blocks"))["required"] == ["OsmSchema-V0.6", "DenseNodes"]


def test_compress_command(spark, built, tmp_path):
    options = products.Options(str(built / "dump.sql"), str(built / "staged"), {"changesets": str(tmp_path / "c.gz")}, generator="test", resume=True, compress_command="gzip -c")
    products.build(spark, options)
    assert gzip.decompress((tmp_path / "c.gz").read_bytes()) == bz2.decompress((built / "changesets").read_bytes())
    options.compress_command = "cat >/dev/null; exit 3"
    with pytest.raises(RuntimeError, match="status 3"):
        products.build(spark, options)


def test_archives(spark, tmp_path, monkeypatch):
    """An archive is turned to text by the tool, table by table; its failure is an error."""
    (tmp_path / "dump").write_bytes(b"PGDMP archive")
    (tmp_path / "dump.sql").write_bytes(dumps.text().encode())
    with pytest.raises(copy_dump.DumpError, match="not installed"):
        staging.stage_table(spark, str(tmp_path / "dump"), "users", str(tmp_path / "staged"))
    tool = tmp_path / "pg_restore"
    tool.write_text(f"#!/bin/sh\n[ $5 = ways ] && echo broken >&2 && exit 1\ncp {tmp_path}/dump.sql $2\n")
    tool.chmod(0o755)
    monkeypatch.setenv("PATH", str(tmp_path), prepend=":")
    (tmp_path / "staged").mkdir()
    staging.stage_table(spark, str(tmp_path / "dump"), "users", str(tmp_path / "staged"))
    assert spark.read.parquet(str(tmp_path / "staged" / "users")).count() == 3 and not (tmp_path / "staged" / "users.copy").exists()
    with pytest.raises(copy_dump.DumpError, match="status 1: broken"):
        staging.stage_table(spark, str(tmp_path / "dump"), "ways", str(tmp_path / "staged"))
    with pytest.raises(copy_dump.DumpError, match="status 1"):
        staging.stage(spark, str(tmp_path / "dump"), str(tmp_path / "staged"), resume=True)


def test_withheld_comments_are_counted(spark, built, caplog, tmp_path):
    products.build(spark, products.Options(str(built / "dump.sql"), str(built / "staged"), {"changeset-discussions": str(tmp_path / "d")}, resume=True))
    assert "2 visible comments are left out" in caplog.text
