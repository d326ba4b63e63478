"""Elements as compact binary blocks.

The wire format is protocol buffers: a length, a block header and a compressed block, again
and again. Sorted partitions are encoded by the tasks that hold them, a group of rows at a time and
column by column; blocks end where a partition, a kind of element or the size limit ends. Strings are numbered
per block in the order in which they appear; 0 is the empty string that dense nodes use as
their delimiter.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import FAMILIES
from . import fixed, files


# --- protocol buffers -------------------------------------------------------------------


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def zigzag(n: int) -> int:
    return n << 1 ^ n >> 63


def number(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def data(field: int, payload: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(payload)) + payload


def packed(field: int, values, signed: bool = False) -> bytes:
    """A packed list of numbers, as varints of the numbers or of their zigzag form; nothing
    if it is empty."""
    v = np.asarray(values, np.int64)
    if not len(v):
        return b""
    if signed:
        v = v << 1 ^ v >> 63
    u = v.astype(np.uint64)
    size = np.ones(len(u), np.int64)
    for k in range(1, 10):
        size += u >= np.uint64(1 << 7 * k)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]), np.uint8)
    for k in range(int(size.max())):
        has = size > k
        at = (ends - size)[has] + k
        more = (size[has] > k + 1).astype(np.uint64) << np.uint64(7)
        out[at] = (u[has] >> np.uint64(7 * k) & np.uint64(127) | more).astype(np.uint8)
    return data(field, out.tobytes())


def framed(kind: str, block: bytes) -> bytes:
    """A block with its frame, compressed."""
    if len(block) >= fixed.MAX_BLOCK:
        raise ValueError(f"a block of {len(block)} bytes is over the format's limit")
    blob = number(2, len(block)) + data(3, zlib.compress(block, 9))
    head = data(1, kind.encode()) + number(3, len(blob))
    return struct.pack(">I", len(head)) + head + blob


def header_block(max_seconds: int | None, generator: str, source: str, history: bool, dense: bool) -> bytes:
    nano = 10**9
    box = b"".join(number(i, zigzag(v * nano)) for i, v in ((1, -180), (2, 180), (3, 90), (4, -90)))
    needed = [fixed.SCHEMA_FEATURE, *[fixed.HISTORY_FEATURE] * history, *[fixed.DENSE_FEATURE] * dense]
    out = data(1, box) + b"".join(data(4, f.encode()) for f in needed) + b"".join(data(5, f.encode()) for f in fixed.OPTIONAL_FEATURES)
    out += data(16, generator.encode()) + data(17, source.encode())
    return framed(fixed.HEADER_TYPE, out + (number(32, max_seconds) if max_seconds is not None else b""))


# --- blocks -----------------------------------------------------------------------------


class StringTable:
    """Numbers of strings in the order in which they appear."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.size = 0

    def numbers(self, strings: pa.Array) -> np.ndarray:
        """The number of each string; each different one of them is looked up once."""
        coded = strings.dictionary_encode()
        return np.fromiter(map(self._number, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))[coded.indices.to_numpy()]

    def _number(self, text: str) -> int:
        i = self.ids.get(text)
        if i is None:
            i = self.ids[text] = len(self.ids) + 1
            n = len(text.encode())
            self.size += 1 + len(varint(n)) + n
        return i

    def encoded(self) -> bytes:
        return data(1, b"") + b"".join(data(1, s.encode()) for s in self.ids)


def group_deltas(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences of neighbours; at each of ``starts`` they begin again, from 0."""
    out = np.diff(values, prepend=0)
    out[starts[starts < len(values)]] = values[starts[starts < len(values)]]
    return out


def _ints(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64)


class _List:
    """A column of lists: where each row's items are, and the items. Rows that ``shown`` is
    false for have none."""

    def __init__(self, column: pa.ListArray, shown: np.ndarray):
        flat = column.filter(pa.array(shown))
        size = np.zeros(len(shown), np.int64)
        size[shown] = pc.fill_null(pc.list_value_length(flat), 0).to_numpy()
        self.stop = np.cumsum(size)
        self.start = self.stop - size
        self.items = flat.flatten()

    def of(self, field: str) -> pa.Array:
        return self.items.field(field) if len(self.items) else pa.array([], self.items.type.field(field).type)


class BlockEncoder:
    """Blocks of one kind of element, from batches of rows in order.

    A group is encoded as a whole, from columns. A block ends at the group that brings its
    encoded bytes to the limit, which may be of fewer rows than a full one: rows are taken in
    steps of a size that what is already encoded foretells."""

    def __init__(self, kind: str, history: bool, full: bool, dense: bool):
        self.kind, self.history, self.full, self.dense = kind, history, full, dense
        self.strings, self.groups, self.bytes, self.rows = StringTable(), [], 0, 0
        self.limit = fixed.MAX_BLOCK // fixed.BLOCK_SHARE

    def step(self, batch: pa.RecordBatch) -> int:
        """How many rows of the batch the next group takes."""
        if self.kind != "relation":
            return min(batch.num_rows, fixed.GROUP_SIZE[self.kind])
        # the sizes of relations vary most: an item is a few bytes at least, most often less than ten
        items = np.cumsum(_ints(pc.list_value_length(batch["members"])) + _ints(pc.list_value_length(batch["tags"])) + 1)
        most = int(np.searchsorted(items, (self.limit - self.bytes - self.strings.size) // 10, side="right"))
        return min(batch.num_rows, fixed.GROUP_SIZE[self.kind], max(1, most))

    def add(self, batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        """Take rows. Yields each block that is complete, and how many rows of the batch it took
        in with those before it."""
        at = 0
        while at < batch.num_rows:
            n = self.step(batch.slice(at))
            group = (self._dense if self.kind == "node" and self.dense else self._plain)(batch.slice(at, n))
            self.groups.append(group)
            self.bytes += len(group)
            at += n
            if self.bytes + self.strings.size >= self.limit:
                yield at, self.finish()

    def finish(self) -> bytes | None:
        if not self.groups:
            return None
        block = data(1, self.strings.encoded()) + b"".join(data(2, g) for g in self.groups)
        self.strings, self.groups, self.bytes = StringTable(), [], 0
        return framed(fixed.DATA_TYPE, block)

    def _known(self, batch: pa.RecordBatch) -> np.ndarray:
        return batch["user"].is_valid().to_numpy(zero_copy_only=False) & self.full

    def _in_order(self, *columns: tuple[np.ndarray, pa.Array]) -> list[np.ndarray]:
        """Numbers of several columns' strings, given in the order of the places of all."""
        places = np.concatenate([at for at, _ in columns])
        order = np.argsort(places, kind="stable")
        strings = pa.concat_arrays([c.cast(pa.string()) for _, c in columns])
        out = np.zeros(len(places), np.int64)
        out[order] = self.strings.numbers(strings.take(pa.array(order)))
        return np.split(out, np.cumsum([len(at) for at, _ in columns])[:-1])

    def _plain(self, batch: pa.RecordBatch) -> bytes:
        """One message for each row; of its strings the user's comes first, then roles, then keys
        and values in turn."""
        shown, known = batch["visible"].to_numpy(zero_copy_only=False), self._known(batch)
        tags, n = _List(batch["tags"], shown), batch.num_rows
        members = _List(batch["members"], shown) if self.kind == "relation" else None
        rows, roles_of = np.arange(n), np.zeros(n, np.int64) if members is None else members.stop - members.start
        before = np.cumsum(roles_of) - roles_of
        row_at = 2 * tags.start + before + rows
        of_tag = np.repeat(rows, tags.stop - tags.start)
        tag_at = (row_at + 1 + roles_of)[of_tag] + 2 * (np.arange(len(of_tag)) - tags.start[of_tag])
        columns = [(row_at[known], batch["user"].filter(pa.array(known))), (tag_at, tags.of("k")), (tag_at + 1, tags.of("v"))]
        if members is not None:
            of_role = np.repeat(rows, roles_of)
            columns.append((row_at[of_role] + 1 + np.arange(len(of_role)) - before[of_role], members.of("member_role")))
        user, keys, values, *roles = self._in_order(*columns)
        sid = np.zeros(n, np.int64)
        sid[known] = user
        ids, version, seconds, changeset, uid = (_ints(batch[c]).tolist() for c in ("id", "version", "seconds", "changeset_id", "uid"))
        refs = _List(batch["refs"], shown) if self.kind == "way" else None
        deltas = group_deltas(_ints(refs.items), refs.start) if refs is not None else group_deltas(_ints(members.of("member_id")), members.start) if members is not None else None
        codes = _ints(members.of("code")) if members is not None else None
        lat, lon = (np.where(shown, _ints(batch[c]), 0).tolist() for c in ("latitude", "longitude")) if self.kind == "node" else (None, None)
        out = []
        for i in range(n):
            info = number(1, version[i]) + number(2, seconds[i]) + number(3, changeset[i])
            if known[i]:
                info += number(4, uid[i]) + number(5, int(sid[i]))
            if self.history and not shown[i]:
                info += number(6, 0)
            t = slice(tags.start[i], tags.stop[i])
            tagged = packed(2, keys[t]) + packed(3, values[t])
            if self.kind == "node":
                out.append(data(1, number(1, zigzag(ids[i])) + tagged + data(4, info) + number(8, zigzag(lat[i])) + number(9, zigzag(lon[i]))))
            elif self.kind == "way":
                out.append(data(3, number(1, ids[i]) + tagged + data(4, info) + packed(8, deltas[refs.start[i] : refs.stop[i]], True)))
            else:
                m = slice(members.start[i], members.stop[i])
                out.append(data(4, number(1, ids[i]) + tagged + data(4, info) + packed(8, roles[0][m]) + packed(9, deltas[m], True) + packed(10, codes[m])))
        return b"".join(out)

    def _dense(self, batch: pa.RecordBatch) -> bytes:
        """Columns of differences, from 0 in each group. Anonymous elements have user 0 and
        a string of their own for the empty name."""
        shown, known, n = batch["visible"].to_numpy(zero_copy_only=False), self._known(batch), batch.num_rows
        tags, rows = _List(batch["tags"], shown), np.arange(batch.num_rows)
        size = tags.stop - tags.start
        row_of = np.repeat(rows, size)
        # places of strings: of each row its user, then keys and values in turn, then the end of its tags
        row_at = 2 * tags.start + rows
        at = row_at[row_of] + 1 + 2 * (np.arange(len(row_of)) - tags.start[row_of])
        names = pc.if_else(pa.array(known), batch["user"], "").cast(pa.string())
        sid, keys, values = self._in_order((row_at, names), (at, tags.of("k")), (at + 1, tags.of("v")))
        listed = np.zeros(n + 2 * len(row_of), np.int64)
        pair = row_of + 2 * np.arange(len(row_of))
        listed[pair], listed[pair + 1] = keys, values
        none = np.zeros(1, np.int64)
        deltas = lambda values: group_deltas(values, none)
        of = lambda name: _ints(batch[name])
        place = lambda name: np.where(shown, of(name), 0)
        info = packed(1, of("version")) + packed(2, deltas(of("seconds")), True) + packed(3, deltas(of("changeset_id")), True)
        info += packed(4, deltas(np.where(known, of("uid"), 0)), True) + packed(5, deltas(sid), True) + (packed(6, shown.astype(np.int64)) if self.history else b"")
        return data(2, packed(1, deltas(of("id")), True) + data(5, info) + packed(8, deltas(place("latitude")), True) + packed(9, deltas(place("longitude")), True) + packed(10, listed))


def _encoder_rows(kind: str, elements: DataFrame) -> DataFrame:
    rows = elements.withColumn("seconds", X.epoch_seconds(F.col("timestamp")))
    if kind == "relation":
        rows = rows.withColumn("members", F.transform("members", lambda m: F.struct(m["member_id"].alias("member_id"), m["member_role"].alias("member_role"), X.member_type_code(m["member_type"]).alias("code"))))
    own = {"node": ["latitude", "longitude"], "way": ["refs"], "relation": ["members"]}[kind]
    return rows.select("id", "version", "visible", "changeset_id", "seconds", "user", "uid", "tags", *own)


def encode(kind: str, elements: DataFrame, history: bool, full: bool, dense: bool) -> DataFrame:
    """``kind_order, id, version, block``: the blocks of a kind, placed by their first element.
    Partitions are ranges of ids in order, and so are the blocks of each."""
    place = FAMILIES[kind].order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first, waiting = BlockEncoder(kind, history, full, dense), None, None

        def placed(block: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()), pa.array([block], pa.binary())], ["kind_order", "id", "version", "block"])

        def taken(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal first
            start = 0
            for end, block in encoder.add(batch):
                first = first or (batch["id"][start].as_py(), batch["version"][start].as_py())
                yield placed(block)
                first, start = None, end
            if start < batch.num_rows:
                first = first or (batch["id"][start].as_py(), batch["version"][start].as_py())

        whole = fixed.GROUP_SIZE[kind]
        for batch in batches:  # groups are full but for the last of a partition
            waiting = batch if waiting is None else pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            if (ready := waiting.num_rows // whole * whole) > 0:
                yield from taken(waiting.slice(0, ready))
                waiting = waiting.slice(ready)
        if waiting is not None:
            yield from taken(waiting)
        if block := encoder.finish():
            yield placed(block)

    return _encoder_rows(kind, elements).repartitionByRange("id").sortWithinPartitions("id", "version").mapInArrow(run, "kind_order int, id long, version long, block binary")


def write(blocks: list[DataFrame], header: bytes, out: str) -> None:
    """One file of the header and all blocks in order. Each task writes its blocks to a file of
    its own, and a manifest that Spark commits tells which of these count; partitions are ranges
    in order, so that the files need only be appended."""
    spark, parts = blocks[0].sparkSession, f"{out}.parts"
    files.create(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = files.filesystem(parts)
        path, place, stream = f"{parts}/{uuid.uuid4().hex}", None, None
        for batch in batches:
            for kind_order, first, version, block in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if stream is None:
                    place, stream = (kind_order, first, version), fs.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)
                stream.write(block)
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([place[0]], pa.int32()), pa.array([place[1]], pa.int64()), pa.array([place[2]], pa.int64()), pa.array([path])], ["kind_order", "id", "version", "path"])

    # a row for each partition
    made = [r for b in blocks for r in b.mapInArrow(run, "kind_order int, id long, version long, path string").collect()]
    order = sorted(made, key=lambda r: (r.kind_order, r.id, r.version))
    files.write_all(out, itertools.chain([header], files.pieces(r.path for r in order)))
    files.remove(parts)
