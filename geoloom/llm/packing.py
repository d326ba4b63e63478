"""Packing tokenised documents into sequences, online and in bounded space.

Each input partition keeps a fixed number of open windows. A document fills whole sequences
first; what is left is placed in the open window that it fits best. Where it fits none, a
new window is opened, or, with all in use, the fullest window is topped up with the first
tokens of the piece and emitted, and the rest is placed again. Windows that are open at the
end of the partitions are merged, those of a fixed number of partitions together; a merge
cuts its last tokens into sequences whose lengths are powers of two. So no sequence needs
padding. There is no exchange of texts or of packed pieces; only the open windows move.

Defined results
* null or empty text: the end-of-document id alone.
* very long text: fills whole sequences first, its rest is placed like a short one.
* ties: of windows with equal room the one opened first is taken.
* null id: packed like others, with a null id in its pieces.
* repeated rows: each is packed. Other columns are ignored.
* empty table: empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .storage import quoted, release_memory, stash

#: Partitions whose open windows are merged by one task.
MERGED_PARTITIONS = 64
#: Sequence ids: the place of the task that made it, then a count. Merges come after all partitions.
TASK_BITS, MERGE_BASE = 32, 1 << 30

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("open_in", pa.int64())])
SPARK_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, open_in long"


class Packer:
    """Open windows and the sequences made of them. A piece is (doc_id, start, ids as bytes
    of four each, tokens of the document)."""

    def __init__(self, size: int, windows: int, first_id: int, keep_ids: bool):
        self.size, self.windows, self.next_id, self.keep_ids = size, windows, first_id, keep_ids
        self.free: list[tuple[int, int]] = []  # (free tokens, key), sorted
        self.open: dict[int, list[tuple]] = {}
        self.opened = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, at, ids if self.keep_ids else None, None))
            at += n
        self.next_id += 1

    def add(self, doc: int | None, start: int, ids: bytes, total: int) -> None:
        whole = 4 * self.size
        at = 0
        while len(ids) - at >= whole:
            self.emit([(doc, start + at // 4, ids[at : at + whole], total)])
            at += whole
        while at < len(ids):
            n = (len(ids) - at) // 4
            best = bisect.bisect_left(self.free, (n, -1))
            if best == len(self.free):
                if len(self.free) < self.windows:
                    self.opened += 1
                    self.open[self.opened] = []
                    self.free.insert(best, (self.size, self.opened))
                else:
                    best, n = 0, self.free[0][0]  # the fullest, topped up
            room, key = self.free.pop(best)
            self.open[key].append((doc, start + at // 4, ids[at : at + 4 * n], total))
            at += 4 * n
            if room == n:
                self.emit(self.open.pop(key))
            else:
                bisect.insort(self.free, (room - n, key))

    def close(self) -> None:
        """Emit what is open as full sequences and then sequences of powers of two."""
        left = [p for key in sorted(self.open) for p in self.open[key]]
        total = sum(len(p[2]) for p in left) // 4
        sizes = [self.size] * (total // self.size) + [1 << b for b in range(self.size.bit_length(), -1, -1) if total % self.size >> b & 1]
        row: list[tuple] = []
        for room in sizes:
            while room:
                doc, start, ids, tokens = left[0]
                n = min(room, len(ids) // 4)
                row.append((doc, start, ids[: 4 * n], tokens))
                room -= n
                left[0] = (doc, start + n, ids[4 * n :], tokens)
                if not left[0][2]:
                    left.pop(0)
            self.emit(row)
            row = []
        self.open, self.free = {}, []

    def take(self) -> pa.RecordBatch:
        """The rows so far."""
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE, strict=True)] if rows else [pa.array([], f.type) for f in PIECE], schema=PIECE)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, windows: int = 16, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``keep_ids`` the ids as little-endian unsigned 32-bit numbers.

    ``path``: the tokenizer file; ``end_id`` follows each document; a sequence has ``size``
    ids at most; ``windows`` are open at a time in each partition."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(size, windows, task << TASK_BITS, keep_ids)
        known = bpe.flat_cache(path)
        for part, texts in bpe.text_blocks(batches, 1):
            for doc, found in zip(part.column(0).to_pylist(), known.block(texts).ids(), strict=True):
                ids = found.astype("<u4").tobytes() + end
                packer.add(doc, 0, ids, len(ids) // 4)
            yield packer.take()
        left = [(d, s, len(ids) // 4, None, total, None, None, ids, task) for key in sorted(packer.open) for d, s, ids, total in packer.open[key]]
        packer.rows = left
        yield packer.take()
        release_memory()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task may get several groups, one after the other
        packer, group = None, None
        for batch in batches:
            for place, doc, start, ids, total in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if place != group:
                    if packer:
                        packer.close()
                        yield packer.take()
                    packer, group = Packer(size, windows, (MERGE_BASE + place) << TASK_BITS, keep_ids), place
                packer.add(doc, start, ids, total)
        if packer:
            packer.close()
            yield packer.take()

    slim = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"))
    made, _ = stash(slim.mapInArrow(run, SPARK_PIECE), "pieces")
    group = F.floor(F.col("open_in") / MERGED_PARTITIONS).cast("long").alias("place")
    left = made.filter("open_in is not null").select(group, "doc_id", "start", "ids", "doc_tokens")
    # longest first: the short ones then close the gaps
    merged = left.repartition("place").sortWithinPartitions("place", F.length("ids").desc(), "doc_id", "start").mapInArrow(merge, SPARK_PIECE)
    out = made.filter("open_in is null").unionByName(merged).drop("open_in")
    return out if keep_ids else out.drop("ids")
