"""COPY text as a Spark data source.

A dump is indexed once: tasks scan ranges of its bytes for lines that may open or end a block,
and from these few lines the driver tells where each table's data lines are. ``format("copy_dump")``
then gives the data lines of a block as the column ``value``, read in ranges of bytes, one
partition each, cut at line feeds. Splitting, unescaping and typing are native expressions on
top (``read_table``). An archive of the database's own format is first turned to text by the
database's tool.
"""

from __future__ import annotations

import re
import shutil
import subprocess
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import copy_text
from ..schemas import TABLES, Table

CHUNK = 8 << 20
#: Fixed value: how an archive of the database's own format begins.
ARCHIVE_MAGIC = b"PGDMP"
_CANDIDATE, _LAST = (re.compile(rb"\n(COPY [^\n]*|\\\.)(?=" + end + rb")") for end in (rb"\n", rb"\n|\Z"))
_NAME = r'(?:"(?:[^"]|"")+"|[A-Za-z_][\w$]*)'
_HEADER = re.compile(rf"COPY (?:{_NAME}\.)?({_NAME}) \(\s*({_NAME}(?:\s*,\s*{_NAME})*)\s*\) FROM stdin;")


class DumpError(ValueError):
    """A dump that is not as it should be."""


def _unquoted(name: str) -> str:
    return name[1:-1].replace('""', '"') if name.startswith('"') else name


def parse_header(line: str) -> tuple[str, list[str]]:
    """The table and the columns that a COPY line names."""
    m = _HEADER.fullmatch(line.rstrip("\r\n"))
    if not m:
        raise DumpError(f"not a COPY header: {line[:120]!r}")
    return _unquoted(m[1]), [_unquoted(x) for x in re.findall(_NAME, m[2])]


@dataclass
class Block:
    """Where a table's data lines are; ``stop`` is None if nothing ends them."""

    path: str
    columns: list[str]
    start: int
    stop: int | None


def _open(path: str):
    fs, base = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    return fs.open_input_file(base)


def _lines(path: str, start: int, stop: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Offsets and texts of lines that begin in the range and may open or end a block: that
    start with COPY, or are a backslash and a dot."""
    with _open(path) as f:
        at = max(0, start - 1)
        f.seek(at)
        # what is left of the last piece: the line feed before a line that is not whole yet
        tail = b"\n" if start == 0 else b""
        while at < size and (at < stop or tail and at - len(tail) + 1 < stop):
            read = f.read(min(CHUNK, size - at))
            data, base = tail + read, at - len(tail)
            at += len(read)
            for found in (_LAST if at >= size else _CANDIDATE).finditer(data):
                if start <= base + found.start() + 1 < stop:
                    yield base + found.start() + 1, found[1]
            cut = data.rfind(b"\n")
            # a line that is neither so far is passed by, however long
            tail = data[cut:] if cut >= 0 and (data.startswith(b"COPY ", cut + 1) or len(data) - cut <= 5) else b""


def index_blocks(spark: SparkSession, path: str, compat: bool = False, split: int = 256 << 20) -> dict[str, Block]:
    """Where the blocks of all tables are, by a scan in parallel. Between a header and the line
    that ends its data all is data, whatever it looks like. A missing end is an error for the
    table unless ``compat``, which then drops an unended line."""
    with _open(path) as f:
        size = f.size()
    tasks = max(1, -(-size // split))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for i in batch.column(0).to_pylist() for x in _lines(path, i * split, min(size, (i + 1) * split), size)]
            yield pa.RecordBatch.from_arrays([pa.array([o for o, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], ["at", "line"])

    # a few lines for each table
    lines = sorted((r.at, bytes(r.line)) for r in spark.range(0, tasks, 1, tasks).mapInArrow(scan, "at long, line binary").distinct().collect())
    out: dict[str, Block] = {}
    now: tuple[str, list[str], int] | None = None
    for at, line in lines:
        if now is None and line.startswith(b"COPY "):
            name, columns = parse_header(line.decode())
            now = name, columns, at + len(line) + 1
        elif now is not None and line == b"\\.":
            out.setdefault(now[0], Block(path, now[1], now[2], at))
            now = None
    if now is not None:
        with _open(path) as f:
            out.setdefault(now[0], Block(path, now[1], now[2], _after_last_line(f, now[2], size) if compat else None))
    return out


def found_block(blocks: dict[str, Block], path: str, table: str) -> Block:
    """The block of a table; one that the dump lacks or that has no end is an error."""
    if table not in blocks:
        raise DumpError(f"table {table}: no COPY header in {path}")
    if blocks[table].stop is None:
        raise DumpError(f"table {table}: the data has no end line; the dump is cut short")
    return blocks[table]


def _after_last_line(f, start: int, size: int) -> int:
    at = size
    while at > start:
        low = max(start, at - CHUNK)
        f.seek(low)
        found = f.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return start


@dataclass
class Range(InputPartition):
    start: int
    stop: int


class CopyReader(DataSourceReader):
    def __init__(self, block: Block, split: int):
        self.block, self.split = block, split

    def partitions(self) -> list[Range]:
        at = range(self.block.start, self.block.stop, self.split)
        return [Range(s, min(s + self.split, self.block.stop)) for s in at] or [Range(self.block.start, self.block.start)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        """The lines that start in the range."""
        with _open(self.block.path) as f:
            at = part.start
            if at > self.block.start:  # a line that starts before belongs to the range before
                f.seek(at - 1)
                while at < self.block.stop:
                    data = f.read(min(CHUNK, self.block.stop - at + 1))
                    cut = data.find(b"\n")
                    if cut >= 0:
                        at += cut
                        break
                    at += len(data)
            rest = b""
            f.seek(at)
            while at < part.stop or rest:
                data = f.read(min(CHUNK, self.block.stop - at))
                base, at = at - len(rest), at + len(data)
                rest += data
                lines = rest.split(b"\n")
                rest = lines.pop()
                taken = []
                for line in lines:
                    if base >= part.stop:
                        rest = b""
                        break
                    taken.append(line)
                    base += len(line) + 1
                if taken:
                    yield pa.RecordBatch.from_arrays([pa.array(taken, pa.binary()).cast(pa.string())], ["value"])
                if base >= part.stop or not data:
                    break


class CopyDumpSource(DataSource):
    """Options: path, start, stop (of the block), split_bytes (default 64 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "copy_dump"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> CopyReader:
        block = Block(self.options["path"], [], int(self.options["start"]), int(self.options["stop"]))
        return CopyReader(block, int(self.options.get("split_bytes", 64 << 20)))


def bind(table: Table, columns: list[str]) -> dict[str, int]:
    """Where each wanted column is. Extra columns are ignored, missing ones an error."""
    at = {name: i for i, name in enumerate(columns)}
    wanted = {c.name: 0 if c.dump_name == "*" else at.get(c.dump_name or c.name) for c in table.columns}
    if missing := [name for name, i in wanted.items() if i is None]:
        raise DumpError(f"table {table.name} lacks columns: {', '.join(missing)}")
    return wanted


def typed(lines: DataFrame, table: Table, columns: list[str], compat: bool = False) -> DataFrame:
    """Data lines (column ``value``) as rows of the table."""
    at = bind(table, columns)
    parts = lines.select(F.split("value", "\t", -1).alias("f"), "value")
    short = F.size("f") != len(columns)
    whole = F.when(short, copy_text.fail(F.concat(F.lit(f"table {table.name}: wrong number of fields: "), F.col("value")), "array<string>")).otherwise(F.col("f"))
    return parts.select(whole.alias("f")).select(*[copy_text.decode(F.element_at("f", at[c.name] + 1), c.kind, c.nullable, compat).alias(c.name) for c in table.columns])


def read_block(spark: SparkSession, block: Block, table: str, compat: bool = False, split_bytes: int = 64 << 20) -> DataFrame:
    """A table from its block, with the columns of its schema."""
    spark.dataSource.register(CopyDumpSource)
    lines = spark.read.format("copy_dump").options(path=block.path, start=block.start, stop=block.stop, split_bytes=split_bytes).load()
    return typed(lines, TABLES[table], block.columns, compat)


def read_table(spark: SparkSession, path: str, table: str, compat: bool = False, split_bytes: int = 64 << 20) -> DataFrame:
    """A table of a plain-text dump."""
    return read_block(spark, found_block(index_blocks(spark, path, compat), path, table), table, compat, split_bytes)


def is_archive(path: str) -> bool:
    with _open(path) as f:
        return f.read(len(ARCHIVE_MAGIC)) == ARCHIVE_MAGIC


def restore_to_text(dump: str, table: str, out: str, tool: str = "pg_restore") -> None:
    """Turn a table of an archive to text with the database's own tool, if installed. Its exit
    status is checked."""
    found = shutil.which(tool)
    if found is None:
        raise DumpError(f"{tool} is not installed; give a plain-text dump")
    done = subprocess.run([found, "-f", out, "-a", "-t", table, dump], capture_output=True, text=True)
    if done.returncode:
        raise DumpError(f"table {table}: {tool} ended with status {done.returncode}: {done.stderr.strip()[:500]}")
