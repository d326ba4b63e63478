"""Tables as a plain-text dump in COPY form: the inverse of the dump source."""

from __future__ import annotations

import itertools

import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files


def field(value: Column, kind: T.DataType) -> Column:
    """A value in COPY's text form; null is its marker."""
    if isinstance(kind, T.BooleanType):
        text = F.when(value, "t").otherwise("f")
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        text = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
        for char, letter in (("\n", "n"), ("\t", "t"), ("\r", "r"), ("\b", "b"), ("\f", "f"), ("\v", "v")):
            text = F.replace(text, F.lit(char), F.lit(f"\\{letter}"))
    return F.when(value.isNull(), "\\N").otherwise(text)


def lines(rows: DataFrame) -> DataFrame:
    """Data lines (column ``value``) of the rows."""
    return rows.select(F.concat_ws("\t", *[field(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema]).alias("value"))


def write(tables: dict[str, DataFrame], out: str) -> None:
    """One dump of all tables: their lines are written by the tasks and appended in turn."""
    parts = f"{out}.parts"
    for name, rows in tables.items():
        lines(rows).write.mode("overwrite").text(f"{parts}/{name}")

    def block(name: str, rows: DataFrame):
        fs, base = files.filesystem(f"{parts}/{name}")
        found = sorted(f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(base)) if f.base_name.startswith("part-"))
        scheme = parts[: parts.index("://") + 3] if "://" in parts else ""
        columns = ", ".join('"' + c.replace('"', '""') + '"' for c in rows.columns)
        yield f"COPY public.{name} ({columns}) FROM stdin;\n".encode()
        yield from files.pieces(scheme + path for path in found)
        yield b"\\.\n\n"

    files.write_all(out, itertools.chain([b"--\n-- a dump\n--\n\n"], *(block(n, r) for n, r in tables.items())))
    files.remove(parts)
