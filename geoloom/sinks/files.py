"""Ordered parts of a distributed write, joined to one file."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Iterable, Iterator

import pyarrow.fs
from pyspark.sql import SparkSession


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def pieces(paths: Iterable[str]) -> Iterator[bytes]:
    """What the files hold, one after the other, in pieces of a bounded size."""
    for path in paths:
        fs, base = filesystem(path)
        with fs.open_input_stream(base, compression=None) as f:
            while data := f.read(8 << 20):
                yield data


def concatenate(parts_dir: str, out: str, through: str | None = None) -> None:
    """Append the part files in their order. Compressed parts (bzip2, gzip) form one stream
    that decompresses as a whole. ``through``: a command that the stream is piped through."""
    fs, base = filesystem(parts_dir)
    found = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(base)) if f.type == pyarrow.fs.FileType.File and f.base_name.startswith("part-")]
    scheme = parts_dir[: -len(base)] if "://" in parts_dir and parts_dir.endswith(base) else ""
    read = pieces(scheme + path for path in sorted(found))
    write_all(out, piped(through, read) if through else read)


def piped(command: str, given: Iterable[bytes]) -> Iterator[bytes]:
    """What a shell command makes of the stream; a status other than 0 is an error."""
    with subprocess.Popen(command, shell=True, stdin=subprocess.PIPE, stdout=subprocess.PIPE) as process:

        def feed() -> None:
            try:
                for data in given:
                    process.stdin.write(data)
                process.stdin.close()
            except BrokenPipeError:  # the command's status tells why
                pass

        feeder = threading.Thread(target=feed)
        feeder.start()
        while data := process.stdout.read(1 << 20):
            yield data
        feeder.join()
    if process.returncode:
        raise RuntimeError(f"the command {command!r} ended with status {process.returncode}")


def write_all(out: str, pieces: Iterable[bytes]) -> None:
    """Write pieces under a temporary name and move the file when it is whole."""
    fs, base = filesystem(out)
    if "/" in base.strip("/"):
        fs.create_dir(base.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{base}.partial", compression=None) as f:
        for data in pieces:
            f.write(data)
    fs.move(f"{base}.partial", base)


def create(path: str) -> None:
    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)


def remove(path: str) -> None:
    fs, base = filesystem(path)
    kind = fs.get_file_info(base).type
    if kind == pyarrow.fs.FileType.Directory:
        fs.delete_dir(base)
    elif kind == pyarrow.fs.FileType.File:
        fs.delete_file(base)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
