"""Lineage cuts in the folder that driver and executors share.

``spark.checkpoint.dir`` names it. Only a local master may run without it (tests);
it then gets a folder of its own. What an application has stored there is removed when its
driver ends.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The URI of the shared folder, without a trailing slash."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="geoloom-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
            spark.sparkContext.setCheckpointDir(_own[app])
        base = f"file://{_own[app]}"
    return base.rstrip("/")


_folders: dict[str, str] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that nothing has yet, in a folder of this application that the end of its driver
    removes."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{shared_dir(spark)}/geoloom-{app}"
        root = spark._jvm.org.apache.hadoop.fs.Path(_folders[app])
        atexit.register(_remove, root.getFileSystem(spark._jsc.hadoopConfiguration()), root)
    return f"{_folders[app]}/{label}-{uuid.uuid4().hex}"


def _remove(fs, root) -> None:
    try:
        fs.delete(root, True)
    except Exception:  # the JVM may have ended before; what is left is only unused
        pass


#: While a table is written: shuffle files go with its end, and batches of texts for Python
#: workers are small, as both the executor and the worker hold several.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: For shared folders that are mounted (``file:``). Hadoop's default there, without its native
#: library, starts ``chmod`` for each file, each task's folder and each file of checksums, and a
#: JVM that starts a process counts twice until the process runs its own program. This one makes
#: no files of checksums; a table of few files saves the rest.
_MOUNTED = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def few_files(spark: SparkSession) -> int:
    """Files for a table with a few bytes to each row of the corpus: as many as tasks read it
    where small files are read together."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def stash(df: DataFrame, label: str, files: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once and read it back: later uses neither recompute it nor depend on
    the executors that made it. The file sizes also let the planner decide on broadcasts. The
    shuffle files of the write are removed with its end, nothing can ask for them again.
    ``files``: rows are dealt evenly over so many files, however many tasks made them."""
    path, conf = fresh_path(df.sparkSession, label), df.sparkSession.conf
    before = {k: conf.get(k) for k in _WRITING}
    for k, v in _WRITING.items():
        conf.set(k, v)
    try:
        (df.repartition(files) if files else df).write.options(**_MOUNTED).parquet(path)
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove stashed tables that no live DataFrame reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spare(columns: list[str], name: str) -> str:
    """``name``, or a variant that clashes with none of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Bits of a row's number within its file, and of its file's number; seeds that are tried.
ROW_BITS, FILE_BITS, SEEDS = 28, 35, 64


def _file_rows(docs: DataFrame, key: str) -> DataFrame | None:
    """``docs`` with a number made of a digest of the file's path and the row's place there, or
    None where they come from no files. The digest's seed is one that tells all paths apart."""
    if "_metadata" in {c.lower() for c in docs.columns}:
        return None
    path = F.col("_metadata.file_path")
    try:
        # no columns are read; the planner lists the files on the driver anyway
        paths = [r[0] for r in docs.select(path).distinct().collect()]
    except AnalysisException:
        return None
    digest = lambda p, seed: xxhash.xxh64_intdigest(f"{p}#{seed}".encode(), 42) >> 64 - FILE_BITS  # noqa: E731  (Spark's xxhash64)
    seed = next((s for s in range(SEEDS) if len({digest(p, s) for p in paths}) == len(paths)), None)
    if seed is None:
        return None
    number = F.shiftrightunsigned(F.xxhash64(F.concat(path, F.lit(f"#{seed}"))), 64 - FILE_BITS)
    place = F.col("_metadata.row_index")
    inside = F.when(place < 1 << ROW_BITS, place).otherwise(F.raise_error(F.lit("a file has more rows than row keys can tell apart")).cast("long"))
    return docs.select(*[quoted(c) for c in docs.columns], (F.shiftleft(number, ROW_BITS) + inside).alias(key))


def release_memory(cycles: bool = True) -> None:
    """Give back what a worker no longer uses; workers live on between tasks. Without ``cycles``
    it is cheap enough for each block of texts."""
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def release_heaps(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage, which shrinks heaps that the stages before
    have grown; what they give back is free for Python workers. A task on each core, four times
    over, reaches every executor in practice; one that it misses only keeps its heap."""
    n = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def release_driver(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage and give back what its C library has kept of freed
    memory: a stage of many small jobs compiles many plans, and the blocks that compilers free stay
    with the threads' arenas, more than the heap holds. Where the JVM has no such command
    (other C libraries, early releases), only garbage goes."""
    jvm = spark._jvm
    jvm.java.lang.System.gc()
    # by its interface, as the server's own class is closed to calls from outside
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
    arguments = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    arguments[0], arguments[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments)
    except Py4JJavaError:
        pass


def with_row_key(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a number that tells repeated rows apart, and the number's column.

    Rows of files are numbered by their places there, which every later read agrees on. Other
    rows are written once with a number, so that it stays even if the input is split otherwise."""
    key = spare(docs.columns, "row_key")
    found = _file_rows(docs, key)
    return (stash(docs.withColumn(key, F.monotonically_increasing_id()), label)[0] if found is None else found), key


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application; the driver may run where it
    is on the path and they may not."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="geoloom-code-")  # of the driver, which serves it to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
