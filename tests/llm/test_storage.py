import gc
import re
import time
from pathlib import Path

from geoloom.llm import simhash, storage
from pyspark.sql import functions as F


def test_batches_of_a_write_are_small(spark):
    """A worker gets texts in batches of a few MB, and the session's settings come back."""

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    texts = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("x"), 40_000).alias("text"))
    made, path = storage.stash(texts.mapInArrow(sizes, "size long"), "sizes")
    found = [r["size"] for r in made.collect()]
    assert sum(found) > 20_000_000 and max(found) < 6 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    storage.discard(spark, path)


def test_heaps_are_collected(spark):
    """The JVMs that run tasks, here the driver's, collect their garbage."""

    def collections():
        return sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Concurrent" not in b.getName())

    before = collections()
    storage.release_heaps(spark)
    assert collections() >= before + spark.sparkContext.defaultParallelism


def started(spark, folder, work):
    """The commands of the processes that the JVM, which runs tasks here, starts during ``work``."""
    jvm, file = spark._jvm, str(folder / "starts.jfr")
    record = jvm.jdk.jfr.Recording()
    record.enable("jdk.ProcessStart")
    record.start()
    try:
        work()
        record.stop()
        record.dump(jvm.java.io.File(file).toPath())
    finally:
        record.close()
    return [e.getString("command") for e in jvm.jdk.jfr.consumer.RecordingFile.readAllEvents(jvm.java.io.File(file).toPath())]


def test_small_tables_start_few_processes(spark, tmp_path):
    """The tables between the rounds of SimHash are small, however many tasks make them: a
    process for each of their files would be some thousands on 200 partitions."""
    texts = [(i, " ".join(f"w{1000 * (i % 80) + j}" for j in range(40))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, got = {k: spark.conf.get(k) for k in conf}, []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        starts = started(spark, tmp_path, lambda: got.extend(simhash.near_duplicates(docs).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.component_id for r in got} == {i: i % 80 for i in range(400)}
    assert len(starts) < 120, len(starts)
    assert not [c for c in starts if c.endswith(".crc")]


def test_the_driver_gives_back_what_is_freed(spark):
    """What has been freed in the driver's JVM does not stay with its C library: compilers leave
    such blocks, here some buffers do."""
    jvm = spark._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def held():
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024

    made = [jvm.java.nio.ByteBuffer.allocateDirect(60_000) for _ in range(3000)]
    kept = made[::50]  # so that the library's own trimming finds little at the end of an arena
    del made
    gc.collect()
    for _ in range(2):
        jvm.System.gc()
        time.sleep(1)
    before = held()
    storage.release_driver(spark)
    assert held() < before - 60 and len(kept) == 60
