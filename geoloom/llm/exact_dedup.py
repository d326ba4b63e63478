"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by SHA-256 digest, one row for each distinct text
ever seen, in a folder that all executors share. A batch is first reduced to one row per
digest (map-side combine, so a text that is a third of all rows costs one row per task), then
meets the index in sort-merge joins that neither move nor, while each bucket is one file, sort
it; digests that the anti-join leaves are appended. DataFrame operations only.

A corpus is taken in batches of falling ids, so that the row that is indexed first is the one
with the largest id. Appended rows carry the label of their batch: a batch that is tried again
after a failure knows its own rows and appends only those that are missing. ``compact`` makes
one sorted file of each bucket again after many batches.

Defined results
* null text: the empty text. Texts are compared whole and unchanged, however long.
* null id: smaller than any id; ``keep_id`` is null if no row of the group has an id.
* ties and repeated rows (equal id and text): one of them is kept.
* a text that the index knows from before: the indexed row stays, all rows of the batch are
  dropped, ``group_size`` also counts the indexed row.
* empty batch: empty result, the index is unchanged.
* other columns of the input are ignored (``verdicts``) or kept as they are (``keep_first``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import discard, fresh_path, quoted, stash, with_row_key

#: Batches that a corpus is taken in.
BATCHES = 2
_SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def digest(text) -> F.Column:
    """SHA-256 of the text's UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Let scans of buckets of one file each count as sorted."""
    before = spark.conf.get(_SORTED_SCAN)
    spark.conf.set(_SORTED_SCAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_SORTED_SCAN, before)


class DigestIndex:
    """``folder``: a URI that driver and executors share; what is there is the index.

    ``buckets``: of a new index, as many as the shuffle has partitions by default. Texts over
    about 2^32 rows want more. An existing index keeps its own number, which its folder names."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.generation, self.buckets = max(self._generations(), default=(0, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))))
        self._open()

    def _path(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _generations(self) -> list[tuple[int, int]]:
        """Numbers and buckets of the generations; one counts from its first commit on."""
        fs, root = self._path(self.folder)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return [(int(n), int(b)) for n, b in (x.split("-") for x in names) if fs.exists(self._path(f"{self.folder}/{n}-{b}/_SUCCESS")[1])]

    def _open(self) -> None:
        self.location = f"{self.folder}/{self.generation}-{self.buckets}"
        self.name = f"digest_index_{hashlib.md5(self.location.encode()).hexdigest()}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, run STRING, batch INT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )

    def _write(self, rows: DataFrame) -> None:
        rows.select("digest", "keep_id", "run", "batch").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.folder)

    def compact(self) -> None:
        """One sorted file for each bucket, in a new generation that counts once complete."""
        # as plain files: of a bucketed scan the planner would drop the exchange that gathers buckets
        rows, old = self.spark.read.schema(self.table().schema).parquet(self.location), (self.name, self.location)
        self.generation += 1
        discard(self.spark, f"{self.folder}/{self.generation}-{self.buckets}")  # of an attempt that failed
        self._open()
        self._write(rows)
        self.spark.sql(f"DROP TABLE {old[0]}")
        discard(self.spark, old[1])

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index lacks. A merge join even where the
        batch is small: the index stays where it is."""
        return groups.join(self.table().hint("merge"), "digest", "left_anti")

    def add(self, groups: DataFrame, run: str, batch: int = 0) -> tuple[DataFrame, list[str]]:
        """Match one row per digest (``digest, keep_id, keep_key, n``) with the index and
        append the new ones under the label ``run, batch``. Returns the stored ``digest,
        keep_id, keep_key, n, before`` (whether a row from before this run stays; ``keep_key``
        is null where a row of another batch stays), and the paths of what is stored."""
        groups, groups_path = stash(groups, "digest-groups")
        with _sorted_scans(self.spark):
            fresh, fresh_path = stash(self.unknown(groups), "fresh-digests")
            indexed = self.table().withColumnsRenamed({"keep_id": "kept", "run": "of_run", "batch": "of_batch"})
            own = (F.col("of_run") == run) & (F.col("of_batch") == batch)
            known = groups.join(indexed.hint("merge"), "digest").select("digest", F.col("kept").alias("keep_id"), F.when(own, F.col("keep_key")).alias("keep_key"), "n", (F.col("of_run") != run).alias("before"))
            known, known_path = stash(known, "known-digests")  # read before the append changes the index
        if not fresh.isEmpty():
            self._write(fresh.select("digest", "keep_id", F.lit(run).alias("run"), F.lit(batch).alias("batch")))
        return fresh.withColumn("before", F.lit(False)).unionByName(known), [groups_path, fresh_path, known_path]


def _decided(rows: DataFrame, key: str, id_col: str, index: DigestIndex, batches: int, run: str) -> tuple[DataFrame, list[str]]:
    """Stored ``rows`` (with ``digest`` and a row key) and what becomes of each."""
    cuts = sorted(rows.approxQuantile(id_col, [i / batches for i in range(1, batches)], 0.01), reverse=True) if batches > 1 else []
    number, at = F.col(id_col), F.lit(len(cuts))
    for i in reversed(range(len(cuts))):  # the largest ids first, null ids last
        at = F.when(number > int(cuts[i]), i).otherwise(at)
    rows = rows.withColumn("batch_no", at)
    best = F.max(F.struct(F.col(id_col).alias("id"), F.col(key).alias("key")))
    made, paths = [], []
    for batch in range(len(cuts) + 1):
        groups = rows.filter(F.col("batch_no") == batch).groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("n")).select("digest", F.col("best.id").alias("keep_id"), F.col("best.key").alias("keep_key"), "n")
        out, stored = index.add(groups, run, batch)
        made.append(out)
        paths += stored
    every = reduce(DataFrame.unionByName, made).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("keep_key").alias("keep_key"), (F.sum("n") + F.max(F.col("before").cast("int"))).alias("group_size"))
    # both sides are exchanged by digest, so adaptive execution splits a hot digest
    return rows.drop("batch_no").join(every, "digest"), paths


def verdicts(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, run: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. The same
    ``run`` names the same rows when a failed run is tried again."""
    slim = docs.select(quoted(id_col).cast("long").alias("doc_id"), digest(quoted(text_col)).alias("digest")).withColumn("row_key", F.monotonically_increasing_id())
    slim, _ = stash(slim, "digests")
    decided, _ = _decided(slim, "row_key", "doc_id", index, batches, run or uuid.uuid4().hex)
    return decided.select("doc_id", "keep_id", "group_size", F.col("row_key").eqNullSafe(F.col("keep_key")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES, run: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Only keys are joined while
    decisions are made; the texts meet the list of dropped rows once."""
    table, key = with_row_key(docs, "keyed-documents")
    slim = table.select(quoted(id_col).cast("long").alias("doc_id"), F.col(key).alias("row_key"), digest(quoted(text_col)).alias("digest"))
    slim, slim_path = stash(slim, "digests")
    decided, paths = _decided(slim, "row_key", "doc_id", index, batches, run or uuid.uuid4().hex)
    gone, _ = stash(decided.filter(~F.col("row_key").eqNullSafe(F.col("keep_key"))).select(F.col("row_key").alias(key)), "dropped-keys")
    discard(docs.sparkSession, slim_path, *paths)
    return table.join(gone, key, "left_anti").drop(key)


@contextmanager
def one_off_index(spark: SparkSession) -> Iterator[DigestIndex]:
    """An index for a single corpus, in the shared folder; removed when done."""
    index = DigestIndex(spark, fresh_path(spark, "digest-index"))
    try:
        yield index
    finally:
        index.drop()
