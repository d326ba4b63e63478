"""Tables of a dump staged as sorted Parquet, with the time of the dump, resumably."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from ..sinks.files import create, exists, remove
from ..sources.copy_dump import Block, found_block, index_blocks, is_archive, read_block, restore_to_text


def table_time(rows: DataFrame, column: str | None) -> DataFrame:
    """``max_time`` of a table over all its rows; null if it has no times."""
    return rows.agg((F.max(column) if column else F.lit(None).cast("timestamp_ntz")).alias("max_time"))


def max_time(tables: list[tuple[DataFrame, str]]) -> DataFrame:
    """The latest time of several tables: a maximum per table, then over them."""
    each = [table_time(rows, column) for rows, column in tables]
    return reduce(DataFrame.unionByName, each).agg(F.max("max_time").alias("max_time"))


def stage_table(spark: SparkSession, dump: str, name: str, folder: str, resume: bool = False, compat: bool = False, blocks: dict[str, Block] | None = None) -> None:
    """Write a table sorted by its key, then its time as the marker that it is complete.
    ``blocks``: the index of the dump; without it, or for an archive, the table's own is made."""
    table = TABLES[name]
    marker, text = f"{folder}/{name}.complete", f"{folder}/{name}.copy"
    if resume and exists(spark, f"{marker}/_SUCCESS"):
        return
    if archive := blocks is None and is_archive(dump):
        restore_to_text(dump, name, text)
        dump = text
    blocks = index_blocks(spark, dump, compat) if blocks is None else blocks
    rows = read_block(spark, found_block(blocks, dump, name), name, compat)
    # lines are split and decoded once, not again for the sample that ranges are drawn from
    raw = f"{folder}/{name}.rows"
    rows.write.mode("overwrite").parquet(raw)
    stored = spark.read.schema(table.schema).parquet(raw)
    stored.repartitionByRange(*table.key_columns).sortWithinPartitions(*table.key_columns).write.mode("overwrite").parquet(f"{folder}/{name}")
    table_time(spark.read.schema(table.schema).parquet(f"{folder}/{name}"), table.time_column).coalesce(1).write.mode("overwrite").parquet(marker)
    remove(raw)
    if archive:
        remove(text)


def stage(spark: SparkSession, dump: str, folder: str, resume: bool = False, compat: bool = False, concurrency: int = 4) -> None:
    """All tables, ``concurrency`` at a time. One that the dump lacks is an error that names it."""
    waiting = [n for n in TABLES if not (resume and exists(spark, f"{folder}/{n}.complete/_SUCCESS"))]
    if not waiting:
        return
    if is_archive(dump):
        create(folder)
        blocks = None
    else:
        blocks = index_blocks(spark, dump, compat)
        for name in waiting:
            found_block(blocks, dump, name)
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        for done in [pool.submit(stage_table, spark, dump, name, folder, resume, compat, blocks) for name in waiting]:
            done.result()


def staged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(t.schema).parquet(f"{folder}/{name}") for name, t in TABLES.items()}


def staged_time(spark: SparkSession, folder: str):
    """The time of the dump, or None if it has no rows with a time."""
    times = [spark.read.parquet(f"{folder}/{name}.complete") for name in TABLES]
    return reduce(DataFrame.unionByName, times).agg(F.max("max_time")).first()[0]
