"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into segments, and each distinct fingerprint is filed in a table
of (segment, value). By the pigeonhole principle two fingerprints within a distance differ in
few bits of at least one segment: with d = a * segments + b, in at most a bits of one of the
first b + 1 segments or in fewer than a bits of one of the others. Each fingerprint therefore
enumerates the ball of that radius within each segment, fetches the fingerprints that the
tables have under these values, and verifies the complete distance.

A value that more than HOT fingerprints share is not matched: the fingerprints that are filed
there or that reach it are matched again over half as many, hence twice as long segments, at
last over whole fingerprints, where no value is hot. There each is filed under all values of
the ball of half the distance, and those that meet at a value are within the distance of the
least of them: links of a group are a star, never all pairs, whatever the texts.

Defined results
* null or empty text, or one without words: fingerprint 0, linked like any other.
* very long text: read whole; bits are counted 2^14 shingles at a time.
* fewer words than a shingle has: the whole sequence is the one shingle.
* null id: ignored for component ids; a component of nothing else has a null id.
* ties (equal fingerprints) and repeated rows: one result row each, same component.
* empty table: empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import discard, few_files, quoted, release_heaps, release_memory, stash, with_row_key

SEED = 42
BITS = 64
#: The most fingerprints under a value of a segment that are compared with those that reach it.
HOT = 64


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The SimHash of a UTF-8 text, as a signed 64-bit number."""
    # bytes.lower() changes A-Z only; bytes.split() cuts at 0x20 and 0x09 to 0x0D only
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size + 1) - 1
        digest = xxhash.xxh64_intdigest
        spans = zip((ends - size)[: 1 - words or None].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = [digest(joined[s:e], SEED) for s, e in spans]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):  # the unpacked bits of a long text stay small
        part = np.array(hashes[i : i + (1 << 14)], np.uint64).astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, fp`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), words) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])
        release_memory()

    slim = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def ball(offset: int, width: int, radius: int) -> list[int]:
    """Masks of all flips of at most ``radius`` of ``width`` bits from ``offset`` on, as
    signed longs; none for a negative radius."""
    flips = itertools.chain.from_iterable(itertools.combinations(range(offset, offset + width), n) for n in range(radius + 1))
    return [int(np.array(sum(1 << b for b in bits), np.uint64).astype(np.int64)) for bits in flips]


def segment_radii(max_distance: int, segments: int) -> list[int]:
    """The radius of the ball within each segment; -1 where a segment need not be searched."""
    whole, rest = divmod(max_distance, segments)
    return [whole if s <= rest else whole - 1 for s in range(segments)]


def _filed(fps: DataFrame, balls: list[list[int]], width: int) -> DataFrame:
    """``segment, value, fp``: each fingerprint under the values of a ball in each segment."""
    out = []
    for s, masks in enumerate(balls):
        inside = int(np.array(((1 << width) - 1) << s * width, np.uint64).astype(np.int64))
        if masks:
            flipped = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
            out.append(fps.select(F.lit(s).alias("segment"), F.col("fp"), flipped.alias("flip")).select("segment", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(inside).alias("value"), "fp"))
    return reduce(DataFrame.unionByName, out)


def links(distinct_fps: DataFrame, max_distance: int = 2, segments: int = 2, hot: int = HOT) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within ``max_distance`` among
    the column ``fp`` of distinct fingerprints, which should be stored. Each is verified."""
    if BITS % segments or segments & segments - 1:
        raise ValueError("segments must be a power of two that divides 64")
    width = BITS // segments
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    if segments == 1:
        near, far = (ball(0, BITS, r) for r in (max_distance // 2, max_distance - max_distance // 2))
        if len(near) == len(far):
            met = _filed(distinct_fps, [near], BITS)
            stars = met.withColumn("a", F.min("fp").over(Window.partitionBy("value"))).select("a", F.col("fp").alias("b"))
        else:  # an odd distance: the larger ball of one meets the smaller of the other
            stars = _filed(distinct_fps, [far], BITS).withColumnRenamed("fp", "a").join(_filed(distinct_fps, [near], BITS).withColumnRenamed("fp", "b"), "value").select("a", "b")
        return stars.filter((F.col("a") != F.col("b")) & (distance <= max_distance)).distinct()
    radii = segment_radii(max_distance, segments)
    table = _filed(distinct_fps, [ball(0, 0, min(0, r)) for r in radii], width)
    probes = _filed(distinct_fps, [ball(s * width, width, r) for s, r in enumerate(radii)], width)
    crowded, path = stash(table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("segment", "value"), "hot-values", files := few_files(distinct_fps.sparkSession))
    again = None
    if not crowded.isEmpty():
        again, _ = stash(probes.join(crowded, ["segment", "value"], "left_semi").select("fp").distinct(), "fingerprints-at-hot-values", files)
        table = table.join(crowded, ["segment", "value"], "left_anti")
    met = probes.withColumnRenamed("fp", "a").join(table.withColumnRenamed("fp", "b"), ["segment", "value"])
    # either of a pair reaches the other, so that one direction is enough
    found = met.filter((F.col("a") < F.col("b")) & (distance <= max_distance)).select("a", "b").distinct()
    if again is not None:
        return found.unionByName(links(again, max_distance, segments // 2, hot)).distinct()
    discard(distinct_fps.sparkSession, path)
    return found


def classes(fps: DataFrame, max_distance: int = 2, segments: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` for rows of ``doc_id, fp``: the smallest doc_id that is
    reachable over links between fingerprints. ``fps`` should be stored, it is read twice."""
    least, path = stash(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints", files := few_files(fps.sparkSession))
    roots = components(links(least.select("fp"), max_distance, segments))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named, _ = stash(rooted.join(lowest, "root").select("fp", "component_id"), "fingerprint-classes", files)
    discard(fps.sparkSession, path)
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    fps, _ = stash(fingerprints(docs, id_col, text_col, words), "fingerprints")
    release_heaps(docs.sparkSession)  # texts and, below, probes have grown them, of which nothing is left
    named = classes(fps, max_distance)
    release_heaps(docs.sparkSession)
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without those near to one that stays; of each component the row
    with the smallest id stays (of rows without id or with equal ids, the first stored).
    Texts are written once and meet the list of dropped rows once."""
    table, key = with_row_key(docs, "keyed-documents")
    order = F.struct(quoted(id_col).isNull().alias("none"), quoted(id_col).cast("long").alias("id"), F.col(key).alias("key"))
    # rows are ranked by (id, key) where classes() wants ids, hence the row key stands for both
    fps, fps_path = stash(fingerprints(table, key, text_col, words), "fingerprints")
    grouped = classes(fps, max_distance).select(F.col("doc_id").alias(key), F.col("component_id").alias("class"))
    ranked, ranked_path = stash(table.select(key, order.alias("order")).join(grouped, key).select("class", "order"), "ranked-rows")
    first = ranked.groupBy("class").agg(F.min("order").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("class", "best")
    gone, _ = stash(ranked.join(first, "class").filter("order <> best").select(F.col("order.key").alias(key)), "dropped-keys")
    discard(docs.sparkSession, fps_path, ranked_path)
    return table.join(gone, key, "left_anti").drop(key)
