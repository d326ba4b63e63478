"""Connected components by alternating large-star and small-star steps.

Each round costs a few hash exchanges of the edges and is written to the shared folder, so
lineage stays short and no link ever reaches the driver. A hub is only ever a group of a
map-side combined minimum and one side of a merge join that adaptive execution can split.
Rounds grow with the logarithm of the longest path, not with the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, few_files, stash

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    """A digest of the set of edges."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns, in any direction, repeats and loops allowed.

    Returns ``node, root`` for every node that has an edge to another; ``root`` is the
    smallest node it reaches. Nulls link with nothing. No edges: an empty table."""
    a, b = (F.col(c) for c in edges.columns)
    spark = edges.sparkSession
    now, path = stash(edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges", files := few_files(spark))
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        # large star: whatever is above a node moves to the least node next to it
        least = now.select("lo", "hi").union(now.select("hi", "lo")).toDF("at", "to").groupBy("at").agg(F.min("to").alias("to"))
        least = least.select(F.col("at").alias("lo"), F.least("at", "to").alias("root"))
        lifted = now.join(least, "lo").select("hi", F.col("root").alias("lo")).distinct()
        # small star: whatever is below a node, and the node, move to its least neighbour
        below = lifted.groupBy("hi").agg(F.min("lo").alias("root"))
        moved = lifted.join(below, "hi").filter("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        after, new_path = stash(moved.union(below.select("hi", F.col("root").alias("lo"))).distinct(), "edges", files)
        new_mark = _mark(after)
        discard(spark, path)
        now, path, same, mark = after, new_path, new_mark == mark, new_mark
        if same:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("hi").alias("node"), F.col("lo").alias("root")))
