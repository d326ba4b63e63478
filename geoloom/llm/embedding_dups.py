"""Near-duplicate embeddings by a distributed cover tree and dual traversal, exact.

Equal vectors are first put together, with their number. The tree of all vectors is grown in
rounds: each node of more vectors than a block draws a bounded random sample, the leaves of
the sample's cover tree are the centres of its children, and every vector of the node goes to
the child whose centre is nearest, in tasks of bounded size. Covering radii are measured over
all vectors, not over the sample. Nodes so narrow that all their vectors link are not split.

Pairs of nodes are then traversed from the root down, in joins of the nodes' own table, and
those that their covering radii keep apart are pruned before any vector moves. Narrow nodes of
many vectors that link as a whole are settled by their numbers alone. The other nodes are put
together in blocks, neighbours in the tree next to each other, and each pair of blocks that
has a pair of nodes left is one task, which builds cover trees of both and traverses them
together down to exact cosines (cover_tree.py). A task returns for each vector its number of
links and one link towards the least vector of its local class, so dense groups never become
lists of pairs.

Defined results
* null vectors, zero vectors, and vectors with null or non-finite components or of no
  components: no links. Vectors of different lengths never link. Equal vectors always do.
* components of any size, 1e-200 too: vectors are scaled before their lengths are taken.
* null id: such a vector links like others; a class of nothing else has a null id.
* ties and repeated rows are vectors of their own. ``kept`` is true of every row with the
  least id.
* empty table: empty result. Labels and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .cover_tree import SLACK, CoverTree, DualTraversal, build, unit
from .storage import quoted, stash

#: Vectors in a block at most; vectors in the sample of a node, on average; vectors that one
#: task assigns to children.
BLOCK_ROWS, SAMPLE, ASSIGNED_ROWS = 8192, 1024, 65536
#: Rounds of splitting; each divides a node by about SAMPLE, so that these suffice for any table.
MAX_ROUNDS = 64

_POINTS = "node string, key long, weight long, vector binary, apart double"


def _matrix(vectors: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1)


def _distinct(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, str]:
    """Stored rows (row_key, vec_id, vector, the components as they are) of all vectors, the
    distinct ones that can link (node, key, weight, vector), and numpy's name of a component."""
    given = quoted(vector_col)
    single = vectors.select(given).schema[0].dataType.simpleString() == "array<float>"
    kind, raw = ("<f4", given) if single else ("<f8", given.cast("array<double>"))
    good = raw.isNotNull() & (F.size(raw) > 0) & F.forall(raw, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(raw, lambda x: x != 0)
    base = vectors.select(F.monotonically_increasing_id().alias("row_key"), quoted(id_col).cast("long").alias("vec_id"), F.when(good, raw).alias("vector"))

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # + 0.0: a negative zero is a zero
            packed = [None if x is None else (np.array(x, kind) + np.array(0, kind)).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["row_key", "vec_id", "vector"])

    rows, _ = stash(base.mapInArrow(to_bytes, "row_key long, vec_id long, vector binary"), "vectors")
    some = rows.filter("vector is not null").groupBy("vector").agg(F.min("row_key").alias("key"), F.count(F.lit(1)).alias("weight"))
    points = some.select(F.octet_length("vector").cast("string").alias("node"), "key", "weight", "vector", F.lit(2.0).alias("apart"))
    return rows, stash(points, "distinct-vectors")[0], kind


def _grow(points: DataFrame, kind: str, block_rows: int, narrow: float, sample: int) -> tuple[DataFrame, list[DataFrame]]:
    """Split nodes until each has ``block_rows`` vectors at most or a radius below ``narrow``.
    Returns the vectors by leaf, and of each level the stored nodes: node, parent, centre,
    radius, n, weight, least (key), wide (it is split), block (of a leaf of few vectors)."""

    def centres(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The children's centres, neighbours next to each other."""
        group = group.sort_values("key", ignore_index=True)
        tree = build(unit(_matrix(group.vector, kind)), leaf=1, least_radius=narrow / 2)
        order = tree.leaves[np.argsort(tree.start[tree.leaves])]
        # the vector that is furthest from the node's centre is one too, which ends every split
        chosen = list(dict.fromkeys([*group.vector[tree.centre[order]], group.far[0]]))
        return pd.DataFrame({"parent": key[0], "place": range(len(chosen)), "node": [f"{key[0]}/{i}" for i in range(len(chosen))], "centre": chosen})

    def assign(key: tuple, rows: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        given, raw = given.sort_values("place"), _matrix(rows.vector, kind)
        middle, names = unit(_matrix(given.centre, kind)), given.node.to_numpy()
        child, apart = np.zeros(len(raw), np.int64), np.zeros(len(raw))
        for s in range(0, len(raw), 4096):
            u = unit(raw[s : s + 4096])
            best = np.argmax(u @ middle.T, axis=1)
            child[s : s + 4096], apart[s : s + 4096] = best, np.linalg.norm(u - middle[best], axis=1)
        return pd.DataFrame({"node": names[child], "key": rows.key, "weight": rows.weight, "vector": rows.vector, "apart": apart})

    done, levels, born = [], [], None
    before = F.sum("n").over(Window.partitionBy("parent").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    block = F.concat_ws(":", F.coalesce("parent", "node"), F.floor(F.coalesce(before, F.lit(0)) / block_rows).cast("string"))
    for _ in range(MAX_ROUNDS):
        sizes = points.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"), F.max("apart").alias("radius"), F.min("key").alias("least"), F.max_by("vector", "apart").alias("far"))
        sizes = sizes.withColumns({"parent": F.lit(None).cast("string"), "place": F.lit(0), "centre": F.lit(None).cast("binary")}) if born is None else sizes.join(born, "node")
        sizes = sizes.withColumn("wide", (F.col("n") > block_rows) & (F.col("radius") >= narrow))
        sizes, _ = stash(sizes.withColumn("block", F.when(F.col("n") <= block_rows, block)), "tree-nodes")
        levels.append(sizes)
        wide = sizes.filter("wide").select("node", "n", "far", "least")
        if wide.isEmpty():
            return reduce(DataFrame.unionByName, [*done, points]), levels
        done.append(points.join(wide.select("node"), "node", "left_anti"))
        big = points.drop("apart").join(wide, "node")
        # a draw by the key's digest: an even share of the node, whatever the order of the table
        drawn = big.filter((F.pmod(F.xxhash64("key", "node"), F.col("n")) < sample) | (F.col("key") == F.col("least")))
        born, _ = stash(drawn.groupBy("node").applyInPandas(centres, "parent string, place int, node string, centre binary"), "tree-centres")
        parts = F.ceil(F.col("n") / ASSIGNED_ROWS).cast("long")
        spread = big.select("node", "key", "weight", "vector", F.pmod(F.xxhash64("key"), parts).alias("part"))
        copies = born.join(wide.select(F.col("node").alias("parent"), "n"), "parent").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("n")
        points, _ = stash(spread.groupBy("node", "part").cogroup(copies.groupBy("parent", "part")).applyInPandas(assign, _POINTS), "tree-vectors")
    raise RuntimeError(f"nodes are still too large after {MAX_ROUNDS} rounds")


def _left(levels: list[DataFrame], kind: str, reach: float) -> tuple[DataFrame, DataFrame]:
    """Traverse pairs of nodes from the roots down. Returns the pairs ``x, y`` of blocks that
    are left, and of those nodes of many vectors that are not wide: ``x, y, whole``."""

    def expand(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        row = group.iloc[0]
        sides = []
        for side in ("x", "y"):
            sides.append((np.array(row[f"{side}_nodes"], object), unit(_matrix(pd.Series(row[f"{side}_centres"]), kind)), np.array(row[f"{side}_radii"]), np.array(row[f"{side}_blocks"], object), np.array(row[f"{side}_wide"], bool)))
        (nx, cx, rx, bx, wx), (ny, cy, ry, by, wy) = sides
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * (cx @ cy.T)))
        around = rx[:, None] + ry[None, :]
        left = apart - around <= reach + SLACK
        if key[0] == key[1]:
            left &= np.triu(np.ones_like(left))  # of the children of one node each pair once
        i, j = np.nonzero(left)
        opened = wx[i] | wy[j]
        light = ~opened & (bx[i] != "") & (by[j] != "")
        many = ~opened & ~light
        blocks = pd.DataFrame({"x": bx[i[light]], "y": by[j[light]]}).drop_duplicates()
        same = nx[i[many]] == ny[j[many]]
        whole = np.where(same, 2 * rx[i[many]], (apart + around)[i[many], j[many]]) < reach - SLACK
        whole &= (bx[i[many]] == "") & (by[j[many]] == "")
        parts = [pd.DataFrame({"x": nx[i[opened]], "y": ny[j[opened]]}).assign(state="open", whole=False), blocks.assign(state="light", whole=False), pd.DataFrame({"x": nx[i[many]], "y": ny[j[many]]}).assign(state="many", whole=whole)]
        return pd.concat(parts, ignore_index=True)[["x", "y", "state", "whole"]]

    def families(level: int) -> DataFrame:
        """What stands for each node in a traversal of this level: its children, or itself."""
        rows = levels[level].withColumn("of", F.col("parent"))
        for i in range(level):
            rows = rows.unionByName(levels[i].filter("not wide and centre is not null").withColumn("of", F.col("node")))
        members = F.array_sort(F.collect_list(F.struct("place", "node", "centre", "radius", F.coalesce("block", F.lit("")).alias("block"), "wide")))
        listed = rows.groupBy("of").agg(members.alias("m"))
        return listed.select("of", F.col("m.node").alias("nodes"), F.col("m.centre").alias("centres"), F.col("m.radius").alias("radii"), F.col("m.block").alias("blocks"), F.col("m.wide").alias("wide"))

    roots = levels[0]
    blocks = [roots.filter("not wide").select(F.col("block").alias("x"), F.col("block").alias("y"))]
    many = []
    pairs = roots.filter("wide").select(F.col("node").alias("x"), F.col("node").alias("y"))
    for level in range(1, len(levels)):
        family = families(level)
        x = family.select(F.col("of").alias("x"), *[F.col(c).alias(f"x_{c}") for c in family.columns[1:]])
        y = family.select(F.col("of").alias("y"), *[F.col(c).alias(f"y_{c}") for c in family.columns[1:]])
        made, _ = stash(pairs.join(x, "x").join(y, "y").groupBy("x", "y").applyInPandas(expand, "x string, y string, state string, whole boolean"), "node-pairs")
        pairs = made.filter("state = 'open'").select("x", "y")
        blocks.append(made.filter("state = 'light'").select("x", "y"))
        many.append(made.filter("state = 'many'").select("x", "y", "whole"))
    none = roots.limit(0).select(F.col("node").alias("x"), F.col("node").alias("y"), F.col("wide").alias("whole"))
    return reduce(DataFrame.unionByName, blocks), reduce(DataFrame.unionByName, many, none)


def link_counts(points: DataFrame, kind: str, threshold: float, block_rows: int = BLOCK_ROWS, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """``key, n`` and ``key, root``: numbers of linked vectors, to be summed by key, and links
    whose components are those of all links, of distinct vectors."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    placed, levels = _grow(points, kind, block_rows, max(reach / 2 - SLACK, 10 * SLACK), sample)
    light, many = _left(levels, kind, reach)
    many, _ = stash(many, "pairs-of-many")
    nodes = reduce(DataFrame.unionByName, levels).filter("not wide").select("node", "n", "weight", "least", "block")

    # blocks: of a node of few vectors the one it shares, of another as many as it needs
    parts = F.ceil(F.col("n") / block_rows).cast("long")
    block = F.coalesce("block", F.concat_ws("#", "node", F.pmod(F.xxhash64("key"), parts).cast("string")))
    blocked = placed.join(nodes, "node").select(block.alias("block"), "key", placed.weight, "vector")
    all_of = nodes.select("node", F.when(F.col("block").isNotNull(), F.array("block")).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: F.concat_ws("#", "node", i.cast("string")))).alias("all"))
    apart = many.filter("not whole").join(all_of.toDF("x", "all_x"), "x").join(all_of.toDF("y", "all_y"), "y").select(F.explode("all_x").alias("x"), "all_y").select("x", F.explode("all_y").alias("y"))
    pairs, _ = stash(light.unionByName(apart).select(F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q")).distinct(), "block-pairs")
    sides = pairs.select("p", "q", F.col("p").alias("block"), F.lit(False).alias("second")).unionByName(pairs.filter("p <> q").select("p", "q", F.col("q").alias("block"), F.lit(True).alias("second")))

    last: dict[str, CoverTree] = {}  # of this task: its groups are in order of their first block

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        a, b = group[~group.second], group[group.second]
        if not len(a) or not len(b) and key[0] != key[1]:
            return pd.DataFrame({"key": [], "n": [], "root": []}).astype("int64")
        if key[0] not in last:
            last.clear()
            last[key[0]] = build(unit(_matrix(a.vector, kind)))
        other = None if key[0] == key[1] else _matrix(b.vector, kind)
        found = DualTraversal(last[key[0]], other, threshold, a.weight.to_numpy(), None if other is None else b.weight.to_numpy())
        keys = np.concatenate([a.key.to_numpy(), b.key.to_numpy()])
        n = np.concatenate(found.links)
        at = np.flatnonzero(n)
        return pd.DataFrame({"key": keys[at], "n": n[at], "root": keys[[found.root(i) for i in at.tolist()]] if len(at) else keys[:0]})

    made, _ = stash(blocked.join(sides, "block").groupBy("p", "q").applyInPandas(compare, "key long, n long, root long"), "links")

    # pairs of nodes that link as a whole: by their numbers
    whole = many.filter("whole")
    at_y = nodes.select(F.col("node").alias("y"), F.col("weight").alias("n"), F.col("least").alias("root"))
    of_x = whole.unionByName(whole.filter("x <> y").select(F.col("y").alias("x"), F.col("x").alias("y"), "whole")).join(at_y, "y")
    each = of_x.groupBy(F.col("x").alias("node")).agg(F.sum("n").alias("n"), F.max((F.col("x") == F.col("y")).cast("int")).alias("itself"))
    rows = placed.join(each, "node").join(nodes.select("node", "least"), "node").select("key", (F.col("n") - F.col("itself") * F.col("weight")).alias("n"), F.col("least").alias("root"))
    across = of_x.filter("x <> y").join(nodes.select(F.col("node").alias("x"), F.col("least").alias("key")), "x").select("key", "root")
    settled, _ = stash(rows, "links-of-whole-nodes")
    return made.select("key", "n").unionByName(settled.select("key", "n")), made.select("key", "root").unionByName(settled.select("key", "root")).unionByName(across)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    rows, points, kind = _distinct(vectors, id_col, vector_col)
    counts, links = link_counts(points, kind, threshold, block_rows, sample)
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"))
    classes = components(links).toDF("key", "class")
    # only of vectors that occur again another row than the first is to be found
    again = points.filter("weight > 1").select("vector", "key", "weight")
    keyed = rows.join(again, "vector", "left").select("vec_id", F.coalesce("key", "row_key").alias("key"), (F.coalesce("weight", F.lit(1).cast("long")) - 1).alias("equal"))
    classed, _ = stash(keyed.join(counts, "key", "left").join(classes, "key", "left").select("vec_id", (F.coalesce("n", F.lit(0).cast("long")) + F.col("equal")).alias("n_links"), F.coalesce("class", "key").alias("class")), "classed-vectors")
    lowest = classed.groupBy("class").agg(F.min("vec_id").alias("component_id"))
    return classed.join(lowest, "class").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
