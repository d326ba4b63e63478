"""Near-copies by SimHash fingerprints, complete by the exact Jaccard similarity of shingles.

First, fingerprints within two bits meet by multi-index hashing (``simhash.links``), and texts
of one fingerprint meet the least of them. Each of these links is verified. As no radius of
fingerprints holds every pair that is similar enough, prefixes then give the pairs across the
components of these links. They lose no pair: under one order of all shingles, two sets
whose Jaccard similarity reaches s share a shingle among the first n - ceil(s n) + 1 of each.
Shingles that are frequent in a sample of the documents come last in that order, so that
common passages are rarely in a prefix; the sample has no influence on results.

Documents that share a prefix shingle are first each compared with the least of them, which
joins large groups of copies in as many pairs as documents. Where the least is no copy of the
others, or only of some, as in a group around one text whose members differ from each other by
about as much as is allowed, many components stay beside a large one, and each of their documents
has a link to a large part of it. Rounds therefore deal each shingle's documents anew, by the least
of all their shingles under the round's own order, which similar sets mostly share, and compare the
documents of such a group with one that is drawn from it: again no more pairs than places. Only then
all pairs of a shingle's documents are compared that all
these links left in different components and whose sizes, places of the shingle and short sketches
allow the similarity. Rounds decide how many pairs are left to that, never whether a pair is
compared. Of the candidates most are told apart by sketches, which bound the number of different
shingles from below; every link is verified on the complete sets of shingles, and components of
the links are those of all pairs that are similar enough.

Defined results
* null or empty text, or one without words, and fewer words than a shingle has: the whole
  sequence is the one shingle, so that all texts without words are equal.
* very long text: read whole; its prefix and its set grow with it.
* ties: of equal ids the first stored row stays.
* null id: comes last among the rows to keep. Repeated rows: one stays.
* empty table: empty result. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .components import components
from .simhash import SEED
from .storage import discard, quoted, release_driver, release_memory, stash, with_row_key

#: Documents of the sample that orders shingles, the least documents of it that make a
#: shingle frequent, and the bound on the list of frequent shingles.
SAMPLE, FREQUENT_FROM, FREQUENT = 8192, 3, 100_000
#: Rows of documents that are put out at once, which bounds a worker's memory; bits of the
#: largest sketch.
ROWS, SKETCH_BITS = 256, 8192
#: Words of 64 bits of the short sketches that the join of a shingle's documents compares.
SHORT = 16
#: Rounds of drawn leads at most, and the share of a round's documents that it must have linked for
#: another one.
ROUNDS, PROGRESS = 4, 0.01


def shingles(text: bytes | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of the word shingles of a UTF-8 text, ascending."""
    found = (text or b"").lower().split()
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size + 1) - 1
        spans = zip((ends - size)[: 1 - words or None].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(found) - words + 1)
    return np.unique(hashes.view(np.int64))


def prefix_length(n: int, per_cent: int) -> int:
    return n + (-n * per_cent // 100) + 1


def _texts(table: DataFrame, key: str, text_col: str) -> DataFrame:
    return table.select(F.col(key).alias("key"), quoted(text_col).cast("binary").alias("text"))


def _frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of the sample have, ascending, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                found = [shingles(text.as_py(), words) for text in batch.column(0).slice(at, ROWS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["token"])

    # SAMPLE ids, which bounds this broadcast
    drawn = texts.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    found = texts.join(F.broadcast(drawn), "key").select("text").mapInArrow(run, "token long")
    counted = found.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    tokens, counts = (counted.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def prefixes(texts: DataFrame, words: int, per_cent: int) -> DataFrame:
    """``token, key, n, past``: the prefix of each document's n shingles, and how many of them
    come before each."""
    frequent = texts.sparkSession.sparkContext.broadcast(_frequent(texts, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = frequent.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part, firsts, sizes = batch.slice(start, ROWS), [], []
                for text in part.column(1):
                    own = shingles(text.as_py(), words)
                    often = np.zeros(len(own), np.int64)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                        often = np.where(tokens[at] == own, counts[at], 0)
                    firsts.append(own[np.lexsort((own, often))][: prefix_length(len(own), per_cent)])
                    sizes.append(len(own))
                times = [len(first) for first in firsts]
                columns = np.concatenate(firsts), np.repeat(part.column(0).to_numpy(), times), np.repeat(np.array(sizes, np.int32), times), np.concatenate([np.arange(t, dtype=np.int32) for t in times])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "key", "n", "past"])
        release_memory()

    return texts.mapInArrow(run, "token long, key long, n int, past int")


def _may_reach(n: Column, past_n: Column, m: Column, past_m: Column, per_cent: int) -> Column:
    """Whether sets of n and m shingles can be similar enough if the first that both have
    comes after so many: then no more can be common than either has from there on. A pair's
    first common shingle passes this, so no pair is lost if others do not."""
    return F.least(n - past_n, m - past_m).cast("long") * (100 + per_cent) >= (n + m).cast("long") * per_cent


def sketch(own: np.ndarray) -> bytes:
    """One bit for each value of the last bits of a hash, about two for each shingle: whether
    an odd number of the set's shingles has that value."""
    bits = min(SKETCH_BITS, max(64, 1 << (2 * len(own) - 1).bit_length()))
    odd = np.bincount(own & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_sketch(own: np.ndarray) -> list[int]:
    """The sketch of SHORT words of 64 bits, whatever the set's size."""
    odd = np.bincount(own & (64 * SHORT - 1), minlength=64 * SHORT) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def least_values(own: np.ndarray) -> list[int]:
    """The least of a set's hashes under each of ROUNDS orders, by odd factors."""
    return [int((own.view(np.uint64) * np.uint64(2 * xxhash.xxh64_intdigest(b"order", i) + 1 & (1 << 64) - 1)).min().astype(np.int64)) for i in range(ROUNDS)]


def least_difference(a: bytes, b: bytes) -> int:
    """How many shingles at least only one of two sets has: a shingle of both changes the same
    bit in either sketch. The longer sketch is folded to the length of the other."""
    x, y = (int.from_bytes(v, "little") for v in (a, b))
    size = [8 * len(a), 8 * len(b)]
    while size[0] != size[1]:
        if size[0] < size[1]:
            x, y, size = y, x, size[::-1]
        size[0] //= 2
        x = x >> size[0] ^ x & (1 << size[0]) - 1
    return (x ^ y).bit_count()


def _of_keys(texts: DataFrame, pairs: DataFrame, make, kind: str, words: int, label: str) -> tuple[DataFrame, str]:
    """Stored ``key, n, made`` for the texts of the pairs' keys: the number of shingles and
    what ``make`` gives for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [shingles(text.as_py(), words) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, found), pa.int64()), pa.array(map(make, found), pa.binary() if kind == "binary" else pa.list_(pa.int64()))], ["key", "n", "made"])
        release_memory()

    keys, keys_path = stash(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "candidate-keys")
    made = stash(texts.join(keys, "key", "left_semi").select("key", "text").mapInArrow(run, f"key long, n long, made {kind}"), label)
    discard(texts.sparkSession, keys_path)
    return made


def by_fingerprint(texts: DataFrame, words: int = 3, max_distance: int = 2) -> tuple[DataFrame, list[str]]:
    """``a, b``: a link for each two distinct fingerprints that ``simhash.links`` joins, between
    the least documents of both, and one from each document to the least of its fingerprint;
    and the paths of what is stored."""
    fps, fps_path = stash(simhash.fingerprints(texts, "key", "text", words), "fingerprints")
    least, least_path = stash(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    met = simhash.links(least.select("fp"), max_distance)
    heads = met.join(least.toDF("a", "x"), "a").join(least.toDF("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    copies = fps.join(least, "fp").filter("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    return heads.unionByName(copies), [fps_path, least_path]


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that ``roots`` (node, root) leaves in different components."""
    named = pairs.distinct().join(roots.toDF("a", "root_a"), "a", "left").join(roots.toDF("b", "root_b"), "b", "left")
    return named.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _verified(texts: DataFrame, candidates: DataFrame, words: int, per_cent: int) -> DataFrame:
    """The rows ``a, b`` of ``candidates`` that are similar enough. The result is stored.

    Sketches tell most of the others at a fraction of the size of the sets; what they leave is
    verified on the complete sets."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.fromiter((least_difference(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5), strict=True)), np.int64, batch.num_rows)
            # common <= (n - apart) / 2, and common * 100 must reach (n - common) * per_cent
            keep = pa.array((n - apart) * (100 + per_cent) >= 2 * n * per_cent)
            yield batch.filter(keep).select(["a", "b"])

    def both(of: DataFrame) -> DataFrame:
        return pairs.join(of.toDF("a", "n_a", "of_a"), "a").join(of.toDF("b", "n_b", "of_b"), "b").select("a", "b", "n_a", "n_b", "of_a", "of_b")

    pairs, pairs_path = stash(candidates.distinct(), "candidate-pairs")
    sketches, sketches_path = _of_keys(texts, pairs, sketch, "binary", words, "sketches")
    pairs, near_path = stash(both(sketches).mapInArrow(near, "a long, b long"), "near-pairs")
    sets, sets_path = _of_keys(texts, pairs, np.ndarray.tolist, "array<bigint>", words, "candidate-shingles")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    out, _ = stash(both(sets).select("a", "b", common.alias("common"), (F.col("n_a") + F.col("n_b")).alias("n")).filter(F.col("common") * 100 >= (F.col("n") - F.col("common")) * per_cent).select("a", "b"), "links")
    discard(texts.sparkSession, pairs_path, sketches_path, near_path, sets_path)
    return out


def _mixed(filed: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``filed`` (token, key and others), with their components by ``roots``, whose
    shingles documents of different components have."""
    rooted = filed.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    by_token = Window.partitionBy("token")
    return rooted.withColumn("low", F.min("root").over(by_token)).withColumn("high", F.max("root").over(by_token)).filter("low <> high").drop("low", "high")


def _similar(some: DataFrame, others: DataFrame, per_cent: int, on: list[str]) -> DataFrame:
    """Pairs of rows with equal ``on``, columns with _a and _b, of documents in different
    components, that sizes and short sketches allow to be similar enough."""
    x, y = (of.select(*on, *[F.col(c).alias(f"{c}_{side}") for c in of.columns if c not in on]) for of, side in ((some, "a"), (others, "b")))
    n, m = F.col("n_a").cast("long"), F.col("n_b").cast("long")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(SHORT)])
    # common <= (n + m - apart) / 2, and common * 100 must reach (n + m - common) * per_cent
    near = (n + m - apart) * (100 + per_cent) >= (n + m) * (2 * per_cent)
    return x.join(y, on).filter((F.col("root_a") != F.col("root_b")) & (F.least(n, m) * 100 >= F.greatest(n, m) * per_cent) & near)


def links(texts: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of rows (key, text) with a
    Jaccard similarity of at least ``per_cent`` hundredths. ``texts`` should be stored."""
    spark, by_token = texts.sparkSession, Window.partitionBy("token")
    candidates, fingerprint_paths = by_fingerprint(texts)
    hashed = _verified(texts, candidates, words, per_cent)
    discard(spark, *fingerprint_paths)
    release_driver(spark)  # here and below: each part is some dozens of jobs
    known, known_path = stash(components(hashed), "components-by-fingerprint")
    filed = prefixes(texts, words, per_cent).withColumn("lead", F.min(F.struct("key", "n", "past")).over(by_token)).withColumn("last", F.max("key").over(by_token))
    shared, shared_path = stash(filed.filter("lead.key <> last").select("token", "key", "n", "past", F.col("lead.key").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.past").alias("lead_past")), "shared-prefixes")
    rest = shared.filter("key <> lead")
    led = rest.filter(_may_reach(F.col("n"), F.col("past"), F.col("lead_n"), F.col("lead_past"), per_cent)).select(F.col("lead").alias("a"), F.col("key").alias("b"))
    stars = hashed.unionByName(_verified(texts, _across(led, known), words, per_cent))
    release_driver(spark)
    # pairs with the least document of a shingle are settled; of the others, those across components
    mixed, mixed_path = stash(_mixed(rest.select("token", "key", "n", "past"), components(stars)), "mixed-prefixes")
    signs, signs_path = _of_keys(texts, mixed.select(F.col("key").alias("a"), F.col("key").alias("b")), lambda own: short_sketch(own) + least_values(own), "array<bigint>", words, "short-sketches")
    named = [F.col("made")[i].alias(name) for i, name in enumerate([f"s{i}" for i in range(SHORT)] + [f"least{i}" for i in range(ROUNDS)])]
    drawn, drawn_path = stash(mixed.join(signs.select("key", *named), "key"), "sketched-prefixes")
    documents = signs.count()
    discard(spark, shared_path, mixed_path, signs_path)
    release_driver(spark)
    for seed in range(ROUNDS):
        group = ["token", f"least{seed}"]
        own = drawn.drop(*[f"least{i}" for i in range(ROUNDS) if i != seed])
        lead = own.groupBy(*group).agg(F.min_by(F.struct(*[c for c in own.columns if c not in group]), F.xxhash64(F.lit(seed), "token", "key")).alias("lead")).select(*group, "lead.*")
        led = _similar(lead, own, per_cent, group).select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
        found = _verified(texts, led, words, per_cent)
        linked = found.count()
        if not linked:
            break
        stars, old_path = stars.unionByName(found), drawn_path
        drawn, drawn_path = stash(_mixed(drawn.drop("root"), components(stars)), "sketched-prefixes")
        discard(spark, old_path)
        release_driver(spark)
        if linked < PROGRESS * documents:
            break
    drawn = drawn.drop(*[f"least{i}" for i in range(ROUNDS)])
    across = _similar(drawn, drawn, per_cent, ["token"]).filter((F.col("key_a") < F.col("key_b")) & _may_reach(F.col("n_a"), F.col("past_a"), F.col("n_b"), F.col("past_b"), per_cent))
    out = stars.unionByName(_verified(texts, across.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")), words, per_cent))
    discard(spark, known_path, drawn_path)
    release_driver(spark)
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which, in each component of near-copies, the row with the
    smallest id stays (of rows without id or with equal ids, the first stored)."""
    release_driver(docs.sparkSession)
    table, key = with_row_key(docs, "keyed-documents")
    roots, roots_path = stash(components(links(_texts(table, key, text_col), words, per_cent)).toDF("key", "class"), "near-copies")
    order = F.struct(quoted(id_col).isNull().alias("none"), quoted(id_col).cast("long").alias("id"), F.col(key).alias("key"))
    ranked, ranked_path = stash(table.select(F.col(key).alias("key"), order.alias("order")).join(roots, "key").select("class", "order"), "ranked-rows")
    first = ranked.groupBy("class").agg(F.min("order").alias("best"))
    gone, _ = stash(ranked.join(first, "class").filter("order <> best").select(F.col("order.key").alias(key)), "dropped-keys")
    discard(docs.sparkSession, roots_path, ranked_path)
    return table.join(gone, key, "left_anti").drop(key)
