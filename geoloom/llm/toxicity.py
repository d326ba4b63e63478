"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Every word of a text is a feature. A word weighs (1 + log of its count) times its inverse
document frequency, counted over all documents, times FLOOR plus the share of the labels'
entropy that it explains among the labelled examples, so that words that go with a label lead
the search and no word is left out. Words that no example has weigh as words of no document
at the floor; they can match nothing and count in a text's length only.

The examples are indexed by an inverted index in blocks: for each word and block the largest
weight is kept, so that a query bounds every block, visits blocks in order of their bounds,
and stops where no block can change its k nearest examples. Words of many examples are rows of
all examples instead, and words whose blocks hold hardly more than one example of them have postings
only; the sums of both are complete before the bounds. The search is exact. Votes are
weighted by squared similarity and by how many labelled rows of its class an example stands
for. Examples of a text's own content (equal words and counts) have no vote, so that a score
is never the memory of a label and the examples' own votes can calibrate scores: an isotonic
curve maps votes to the share of toxic rows among examples with such votes.

Defined results
* null, empty or any text without a word: the share of toxic rows among labelled texts
  without a word (of all labelled texts, if there are none), no evidence. A text that shares
  no word with another example: the share of all.
* very long text: read whole.
* ties: of equal similarities the example with the smaller id comes first.
* rows without id: scored, never examples. Repeated rows: one result row each.
* repeated or conflicting labels of an id: toxic if any says so. Null labels: unlabelled.
* no labelled examples of either class: score 0 everywhere. Empty table: empty result.
* other columns, and labels of documents that do not exist, are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, quoted, stash

#: The bound on labelled rows of each class that become examples.
EXAMPLES = 4000
#: A word of more than one in FREQUENT examples has a row of them all, in FREQUENT_BYTES at most;
#: searches whose sums over these rows are made at once.
FREQUENT, FREQUENT_BYTES, BATCH = 24, 32 << 20, 32
#: A word with fewer postings than this to a block that has it is summed before the bounds.
SCATTERED = 4
#: What a word weighs that tells nothing, beside the share of the labels' entropy.
FLOOR = 0.001
#: Neighbours that vote, examples of a block, blocks of the first wave.
NEIGHBOURS, BLOCK, WAVE = 15, 64, 16
#: Weight of the base rate in a vote, against one of typical similarity.
PRIOR_WEIGHT = 0.2
#: From this cosine on an example has a text's own content.
SAME = 1 - 1e-9
#: Rows of documents that are put out at once.
ROWS = 1024

_WORDS, _ASCII_WORDS, _LATIN_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*"), re.compile("[a-z]+"), re.compile("[a-zªµºß-öø-ÿ]+")


def text_words(text: str) -> Counter:
    """How often each lower-case word occurs."""
    text = text.lower()
    if text.isascii():
        return Counter(_ASCII_WORDS.findall(text))
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return Counter(_WORDS.findall(text))
    return Counter(_LATIN_WORDS.findall(text))  # lower-case letters; there are no marks


def explained(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """The share of the labels' entropy that the presence of each word explains, from the
    numbers of toxic and clean examples that have it."""
    n = all_toxic + all_clean
    have, lack = toxic + clean, n - toxic - clean
    gain = np.zeros(len(toxic))
    for joint, of_word, of_label in ((toxic, have, all_toxic), (clean, have, all_clean), (all_toxic - toxic, lack, all_toxic), (all_clean - clean, lack, all_clean)):
        expected = of_word * (of_label / n)
        at = joint > 0
        gain[at] += joint[at] / n * np.log(joint[at] / expected[at])
    entropy = -sum(x / n * math.log(x / n) for x in (all_toxic, all_clean))
    return np.maximum(gain, 0.0) / entropy


class BlockMaxIndex:
    """Exact cosine search over unit vectors, in blocks of BLOCK examples that share their
    heaviest word where they can."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], features: int):
        self.n = len(vectors)
        self.blocks = max(1, -(-self.n // BLOCK))
        heaviest = [int(ids[np.argmax(w)]) if len(ids) else -1 for ids, w in vectors]
        #: the example at each place, places being what postings tell
        self.example = np.argsort(np.array(heaviest, np.int64), kind="stable")
        ids = np.concatenate([vectors[i][0] for i in self.example] or [np.zeros(0, np.int64)])
        weights = np.concatenate([vectors[i][1] for i in self.example] or [np.zeros(0)])
        places = np.repeat(np.arange(self.n), [len(vectors[i][0]) for i in self.example])
        order = np.lexsort((places, ids))
        ids, places, weights = ids[order], places[order], weights[order]
        # words of many examples, the most frequent first, as rows
        counts = np.bincount(ids, minlength=features)
        common = np.flatnonzero(counts > self.n / FREQUENT)
        common = common[np.argsort(-counts[common], kind="stable")][: FREQUENT_BYTES // (8 * max(1, self.n))]
        self.row = np.full(features, -1)
        self.row[common] = np.arange(len(common))
        # the rows and BATCH are multiples of what products of matrices are made in, so that each
        # sum is added up in one way, equal examples' sums too
        self.rows = np.zeros((len(common), self.blocks * BLOCK))
        row = self.row[ids]
        self.rows[row[row >= 0], places[row >= 0]] = weights[row >= 0]
        ids, self.places, self.weights = ids[row < 0], places[row < 0], weights[row < 0]
        # where each word's postings are
        self.postings = np.searchsorted(ids, np.arange(features + 1))
        # an entry for each word and block: where its postings are, and their largest weight
        cell = ids * self.blocks + self.places // BLOCK
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.start, self.stop = first, np.append(first[1:], len(cell))
        self.block = cell[first] % self.blocks
        self.largest = np.maximum.reduceat(self.weights, first) if len(first) else np.zeros(0)
        self.entries = np.searchsorted(ids[first], np.arange(features + 1))
        # words with hardly more postings than entries, whose bounds cost as much as their sums
        self.scattered = np.diff(self.postings) < SCATTERED * np.diff(self.entries)
        self.steps = np.arange(1)

    def _ranges(self, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the ranges one after the other, and for each the weight of its range."""
        size = high - low
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        if total > len(self.steps):
            self.steps = np.arange(2 * total)
        out = np.repeat(low - ends + size, size)
        out += self.steps[:total]
        return out, np.repeat(weights, size)

    def frequent(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For each of BATCH queries at most, the sums over the words that have rows, by place."""
        of = np.zeros((BATCH, len(self.rows)))
        for i, (ids, weights) in enumerate(queries):
            row = self.row[ids]
            of[i, row[row >= 0]] = weights[row >= 0]
        return of @ self.rows

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, same: float = math.inf, whole: np.ndarray | None = None) -> list[tuple[float, int]]:
        """The k examples of largest cosine above 0 and below ``same``, nearest first, ties by
        number. Blocks are visited in order of their bounds, in waves that grow fourfold, until no
        block is left whose bound reaches the k-th cosine so far."""
        if whole is None:
            whole = self.frequent([(ids, weights)])[0]
        rare = self.row[ids] < 0
        ids, weights = ids[rare], weights[rare]
        scattered = self.scattered[ids]
        few = ids[scattered]
        posting, product = self._ranges(self.postings[few], self.postings[few + 1], weights[scattered])
        product *= self.weights.take(posting)
        whole = whole + np.bincount(self.places.take(posting), product, minlength=len(whole))
        ids, weights = ids[~scattered], weights[~scattered]
        entry, weight = self._ranges(self.entries[ids], self.entries[ids + 1], weights)
        block = self.block.take(entry)
        bound = np.bincount(block, weight * self.largest.take(entry), minlength=self.blocks)
        bound = bound + whole.reshape(self.blocks, BLOCK).max(axis=1)
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[float, int]] = []  # (-cosine, example), sorted
        at, wave = 0, WAVE
        while at < self.blocks:
            # a bound is rounded otherwise than the sums of its block, hence the allowance
            least = max(-best[-1][0] - 1e-9 if len(best) == k else 0.0, 1e-12)
            now = order[at : at + wave]
            now = now[bound[now] >= least]
            if not len(now):
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[now] = True
            take = np.flatnonzero(chosen[block])
            of = entry[take]
            posting, product = self._ranges(self.start[of], self.stop[of], weight[take])
            product *= self.weights.take(posting)
            sums = np.bincount(self.places.take(posting), product, minlength=len(whole))
            sums = sums + whole
            sums.reshape(self.blocks, BLOCK)[~chosen] = 0
            # what is further below the k-th than rounding can lift it is not looked at
            found = np.flatnonzero(sums >= least if len(best) == k else sums > 0)
            sums = np.round(sums[found], 12)
            near = (sums > 0) & (sums < same)
            found, sums = found[near], sums[near]
            if len(found) > k:  # all that tie with the k-th stay
                near = sums >= np.partition(sums, -k)[-k]
                found, sums = found[near], sums[near]
            best = sorted(best + list(zip((-sums).tolist(), self.example[found].tolist(), strict=True)))[:k]
            at, wave = at + wave, 4 * wave
        return [(-c, j) for c, j in best]


def isotonic(votes: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising curve next to the labels: votes, and shares of toxic rows, to be interpolated."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for v, y, w in zip(votes[order].tolist(), toxic[order].tolist(), weights[order].tolist(), strict=True):
        pools.append([v * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


@dataclass
class Model:
    """Weights of words and the examples; EXAMPLES texts of a class bound them."""

    word_weight: np.ndarray
    unknown_weight: float
    doc_ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    words: list[tuple[np.ndarray, np.ndarray]]
    curve: tuple[np.ndarray, np.ndarray] | None = None

    def build(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.full = np.array([i for i, (ids, _) in enumerate(model.words) if len(ids)], np.int64)
        self.index = BlockMaxIndex([(model.words[i][0], self.unit(*model.words[i])) for i in self.full], len(model.word_weight))
        rate = lambda at: float((model.stands_for * model.toxic)[at].sum() / (model.stands_for[at].sum() or 1.0))
        bare = np.setdiff1d(np.arange(len(model.words)), self.full)
        self.base = rate(slice(None))
        self.bare = rate(bare) if len(bare) else self.base

    def unit(self, ids: np.ndarray, counts: np.ndarray, unknown: float = 0.0) -> np.ndarray:
        """Weights of known words in the unit vector; ``unknown``: the squares of 1 + log of
        the counts of the others, added up."""
        weights = (1 + np.log(counts)) * self.model.word_weight[ids]
        return weights / math.sqrt(float((weights**2).sum()) + unknown * self.model.unknown_weight**2)

    def _batches(self, rows: Iterable[tuple[np.ndarray, np.ndarray, float]]) -> Iterator[tuple[np.ndarray, float, np.ndarray, np.ndarray]]:
        """Ids, ``unknown``, unit weights, and sums over the frequent words, of each row."""
        rows = iter(rows)
        while group := list(itertools.islice(rows, BATCH)):
            units = [self.unit(*x) if len(x[0]) else np.zeros(0) for x in group]
            for (ids, _, unknown), unit, whole in zip(group, units, self.index.frequent([(x[0], u) for x, u in zip(group, units, strict=True)]), strict=False):
                yield ids, unknown, unit, whole

    def vote(self, ids: np.ndarray, counts: np.ndarray, unknown: float = 0.0) -> tuple[float | None, list[int]]:
        """The vote of the nearest examples (None without any), and their doc_ids."""
        return next(self.votes([(ids, counts, unknown)]))

    def votes(self, rows: Iterable[tuple[np.ndarray, np.ndarray, float]]) -> Iterator[tuple[float | None, list[int]]]:
        """``vote`` of each of ``rows``."""
        for ids, _, unit, whole in self._batches(rows):
            yield self._vote(ids, unit, whole)

    def _vote(self, ids: np.ndarray, unit: np.ndarray, whole: np.ndarray) -> tuple[float | None, list[int]]:
        near = self.index.nearest(ids, unit, same=SAME, whole=whole) if len(ids) else []
        if not near:
            return None, []
        cosine, at = np.array([c for c, _ in near]), self.full[[j for _, j in near]]
        weight = cosine**2 * self.model.stands_for[at]
        prior = PRIOR_WEIGHT * weight.sum() / len(near)
        return float(((weight * self.model.toxic[at]).sum() + prior * self.base) / (weight.sum() + prior)), self.model.doc_ids[at].tolist()

    def score(self, ids: np.ndarray, counts: np.ndarray, unknown: float = 0.0) -> tuple[float, list[int]]:
        """The score, and the doc_ids of the nearest examples."""
        return next(self.scores([(ids, counts, unknown)]))

    def scores(self, rows: Iterable[tuple[np.ndarray, np.ndarray, float]]) -> Iterator[tuple[float, list[int]]]:
        """``score`` of each of ``rows``."""
        for ids, unknown, unit, whole in self._batches(rows):
            if not len(ids) and not unknown:
                yield self.bare, []
                continue
            vote, evidence = self._vote(ids, unit, whole)
            yield self.base if vote is None else float(np.interp(vote, *self.model.curve)), evidence


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").cast("binary").alias("text"))


def draw_examples(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[DataFrame, dict[int, float], list[str]]:
    """``doc_id, toxic, words, counts`` of at most ``examples`` labelled rows of a class that
    are not held out, drawn by a digest of the id (stored), how many labelled rows one of each
    class stands for, and the paths of what is stored."""
    learnt = labels.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    learnt = learnt.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learnt = learnt.join(docs.select(quoted("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    learnt, learnt_path = stash(learnt.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")), "learnt-labels")
    sizes = {r.toxic: r.n for r in learnt.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [learnt.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for t in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_words((t.as_py() or b"").decode("utf-8", "replace")) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(f) for f in found], pa.list_(pa.string())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))], ["doc_id", "toxic", "words", "counts"])

    # at most twice ``examples`` ids, which bounds this broadcast
    texts = _slim(docs).join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").select("doc_id", "toxic", "text")
    found, found_path = stash(texts.mapInArrow(run, "doc_id long, toxic int, words array<string>, counts array<int>"), "example-words")
    totals = {r.toxic: r.n for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    return found, {t: sizes[t] / n for t, n in totals.items()}, [learnt_path, found_path]


def numbered(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, ids, counts, unknown``: the words of the vocabulary in every whole text, in
    order of their numbers, and what its other words add to its length (Scorer.unit)."""
    packed = docs.sparkSession.sparkContext.broadcast("\n".join(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(packed.value.split("\n"))} if packed.value else {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, ids, counts, unknown = batch.slice(at, ROWS), [], [], []
                for text in part.column(1):
                    known, rest = {}, 0.0
                    for word, n in text_words((text.as_py() or b"").decode("utf-8", "replace")).items():
                        i = number.get(word)
                        if i is None:
                            rest += (1 + math.log(n)) ** 2
                        else:
                            known[i] = n
                    order = sorted(known)
                    ids.append(order)
                    counts.append([known[i] for i in order])
                    unknown.append(rest)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), pa.array(unknown, pa.float64())], ["doc_id", "ids", "counts", "unknown"])

    return _slim(docs).mapInArrow(run, "doc_id long, ids array<int>, counts array<int>, unknown double")


def _document_frequency(found: DataFrame, words: int) -> np.ndarray:
    """Of each word of the vocabulary, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(words, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=words)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["i", "n"])

    out = np.zeros(words, np.int64)
    summed = found.select("ids").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # a row for each word of the vocabulary
    out[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    return out


def _rows(batch: pa.RecordBatch, ids: int, counts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The lists of numbers and counts of each row, as arrays."""
    for i, c in zip(batch.column(ids), batch.column(counts), strict=True):
        yield i.values.to_numpy().astype(np.int64), c.values.to_numpy().astype(np.float64)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, examples: int = EXAMPLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (the
    doc_ids of its nearest examples)."""
    spark = docs.sparkSession
    drawn, weight, paths = draw_examples(docs, labels, examples)
    if len(weight) < 2:
        discard(spark, *paths)
        none = docs.select(quoted("doc_id").cast("long").alias("doc_id"))
        return none.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.array().cast("array<bigint>").alias("evidence"))
    # the words of the examples, whose number and whole texts bound this
    counted = drawn.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).orderBy("word").toArrow()
    vocabulary = counted.column(0).to_pylist()
    given = drawn.orderBy("doc_id").toArrow().to_batches()
    number = {w: i for i, w in enumerate(vocabulary)}
    doc_ids, toxic = (np.concatenate([b.column(i).to_numpy() for b in given]) for i in (0, 1))
    words = []
    for b in given:
        for w, c in zip(b.column(2), b.column(3), strict=True):
            ids = np.array([number[x] for x in w.as_py()], np.int64)
            order = np.argsort(ids)
            words.append((ids[order], c.values.to_numpy().astype(np.float64)[order]))
    del number, given

    found, _ = stash(numbered(docs, vocabulary), "numbered-words")
    total = found.count()
    idf = np.log((1 + total) / (1 + _document_frequency(found, len(vocabulary)))) + 1
    share = explained(counted.column(1).to_numpy().astype(np.float64), counted.column(2).to_numpy().astype(np.float64), int(toxic.sum()), int((1 - toxic).sum()))
    model = Model((FLOOR + share) * idf, FLOOR * (math.log(1 + total) + 1), doc_ids, toxic.astype(np.float64), np.array([weight[t] for t in toxic.tolist()]), words)

    # the examples' own votes, without what has their content, calibrate
    first = spark.sparkContext.broadcast(model)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or first.value.build()
            made = [v for v, _ in scorer.votes((*first.value.words[i], 0.0) for i in batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], ["i", "vote"])

    tasks = spark.sparkContext.defaultParallelism
    own = spark.range(0, len(words), 1, tasks).toDF("i").mapInArrow(votes, "i long, vote double").filter("vote is not null").toArrow()  # a row for each example
    at = own.column(0).to_numpy()
    order = np.argsort(at)
    at, vote = at[order], own.column(1).to_numpy()[order]
    model.curve = isotonic(vote, model.toxic[at], model.stands_for[at]) if len(at) else (np.zeros(1), np.zeros(1))
    shared = spark.sparkContext.broadcast(model)
    discard(spark, *paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or shared.value.build()
            made = list(scorer.scores((i, c, u) for (i, c), u in zip(_rows(batch, 1, 2), batch.column(3).to_pylist(), strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in made], pa.float64()), pa.array([e for _, e in made], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    scored = found.mapInArrow(run, "doc_id long, score double, evidence array<bigint>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
