"""Token counts that follow edits.

A document's text is cut into segments of a fixed number of pieces, at spaces and line feeds,
which no token spans; longer pieces (of scripts without spaces, or of encoded data) are cut at
pre-tokens, where a letter or digit meets a mark of punctuation, or a digit what follows it. A
tree over the segments holds the sums of their characters and of their tokens. An edit descends
by characters to the segments that it touches, joins their rests with the new text and, where a
segment's end is no end of a pre-token any more, with the segments next to it; this region
alone is encoded again, and the sums above it are updated. The trees are stored as the two
lists of their leaves, beside the text, and come back from a batch of edits with the edited
text, so that the next batch can follow.

Defined results
* null or empty text: no tokens. Null or empty list of edits: the counts stay.
* very long text: as any other; a segment is as long as the text if it has no place to cut at.
* an edit is (start, stop, text) in characters of the text as the edits before it left it;
  positions beyond the end are its end, a stop before the start is the start, a null text
  deletes. Ties, edits of the same place: in the order of the list.
* null id and repeated rows: one result row each. Other columns are ignored by ``recount``;
  ``build`` keeps them and names its own so that none clashes (``tree_names``).
* empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .storage import quoted, spare

#: Pieces in a segment; a segment that has grown beyond GROWN times that is cut again.
SEGMENT_PIECES, GROWN = 16, 8
#: Characters from which on a piece is cut, and a part of it has at least.
LONG_PIECE = 256
_PIECE = regex.compile(r"[^ \n]*[ \n]|[^ \n]+")
#: Places between characters where tokens end; those of special tokens' own marks are left out.
_APART = regex.compile(r"[\p{L}\p{N}][^\s\p{L}\p{N}\p{M}|<>]|[0-9][A-Za-z0-9]")
_CUT = regex.compile(r"(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}\p{M}|<>])|(?<=[0-9])(?=[A-Za-z0-9])")
TREE = "leaf_chars array<int>, leaf_tokens array<int>"
EDITS = "array<struct<start:int,stop:int,text:string>>"


def apart(before: str, after: str) -> bool:
    """Whether no token and no normalisation spans the place between two characters."""
    return before in " \n" or _APART.match(before + after) is not None


def segments(text: str) -> list[str]:
    """Parts of the text whose tokens are those of the whole."""
    out, start, seen = [], 0, 0
    for m in _PIECE.finditer(text):
        if m.end() - m.start() > LONG_PIECE:
            for cut in _CUT.finditer(text, m.start(), m.end()):
                if cut.start() - start >= LONG_PIECE and cut.start() > m.start():
                    out.append(text[start : cut.start()])
                    start, seen = cut.start(), 0
        seen += 1
        if seen == SEGMENT_PIECES:
            out.append(text[start : m.end()])
            start, seen = m.end(), 0
    return [*out, text[start:]] if start < len(text) or not out else out


class SegmentTree:
    """Sums of characters and tokens over the segments of a text. Edits leave the segments
    that they touch unsettled; their tokens are counted once, when the edits are done."""

    def __init__(self, leaves: list[str], tokens: list[int]):
        self.reencoded = 0
        self._fill(leaves, tokens, [False] * len(leaves))

    def _fill(self, leaves: list[str], tokens: list[int], unsettled: list[bool]) -> None:
        self.leaves, self.unsettled = leaves, unsettled
        self.base = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        self.chars[self.base : self.base + len(leaves)] = map(len, leaves)
        self.tokens[self.base : self.base + len(leaves)] = tokens
        for i in range(self.base - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, leaves: list[int]) -> None:
        """The sums above the leaves."""
        above = {(self.base + i) // 2 for i in leaves} - {0}
        while above:
            for i in above:
                self._sum(i)
            above = {i // 2 for i in above} - {0}

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, at: int) -> tuple[int, int]:
        """The last leaf that has the character, or ends there, and its place in the leaf."""
        i = 1
        while i < self.base:
            i *= 2
            if at > self.chars[i] or at == self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.base, at

    def edit(self, start: int, stop: int, new: str) -> None:
        whole = self.chars[1]
        start = min(max(start, 0), whole)
        stop = min(max(stop, start), whole)
        first, before = self._find(start)
        last, after = self._find(stop)
        region = self.leaves[first][:before] + new + self.leaves[last][after:]
        # the segments on both sides, as far as they are not told apart by what is now between
        while last + 1 < len(self.leaves) and not (region and self.leaves[last + 1] and apart(region[-1], self.leaves[last + 1][0])):
            last += 1
            region += self.leaves[last]
        while first and not (region and self.leaves[first - 1] and apart(self.leaves[first - 1][-1], region[0])):
            first -= 1
            region = self.leaves[first] + region
        if len(parts := segments(region)) > GROWN:
            kept = self.tokens[self.base : self.base + len(self.leaves)]
            self._fill(self.leaves[:first] + parts + self.leaves[last + 1 :], kept[:first] + [0] * len(parts) + kept[last + 1 :], self.unsettled[:first] + [True] * len(parts) + self.unsettled[last + 1 :])
            return
        for i in range(first, last + 1):
            self.leaves[i] = region if i == first else ""
            self.chars[self.base + i] = len(self.leaves[i])
            self.tokens[self.base + i] = 0
            self.unsettled[i] = i == first
        self._update(range(first, last + 1))

    def regions(self) -> list[str]:
        """The texts that are to be encoded."""
        return [leaf for leaf, waits in zip(self.leaves, self.unsettled, strict=True) if waits]

    def settle(self, count: Callable[[str], int]) -> None:
        """Count the tokens of what edits have touched."""
        found = [i for i, waits in enumerate(self.unsettled) if waits]
        for i in found:
            self.tokens[self.base + i] = count(self.leaves[i])
            self.reencoded += len(self.leaves[i])
            self.unsettled[i] = False
        self._update(found)

    def lists(self) -> tuple[list[int], list[int]]:
        """The characters and tokens of the leaves that are not empty."""
        full = [i for i, leaf in enumerate(self.leaves) if leaf]
        return [len(self.leaves[i]) for i in full], [self.tokens[self.base + i] for i in full]


def _counter(path: str) -> tuple[bpe.PieceCache, Callable[[str], int]]:
    known = bpe.cache(path, bpe.id_counts)
    return known, lambda text: sum(known.of(text))


def leaf_sums(block: bpe.Block, texts: list[str], known: bpe.PieceCache) -> tuple[list, list]:
    """The characters and the tokens of the segments of each text. Segments that are whole pieces
    are sums over the pieces of the block; a text with longer pieces is cut as a string."""
    chars, tokens, start = block.chars[block.pieces], block.size[block.pieces], 0
    all_chars, all_tokens = [], []
    for text, stop in zip(texts, block.ends.tolist(), strict=True):
        own, of = chars[start:stop] + 1, tokens[start:stop]  # a piece has the blank behind it
        own[-1] -= 1
        start = stop
        if own.max() > LONG_PIECE:
            leaves = segments(text)
            known.learn(leaves)
            all_chars.append(list(map(len, leaves)))
            all_tokens.append([sum(known.of(x)) for x in leaves])
            continue
        cuts = np.arange(0, len(own) - (own[-1] == 0), SEGMENT_PIECES)  # nothing follows a last blank
        all_chars.append(np.add.reduceat(own, cuts) if len(cuts) else [])
        all_tokens.append(np.add.reduceat(of, cuts) if len(cuts) else [])
    return all_chars, all_tokens


def tree_names(columns: list[str]) -> tuple[str, str]:
    """The names that ``build`` gives the leaves' characters and tokens beside ``columns``."""
    return spare(columns, "leaf_chars"), spare(columns, "leaf_tokens")


def build(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the leaves of every document's tree, under ``tree_names``."""
    tree, at = tree_names(docs.columns), len(docs.columns)
    names = [*docs.columns, *tree]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat = bpe.cache(path, bpe.id_counts), bpe.flat_cache(path)
        for part, texts in bpe.text_blocks(batches, at):
            found = leaf_sums(flat.block(texts), texts, known)
            columns = [part.column(i) for i in range(at)]
            columns += [pa.array(x, pa.list_(pa.int32())) for x in found]
            yield pa.RecordBatch.from_arrays(columns, names)

    quote = lambda n: "`" + n.replace("`", "``") + "`"
    schema = ", ".join(f"{quote(n)} {t}" for n, t in docs.dtypes) + "".join(f", {quote(n)} array<int>" for n in tree)
    return docs.withColumn(spare([*names], "text as bytes"), quoted(text_col).cast("binary")).mapInArrow(run, schema)


def recount(trees: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", tree: tuple[str, str] = ("leaf_chars", "leaf_tokens"), with_text: bool = True) -> DataFrame:
    """Apply each document's edits to its tree. Returns doc_id, n_tokens (before),
    n_tokens_after, reencoded_chars, text_chars (after), and for the next batch of edits the new
    leaf_chars, leaf_tokens and, ``with_text``, text."""
    names = ["doc_id", "n_tokens", "n_tokens_after", "reencoded_chars", "text_chars", "leaf_chars", "leaf_tokens", *["text"] * with_text]
    types = [*[pa.int64()] * 5, *[pa.list_(pa.int32())] * 2, *[pa.string()] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = _counter(path)
        for part, texts in bpe.text_blocks(batches, 1):
            edited = []
            for doc, text, chars, tokens, edits in zip(part.column(0).to_pylist(), texts, *(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                leaves, at = [], 0
                for n in chars:
                    leaves.append(text[at : at + n])
                    at += n
                found = SegmentTree(leaves or [""], tokens or [0])
                before = found.tokens[1]
                for edit in edits or ():
                    found.edit(edit["start"] or 0, edit["stop"] or 0, edit["text"] or "")
                edited.append((doc, before, found))
            # the touched regions of a whole block are encoded together
            known.learn(region for _, _, found in edited for region in found.regions())
            rows = []
            for doc, before, found in edited:
                found.settle(count)
                rows.append((doc, before, found.tokens[1], found.reencoded, found.chars[1], *found.lists(), *[found.text] * with_text))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    slim = trees.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"), quoted(tree[0]).alias("leaf_chars"), quoted(tree[1]).alias("leaf_tokens"), quoted(edits_col).cast(EDITS).alias("edits"))
    return slim.mapInArrow(run, f"doc_id long, n_tokens long, n_tokens_after long, reencoded_chars long, text_chars long, {TREE}" + ", text string" * with_text)


def trial_edits(text) -> F.Column:
    """Three edits for each text by its length alone: a replacement after a third, an
    insertion within a word after two thirds, a deletion at the start."""
    n = F.coalesce(F.length(text), F.lit(0))
    third = F.floor(n / 3).cast("int")
    edit = lambda start, stop, new: F.struct(F.greatest(start, F.lit(0)).cast("int").alias("start"), stop.cast("int").alias("stop"), F.lit(new).alias("text"))
    return F.array(edit(third, third + 12, "a revised passage, "), edit(2 * third, 2 * third, "in\nserted"), edit(F.lit(0), F.lit(5), ""))
