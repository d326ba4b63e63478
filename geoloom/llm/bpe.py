"""Byte-pair encoding by a pair occurrence index, and decoding.

The words that a block of a partition needs and that are not known yet are laid side by
side in flat arrays. An index maps each mergeable pair, under its rank, to all positions
where it occurs. Ranks that are active are taken in ascending order from a heap; the pair
is merged at all its positions at once, and the pairs that this makes left and right of
them enter the lists of their ranks. Positions that a merge has made stale are recognised
when their rank comes up. In the vocabulary no merge makes a pair of a lower rank, so
this order gives every word what merging it alone would (checked when a file is loaded).

A text is cut at spaces and line feeds, which no token spans, and the pieces are looked up
in a cache of bounded size; only unknown pieces are normalised, split and encoded. Where ids
alone are asked for, the cache is flat arrays, looked up for the pieces of a block at once.

Defined results
* null or empty text, or one of white space only: no ids, an empty decoded text.
* bytes that are not UTF-8 count as U+FFFD.
* very long text: encoded whole, a text longer than BLOCK_BYTES as a block of its own; a text
  without spaces is one piece and is not remembered.
* ties: pairs of one rank are merged from the left.
* null ids and repeated rows: one result row each. Other columns are ignored.
* empty table: empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .storage import quoted, release_memory

#: Bytes of pieces of text and their encodings that a worker remembers, in each of two
#: generations, counting PIECE_BYTES for each piece beside its characters; pieces of more
#: characters than LONG_PIECE are not remembered.
CACHE_BYTES, PIECE_BYTES, LONG_PIECE = 24 << 20, 200, 64
#: Bytes of text that are looked up at once.
BLOCK_BYTES = 4 << 20
#: Pieces, and bytes of them and their ids, of a generation of flat arrays; pieces that are
#: encoded at once.
FLAT_PIECES, FLAT_BYTES, FLAT_MADE = 1 << 18, 8 << 20, 1 << 16
#: The words of the tokenizer's pre-tokenizer.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is
    printable Latin-1, else the next from U+0100 on."""
    printable = [b for b in range(256) if chr(b) not in " \xa0\xad" and unicodedata.category(chr(b)) != "Cc"]
    spare = itertools.count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _lower(text: str) -> str:
    """Lower case of each character by itself (str.lower looks at the context of sigma)."""
    return text.replace("Σ", "σ").lower()


class PairIndexEncoder:
    """A tokenizer file of the byte-level BPE kind with word ends and lower case."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PRETOKEN or [x["type"] for x in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("this encoder does not know the file's normaliser or word pattern")
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*vocab.values(), *self.special.values()))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        symbols = _byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int32)
        self.last = np.array([vocab[c + end] for c in symbols], np.int32)
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]), strict=True))
        self.left, self.right, self.made = left.astype(np.int32), right.astype(np.int32), made.astype(np.int32)
        self.width = len(self.tokens)
        self.rank_type = np.uint16 if len(made) <= 1 << 16 else np.int32  # 16 bits are sorted faster
        keys = left * self.width + right
        self.rank_of_sorted = np.argsort(keys, kind="stable").astype(np.int32)
        self.sorted_keys = keys[self.rank_of_sorted]
        born = np.full(self.width, -1)
        born[made] = np.arange(len(made))
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any() or len(set(made.tolist())) < len(made):
            raise ValueError("a merge makes a pair of a lower rank; the order by rank would not be exact")
        #: ranks of two bytes one after the other, within a word and at its end
        self.byte_ranks = np.concatenate([self._ranks(np.repeat(self.inner, 256), np.tile(x, 256)) for x in (self.inner, self.last)])
        self.words = regex.compile(PRETOKEN)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.special_start = next(iter(self.special), "\0")[:2]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is no merge."""
        keys = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
        return np.where(self.sorted_keys[at] == keys, self.rank_of_sorted[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and where each word's ids end."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        sym = self.inner[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[ends - size] = -1
        index: dict[int, list[np.ndarray]] = {}

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            """Add positions to the lists of their ranks, -1 aside."""
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks.astype(self.rank_type), kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for r, i, j in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ranks)], strict=True):
                if r in index:
                    index[r].append(at[i:j])
                else:
                    index[r] = [at[i:j]]
                    heapq.heappush(active, r)

        active: list[int] = []
        first = np.flatnonzero(after >= 0).astype(np.int32)
        pair = raw[first].astype(np.int32) << 8 | raw[first + 1]
        pair[after[first + 1] < 0] += 1 << 16
        enter(first, self.byte_ranks[pair])
        del first, pair
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b, made = self.left[r], self.right[r], self.made[r]
            at = at[(sym[at] == a) & (after[at] >= 0)]
            at = at[sym[after[at]] == b]
            if a == b and len(at) > 1:  # of runs like aaa, pairs from the left
                taken, kept = -1, []
                for p in at.tolist():
                    if p != taken:
                        kept.append(p)
                        taken = after[p]
                at = np.array(kept, np.int32)
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            sym[at], sym[gone], after[at] = made, -1, beyond
            has = beyond >= 0
            before[beyond[has]] = at[has]
            prior = before[at]
            prior, prior_of = prior[prior >= 0], at[prior >= 0]
            near, near_of = at[has], beyond[has]
            at = np.concatenate((prior, near))
            if len(at):
                enter(at, self._ranks(sym[at], sym[np.concatenate((prior_of, near_of))]))
        alive = sym >= 0
        return sym[alive], np.cumsum(alive)[ends - 1] if len(words) else ends

    def split(self, piece: str) -> list[str | int]:
        """A piece of text as words and ids of special tokens."""
        out: list[str | int] = []
        parts = self.special_pattern.split(piece) if self.special_start in piece else [piece]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            part = _lower(part)
            out += [part] if part.isalpha() else self.words.findall(part)
        return out

    def encode_pieces(self, pieces: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, which have no line feeds, one after the other, and where each
        piece's ids end."""
        at: dict[str | int, int] = {}
        order, counts = [], []
        pieces = list(pieces)
        joined = "\n".join(pieces)
        marked = {i for i, p in enumerate(pieces) if self.special_start in p} if self.special_start in joined else ()
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined)
        for i, part in enumerate(_lower(joined).split("\n") if pieces else ()):
            if part.isalpha() and i not in marked:
                counts.append(1)
                order.append(at.setdefault(part, len(at)))
            else:
                parts = self.split(pieces[i]) if i in marked else self.words.findall(part)
                counts.append(len(parts))
                order += [at.setdefault(w, len(at)) for w in parts]
        words = [w.encode() if isinstance(w, str) else b"" for w in at]
        encoded = [i for i, w in enumerate(words) if w]
        ids, word_ends = self.encode_words([words[i] for i in encoded])
        size = np.ones(len(words), np.int64)  # of a special token
        start = np.zeros(len(words), np.int64)
        size[encoded] = np.diff(word_ends, prepend=0)
        start[encoded] = word_ends - size[encoded]
        special = [i for i, w in enumerate(at) if isinstance(w, int)]
        start[special] = len(ids) + np.arange(len(special))
        ids = np.concatenate((ids, np.array([w for w in at if isinstance(w, int)], np.int32)))
        order_at = np.array(order, np.int64)
        sizes = size[order_at]
        word_stops = np.cumsum(sizes)
        return gathered(ids, start[order_at], sizes), np.concatenate(([0], word_stops))[np.cumsum(np.array(counts, np.int64))]


def gathered(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``start``, one after the other."""
    stops = np.cumsum(size)
    at = np.repeat(start - stops + size, size)
    at += np.arange(len(at), dtype=at.dtype)
    return ids[at]


_encoders: dict[str, PairIndexEncoder] = {}


def encoder(path: str) -> PairIndexEncoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = PairIndexEncoder(path)
    return _encoders[path]


class PieceCache:
    """What ``make`` gives for each piece of text. ``make`` gets the ids of many pieces one
    after the other and their ends. The pieces of the last blocks are remembered, in two
    generations of CACHE_BYTES: one is forgotten when the other is full."""

    def __init__(self, path: str, make: Callable[[np.ndarray, np.ndarray], list]):
        self.encoder, self.make, self.known, self.older, self.long, self.size = encoder(path), make, {}, {}, {}, 0

    @staticmethod
    def pieces(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def learn(self, texts: Iterable[str]) -> None:
        """Have all pieces of the texts known, at least until the next call."""
        if self.size > CACHE_BYTES:
            self.known, self.older, self.size = {}, self.known, 0
        self.long = {}
        needed: set[str] = set()
        for text in texts:
            needed.update(self.pieces(text))
        known, older, new = self.known, self.older, []
        for p in needed:
            if p not in known:
                if p in older:
                    known[p] = older[p]
                    self.size += PIECE_BYTES + len(p)
                else:
                    new.append(p)
        if new:
            for p, made in zip(new, self.make(*self.encoder.encode_pieces(new)), strict=True):
                if len(p) > LONG_PIECE:
                    self.long[p] = made
                else:
                    known[p] = made
                    self.size += PIECE_BYTES + len(p)

    def of(self, text: str) -> list:
        """What is known of the text's pieces, in order."""
        known, long = self.known, self.long
        return [known[p] if p in known else long[p] for p in self.pieces(text)] if long else list(map(known.__getitem__, self.pieces(text)))


class _Generation:
    """Pieces and their ids in flat arrays."""

    def __init__(self, pieces: pa.Array, ids: np.ndarray, ends: np.ndarray):
        self.pieces, self.ids, self.size = pieces, ids, np.diff(ends, prepend=0).astype(np.int32)
        self.start = (ends - self.size).astype(np.int64)

    def __len__(self) -> int:
        return len(self.pieces)

    @property
    def bytes(self) -> int:
        return self.pieces.nbytes + self.ids.nbytes

    def joined(self, other: _Generation) -> _Generation:
        ends = np.concatenate((self.start + self.size, len(self.ids) + other.start + other.size))
        return _Generation(pa.concat_arrays([self.pieces, other.pieces]), np.concatenate((self.ids, other.ids)), ends)


class Block:
    """The texts of a block as numbers of its distinct pieces: ``pieces`` (all texts' one after
    the other), ``ends`` (of each text in ``pieces``), ``chars`` and ``size`` (tokens) of each."""

    def __init__(self, pieces: np.ndarray, ends: np.ndarray, distinct: pa.Array, ids: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.pieces, self.ends, self.distinct, self._ids, self._start, self.size = pieces, ends, distinct, ids, start, size

    @property
    def chars(self) -> np.ndarray:
        return pc.utf8_length(self.distinct).to_numpy()

    def ids(self) -> Iterator[np.ndarray]:
        """The ids of each text."""
        start = 0
        for stop in self.ends.tolist():
            at = self.pieces[start:stop]
            start = stop
            yield gathered(self._ids, self._start[at], self.size[at])


class FlatCache:
    """Ids of the pieces of texts, looked up for a block at once. The pieces of the last blocks
    are remembered as flat arrays, in two generations of FLAT_PIECES and FLAT_BYTES: one is
    forgotten when the other is full. Pieces of more bytes than LONG_PIECE are not remembered."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        self.kept = np.uint16 if self.encoder.width <= 1 << 16 else np.int32
        self.known = self.older = self._made([])

    def _made(self, pieces: list[str]) -> _Generation:
        ids, ends = self.encoder.encode_pieces(pieces)
        return _Generation(pa.array(pieces, pa.string()), ids.astype(self.kept), ends)

    def block(self, texts: list[str]) -> Block:
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        numbers, distinct, ends = coded.indices.to_numpy(), coded.dictionary, parts.offsets.to_numpy()[1:].astype(np.int64)
        del parts, coded
        # where the ids of each distinct piece are: in this generation, the older, or made now
        found = [pc.index_in(distinct, value_set=g.pieces).fill_null(-1).to_numpy() for g in (self.known, self.older)]
        source = np.where(found[0] >= 0, 0, np.where(found[1] >= 0, 1, 2))
        lacking = distinct.filter(pa.array(source == 2))
        made = self._made([])
        for at in range(0, len(lacking), FLAT_MADE):
            made = made.joined(self._made(lacking.slice(at, FLAT_MADE).to_pylist()))
        found.append(np.cumsum(source == 2) - 1)
        generations, start, size, base = (self.known, self.older, made), np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int32), 0
        for k, g in enumerate(generations):
            here = np.flatnonzero(source == k)
            at = found[k][here]
            start[here], size[here] = base + g.start[at], g.size[at]
            base += len(g.ids)
        out = Block(numbers, ends, distinct, np.concatenate([g.ids for g in generations]), start, size)
        self._remember(distinct, source != 0, start, size, out._ids)
        del found, lacking, made, generations
        release_memory(cycles=False)
        return out

    def _remember(self, distinct: pa.Array, new: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Take the pieces that this generation has not yet."""
        new = np.flatnonzero(new & (pc.binary_length(distinct).to_numpy() <= LONG_PIECE))
        taken = _Generation(distinct.take(pa.array(new)), gathered(ids, start[new], size[new]), np.cumsum(size[new], dtype=np.int64))
        if len(self.known) + len(taken) > FLAT_PIECES or self.known.bytes + taken.bytes > FLAT_BYTES:
            self.known, self.older = taken, self.known
        else:
            self.known = self.known.joined(taken)


_flat: dict[str, FlatCache] = {}


def flat_cache(path: str) -> FlatCache:
    """One per worker process and file; workers keep it between tasks."""
    if path not in _flat:
        _flat[path] = FlatCache(path)
    return _flat[path]


_caches: dict[tuple[str, str], PieceCache] = {}


def cache(path: str, make: Callable[[np.ndarray, np.ndarray], list]) -> PieceCache:
    """One per worker process, file and kind of value; workers keep it between tasks."""
    key = path, make.__name__
    if key not in _caches:
        _caches[key] = PieceCache(path, make)
    return _caches[key]


def id_bytes(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids of each piece as little-endian unsigned 32-bit numbers."""
    raw, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
    return [raw[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def id_counts(ids: np.ndarray, ends: np.ndarray) -> list[int]:
    return np.diff(ends, prepend=0).tolist()


def text_blocks(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about BLOCK_BYTES of text at most, and their texts from a
    binary column. Null is the empty text, bytes that are not UTF-8 become U+FFFD."""
    for batch in batches:
        ends = np.cumsum([x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()])
        done = 0
        while done < batch.num_rows:
            base = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
            part = batch.slice(done, stop - done)
            yield part, [(x or b"").decode("utf-8", "replace") for x in part.column(column).to_pylist()]
            done = stop


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = flat_cache(path)
        for part, texts in text_blocks(batches, 1):
            ids = [x.astype(np.int32) for x in known.block(texts).ids()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(ids: Iterable[int], tokens: list[str]) -> str:
    """The file names no decoder, so that tokens are joined by spaces, special ones too."""
    return " ".join([tokens[i] for i in ids])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path).tokens
        for batch in batches:
            texts = [decode_ids(x or (), tokens) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


class _Spelled:
    """For each piece its ids in decimal and its decoded text, both joined by spaces."""

    def __init__(self, path: str):
        tokens = encoder(path).tokens
        numbers = list(map(str, range(len(tokens))))

        def spell(ids: np.ndarray, ends: np.ndarray) -> list[tuple[str, str]]:
            listed, stops = ids.tolist(), ends.tolist()
            digits = list(map(numbers.__getitem__, listed))
            words = list(map(tokens.__getitem__, listed))
            return [(" ".join(digits[s:e]), " ".join(words[s:e])) for s, e in zip([0, *stops[:-1]], stops, strict=True)]

        self.cache = cache(path, spell)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every row, and return doc_id, n_tokens, ids_sha256 (of the decimal
    ids joined by spaces) and decoded_sha256, without shipping the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Spelled(path).cache
        for part, texts in text_blocks(batches, 1):
            known.learn(texts)
            counts, ids_sha, text_sha = [], [], []
            for text in texts:
                spelled = [x for x in known.of(text) if x[0]]
                ids, words = map(" ".join, zip(*spelled, strict=True)) if spelled else ("", "")
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(words.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
