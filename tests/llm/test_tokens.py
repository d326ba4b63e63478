import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geoloom.llm import bpe, packing, token_counts

from .corpus import ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder(library):
    rng = random.Random(4)
    parts = [*"aAbéßΣσςİı'sS t́̈\x1c\x85\xa0\t\n\r0²Ⅷ.!$😀日한　​<", "<|endoftext|>", "<|startoftext|>", "'ve", "aaaa", "aaaaaaa", "!!!!!", "hello", "WORLD", "internationalization"]
    known = bpe.PieceCache(PATH, bpe.id_bytes)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)]
    known.learn(texts)
    for t in texts:
        assert np.frombuffer(b"".join(known.of(t)), "<u4").tolist() == ids(library, t), t


def test_cache_forgets(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 3 * (bpe.PIECE_BYTES + 1))
    known = bpe.PieceCache(PATH, bpe.id_counts)
    long = "日本語" * 50_000
    for t in ("a b c d e", "f g h i", "a f z", f"a {long} b", "a b c d e"):
        known.learn([t])
        assert sum(known.of(t)) == len(ids(library, t))
        assert len(known.known) <= 3 + len(t) and long not in known.known and long not in known.older


def test_flat_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "FLAT_PIECES", 40)
    monkeypatch.setattr(bpe, "FLAT_MADE", 7)
    rng = random.Random(5)
    parts = [*"aAéßΣσςİ'st\u0301\x1c\x85\xa0\t\n 0²Ⅷ.!😀日<", " ", "<|endoftext|>", "<|x", "'ve", "aaaaaaa", "hello", "日本語" * 40]
    known = bpe.FlatCache(PATH)
    for n in (0, 1, 9, 9, 30, 30, 2, 60):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]
        got = list(known.block(texts).ids())
        assert [x.tolist() for x in got] == [ids(library, t) for t in texts]
        # the pieces of the last block at most go beyond the bound
        assert len(known.known) <= max(40, len({p for t in texts for p in bpe.PieceCache.pieces(t)}))
        assert not any(len(p.as_py().encode()) > bpe.LONG_PIECE for g in (known.known, known.older) for p in g.pieces)


def test_flat_cache_is_small():
    """A remembered piece takes few bytes beside its own; as Python objects it took PIECE_BYTES."""
    known = bpe.FlatCache(PATH)
    known.block([" ".join(f"w{i}" for i in range(50_000))])
    assert len(known.known) == 50_000 and (known.known.bytes + known.known.start.nbytes + known.known.size.nbytes) / 50_000 < bpe.PIECE_BYTES / 4


def test_round_trip(docs, none, library):
    texts = {i: t for i, t, *_ in ROWS}
    encoded = bpe.encode(docs, PATH)
    got = encoded.collect()
    assert len(got) == len(ROWS)
    assert all(r.ids == ids(library, texts[r.doc_id]) for r in got)
    assert all(r.text == library.decode(ids(library, texts[r.doc_id]), skip_special_tokens=False) for r in bpe.decode(encoded, PATH).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in bpe.digests(docs, PATH).collect():
        want = ids(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want), sha(" ".join(map(str, want))), sha(library.decode(want, skip_special_tokens=False)))
    assert bpe.digests(none, PATH).count() == 0


@pytest.mark.parametrize(("size", "windows"), [(2048, 16), (16, 2), (8, 1)])
def test_packing(docs, none, library, size, windows):
    rows = packing.pack(docs, PATH, size=size, windows=windows, keep_ids=True).collect()
    want = sorted((i is None, i or 0, ids(library, t) + [1]) for i, t, *_ in ROWS)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for i, of in pieces.items():
        full = [x for none_, n, x in want if none_ == (i is None) and n == (i or 0)]
        assert {p.doc_tokens for p in of} == {len(full[0])}
        got = {}
        for p in of:
            for k, x in enumerate(np.frombuffer(p.ids, "<u4").tolist()):
                got.setdefault(p.start + k, []).append(x)
        assert [got[k] for k in sorted(got)] == [[x] * len(full) for x in full[0]]
    for of in sequences.values():
        at = 0
        for p in sorted(of, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == size or at & (at - 1) == 0
    assert packing.pack(none, PATH).count() == 0


def test_packer_keeps_few_windows():
    packer = packing.Packer(100, 4, 0, False)
    rng = random.Random(0)
    total = 0
    for d in range(500):
        n = rng.randint(1, 140)
        total += n
        packer.add(d, 0, bytes(4 * n), n)
        assert len(packer.open) <= 4
    packer.close()
    assert sum(r[2] for r in packer.rows) == total


def edited(text, edits):
    for a, b, new in edits:
        a = min(max(a, 0), len(text))
        text = text[:a] + new + text[min(max(b, a), len(text)) :]
    return text


def test_segment_tree(library):
    known = bpe.PieceCache(PATH, bpe.id_counts)

    def count(t):
        known.learn([t])
        return sum(known.of(t))

    rng = random.Random(2)
    words = ["the", "a", "b'll", "éü", "\n", " ", "  ", "x1", "!!", "longerword", "\t", "<|endoftext|>"]
    dense = ["日本語", "中文。", "，是", "a9B+", "7f/Q", "e\u0301", "1\u0301", "it's", "'", "s", "<|endoftext|>", "|", ">", "--", "²", "각", "\u1100\u1161", "x"]
    for round_no in range(90):
        if round_no < 60:
            text = "".join(rng.choice(words) + rng.choice([" ", "", "\n"]) for _ in range(rng.choice([0, 1, 5, 300, 2000])))
        else:  # without blanks
            text = "".join(rng.choices(dense, k=rng.choice([5, 300, 2000])))
        leaves = token_counts.segments(text)
        tree = token_counts.SegmentTree(leaves, [count(x) for x in leaves])
        for k in range(6):
            a = rng.randint(-1, len(text) + 3)
            edit = (a, a + rng.choice([-2, 0, 1, 5, 100]), rng.choice(["", "x", " ", "new words\nhere", "w " * 300, "'", "。", "\u0301", "7"]))
            tree.edit(*edit)
            text = edited(text, [edit])
            assert (tree.text, tree.chars[1]) == (text, len(text))
            if k % 2:
                tree.settle(count)
                assert tree.tokens[1] == len(ids(library, text)) and not tree.regions()


def test_texts_without_blanks_have_segments():
    for text in ("日本語中文是，" * 2000, "aGVsbG8gd29ybGQ9" * 2000):
        leaves = token_counts.segments(text)
        assert "".join(leaves) == text and len(leaves) > len(text) / 600 and max(map(len, leaves)) < 2 * token_counts.LONG_PIECE


def test_leaf_sums(library):
    """The sums of a block's pieces are those of the segments encoded one by one."""
    rng = random.Random(6)
    texts = ["", " ", "\n", "a", "a ", " a", "x " * 16, "x " * 15 + "x", "x " * 33, "日本語" * 200 + " a", "a" * 256 + " b", "ab," * 120 + " b", "\n" * 50]
    texts += ["".join(rng.choices(["a", " ", "\n", "b c", "<|endoftext|>", "日本。", "x" * 200], k=rng.randint(0, 60))) for _ in range(60)]
    chars, tokens = token_counts.leaf_sums(bpe.FlatCache(PATH).block(texts), texts, bpe.PieceCache(PATH, bpe.id_counts))
    for t, c, n in zip(texts, chars, tokens, strict=True):
        leaves = token_counts.segments(t) if t else []
        assert (list(c), list(n)) == (list(map(len, leaves)), [len(ids(library, x)) for x in leaves])


def test_batches_follow_each_other(spark, library):
    """Edited texts and trees go into the next batch of edits; clashing names keep their columns."""
    rng = random.Random(7)
    texts = {i: " ".join(rng.choices(["one", "two!", "日本。語", "x9y"], k=rng.randint(0, 400))) for i in range(12)}
    rows = spark.createDataFrame([(i, t, "kept", [1]) for i, t in texts.items()], "doc_id long, text string, leaf_chars string, `text as bytes` array<int>")
    trees, names = token_counts.build(rows, PATH), token_counts.tree_names(rows.columns)
    assert names == ("_leaf_chars", "leaf_tokens") and {(r.leaf_chars, r["text as bytes"][0]) for r in trees.collect()} == {("kept", 1)}
    for _ in range(3):
        edits = {i: [(a := rng.randint(0, len(t)), a + rng.randint(0, 9), rng.choice(["", "new", " 日本", "'s "])) for _ in range(2)] for i, t in texts.items()}
        given = spark.createDataFrame([(i, e) for i, e in edits.items()], f"doc_id long, edits {token_counts.EDITS}")
        trees = token_counts.recount(trees.join(given, "doc_id"), PATH, tree=names).cache()
        names = ("leaf_chars", "leaf_tokens")
        for r in trees.collect():
            texts[r.doc_id] = edited(texts[r.doc_id], edits[r.doc_id])
            assert (r.text, r.n_tokens_after) == (texts[r.doc_id], len(ids(library, texts[r.doc_id])))


def test_recount(spark, docs, none, library):
    trees = token_counts.build(docs.select("doc_id", "text"), PATH).withColumn("edits", token_counts.trial_edits(F.col("text")))
    got = token_counts.recount(trees, PATH).collect()
    texts = {i: t or "" for i, t, *_ in ROWS}
    assert len(got) == len(ROWS)
    for r in got:
        text = texts[r.doc_id]
        third = len(text) // 3
        after = edited(text, [(third, third + 12, "a revised passage, "), (2 * third, 2 * third, "in\nserted"), (0, 5, "")])
        assert (r.n_tokens, r.n_tokens_after, r.text_chars) == (len(ids(library, text)), len(ids(library, after)), len(after))
        assert sum(r.leaf_tokens) == r.n_tokens_after and sum(r.leaf_chars) == len(after)
    long = next(r for r in got if r.doc_id == 7)
    assert long.reencoded_chars < 1500 < long.text_chars
    bare = token_counts.recount(trees.withColumn("edits", F.lit(None)), PATH).collect()
    assert all(r.n_tokens == r.n_tokens_after for r in bare)
    assert token_counts.recount(token_counts.build(none.select("doc_id", "text"), PATH).withColumn("edits", token_counts.trial_edits(F.col("text"))), PATH).count() == 0
