import random

import corpus_pipeline
import numpy as np
from geoloom.llm import components, near_copies, simhash

from .corpus import ROWS
from .test_dedup import classes_by_force


def grams(text, n=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def similar(a, b):
    x, y = grams(a), grams(b)
    return 100 * len(x & y) >= 80 * len(x | y)


def variants(rng):
    """Texts with chains of edits, copies of one text, and a passage that many others have."""
    word = lambda: f"w{rng.randrange(5000)}"
    passage, texts = [word() for _ in range(12)], [None, "", "one two", "ONE two", "a b c d e"]
    for base in range(12):
        now = [word() for _ in range(rng.randint(8, 160))]
        for _ in range(10):
            texts.append(" ".join(now))
            now = list(now) if base else list(texts[5].split())
            for _ in range(rng.choice([0, 1, 1, 2])):
                now[rng.randrange(len(now))] = word()
    texts += [" ".join([word() for _ in range(rng.randint(0, 30))] + passage) for _ in range(60)]
    return texts


def test_links_are_all_pairs(spark):
    texts = variants(random.Random(5))
    rng = random.Random(1)
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "key long, text string").selectExpr("key", "cast(text as binary) text").cache()
    want = classes_by_force(range(len(texts)), lambda a, b: similar(texts[a], texts[b]))
    edges = near_copies.links(table).collect()
    assert all(similar(texts[e.a], texts[e.b]) for e in edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in want} == want and 20 < len(set(want.values())) < len(texts) - 20


def test_prefixes_meet_at_the_threshold():
    for n in range(1, 400):
        least = -(-n * 80 // 100)
        assert near_copies.prefix_length(n, 80) == n - least + 1


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 300, 9000):
        for m in (1, n // 2 + 1, n, 3 * n):
            both = rng.integers(-(1 << 62), 1 << 62, min(n, m) // 2)
            a, b = (np.unique(np.concatenate((both, rng.integers(-(1 << 62), 1 << 62, k - len(both))))) for k in (n, m))
            assert near_copies.least_difference(near_copies.sketch(a), near_copies.sketch(b)) <= len(np.setxor1d(a, b))
            assert near_copies.least_difference(near_copies.sketch(a), near_copies.sketch(a)) == 0
    far = [near_copies.sketch(rng.integers(-(1 << 62), 1 << 62, 1000)) for _ in range(2)]
    assert near_copies.least_difference(*far) > 2000 / 9  # such a pair is not verified


def test_keeps_one(docs, none):
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 1 and 1 in ids and 2 not in ids and None in ids and {4, 5, 6} & set(ids) == {4}
    assert len(ids) < len(ROWS) and near_copies.keep_one(none).count() == 0


def test_stage_drops_near_copies(spark):
    """Jaccard similarity above 0.8 with fingerprints more than two bits apart."""
    rng = random.Random(2)
    rows = []
    for i in range(20):
        words = [f"w{rng.randrange(3000)}" for _ in range(120)]
        other = [*words[:-2], "another", "end"]
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join(other), "en", "s", 1)]
        assert similar(rows[-2][1], rows[-1][1])
    far = [i for i in range(20) if ((simhash.fingerprint(rows[2 * i][1].encode()) ^ simhash.fingerprint(rows[2 * i + 1][1].encode())) & (1 << 64) - 1).bit_count() > 2]
    assert far
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()) == list(range(0, 40, 2))


def test_fingerprints_link_first(spark, monkeypatch):
    """SimHash finds what lies within two bits, and the prefixes only what it leaves."""
    rng, texts = random.Random(3), []
    for _ in range(15):
        words = [f"w{rng.randrange(4000)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words[:-1], "end"]), " ".join(words).upper()]
    table = spark.createDataFrame(list(enumerate(texts)), "key long, text string").selectExpr("key", "cast(text as binary) text").cache()
    fps = [simhash.fingerprint(t.encode()) for t in texts]
    want = classes_by_force(range(len(texts)), lambda a, b: ((fps[a] ^ fps[b]) & (1 << 64) - 1).bit_count() <= 2)
    got = {r.node: r.root for r in components.components(near_copies.by_fingerprint(table)[0]).collect()}
    assert {n: got.get(n, n) for n in want} == want and len(set(want.values())) < len(texts)
    asked, verified = [], near_copies._verified

    def noted(texts, candidates, *rest):
        asked.append({(r.a, r.b) for r in candidates.collect()})
        return verified(texts, candidates, *rest)

    monkeypatch.setattr(near_copies, "_verified", noted)
    near_copies.links(table)
    assert asked[0] and all(want[a] != want[b] for later in asked[1:] for a, b in later)


def test_short_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for n in (1, 30, 700, 5000):
        a, b = (np.unique(rng.integers(-(1 << 62), 1 << 62, k)) for k in (n, n + 3))
        x, y = (near_copies.short_sketch(np.union1d(a[: n // 2], v)) for v in (a, b))
        assert len(x) == near_copies.SHORT and sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x, y, strict=True)) <= len(np.setxor1d(np.union1d(a[: n // 2], a), np.union1d(a[: n // 2], b)))


def test_least_values_meet_as_often_as_sets_are_similar():
    rng, same = np.random.default_rng(7), 0
    for _ in range(200):
        both, a, b = (rng.integers(-(1 << 62), 1 << 62, k) for k in (80, 10, 10))
        x, y = (near_copies.least_values(np.unique(np.concatenate((both, v)))) for v in (a, b))
        assert len(x) == near_copies.ROUNDS and all(-(1 << 63) <= v < 1 << 63 for v in x)
        same += sum(p == q for p, q in zip(x, y, strict=True))
    assert abs(same / (200 * near_copies.ROUNDS) - 0.8) < 0.1


def test_pairs_of_a_large_group_grow_with_its_documents(spark, monkeypatch):
    """Edits of one text that differ from each other by about as much as is allowed, after
    short texts that lead their shingles and are not similar to them."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = [" ".join(base[at : at + 5]) for at in range(146)]
    for _ in range(200):
        now = list(base)
        for at in rng.sample(range(150), rng.choice([1, 1, 2, 2])):
            now[at] = f"y{rng.randrange(100_000)}"
        texts.append(" ".join(now))
    table = spark.createDataFrame(list(enumerate(texts)), "key long, text string").selectExpr("key", "cast(text as binary) text").cache()
    sets = [grams(t) for t in texts]
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    want = classes_by_force(range(len(texts)), near)
    asked, verified = [], near_copies._verified

    def noted(texts, candidates, *rest):
        asked.append(candidates.distinct().count())
        return verified(texts, candidates, *rest)

    monkeypatch.setattr(near_copies, "_verified", noted)
    edges = near_copies.links(table).collect()
    assert all(near(e.a, e.b) for e in edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in want} == want and len(set(want.values())) < 146 + 20
    assert sum(asked) < 10 * len(texts), asked
