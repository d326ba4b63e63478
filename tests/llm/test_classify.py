import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import language, toxicity

WORDS = {
    "en": "the of and to in is that for with was house water morning street letter because through would should people", "de": "der die und das nicht mit ist sich auf für haus wasser morgen straße brief weil durch würde leute zwischen",
    "fr": "le la les des et est dans pour que qui maison eau matin rue lettre parce toujours était gens entre", "es": "el los las una y que para con por como casa agua mañana calle carta porque siempre gente entonces también",
}


def text(rng, lang, n):
    return " ".join(rng.choices(WORDS[lang].split(), k=n)).capitalize() + "."


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rng = random.Random(0)
    rows = [(i, text(rng, lang, rng.randint(20, 200)), lang, f"site{i % 7}.example.org", 5) for i, lang in enumerate(rng.choices(list(WORDS), k=240))]
    rows += [(1000, None, None, None, 5), (1001, "", "en", "s", 5), (1002, "12 34 !!! ...", "en", "s", 5), (1003, rows[0][1], rows[0][2], rows[0][3], 5), (1003, rows[0][1], rows[0][2], rows[0][3], 5), (None, text(rng, "de", 50), None, None, 5), (1004, text(rng, "fr", 20_000), "en", "site1.example.org", 5)]
    path = str(tmp_path_factory.mktemp("written"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mark_a int").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_language(written):
    got = {r.doc_id: r for r in language.identify_documents(written).collect()}
    assert all(r.lang == r.declared and r.accepted for i, r in got.items() if i is not None and i < 1000)
    assert got[None].lang == "de" and got[1004].lang == "fr" and got[1004].accepted
    assert all((got[i].lang, got[i].accepted) == ("und", False) for i in (1000, 1001, 1002))
    kept = language.keep_accepted(written)
    assert kept.columns == written.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == written.count() - 3 and not {1000, 1001, 1002} & set(ids) and ids.count(1003) == 2


def test_trigrams_cover_the_text():
    assert len(language.trigrams(b"")) == len(language.trigrams(b"12 !!")) == 0
    a, b = language.trigrams("Ab, Éa".encode()), language.trigrams("ab éA".encode())
    assert a.tolist() == b.tolist() and len(a) == len(b" ab \xc3\xa9a ") - 2


def test_fusion_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    langs, n = ("aa", "bb"), 3
    rows = []
    for i in range(60):
        host = [None, "x.one.org", "y.one.org", "z.two.net", "bare"][i % 5]
        ll = None if i % 11 == 0 else (rng.normal(size=3) * 2).tolist()
        rows.append((i, ll, [None, "aa", "bb"][i % 3], [None, "de"][i % 2], host))
    post = {i: np.exp(np.array(ll) - max(ll)) / np.exp(np.array(ll) - max(ll)).sum() for i, ll, *_ in rows if ll}
    given = [(*r, post[r[0]].tolist() if r[0] in post else None) for r in rows]
    got = {r.id: r for r in language.fuse(spark.createDataFrame(given, "id long, ll array<double>, declared string, suffix string, host string, post array<double>"), langs).collect()}
    domain = lambda h: h if h and "." not in h.split(".", 2)[-1] and h.count(".") == 1 else ".".join(h.split(".")[-2:]) if h and "." in h else None
    total = sum(post.values())
    base = (total + 1) / (total.sum() + n)
    for i, ll, declared, suffix, host in rows:
        own, one = post.get(i, np.zeros(n)), float(i in post)

        def level(key, value, prior):
            members = [post[j] for j, _, _, _, h in rows if j in post and h is not None and key(h) == value]
            if value is None or not members:
                return prior
            c, of = np.maximum(sum(members) - own, 0), max(len(members) - one, 0)  # noqa: B023
            return (c + language.HOST_SMOOTHING * prior) / (of + language.HOST_SMOOTHING)

        p = level(lambda h: h, host, level(domain, domain(host), base))

        def evidence(at, value):
            if value is None:
                return np.zeros(n)
            counts = {}
            for r in rows:
                if r[0] in post and r[at] is not None:
                    counts[r[at]] = counts.get(r[at], 0) + post[r[0]]
            share = counts[value].sum() / sum(c.sum() for c in counts.values())
            return np.log((counts[value] + language.VALUE_SMOOTHING * share) / (sum(counts.values()) + language.VALUE_SMOOTHING))

        logs = np.array(ll or [0.0] * n) + evidence(2, declared) + evidence(3, suffix) + np.log(p)
        fused = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        want = "und" if ll is None else (*langs, "und")[int(fused.argmax())]
        assert got[i].lang == want
        assert got[i].posterior == pytest.approx(0.0 if ll is None else fused.max(), abs=1e-9)


def test_pages(spark, written):
    rng = random.Random(1)
    de, short = text(rng, "de", 60), "Casa"
    rows = [
        (1, "http://www.site.de/a", f'<html lang="de-AT"><head><style>the of and</style><script>var the = "of";</script></head><body><p>{de}&nbsp;</p><!-- the of --></body></html>'),
        (2, "https://blog.site.es:80/", f"<!DOCTYPE html><html class=x lang=es><p>{short}</p></html>"), (3, None, None), (4, "nonsense", ""), (5, "http://[::1", "<html></html>"),
    ]
    got = {r.page_id: r for r in language.identify_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), language.fit(written)).collect()}
    assert (got[1].lang, got[1].declared, got[1].suffix, got[1].host) == ("de", "de", "de", "www.site.de")
    assert (got[2].lang, got[2].declared, got[2].host) == ("es", "es", "blog.site.es")
    assert all(got[i].lang == "und" and not got[i].accepted for i in (3, 4, 5))


def brute_scores(texts, model_rows, languages):
    """The model and its scores by dictionaries of trigrams."""
    import math

    def grams(text):
        words = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()
        raw = (" " + " ".join(words) + " ").encode() if words else b""
        return [raw[i : i + 3] for i in range(len(raw) - 2)]

    bucket = lambda g: ((((g[0] * 0x9E37 + g[1]) * 0x85EB + g[2]) * 0x9E3779B1) % 2**32) >> 16
    counts = {lang: {} for lang in languages}
    for lang, text in model_rows:
        for g in grams(text):
            counts[lang][bucket(g)] = counts[lang].get(bucket(g), 0) + 1
    used = len(set().union(*counts.values()))
    smooth = 0.5 / 65536
    out = []
    for text in texts:
        found = [bucket(g) for g in grams(text)]
        logs = []
        for lang in languages:
            total = sum(counts[lang].values())
            p = lambda b: (counts[lang].get(b, 0) + smooth) / (total + smooth * 65536)  # noqa: B023, E731
            logs.append(sum(math.log((1 - language.NOISE) * p(b) + language.NOISE / 65536) for b in found))
        logs.append(len(found) * -math.log(65536))
        out.append([x * min(1.0, language.TEXT_EVIDENCE / len(found)) for x in logs] if found else None)
    assert used
    return out


def test_fit_and_scores_match_brute_force(spark, written):
    model = language.fit(written)
    assert model.languages == ("de", "en", "es", "fr")
    rows = written.filter("doc_id is not null and lang is not null and text is not null").collect()
    texts = ["Haus und Wasser, 12 Straße!", "la maison 3 était", "x", "12 !", rows[3].text]
    want = brute_scores(texts, [(r.lang, r.text) for r in rows], model.languages)
    scored = language.text_scores(spark.createDataFrame(list(enumerate(texts)), "id int, t string").selectExpr("id", "cast(t as binary) text"), model)
    for r in scored.collect():
        assert (r.ll is None) == (want[r.id] is None) == (r.post is None)
        if r.ll is not None:
            assert r.ll == pytest.approx(want[r.id], rel=1e-5) and sum(r.post) == pytest.approx(1)


def test_fifth_language(spark, written):
    """A language that enough rows declare is modelled, whatever its code."""
    rng = random.Random(9)
    dutch = "het een van de niet met zijn voor huis water morgen straat brief omdat door zou mensen".split()
    more = spark.createDataFrame([(5000 + i, " ".join(rng.choices(dutch, k=60)), "nl", None, 1) for i in range(40)], written.schema)
    got = language.identify_documents(written.unionByName(more)).filter("doc_id >= 5000").collect()
    assert {(r.lang, r.accepted) for r in got} == {("nl", True)}


def test_language_of_nothing(written):
    assert language.identify_documents(written.limit(0)).count() == 0
    assert language.keep_accepted(written.limit(0)).count() == 0


def test_block_max_index_is_exact():
    rng = np.random.default_rng(0)
    features, vectors = 60, []
    for _ in range(900):
        ids = np.sort(rng.choice(features, rng.integers(1, 6), replace=False))
        w = rng.choice([1.0, 2.0, 3.0], len(ids))
        vectors.append((ids, w / np.sqrt((w**2).sum())))
    index = toxicity.BlockMaxIndex(vectors, features)
    dense = np.zeros((900, features))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    for q in range(200):
        ids, w = vectors[q] if q % 2 else (lambda k: (np.sort(rng.choice(features, k, replace=False)), np.ones(k) / np.sqrt(k)))(rng.integers(1, 7))
        sims = np.round(dense[:, ids] @ w, 12)
        for same in (float("inf"), toxicity.SAME):
            want = sorted((-s, i) for i, s in enumerate(sims) if 0 < s < same)[: toxicity.NEIGHBOURS]
            assert [i for _, i in index.nearest(ids, w, same=same)] == [i for _, i in want]
    assert toxicity.BlockMaxIndex([], 3).nearest(np.array([1]), np.array([1.0])) == []


def test_frequent_words_have_rows():
    """Words of many examples are summed as rows, for many searches at once, with the same results;
    equal examples tie, the smaller number first."""
    rng = np.random.default_rng(3)
    vectors = []
    for i in range(300):
        ids = np.unique(np.concatenate([rng.integers(0, 12, 8), rng.integers(12, 400, 9)]))
        w = rng.random(len(ids))
        vectors.append(vectors[i - 150] if i % 3 == 0 and i >= 150 else (ids, w / np.sqrt((w**2).sum())))
    index = toxicity.BlockMaxIndex(vectors, 400)
    assert 12 <= len(index.rows) < 40 and 0 < len(index.places) < sum(len(v[0]) for v in vectors) / 1.5
    queries = [vectors[i] for i in rng.integers(0, 300, 20)]
    together = index.frequent(queries)
    for (ids, w), whole in zip(queries, together, strict=False):
        dense = np.zeros(400)
        dense[ids] = w
        want = sorted((-round(float((dense[i] * x).sum()), 12), n) for n, (i, x) in enumerate(vectors))[:15]
        for found in (index.nearest(ids, w), index.nearest(ids, w, whole=whole)):
            assert [n for _, n in found] == [n for _, n in want] and np.allclose([c for c, _ in found], [-c for c, _ in want], atol=1e-11)


def test_words_of_latin_texts():
    """Texts of Latin-1 give the words that the general pattern finds."""
    every = "".join(f"{chr(i)}a{chr(i)}{chr(i)} B{chr(i)}" for i in range(256)) + "déjà vu, ÀÉß²x ªb"
    assert toxicity.text_words(every) == Counter(toxicity._WORDS.findall(every.lower()))


def test_search_looks_at_few_sums():
    """Postings need no conversion, and only sums near the k-th best are rounded and ranked."""
    rng = np.random.default_rng(8)
    vectors = [(np.arange(40), v / np.linalg.norm(v)) for v in rng.random((3000, 40))]
    index = toxicity.BlockMaxIndex(vectors, 40)
    assert {index.places.dtype, index.block.dtype} == {np.dtype(np.intp)}
    ids, query = vectors[5]
    rounded, round_ = [], np.round
    with pytest.MonkeyPatch.context() as m:
        m.setattr(np, "round", lambda x, *n: (rounded.append(len(x)), round_(x, *n))[1])
        found = index.nearest(ids, query)
    want = sorted((-c, i) for i, c in enumerate(round_(np.array([v for _, v in vectors]) @ query, 12)))[: toxicity.NEIGHBOURS]
    assert [i for _, i in found] == [i for _, i in want] and sum(rounded) < 3000


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.9]), np.array([0, 1.0, 0, 1, 1]), np.array([1, 1, 3, 1, 1.0]))
    assert y.tolist() == [0, 0.25, 1] and x == pytest.approx([0.1, 0.275, 0.65])


def scores_by_force(rows, labels):
    """The whole score with dictionaries: words, weights, all cosines, votes, calibration."""
    import math
    import re
    import zlib
    from collections import Counter

    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    words = [Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for _, t in rows]
    df = Counter(w for c in words for w in c)
    toxic = {}
    for i, t in labels:
        if i is not None and t is not None and not held(i):
            toxic[i] = max(t, toxic.get(i, 0))
    examples = sorted((i, toxic[i], c) for (i, _), c in zip(rows, words, strict=True) if i in toxic)
    n, n1 = len(examples), sum(t for _, t, _ in examples)

    def share(word):
        """Entropy of the label less that which is left when the word's presence is known."""
        h = lambda p: sum(-x * math.log(x) for x in (p, 1 - p) if x > 0)
        have = [t for _, t, c in examples if word in c]
        lack = n - len(have)
        left = len(have) / n * h(sum(have) / len(have)) + (lack / n * h((n1 - sum(have)) / lack) if lack else 0)
        return (h(n1 / n) - left) / h(n1 / n)

    weight = {w: (toxicity.FLOOR + share(w)) * (math.log((1 + len(rows)) / (1 + df[w])) + 1) for w in {w for *_, c in examples for w in c}}
    unknown = toxicity.FLOOR * (math.log(1 + len(rows)) + 1)

    def vector(c):
        v = {w: (1 + math.log(k)) * weight.get(w, unknown) for w, k in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = [vector(c) for *_, c in examples]
    base = n1 / n

    def vote(c):
        v = vector(c)
        near = [(round(sum(x * e.get(w, 0.0) for w, x in v.items()), 12), -k) for k, e in enumerate(vectors)]
        near = sorted((x for x in near if 0 < x[0] < toxicity.SAME), reverse=True)[: toxicity.NEIGHBOURS]
        if not near:
            return None
        mass = sum(s * s for s, _ in near)
        prior = toxicity.PRIOR_WEIGHT * mass / len(near)
        return (sum(s * s * examples[-k][1] for s, k in near) + prior * base) / (mass + prior)

    own = [(v, t) for v, t in ((vote(c), t) for _, t, c in examples) if v is not None]
    curve = toxicity.isotonic(np.array([v for v, _ in own]), np.array([float(t) for _, t in own]), np.ones(len(own)))
    bare = [t for _, t, c in examples if not c]
    out = []
    for c in words:
        v = vote(c) if c else None
        out.append(float(np.interp(v, *curve)) if v is not None else base if c else sum(bare) / len(bare) if bare else base)
    return out


def test_toxicity_matches_brute_force(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(150):
        words = text(rng, rng.choice(list(WORDS)), rng.randint(1, 25)).split() + ["vile"] * (i % 4 == 0) + ["mean"] * rng.randint(0, 1)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0 and rng.random() < 0.9)))
    rows += [(200, None), (201, "12 !"), (202, "zyx"), (203, rows[4][1]), (204, rows[8][1])]
    labels += [(201, 0), (203, 1), (77777, 1), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    want = scores_by_force(rows, labels)
    assert {i: pytest.approx(s, abs=1e-9) for (i, _), s in zip(rows, want, strict=True)} == got


def test_toxicity(spark):
    rng = random.Random(6)
    bad = ["vilethou", "grimwort", "foulmere"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = text(rng, rng.choice(list(WORDS)), rng.randint(10, 80)).split()
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "en", "ly"]))
        rows.append((i, " ".join(words), "en", 7.0))
        if i % 3:
            labels.append((i, 0, int(toxic)))
        elif i % 2 == 0:
            labels += [(i, 1, int(toxic)), (i, None, None)]
    rows += [(9000, None, None, 7.0), (9001, "", "en", 7.0), (9002, "zzz " * 50_000 + "FOULMERE!!", "en", 7.0), (None, "vilethou", "en", 7.0), (0, rows[0][1], "en", 7.0)]
    labels += [(77777, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    of = {r.doc_id: r for r in got}
    held = [i for i in range(600) if of[i].held_out]
    assert 150 < len(held) < 250
    assert all(of[i].predicted == int(i % 6 == 0) for i in held)
    assert of[9002].predicted == of[None].predicted == 1 and of[9000].predicted == of[9001].predicted == 0 and of[9000].evidence == []
    learnt = {r.doc_id for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    assert all(set(r.evidence) <= learnt for r in got)
    # columns that must not matter do not
    blind = {r.doc_id: r.score for r in toxicity.score(docs.drop("lang", "score").withColumn("source", F.lit("toxic")), marks.drop("quality")).collect()}
    assert blind == {r.doc_id: r.score for r in got}
    assert {r.score for r in toxicity.score(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), marks).count() == 0


def test_scattered_words_need_no_bounds():
    """Words of few examples, each in a block of its own, are summed before the bounds, which
    they would cost as much as their sums; the search stays exact."""
    rng = np.random.default_rng(7)
    vectors = []
    for i in range(400):
        ids = np.unique(np.concatenate([[i % 40], 40 + rng.choice(1000, 6, replace=False)]))
        weights = rng.random(len(ids)) + 0.1
        vectors.append((ids, weights / np.linalg.norm(weights)))
    index = toxicity.BlockMaxIndex(vectors, 1040)
    dense = np.zeros((400, 1040))
    for i, (ids, weights) in enumerate(vectors):
        dense[i, ids] = weights
    counts = np.bincount(np.concatenate([ids for ids, _ in vectors]), minlength=1040)
    few = (counts > 0) & (counts < 4)
    assert few.sum() > 500 and index.scattered[few].all() and not index.scattered.all()
    for ids, weights in vectors[::7]:
        got = index.nearest(ids, weights, 10)
        cosines = np.round(dense @ dense[[i for i, v in enumerate(vectors) if v[0] is ids][0]], 12)
        expected = sorted(((-c, i) for i, c in enumerate(cosines.tolist()) if c > 0))[:10]
        assert [i for _, i in got] == [i for _, i in expected]
        assert np.allclose([c for c, _ in got], [-c for c, _ in expected])
