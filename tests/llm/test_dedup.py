import hashlib
import random
import re

import pytest
import xxhash

from geoloom.llm import components, exact_dedup, simhash

from .corpus import ROWS


def test_exact(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index")
    got = exact_dedup.verdicts(docs, index).collect()
    assert len(got) == len(ROWS)
    texts = {}
    for i, t, *_ in ROWS:
        texts.setdefault(t or "", []).append(i)
    for r in got:
        text, ids = next((t, ids) for t, ids in texts.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256 and r.doc_id in ids)
        assert (r.keep_id, r.group_size) == (max((i for i in ids if i is not None), default=None), len(ids))
    # of repeated rows one is kept
    assert sum(r.kept for r in got) == len(texts)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert index.table().count() == len(texts) and index.table().select("batch").distinct().count() == 2
    # later rows meet the index: what it knows is dropped, the rest appended
    batch = spark.createDataFrame([(100, "new"), (101, "new"), (102, "two words"), (103, None)], "doc_id long, text string")
    want = {100: (101, 2, False), 101: (101, 2, True), 102: (11, 2, False), 103: (5, 2, False)}
    decide = lambda run: {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.verdicts(batch, index, run=run).collect()}
    assert decide("a run") == want
    # the same run again, as after a failure, decides alike and appends nothing
    rows = index.table().count()
    assert decide("a run") == want and index.table().count() == rows
    assert not any(kept for _, _, kept in decide("another run").values())
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index.name}").collect()}
    assert "digest" in described["Bucket Columns"] and "digest" in described["Sort Columns"]
    # compacted and opened anew it is the same, one file for each bucket
    index.compact()
    assert index.table().count() == rows
    opened = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", buckets=3)
    assert (opened.generation, opened.buckets) == (1, index.buckets) and not any(kept for _, _, kept in decide("third").values())
    # the anti-join is a merge that neither moves nor sorts the index
    groups = batch.select("text").selectExpr("unhex(sha2(text, 256)) digest").groupBy("digest").count()
    with exact_dedup._sorted_scans(spark):
        plan = opened.unknown(groups)._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.rindex("Exchange") :].split("FileScan")[-1]
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Bucketed: true" in side
    opened.drop()
    assert not (tmp_path / "index").exists()


def test_exact_keeps_columns(spark, docs, none):
    def keep(rows, **more):
        with exact_dedup.one_off_index(spark) as index:
            return exact_dedup.keep_first(rows, index, **more)

    for rows in (docs, docs.repartition(2)):  # of files, and not
        for batches in (1, 2, 5):
            kept = keep(rows, batches=batches)
            assert kept.columns == docs.columns
            assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12]
    assert keep(none).count() == 0
    with exact_dedup.one_off_index(spark) as index:
        assert exact_dedup.verdicts(none, index).count() == 0


def fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for n in (1, 2, 3, 5):
        for _, t, *_ in ROWS:
            assert simhash.fingerprint(None if t is None else t.encode(), n) & (1 << 64) - 1 == fingerprint(t, n)


def classes_by_force(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def near_fingerprints(rng, n):
    fps = set()
    while len(fps) < n:
        base = rng.choice([0, (1 << 64) - 1, 0x1234567890ABCDEF, rng.getrandbits(64)])
        for _ in range(rng.randint(0, 4)):
            base ^= 1 << rng.randrange(64)
        fps.add(base)
    return sorted(map(signed, fps))


@pytest.mark.parametrize(("distance", "segments", "hot"), [(0, 2, 64), (1, 4, 64), (2, 1, 64), (2, 2, 64), (2, 4, 64), (2, 8, 64), (2, 2, 2), (2, 4, 3), (1, 2, 1), (3, 4, 64), (3, 2, 2)])
def test_links_are_all_links(spark, distance, segments, hot):
    fps = near_fingerprints(random.Random(3), 260 if distance < 3 else 60)
    want = classes_by_force(fps, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance, segments, hot)
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert {f: got.get(f, f) for f in fps} == want
    assert all(1 <= ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= distance for r in edges.collect())


def test_segments_matter():
    assert simhash.segment_radii(2, 2) == [1, 0] and simhash.segment_radii(2, 4) == [0, 0, 0, -1] and simhash.segment_radii(3, 2) == [1, 1] and simhash.segment_radii(2, 1) == [2]
    assert len(simhash.ball(0, 32, 1)) == 33 and len(simhash.ball(0, 64, 2)) == 1 + 64 + 2016 and simhash.ball(0, 16, -1) == []
    assert simhash.ball(63, 1, 1) == [0, -(1 << 63)]


def test_a_hot_value_gives_no_pairs_of_all(spark):
    """A thousand fingerprints that share one half: no list of pairs but stars."""
    rng = random.Random(8)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 1000:
        fp = base
        for b in rng.sample(range(32), rng.randint(0, 3)):
            fp ^= 1 << b
        fps.add(signed(fp))
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long").cache())
    roots = {r.root for r in components.components(edges).collect()}
    near = sum(1 for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2)
    assert len(roots) == 1 and edges.count() < min(near, 65 * 1000)


def test_near_duplicates(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    fps = {i: fingerprint(t, 3) for i, t, *_ in ROWS}
    for r in got:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        near = [i for i in fps if i is not None and (fps[i] ^ fps[r.doc_id]).bit_count() <= 2]
        assert r.component_id == min(near, default=None)
    assert simhash.near_duplicates(none).count() == 0


def test_near_keeps_one(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 1 and 1 in ids and 2 not in ids and None in ids
    assert {4, 5, 6} & set(ids) == {4}
    assert simhash.keep_one(none).count() == 0


def test_components(spark):
    path = [(i, i + 1) for i in range(60)]  # a long path, ids against the grain
    rng = random.Random(1)
    names = list(range(61))
    rng.shuffle(names)
    edges = [(names[a], names[b]) for a, b in path] + [(100, 101), (101, 100), (102, 102), (200, 103)] + [(300, 301 + i) for i in range(50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in names} | {100: 100, 101: 100, 200: 103, 103: 103} | {300 + i: 300 for i in range(51)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
