import numpy as np
import pytest

from geoloom.llm import cover_tree
from geoloom.llm import embedding_dups as ed


def links(x, threshold):
    x = x.astype(np.float64)
    near = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= threshold
    np.fill_diagonal(near, False)
    return near


def classes(near):
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        if (new == label).all():
            return label
        label = new


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 16))
    spread = rng.choice([0.001, 0.05, 0.3, 1], size=(500, 1))
    return np.concatenate([centres[rng.integers(25, size=500)] + rng.normal(size=(500, 16)) * spread, np.repeat(centres[:1], 200, 0) + rng.normal(size=(200, 16)) * 1e-4])


def test_tree_covers(vectors):
    x = cover_tree.unit(vectors)
    tree = cover_tree.build(x, leaf=8)
    assert sorted(tree.rows) == list(range(len(x))) and len(tree.leaves) > 20
    for i in range(len(tree.centre)):
        rows = tree.rows[tree.start[i] : tree.stop[i]]
        assert np.linalg.norm(x[rows] - x[tree.centre[i]], axis=1).max() <= tree.radius[i] + 1e-12
        below = range(tree.first[i], tree.last[i])
        if below:
            assert sorted(np.concatenate([tree.rows[tree.start[c] : tree.stop[c]] for c in below])) == sorted(rows)
            # children are a net: their radii at most that of the level, their centres further apart
            level = max(tree.radius[c] for c in below)
            centres = x[tree.centre[list(below)]]
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2)[~np.eye(len(centres), dtype=bool)]
            assert level < tree.radius[i] and (len(gaps) == 0 or gaps.min() > level - 1e-9)


@pytest.mark.parametrize("threshold", [0.5, 0.95, 0.999999])
def test_dual_traversal(vectors, threshold):
    near = links(vectors, threshold)
    own = cover_tree.DualTraversal(vectors, None, threshold)
    assert (own.links[0] == near.sum(axis=1)).all()
    assert [own.root(i) for i in range(len(vectors))] == classes(near).tolist()
    two = cover_tree.DualTraversal(vectors[:300], vectors[300:], threshold)
    assert (two.links[0] == near[:300, 300:].sum(axis=1)).all() and (two.links[1] == near[:300, 300:].sum(axis=0)).all()
    w = np.random.default_rng(0).integers(1, 9, len(vectors))
    own = cover_tree.DualTraversal(vectors, None, threshold, w)
    assert (own.links[0] == near @ w).all()
    two = cover_tree.DualTraversal(vectors[:300], vectors[300:], threshold, w[:300], w[300:])
    assert (two.links[0] == near[:300, 300:] @ w[300:]).all() and (two.links[1] == near[:300, 300:].T @ w[:300]).all()


def clustered(clusters, n, seed=0, spread=0.02, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    return (centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, dims)) * spread).astype(np.float32)


@pytest.mark.parametrize(("clusters", "n"), [(33, 2048), (400, 2048), (400, 8192), (4000, 8192)])
def test_clusters_prune(clusters, n):
    """With the parameters of production few of all pairs of vectors are compared, and the
    pairs of nodes grow with the clusters, not with the vectors."""
    x = clustered(clusters, n)
    found = cover_tree.DualTraversal(x, None, 0.95)
    assert found.compared_vectors < n * n / 2 / 10 and found.compared_nodes < 3 * (clusters**2 + n * 20)
    assert (found.links[0] == links(x, 0.95).sum(axis=1)).all()


def test_nodes_prune_before_vectors_move(spark):
    """On clustered tables a vector goes to about one task, whatever the number of blocks."""
    copies = []
    for n in (4000, 12000):
        x = clustered(40, n, dims=16)
        points = spark.createDataFrame([("64", i, 1, v.tobytes(), 2.0) for i, v in enumerate(x)], ed._POINTS).cache()
        placed, levels = ed._grow(points, "<f4", 500, 0.15, 256)
        blocks, many = ed._left(levels, "<f4", 0.3163)
        assert placed.count() == n and len(levels) > 1
        pairs = blocks.distinct().collect()
        copies.append(len(pairs) / len({p.x for p in pairs}))
    assert max(copies) < 2.5 and copies[1] < copies[0] * 1.5


@pytest.mark.parametrize(("threshold", "block_rows", "sample"), [(0.95, 8192, 1024), (0.95, 40, 12), (0.9999, 60, 30), (0.5, 50, 16)])
def test_operator(spark, vectors, threshold, block_rows, sample):
    rows = [(int(i), v.tolist(), 0, "x", 7) for i, v in enumerate(vectors)]
    one, scaled = [1e-200] * 16, (vectors[9] * 1e150).tolist()
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [float("inf")] + [1.0] * 15), (1004, [None] + [1.0] * 15), (1005, []), (1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (None, (-vectors[0]).tolist()), (5, vectors[5].tolist()), (1010, scaled)]
    odd += [(1100 + i, [1.0, float(i), 0.0]) for i in range(120)] + [(1300, [1e-200, 0.0, -0.0, 1e-200]), (1301, [1e-200, 0.0, 0.0, 1e-200])]
    df = spark.createDataFrame(rows + [(*r, 0, "x", 7) for r in odd] + [(1400, one, 0, "x", 7)], "vec_id long, embedding array<double>, label int, node string, key int")
    got = ed.near_duplicates(df, threshold, block_rows=block_rows, sample=sample).collect()
    assert len(got) == len(rows) + len(odd) + 1
    same_length = np.concatenate([vectors, vectors[5:6], vectors[9:10], [np.array(one) * 1e200], -vectors[:1]])
    near = links(same_length, threshold)
    ids = [*range(len(vectors)), 5, 1010, 1400, None]
    label = classes(near)
    least = {}
    for c, i in zip(label.tolist(), ids, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    by_id = {i: (int(near[k].sum()), least.get(int(label[k]))) for k, i in enumerate(ids)}
    short = links(np.array([[1.0, float(i), 0.0] for i in range(120)]), threshold)
    of_short = classes(short)
    for r in got:
        if r.vec_id in by_id:
            assert (r.n_links, r.component_id) == by_id[r.vec_id], r
        elif 1100 <= r.vec_id < 1220:
            assert (r.n_links, r.component_id) == (short[r.vec_id - 1100].sum(), 1100 + of_short[r.vec_id - 1100]), r
        elif r.vec_id in (1006, 1007, 1300, 1301):
            assert (r.n_links, r.component_id) == (1, r.vec_id // 2 * 2 if r.vec_id > 1007 else 1006)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        assert r.kept == (r.vec_id == r.component_id)


def test_narrow_nodes_of_many_vectors(spark):
    """Thousands of all but equal vectors link without being compared, equal ones are one."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3, 8))
    x = np.concatenate([base[0] + rng.normal(size=(900, 8)) * 1e-5, base[1] + rng.normal(size=(50, 8)) * 0.2, np.repeat(base[2:3], 500, 0), rng.normal(size=(60, 8))])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows, points, kind = ed._distinct(df, "vec_id", "embedding")
    assert points.count() == 900 + 50 + 1 + 60
    got = {r.vec_id: r for r in ed.near_duplicates(df, 0.95, block_rows=60, sample=20).collect()}
    near = links(x, 0.95)
    label = classes(near)
    assert all((got[i].n_links, got[i].component_id) == (near[i].sum(), label[i]) for i in range(len(x)))


def test_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, vector string")
    assert ed.near_duplicates(df).count() == 0
    assert [tuple(r) for r in ed.near_duplicates(spark.createDataFrame([(3, None, "a")], df.schema)).collect()] == [(3, 0, 3, True)]
