"""Pivot blocks and what is built on them against brute force, with blocks small enough to split."""

import numpy as np
import pytest

from tablewise.operators import blocks, cluster, density, linkage, metrics, neighbors
from tests.test_cluster import brute_dbscan


def frame(spark, ids, X, **more):
    rows = [(int(i), [float(v) for v in x], *(m[k] for m in more.values())) for k, (i, x) in enumerate(zip(ids, X))]
    return spark.createDataFrame(rows, ", ".join(["id long, x array<double>", *(f"{c} string" for c in more)])).repartition(3)


@pytest.fixture(scope="module")
def clustered():
    """Far clusters, a dense spot of repeated points and single far points, in three dimensions."""
    rng = np.random.default_rng(11)
    centres = rng.uniform(-50, 50, (6, 3))
    X = np.concatenate([c + rng.normal(scale=1.0, size=(40, 3)) for c in centres] + [np.repeat(centres[:1] + 20, 90, axis=0),
                       rng.uniform(-200, 200, (12, 3))])
    ids = rng.permutation(len(X)) * 3 + 1
    return ids, X


def gaps(X, metric="euclidean"):
    diff = X[:, None, :] - X[None, :, :]
    return np.sqrt((diff ** 2).sum(-1)) if metric == "euclidean" else np.abs(diff).sum(-1)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_bounds_hold_and_skip(spark, clustered, metric):
    ids, X = clustered
    cut = density.point_blocks(frame(spark, ids, X), "id", "x", metric, 16)
    rows = cut.points.collect()
    assert sorted(r.rid for r in rows) == sorted(ids.tolist())
    at = {r.rid: r.ring for r in rows}
    D = gaps(X, metric)
    for ring in range(len(cut.rings)):
        least, greatest = blocks.bounds(cut, cut, ring)
        home = [k for k, i in enumerate(ids.tolist()) if at[i] == ring]
        for other in range(len(cut.rings)):
            away = [k for k, i in enumerate(ids.tolist()) if at[i] == other]
            d = D[np.ix_(home, away)]
            assert d.min() >= least[other] - 1e-9 and d.max() <= greatest[other] + 1e-9
    near = blocks.near_rings(cut, cut, lambda ring, least, greatest: least <= 3.0)
    assert blocks.skipped_share(cut, cut, near) > 0.5


@pytest.mark.parametrize("metric,eps,ms", [("euclidean", 1.2, 5), ("euclidean", 0.0, 3), ("manhattan", 2.5, 4)])
def test_dbscan_of_clusters_and_repeated_points(spark, clustered, metric, eps, ms):
    ids, X = clustered
    labels, core = brute_dbscan(ids, X, eps, ms, metric)
    got = {r.rid: (r.cluster, r.is_core) for r in density.dbscan(frame(spark, ids, X), "id", "x", eps, ms, metric, block_rows=16).collect()}
    assert got == {i: (labels[i], core[i]) for i in labels}


def test_dbscan_of_an_empty_table(spark):
    none = spark.createDataFrame([], "id long, x array<double>")
    assert cluster.dbscan(none, "id", "x", 1.0, 3).collect() == []


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_of_other_points(spark, clustered, metric):
    ids, X = clustered
    rng = np.random.default_rng(2)
    Q = np.concatenate([X[:20] + 0.01, rng.uniform(-300, 300, (25, 3))])
    query, ref = frame(spark, range(len(Q)), Q), frame(spark, ids, X, tag=[f"t{i}" for i in ids])
    got = {}
    for r in neighbors.knn(query, ref, "id", "id", "x", 7, metric, extra=["tag"], block_rows=16).collect():
        got[r.qid, r["rank"]] = (r.nid, r.tag)
        assert abs(r.dist - gaps(np.stack([Q[r.qid], X[list(ids).index(r.nid)]]), metric)[0, 1]) < 1e-9
    diff = Q[:, None, :] - X[None, :, :]
    D = np.sqrt((diff ** 2).sum(-1)) if metric == "euclidean" else np.abs(diff).sum(-1)
    for k in range(len(Q)):
        best = np.lexsort((ids, D[k]))[:7]
        assert [got[k, j + 1] for j in range(7)] == [(int(ids[b]), f"t{ids[b]}") for b in best]


def test_knn_of_fewer_points_than_asked(spark):
    df = frame(spark, [1, 2, 3], np.array([[0.0], [1.0], [5.0]]))
    got = sorted((r.qid, r["rank"], r.nid) for r in neighbors.knn(df, df, "id", "id", "x", 5).collect())
    assert got == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 2), (2, 2, 1), (2, 3, 3), (3, 1, 3), (3, 2, 2), (3, 3, 1)]


def brute_silhouette(X, labels, square=False):
    D = gaps(X)
    D = D * D if square else D
    out = []
    for i in range(len(X)):
        mean = {}
        for c in set(labels):
            m = np.array([l == c for l in labels])
            mean[c] = D[i][m].sum() / (m.sum() - (c == labels[i]))
        a, b = mean.pop(labels[i]), min(mean.values())
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("square", [False, True])
def test_silhouette_over_all_rows(spark, clustered, square):
    ids, X = clustered
    labels = [f"c{int(k) % 5}" for k in np.arange(len(X)) // 40]
    df = frame(spark, ids, X, label=labels)
    out = metrics.silhouette_squared(df, "x", "label") if square else metrics.silhouette(df, "x", "label", "id")
    got = out.first()
    assert got[1] == len(X) and abs(got[0] - brute_silhouette(X, labels, square)) < 1e-9


def test_silhouette_beyond_the_former_sample(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(6000, 2)) + np.arange(6000)[:, None] % 3 * 2.0
    labels = [str(k % 3) for k in range(6000)]
    got = metrics.silhouette(frame(spark, range(6000), X, label=labels), "x", "label", "id").first()
    D = gaps(X)
    codes = np.arange(6000) % 3
    sums = np.stack([D[:, codes == c].sum(1) for c in range(3)], 1)
    own = sums[np.arange(6000), codes] / 1999
    sums[np.arange(6000), codes] = np.inf
    other = sums.min(1) / 2000
    assert got.n == 6000 and abs(got.silhouette - ((other - own) / np.maximum(own, other)).mean()) < 1e-9


@pytest.mark.parametrize("labels", [["a"] * 4, ["a", "a", "a", "b"]])
def test_silhouette_needs_two_labels_of_two(spark, labels):
    df = frame(spark, range(4), np.arange(8.0).reshape(4, 2), label=labels)
    assert metrics.silhouette(df, "x", "label", "id").first()[0] is None
    assert metrics.silhouette_squared(df, "x", "label").first()[0] is None


def brute_single(ids, X):
    """(left, right, height, size) of each merge, named by the least rows."""
    D = gaps(X)
    pairs = sorted((D[i, j], *sorted((int(ids[i]), int(ids[j])))) for i in range(len(X)) for j in range(i))
    members = {int(i): {int(i)} for i in ids}
    out = []
    for h, a, b in pairs:
        if members[a] is not members[b]:
            both = members[a] | members[b]
            out.append((min(min(members[a]), min(members[b])), max(min(members[a]), min(members[b])), round(h, 9), len(both)))
            for m in both:
                members[m] = both
    return out


def test_boruvka_rounds_and_one_task_agree(spark):
    rng = np.random.default_rng(6)
    pairs = {(int(min(p)), int(max(p))): float(rng.integers(1, 40)) for p in rng.integers(0, 60, (300, 2)) if p[0] != p[1]}
    edges = spark.createDataFrame([(a, b, h) for (a, b), h in pairs.items()], "a long, b long, height double")
    trees = [sorted(tuple(r) for r in linkage.spanning_tree(edges, leaf).collect()) for leaf in (10 ** 5, 30)]
    assert trees[0] == trees[1] and len(trees[0]) == len({n for p in pairs for n in p}) - 1


@pytest.mark.parametrize("leaf", [10 ** 5, 60])
def test_single_linkage_merges(spark, leaf):
    rng = np.random.default_rng(8)
    X = np.concatenate([rng.normal(size=(70, 3)), rng.normal(size=(60, 3)) + 9, rng.uniform(-60, 60, (20, 3))])
    ids = rng.permutation(len(X)) * 2
    ranked = linkage.single_linkage(frame(spark, ids, X), "id", "x", block_rows=16)
    got = linkage.merge_table(ranked, leaf).orderBy("step").collect()
    assert [(r.left, r.right, round(r.height, 9), r["size"]) for r in got] == brute_single(ids, X)


def test_single_linkage_cut_of_chains(spark):
    """Two interlocked half moons: single linkage parts them."""
    t = np.linspace(0, np.pi, 60)
    X = np.concatenate([np.stack([np.cos(t), np.sin(t)], 1), np.stack([1 - np.cos(t), 0.5 - np.sin(t)], 1)])
    labels, merges = cluster.agglomerative(frame(spark, range(120), X), "id", "x", 2, "single")
    got = {r.id: r.cluster for r in labels.collect()}
    assert [got[i] for i in range(120)] == [0] * 60 + [1] * 60
    cut = linkage.suggest_distance_cut(merges).first()
    assert cut.n_clusters == 2 and cut["index"] == 117


def test_single_linkage_of_equal_points(spark):
    X = np.array([[0.0, 0.0]] * 40 + [[3.0, 4.0]] * 3)
    merges = linkage.merge_table(linkage.single_linkage(frame(spark, range(43), X), "id", "x", block_rows=8)).orderBy("step").collect()
    assert [r.height for r in merges] == [0.0] * 41 + [5.0] and merges[-1]["size"] == 43
    one = frame(spark, [7], np.array([[1.0]]))
    assert linkage.single_linkage(one, "id", "x").collect() == []
    assert [tuple(r) for r in linkage.cut_single(one, "id", linkage.single_linkage(one, "id", "x"), 1).collect()] == [(7, 0)]


def test_summary_has_one_path(spark):
    """Fewer rows than pivots are their own micro-clusters; more rows share them."""
    rng = np.random.default_rng(1)
    X = np.concatenate([rng.normal(size=(30, 2)), rng.normal(size=(30, 2)) + 50, rng.normal(size=(30, 2)) - 50])
    df = frame(spark, range(90), X)
    for most in (2000, 12):
        got = {r.id: r.cluster for r in cluster.ward(df, "id", "x", 3, most)[0].collect()}
        assert [got[i] for i in range(90)] == [0] * 30 + [1] * 30 + [2] * 30
    assert cluster.summarised(df, "id", "x", 12).select("micro").distinct().count() == 12
