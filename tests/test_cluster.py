"""Brute-force cross-checks for the neighbour-based operators (SURVEY 5 (4))."""

import numpy as np
import pandas as pd
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def emb():
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    return e.vec_id.to_numpy(), np.stack(e.embedding.values).astype(float)


def brute_dbscan(ids, X, eps, ms, metric="euclidean"):
    diff = X[:, None, :] - X[None, :, :]
    D = np.sqrt((diff ** 2).sum(-1)) if metric == "euclidean" else np.abs(diff).sum(-1)
    nb = D <= eps
    core = nb.sum(1) >= ms
    order = np.argsort(ids)
    comp = -np.ones(len(ids), dtype=int)
    c = 0
    for i in order:
        if not core[i] or comp[i] >= 0:
            continue
        stack = [i]
        comp[i] = c
        while stack:
            j = stack.pop()
            for t in np.nonzero(nb[j] & core)[0]:
                if comp[t] < 0:
                    comp[t] = c
                    stack.append(t)
        c += 1
    lab = comp.copy()
    for i in range(len(ids)):
        if not core[i]:
            adj = comp[nb[i] & core]
            lab[i] = adj.min() if len(adj) else -1
    return dict(zip(ids.tolist(), lab.tolist())), dict(zip(ids.tolist(), core.tolist()))


@pytest.mark.parametrize("eps,ms,metric", [(1.15, 3, "euclidean"), (1.2, 5, "euclidean"), (7.7, 4, "manhattan")])
def test_dbscan_matches_brute_force(spark, emb, eps, ms, metric):
    from tablewise.operators import cluster
    from tablewise.sources.tables import table
    ids, X = emb
    want, want_core = brute_dbscan(ids, X, eps, ms, metric)
    got = {r["rid"]: (r["cluster"], r["is_core"]) for r in
           cluster.dbscan(table(spark, SF, "embeddings"), "vec_id", "embedding", eps, ms, metric).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert {k: v[1] for k, v in got.items()} == want_core


def test_knn_matches_brute_force(spark, emb):
    from tablewise.operators import neighbors
    from tablewise.sources.tables import table
    ids, X = emb
    e = table(spark, SF, "embeddings")
    got = neighbors.knn(e, e, "vec_id", "vec_id", "embedding", 4, block_rows=150).collect()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    pos = {v: i for i, v in enumerate(ids.tolist())}
    for r in got:
        row = D[pos[r["qid"]]]
        order = np.lexsort((ids, row))
        assert ids[order[r["rank"] - 1]] == r["nid"]


def test_ward_exact_small(spark):
    from tablewise.operators import cluster
    pts = [(0, [0.0, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0]), (3, [5.0, 6.0]), (4, [10.0, 0.0])]
    df = spark.createDataFrame(pts, "id long, x array<double>")
    lab, Z = cluster.ward(df, "id", "x", 3)
    got = {r["id"]: r["cluster"] for r in lab.collect()}
    assert got[0] == got[1] and got[2] == got[3] and len({got[0], got[2], got[4]}) == 3
    # first two merges join the unit-distance pairs at height 1
    heights = [r.height for r in Z.orderBy("step").collect()]
    assert np.allclose(heights[:2], [1.0, 1.0]) and [r["size"] for r in Z.orderBy("step").collect()][-1] == 5


@pytest.mark.parametrize("linkage", ["ward", "single", "complete", "average"])
def test_agglomerate_matches_definition(linkage):
    from tablewise.operators.cluster import _agglomerate
    rng = np.random.default_rng(7)
    X = rng.normal(size=(25, 3))
    Z = _agglomerate(X, np.ones(len(X)), linkage)
    clusters = {i: [i] for i in range(len(X))}
    heights = []
    for step in range(len(X) - 1):
        best = None
        keys = sorted(clusters)
        for a_i, a in enumerate(keys):
            for b in keys[a_i + 1:]:
                A, B = X[clusters[a]], X[clusters[b]]
                pd_ = np.sqrt(((A[:, None, :] - B[None, :, :]) ** 2).sum(-1))
                if linkage == "ward":
                    na, nb = len(A), len(B)
                    d = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(A.mean(0) - B.mean(0))
                elif linkage == "single":
                    d = pd_.min()
                elif linkage == "complete":
                    d = pd_.max()
                else:
                    d = pd_.mean()
                if best is None or d < best[0]:
                    best = (d, a, b)
        d, a, b = best
        heights.append(d)
        clusters[len(X) + step] = clusters.pop(a) + clusters.pop(b)
    assert np.allclose(Z[:, 2], heights)


def test_dbscan_split_cells_match(spark, emb):
    """Tiny blocks force every cell into many sub-blocks (the dense-cell path)."""
    from tablewise.operators import density
    from tablewise.sources.tables import table
    ids, X = emb
    want, want_core = brute_dbscan(ids, X, 1.15, 3)
    got = {r["rid"]: (r["cluster"], r["is_core"]) for r in
           density.dbscan(table(spark, SF, "embeddings"), "vec_id", "embedding", 1.15, 3, block_rows=37).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert {k: v[1] for k, v in got.items()} == want_core


@pytest.mark.parametrize("kind", ["long", "struct<part: long, node: long>"])
def test_components_of_long_paths(spark, kind):
    """Paths of least fellows far apart settle in a few rounds, as in one task."""
    from pyspark.sql import functions as F

    from tablewise.operators.cluster import connected_components
    n = 150
    at = np.random.default_rng(3).permutation(n)
    edges = [(int(at[i]), int(at[i + 1])) for i in range(n - 1) if i != 60] + [(7, 7)]
    name = (lambda c: F.col(c)) if kind == "long" else (lambda c: F.struct(F.lit(1).cast("long").alias("part"), F.col(c).alias("node")).cast(kind))
    ends = spark.createDataFrame(edges, "src long, dst long").select(name("src").alias("src"), name("dst").alias("dst"))
    nodes = spark.range(n + 1).select(name("id").alias("id"))
    want = {int(v): int(min(part)) for part in (at[:61], at[61:], [n]) for v in part}
    for leaf in (30, 100_000):
        rows = connected_components(nodes, ends, 10, leaf=leaf).collect()
        plain = [(r.id, r.comp) if kind == "long" else (r.id.node, r.comp.node) for r in rows]
        assert len(plain) == n + 1 and dict(plain) == want


@pytest.mark.parametrize("linkage", ["complete", "average"])
def test_linkage_of_more_rows_than_one_task_merges(spark, linkage, monkeypatch):
    """All rows count, not a summary: merges and labels are those of the whole matrix of distances."""
    from tablewise.operators import cluster, pairwise
    monkeypatch.setattr(pairwise, "_UNIT_ROWS", (16, 64))
    monkeypatch.setattr(pairwise, "_PIECE_ROWS", 2)
    rng = np.random.default_rng(11)
    X = np.concatenate([rng.normal(size=(30, 3)), rng.normal(size=(20, 3)) + 6, rng.uniform(-20, 20, (10, 3))])
    ids = rng.permutation(len(X)) * 3
    df = spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)] + [(5000, [float(v) for v in X[0]])], "id long, x array<double>")
    order = np.argsort(ids)
    X = np.concatenate([X[order], X[:1]])
    Z = cluster._agglomerate(X, np.ones(len(X)), linkage)
    labels, merges = cluster.agglomerative(df, "id", "x", 7, linkage, max_points=40)
    got = merges.orderBy("step").collect()
    assert [(r.left, r.right, r["size"]) for r in got] == [(min(a, b), max(a, b), s) for a, b, _, s in Z.astype(int).tolist()]
    assert np.allclose([r.height for r in got], Z[:, 2])
    want = dict(zip([*ids[order].tolist(), 5000], cluster._cut(Z, len(X), 7).tolist()))
    assert {r.id: r.cluster for r in labels.collect()} == want
