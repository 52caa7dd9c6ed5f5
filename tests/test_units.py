"""What bounds the copies, sorts and passes of the block operators and of the aggregates beside them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.functions.quantiles import quantile_table
from tablewise.operators import assoc, blocks, density, linkage, metrics
from tests.test_blocks import brute_silhouette, clustered, frame, gaps  # noqa: F401


def test_units_stay_few_when_rings_are_many():
    rng = np.random.default_rng(0)
    rings = np.array([(p, 100 + p % 7, r, r + 1, 1) for p in range(1000) for r in range(8)], float)
    rings[5, 1], rings[5, 4] = 500_000, 489
    home = blocks.Blocks(None, rng.normal(size=(1000, 4)), rings, "euclidean")
    units = blocks.home_units(home)
    shared = {g: s for g, s, _ in units.tolist()}
    assert sum(shared.values()) <= 3 * blocks.MOST_UNITS
    assert units[5].tolist()[1:] == [13, 38] and (units[:, 0] == units[5, 0]).sum() == 1


def test_points_are_sent_once_a_unit_and_all_counted(spark):
    """Nothing is left out by the bounds here: every unit sees every point."""
    rng = np.random.default_rng(1)
    X = rng.normal(size=(3000, 16))
    cut = density.point_blocks(frame(spark, range(3000), X), "id", "x", "euclidean", 32)
    assert len(cut.rings) > 3 * blocks.MOST_UNITS

    class Seen(blocks.Meeting):
        def meet(self, far):
            return {"n": np.array([len(far["rid"]) * len(self.base["rid"])])}

    rows = blocks.met(cut, cut, lambda ring, least, greatest: least >= 0, Seen, "n long")
    assert rows.agg(F.sum("n")).first()[0] == 3000 * 3000
    assert rows.rdd.getNumPartitions() <= 2 * blocks.MOST_UNITS
    got = {r.rid: r.n_0 for r in density.neighbour_counts(cut, [4.5]).collect()}
    assert got == dict(enumerate((gaps(X) <= 4.5).sum(1).tolist()))


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_limits_are_inclusive(metric):
    """Whole-number points lie at exactly the limit, where a rounded product may not decide."""
    rng = np.random.default_rng(2)
    a, b = (rng.integers(1000, 1006, (n, 3)).astype(float) for n in (70, 90))
    d = blocks.distances(a, b, metric)
    for limit, near in zip((0.0, 3.0, 5.0), blocks.within(a, b, (0.0, 3.0, 5.0), metric)):
        assert np.array_equal(near, d <= limit)
    assert np.allclose(blocks.close_distances(a, b, metric), d, rtol=1e-10, atol=0)
    i, j, got = blocks.candidates(a, b, np.full(len(a), np.inf), 4, metric)
    assert np.array_equal(got, d[i, j])
    assert all(set(np.argsort(d[r], kind="stable")[:4]) <= set(j[i == r]) for r in range(len(a)))


def test_silhouettes_of_several_partitions_share_their_distances(spark, clustered):  # noqa: F811
    ids, X = clustered
    first = [f"c{int(k) % 5}" for k in np.arange(len(X)) // 40]
    second = [None if k % 7 == 0 else str(k % 90) for k in range(len(X))]
    lone = ["a"] * (len(X) - 1) + ["b"]
    df = frame(spark, ids, X, one=first, two=second, three=lone)
    got = metrics.silhouettes(df, "x", ["one", "two", "three"], "id")
    kept = [k for k, s in enumerate(second) if s is not None]
    assert got[0][1] == len(X) and abs(got[0][0] - brute_silhouette(X, first)) < 1e-9
    assert got[1][1] == len(kept) and abs(got[1][0] - brute_silhouette(X[kept], [second[k] for k in kept])) < 1e-9
    assert got[2] == (None, len(X))


def test_rows_of_few_groups_are_not_sorted_by_group(spark):
    df = spark.range(2001).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("v"))
    out = quantile_table(df, ["g"], "v", (0.5,), ("median",))
    joins = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "_on_g" in line and "Join" in line and "LeftOuter" not in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    assert {r.g: r.median for r in out.collect()} == {"0": 999.0, "1": 1000.0, "2": 1001.0}


def test_spearman_of_full_columns_has_no_regroup(spark):
    rng = np.random.default_rng(3)
    X = rng.integers(0, 40, (500, 3)).astype(float)
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    out = assoc.spearman_long(df, ["a", "b", "c"], False)
    assert "rid" not in out._jdf.queryExecution().optimizedPlan().toString()
    ranks = [np.array([(X[:, i] < v).sum() + ((X[:, i] == v).sum() + 1) / 2 for v in X[:, i]]) for i in range(3)]
    got = {(r.var1, r.var2): r.correlation for r in out.collect()}
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            if i != j:
                assert abs(got[a, b] - np.corrcoef(ranks[i], ranks[j])[0, 1]) < 1e-9


def test_predictions_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            made.add(1)
            yield r

    pred = spark.createDataFrame(spark.createDataFrame([(k % 3, k % 2) for k in range(60)], "label long, prediction long").rdd.mapPartitions(count),
                                 "label long, prediction long")
    assert metrics.confusion_long(pred, "label", "prediction").agg(F.sum("n")).first()[0] == 60 and made.value == 60
    assert metrics.classification_report(pred, "label", "prediction").count() == 6 and made.value == 120
    got = metrics.regression_metrics(pred, "label", "prediction").first()
    y, p = np.array([k % 3 for k in range(60)]), np.array([k % 2 for k in range(60)])
    assert made.value == 180 and abs(got.r2 - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_spanning_trees_need_no_other_pairs(metric):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 30, (80, 3)).astype(float), rng.integers(0, 40, (60, 3)).astype(float)
    own = linkage._tree(blocks.distances(a, a, metric))
    d = blocks.distances(a, b, metric)
    i, j, w = blocks.tree_candidates(a, b, own[2].max(), metric)
    assert np.array_equal(w, d[i, j]) and len(i) < d.size / 2
    trees = []
    for cross in (d, np.full(d.shape, np.inf)):
        cross[i, j] = d[i, j]
        weights = np.full((140, 140), np.inf)
        weights[own[0], own[1]] = weights[own[1], own[0]] = own[2]
        weights[:80, 80:], weights[80:, :80] = cross, cross.T
        trees.append(linkage._tree(weights))
    assert all(np.array_equal(x, y) for x, y in zip(*trees))


def test_boruvka_rounds_do_not_grow_the_plan(spark):
    from tablewise.session import written
    df = written(spark.range(20).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b")).where("a > 3"))
    assert "LogicalRDD" not in df._jdf.queryExecution().analyzed().toString() and df.count() == 16
    rng = np.random.default_rng(9)
    edges = spark.createDataFrame([(k, k + 1, float(h)) for k, h in enumerate(rng.permutation(400))], "a long, b long, height double")
    got = sorted(tuple(r) for r in linkage.spanning_tree(edges, 3).collect())
    assert got == sorted(tuple(r) for r in edges.collect())


def test_dbscan_measures_until_core_and_until_joined(monkeypatch):
    """A point is measured until it has the neighbours of a core, an away point until one near point joins it."""
    x = np.random.default_rng(5).normal(size=(3000, 2))
    x[490:495] += 40 * np.arange(1, 6)[:, None]  # five points far from all
    gap = np.sqrt(((x[:500, None] - x[None]) ** 2).sum(-1))
    cells, real = [], density.within
    monkeypatch.setattr(density, "within", lambda a, b, *more: cells.append(len(a) * len(b)) or real(a, b, *more))
    light = blocks.Blocks(None, np.zeros((1, 2)), np.array([[0, 3000, 0, np.inf, 1]], float), "euclidean")
    rows = lambda i, j: {"rid": np.arange(i, j), "x": x[i:j], "ring": np.zeros(j - i, int)}
    counts = density._Counts(rows(0, 500), light, [0.5], 5)
    counts.meet(rows(0, 3000))
    n, whole = counts.done()["n_0"], (gap <= 0.5).sum(1)
    assert np.array_equal(n >= 5, whole >= 5) and np.array_equal(n[n < 5], whole[n < 5]) and (n < 5).any()
    assert sum(cells) < 500 * 3000 / 3
    forest, edges = density._Forest(rows(0, 500), 0.5, "euclidean"), []
    edges.append(forest.meet(rows(0, 1000)))
    cells.clear()
    edges.append(forest.meet(rows(1000, 3000)))
    assert sum(cells) < 500 * 2000 / 3
    edges.append(forest.done())
    a, b = (np.concatenate([e[c] for e in edges]) for c in ("src", "dst"))
    labels, told = np.arange(3000), np.arange(3000)
    density.merge_labels(a, b, told)
    density.merge_labels(*np.nonzero(gap <= 0.5), labels)
    assert np.array_equal(told, labels)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_away_points_are_prepared_once_and_met_in_tiles(monkeypatch, metric):
    """A task makes the away side of a product once for all its home blocks, and no array of distances outgrows a tile."""
    rng, made, cells = np.random.default_rng(9), [], []
    x = rng.normal(size=(900, 5)) + 3
    rid, ring = np.arange(900), np.arange(900) // 100
    real, pieces = blocks._side, blocks.close_pieces
    monkeypatch.setattr(blocks, "_side", lambda p, *more: made.append(len(p)) or real(p, *more))
    home, far = ({"x": v, "rid": rid[:k], "ring": ring[:k]} for k, v in ((900, x), (900, x)))
    if metric == "euclidean":
        centre = x.mean(0)
        sides = (*blocks._side(x, centre, np.float32, True), *blocks._side(x, centre, np.float32, False))
        made.clear()
        i, j, d = blocks.candidates(home["x"], far["x"], np.full(900, np.inf), 4, metric, sides)
        assert not made
    else:
        i, j, d = blocks.candidates(home["x"], far["x"], np.full(900, np.inf), 4, metric)
    gap = gaps(x, metric)
    for k in (0, 450, 899):
        assert np.allclose(np.sort(d[i == k])[:4], np.sort(gap[k])[:4], rtol=1e-12, atol=0)
    out = np.concatenate([cells.append(got.size) or got for _, got in pieces(x, x, metric)])
    assert np.allclose(out, gap, rtol=1e-10, atol=0) and max(cells) <= blocks._TILE_ROWS * 900
    if metric == "euclidean":
        x, rid = x[:300], rid[:300]
        base = {"rid": rid, "x": x, "ring": ring[:300], "label_0": rid % 3, "has_0": rid > 5, "label_1": rid % 80, "has_1": rid >= 0}
        score = blocks._Silhouette(base, 2, metric)
        for k in range(0, 300, 150):
            score.meet({c: v[k:k + 150] for c, v in base.items()})
        for got, mask, label in zip(score.done()["s"], (rid > 5, rid >= 0), (rid % 3, rid % 80)):
            assert np.isclose(got / mask.sum(), brute_silhouette(x[mask], label[mask]), rtol=1e-9)


def test_models_of_a_grid_are_fitted_at_the_same_time_from_one_table(spark, monkeypatch):
    from threading import Barrier

    from tablewise.operators import cluster
    x = np.random.default_rng(3).normal(size=(60, 2)) + 9 * (np.arange(60)[:, None] % 2)
    both, seen, real = Barrier(2), [], cluster._best_fit

    def fit(vec, k, *more):
        both.wait(60)
        seen.append(id(vec))
        return real(vec, k, *more)
    monkeypatch.setattr(cluster, "_best_fit", fit)
    rows = cluster.kmeans_grid(frame(spark, range(60), x), "x", "id", [2, 3]).orderBy("k").collect()
    assert len(set(seen)) == 1 and [r.k for r in rows] == [2, 3] and rows[0].silhouette > 0.7 and rows[1].inertia < rows[0].inertia


def test_knn_sends_a_point_once_a_unit_at_every_size(spark):
    """What k-NN shuffles is at most the points times the units, and the units don't grow with the points."""
    rng, most = np.random.default_rng(5), 2 * blocks.MOST_UNITS
    for n in (2000, 8000):
        cut = density.point_blocks(frame(spark, range(n), rng.normal(size=(n, 8))), "id", "x", "euclidean", 16)
        units = blocks.home_units(cut)
        assert sum({g: s for g, s, _ in units.tolist()}.values()) <= most

        class Sent(blocks.Meeting):
            def done(self):
                return {"ring": self.base["ring"]}

        rows = blocks.met(cut, cut, lambda ring, least, greatest: least >= 0, Sent, "ring int", split_far=False)
        assert rows.count() == n  # each home point in one unit
        assert rows.rdd.getNumPartitions() <= most


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_links_of_a_block_go_by_the_way_of_each_row(metric):
    """One far row of the block doesn't make every pair a candidate, and the tree of all is still found."""
    from tablewise.operators import blocks, linkage
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 4))
    X[3] += 40
    given = type("B", (), {"metric": metric})
    first, second = (linkage._Edges({"rid": ids, "x": X[ids]}, given, np.inf) for ids in (np.arange(120), np.arange(120, 300)))
    assert len(blocks.tree_candidates(X[:120], X[120:], first.way, metric)[0]) < 180 * 120 / 4
    parts = [first.meet({"rid": np.arange(300), "x": X}), first.done(), second.done()]
    a, b, w = (np.concatenate([p[c] for p in parts]) for c in ("a", "b", "height"))
    kept = linkage._forest(300, a, b, w)
    assert kept.sum() == 299
    assert np.allclose(np.sort(w[kept]), np.sort(linkage._tree(blocks.distances(X, X, metric))[2]))
