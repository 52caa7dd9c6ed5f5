"""Clustering, dimensionality reduction and cluster reports.

* k-means is ``pyspark.ml.clustering.KMeans`` on a cached vector column; the
  reference's n_init restarts are a loop over seeds keeping the least cost.
* DBSCAN runs over pivot blocks (``operators.density``): neighbour counts,
  spanning forests of the core graph and border labels are emitted instead of
  neighbour pairs; components by contraction with pointer doubling, each round's
  tables written to the checkpoint folder.
* Single linkage (``operators.linkage``), complete and average linkage (``operators.pairwise``)
  are exact at every size.  Ward merges a summary of at most ``max_points`` weighted rows in one
  task: every row goes to its nearest pivot, and where there are fewer rows than
  pivots each row is its own, so the same steps are exact then.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.core import q, unpivot
from tablewise.functions.topk import top_n_per_group
from tablewise.operators.metrics import centroids, feature_array, sq_dist
from tablewise.session import cut_lineage, written

MAX_WARD_POINTS = 2000


def _vectors(df: DataFrame, features: Sequence[str] | str, keep: Sequence[str] = ()) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.select(*[q(c) for c in keep], array_to_vector(feature_array(df, features)).alias("features"))


# ------------------------------------------------------------------ k-means (K1-K8)

def kmeans(df: DataFrame, features: Sequence[str] | str, k: int, seed: int = 42, n_init: int = 10,
           max_iter: int = 300, keep: Sequence[str] = ()):
    """K1-K3: k-means (k-means|| init), best of ``n_init`` seeded restarts by
    training cost.  Returns (model, labelled DataFrame with ``cluster``)."""
    vec = _vectors(df, features, keep).persist()
    model = _best_fit(vec, k, seed, n_init, max_iter)
    labelled = model.transform(vec).drop("features")
    return model, labelled


def _best_fit(vec: DataFrame, k: int, seed: int, n_init: int, max_iter: int = 300):
    from pyspark.ml.clustering import KMeans
    if k < 2:
        raise ValueError("k must be >= 2")
    best = None
    for i in range(max(1, n_init)):
        m = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(vec)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost)
    return best[0]


def kmeans_inertia(model) -> float:
    """K2: within-cluster sum of squared distances (scikit-learn ``inertia_``)."""
    return float(model.summary.trainingCost)


def kmeans_grid(df: DataFrame, features: Sequence[str] | str, row_id: str, ks: Sequence[int], seed: int = 42,
                n_init: int = 1, silhouette_sample: int | None = None) -> DataFrame:
    """K4/K5: per k: inertia, silhouette (over all rows unless a sample is asked for), change of
    inertia vs the previous k and its drop in percent (first row 0)."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    from tablewise.operators.metrics import silhouettes
    keep = [row_id, *([features] if isinstance(features, str) else features)]
    # each k has its own run of many short jobs, which leave cores idle one after the other; all read one cached table
    vec = _vectors(df, features, keep).persist()
    with ThreadPool(max(1, min(4, len(ks)))) as pool:
        models = pool.map(inheritable_thread_target(df.sparkSession)(lambda k: _best_fit(vec, k, seed, n_init)), ks, chunksize=1)
    vec.unpersist()
    labelled, labels = _vectors(df, features, keep), [f"cluster_{i}" for i in range(len(models))]
    for model, label in zip(models, labels):
        labelled = model.copy({model.getParam("predictionCol"): label}).transform(labelled)
    scores = silhouettes(labelled, features, labels, row_id, silhouette_sample)
    rows = [(int(k), kmeans_inertia(model), s) for k, model, (s, _) in zip(ks, models, scores)]
    g = df.sparkSession.createDataFrame(rows, "k long, inertia double, silhouette double")
    w = Window.orderBy("k")
    prev = F.lag("inertia").over(w)
    return g.select("k", "inertia", "silhouette",
                    F.coalesce(F.col("inertia") - prev, F.lit(0.0)).alias("delta_inertia"),
                    F.coalesce(F.try_divide((prev - F.col("inertia")) * 100.0, prev), F.lit(0.0)).alias("inertia_drop_pct"))


def recommend_k_elbow(grid: DataFrame, threshold_pct: float = 10.0, skip_first: bool = True):
    """K6: first k whose inertia drop is under the threshold, else the last k.
    ``skip_first=False`` reproduces the reference (its first drop is 0, so
    it always returns the smallest k)."""
    rows = grid.orderBy("k").collect()
    cand = rows[1:] if skip_first else rows
    for r in cand:
        if r["inertia_drop_pct"] < threshold_pct:
            return r["k"]
    return rows[-1]["k"] if rows else None


def recommend_k_silhouette(grid: DataFrame):
    """K7: k with the greatest silhouette (nulls ignored); else the first k."""
    r = grid.where(F.col("silhouette").isNotNull()).orderBy(F.desc("silhouette"), "k").first()
    if r is None:
        f = grid.orderBy("k").first()
        return f["k"] if f else None
    return r["k"]


def cluster_sizes(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Count and share (pct) per cluster."""
    tot = labelled.select(F.count(F.lit(1))).scalar()
    return labelled.groupBy(q(label).alias("cluster")).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "pct", F.col("count") * 100.0 / tot)


def noise_summary(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Clusters (excluding -1), noise n and pct, largest non-noise cluster pct."""
    c = labelled.groupBy(q(label).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.count_if(F.col("cluster") != -1).alias("n_clusters"),
                 F.coalesce(F.sum(F.when(F.col("cluster") == -1, F.col("n"))), F.lit(0)).alias("n_noise"),
                 F.sum("n").alias("_n"),
                 F.max(F.when(F.col("cluster") != -1, F.col("n"))).alias("_mx"),
                 F.sum(F.when(F.col("cluster") != -1, F.col("n"))).alias("_nn")).select(
        "n_clusters", "n_noise", (F.col("n_noise") * 100.0 / F.col("_n")).alias("noise_pct"),
        F.try_divide(F.col("_mx") * 100.0, F.col("_nn")).alias("largest_cluster_pct"))


# ------------------------------------------------------------- profiles

def cluster_profile(labelled: DataFrame, features: Sequence[str], label: str = "cluster") -> DataFrame:
    """K9: per (cluster, feature): mean, global mean, delta, |delta|; order |delta| desc."""
    long = unpivot(labelled, features, [label], "feature", "value")
    g = long.groupBy("feature").agg(F.avg("value").alias("global_mean"))
    c = long.groupBy(F.col(label).alias("cluster"), "feature").agg(F.avg("value").alias("mean"))
    # g has one row per feature: a fixed bound, broadcast
    out = c.join(F.broadcast(g), "feature").withColumn("delta", F.col("mean") - F.col("global_mean"))
    return out.withColumn("abs_delta", F.abs("delta")).orderBy(F.desc("abs_delta"), "cluster", "feature")


def top_features(profile: DataFrame, n: int = 3, roles: dict[str, str] | None = None) -> DataFrame:
    """Per cluster the n features most above and most below the global
    mean (|delta| ranking), and the n binary features with largest |delta|.
    ``roles`` maps feature -> 'continuous'|'binary'|...; features in no role
    are excluded when roles are given."""
    p = profile
    if roles is not None:
        rm = F.create_map(*[F.lit(v) for kv in roles.items() for v in kv])
        p = p.withColumn("role", rm[F.col("feature")]).where(F.col("role").isNotNull())
    else:
        p = p.withColumn("role", F.lit(None).cast("string"))
    above = p.where(F.col("delta") > 0).withColumn("list", F.lit("above"))
    below = p.where(F.col("delta") < 0).withColumn("list", F.lit("below"))
    binary = p.where(F.col("role") == "binary").withColumn("list", F.lit("binary"))
    u = above.unionByName(below).unionByName(binary)
    w = Window.partitionBy("cluster", "list").orderBy(F.desc("abs_delta"), "feature")
    return u.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


# Readings of a delta above, near and below the mean, by the feature's role, as in the reference.
DELTA_READINGS = {
    "binary": ("maior prevalência de {f}", "prevalência semelhante de {f}", "menor prevalência de {f}"),
    "continuous": ("{f} acima da média", "{f} próximo da média", "{f} abaixo da média"),
    "other": ("tendência acima da média em {f}", "{f} semelhante à média", "tendência abaixo da média em {f}"),
}


def describe_deltas(profile: DataFrame, roles: dict[str, str], readings: dict[str, tuple[str, str, str]] = DELTA_READINGS,
                    own: dict[str, tuple[str, str, str]] | None = None) -> DataFrame:
    """Adds ``reading``, what a delta says.  Readings come from the feature's role
    (features without a role are ``other``) or from ``own``, by feature; each is a text for
    above, equal to and below the mean, with {f} for the feature's name.  A null delta has none."""
    texts = {f: readings[r] for f, r in roles.items()} | (own or {})
    told = F.create_map(*[x for f, t in texts.items() for x in (F.lit(f), F.array(*map(F.lit, t)))])
    text = F.coalesce(told[F.col("feature")], F.array(*map(F.lit, readings["other"]))) if texts else F.array(*map(F.lit, readings["other"]))
    place = F.when(F.col("delta") > 0, 0).when(F.col("delta") == 0, 1).when(F.col("delta") < 0, 2)
    return profile.withColumn("reading", F.replace(F.get(text, place), F.lit("{f}"), F.col("feature")))


def narrative_features(profile: DataFrame, roles: dict[str, str], n: int = 4) -> DataFrame:
    """Per cluster the n features of greatest |delta|, whatever their side, with their rank
    and reading; features in no role are left out."""
    w = Window.partitionBy("cluster").orderBy(F.desc("abs_delta"), "feature")
    listed = profile.where(F.col("feature").isin(list(roles))).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return describe_deltas(listed, roles)


def centroid_distances(centers: np.ndarray) -> tuple[float, float, float]:
    """Max, mean and min distance between distinct centroids (k x k on k centroids)."""
    c = np.asarray(centers, dtype=float)
    if len(c) < 2:
        return (float("nan"),) * 3
    d = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(-1))
    iu = np.triu_indices(len(c), 1)
    v = d[iu]
    return float(v.max()), float(v.mean()), float(v.min())


def characterize_clusters(labelled: DataFrame, features: Sequence[str], label: str = "cluster",
                          n: int = 5) -> DataFrame:
    """Per cluster n, pct and the n features with greatest |mean delta|
    (long form: cluster, n_samples, percentage, rank, feature, mean, delta)."""
    prof = cluster_profile(labelled, features, label)
    sizes = cluster_sizes(labelled, label)
    w = Window.partitionBy("cluster").orderBy(F.desc("abs_delta"), "feature")
    top = prof.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return top.join(sizes, "cluster").select("cluster", F.col("count").alias("n_samples"), F.col("pct").alias("percentage"),
                                             "rank", "feature", "mean", "delta")


def representatives(labelled: DataFrame, features: Sequence[str] | str, row_id: str, label: str = "cluster",
                    n: int = 3) -> DataFrame:
    """The n rows nearest to their own cluster centroid (rank, distance)."""
    cent = centroids(labelled, features, label)
    x = labelled.select(q(row_id).alias("row_id"), q(label).alias("cluster"), feature_array(labelled, features).alias("x"))
    j = x.join(F.broadcast(cent.select(F.col("label").alias("cluster"), "centroid")), "cluster")
    d = j.select("row_id", "cluster", F.sqrt(sq_dist(F.col("x"), F.col("centroid"))).alias("distance_to_centroid"))
    return top_n_per_group(d, ["cluster"], ["distance_to_centroid", "row_id"], n, rank_col="example_rank")


def pca(df: DataFrame, features: Sequence[str] | str, k: int = 2, keep: Sequence[str] = ()):
    """PCA on centred data; returns (projected DataFrame with pc1..pck,
    explained variance ratios).  Component signs are fixed so the largest
    absolute loading is positive."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import vector_to_array
    vec = _vectors(df, features, keep)
    sc = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="c").fit(vec)
    centred = sc.transform(vec)
    model = PCA(k=k, inputCol="c", outputCol="p").fit(centred)
    pcm = model.pc.toArray()
    signs = np.sign(pcm[np.abs(pcm).argmax(axis=0), range(pcm.shape[1])])
    signs[signs == 0] = 1
    arr = vector_to_array("p")
    proj = model.transform(centred).select(*[q(c) for c in keep],
                                           *[(arr[i] * float(signs[i])).alias(f"pc{i + 1}") for i in range(k)])
    return proj, [float(v) for v in model.explainedVariance.toArray()]


# -------------------------------------------------------------------- DBSCAN

def _least_fellows(edges):
    """(id, comp) of the nodes of a bounded table of edges, by union-find."""
    import pandas as pd

    from tablewise.operators.density import merge_labels
    nodes, at = np.unique(np.concatenate([edges["src"], edges["dst"]]), return_inverse=True)
    labels = np.arange(len(nodes))
    merge_labels(at[:len(edges)], at[len(edges):], labels)
    return pd.DataFrame({"id": nodes, "comp": nodes[labels]})


def connected_components(vertices: DataFrame, edges: DataFrame, max_iter: int = 100,
                         leaf: int = 100_000) -> DataFrame:
    """(id, comp) where comp is the least id of the component, by contraction: every component
    hooks to its least neighbour, pointers double until all point at roots, edges inside a
    component go.  Each of the at most ``max_iter`` rounds leaves at most half of the
    components that have edges, whatever the shape of the graph, and its tables are files, so that no
    round's plan is larger than the one before.  The last ``leaf`` edges go through one task."""
    if vertices.schema["id"].dataType.typeName() != "long":
        return _numbered_components(vertices, edges, max_iter, leaf)
    left, found = cut_lineage(edges.select("src", "dst")), None
    for _ in range(max_iter):
        if left.limit(leaf + 1).count() <= leaf:
            break
        both = left.unionByName(left.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst")
        # a component that is its least neighbour's least neighbour is the root if it is the lesser one
        to = written(both.groupBy(F.col("src").alias("c")).agg(F.min("dst").alias("to")))
        back = to.select(F.col("c").alias("to"), F.col("to").alias("back"))
        up = to.join(back, "to").select("c", F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c"))
                                        .otherwise(F.col("to")).alias("root"))
        moved = True
        while moved:  # pointers double until all of them point at roots
            above = up.select(F.col("c").alias("root"), F.col("root").alias("above"))
            doubled = written(up.join(above, "root").select("c", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")))
            moved, up = doubled.where("moved").limit(1).count() > 0, doubled.select("c", "root")
        # whatever has edges later had some in the first round
        found = up.select(F.col("c").alias("id"), F.col("root").alias("comp")) if found is None else written(
            found.join(up.select(F.col("c").alias("comp"), "root"), "comp", "left").select("id", F.coalesce("root", "comp").alias("comp")))
        left = written(left.join(up.select(F.col("c").alias("src"), F.col("root").alias("a")), "src")
                       .join(up.select(F.col("c").alias("dst"), F.col("root").alias("b")), "dst").where("a <> b")
                       .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_iter} rounds")
    labels = left.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda e: _least_fellows(e), "id long, comp long")
    if found is not None:
        labels = found.join(labels.select(F.col("id").alias("comp"), F.col("comp").alias("least")), "comp", "left").select(
            "id", F.coalesce("least", "comp").alias("comp"))
    return cut_lineage(vertices.select("id").join(labels, "id", "left").select("id", F.coalesce("comp", "id").alias("comp")))


def _numbered_components(vertices: DataFrame, edges: DataFrame, *rest: int) -> DataFrame:
    """Components of vertices that are no long numbers: they get numbers, and names back at the end."""
    named = written(vertices.select("id").distinct())
    named = written(named.withColumn("no", F.monotonically_increasing_id()))
    ends = (edges.select("src", "dst").join(named.select(F.col("id").alias("src"), F.col("no").alias("a")), "src")
            .join(named.select(F.col("id").alias("dst"), F.col("no").alias("b")), "dst"))
    comp = connected_components(named.select(F.col("no").alias("id")), ends.select(F.col("a").alias("src"), F.col("b").alias("dst")), *rest)
    labels = named.join(comp.withColumnRenamed("id", "no"), "no")
    least = labels.groupBy(F.col("comp").alias("no")).agg(F.min("id").alias("comp"))
    labels = labels.select("id", F.col("comp").alias("no")).join(least, "no").select("id", "comp")
    return cut_lineage(vertices.select("id").join(labels, "id", "left").select("id", F.coalesce("comp", "id").alias("comp")))


def dbscan(df: DataFrame, row_id: str, features: Sequence[str] | str, eps: float, min_samples: int,
           metric: str = "euclidean") -> DataFrame:
    """DBSCAN labels (rid, cluster, is_core); see ``operators.density``."""
    from tablewise.operators import density
    return density.dbscan(df, row_id, features, eps, min_samples, metric)


def dbscan_grid(df: DataFrame, row_id: str, features: Sequence[str] | str, eps_values: Sequence[float],
                min_samples_values: Sequence[int], metric: str = "euclidean", silhouette_sample: int | None = None) -> DataFrame:
    """Neighbour counts for every eps in ONE pass over the pivot blocks,
    reused for every (eps, min_samples): clusters, noise n / pct, core points,
    largest cluster pct, silhouette over all points (noise as a label) and
    without noise.  Silhouettes use the labels of the evaluated fit (no refit)."""
    from tablewise.operators import density
    from tablewise.operators.metrics import silhouettes
    eps_sorted = sorted(eps_values)
    blocks = density.point_blocks(df, row_id, features, metric)
    counts = cut_lineage(density.neighbour_counts(blocks, eps_sorted, max(min_samples_values, default=0)))
    labelled = blocks.points.select("rid", "x")
    rows, labels = [], []
    for i, eps in enumerate(eps_sorted):
        for ms in min_samples_values:
            lab = cut_lineage(density.label_points(blocks, counts, f"n_{i}", eps, ms))
            s = noise_summary(lab).collect()[0]
            core_n = lab.where("is_core").count()
            at = f"cluster_{len(rows)}"
            # a label is a matter of the row id; the first join is as the table of labels, row for row
            told = lab.select("rid", F.col("cluster").alias(at))
            labelled = (labelled.join(told if not rows else told.distinct(), "rid")
                        .withColumn(f"{at}_inside", F.when(F.col(at) != -1, F.col(at))))
            labels += [at, f"{at}_inside"]
            rows.append((float(eps), int(ms), int(s["n_clusters"]), int(s["n_noise"]), float(s["noise_pct"]),
                         int(core_n), s["largest_cluster_pct"]))
    # the distances of all configurations are computed once
    scores = [s for s, _ in silhouettes(labelled, "x", labels, "rid", silhouette_sample)]
    rows = [(*row, *scores[2 * i:2 * i + 2]) for i, row in enumerate(rows)]
    return df.sparkSession.createDataFrame(
        rows, "eps double, min_samples long, n_clusters long, n_noise long, noise_pct double, core_points long, "
              "largest_cluster_pct double, silhouette_all double, silhouette_non_noise double")


def choose_best_configuration(grid: DataFrame, max_noise_pct: float = 60.0) -> DataFrame:
    """>= 2 clusters, noise <= 60 %, silhouette present, ordered by
    silhouette desc, noise asc, clusters desc, core desc; else fallback order
    clusters desc, noise asc, core desc."""
    cand = grid.where((F.col("n_clusters") >= 2) & (F.col("noise_pct") <= max_noise_pct)
                      & F.col("silhouette_non_noise").isNotNull())
    best = cand.orderBy(F.desc("silhouette_non_noise"), "noise_pct", F.desc("n_clusters"), F.desc("core_points"),
                        "eps", "min_samples").limit(1)
    if best.count() == 0:
        return grid.orderBy(F.desc("n_clusters"), "noise_pct", F.desc("core_points"), "eps", "min_samples").limit(1)
    return best


def practical_configurations(grid: DataFrame, top: int = 5, max_noise_pct: float = 60.0) -> DataFrame:
    """Top practical configurations (same filter and order as K16)."""
    cand = grid.where((F.col("n_clusters") >= 2) & (F.col("noise_pct") <= max_noise_pct)
                      & F.col("silhouette_non_noise").isNotNull())
    return cand.orderBy(F.desc("silhouette_non_noise"), "noise_pct", F.desc("n_clusters"), F.desc("core_points"),
                        "eps", "min_samples").limit(top)


def k_distance(df: DataFrame, row_id: str, features: Sequence[str] | str, k: int = 5,
               metric: str = "euclidean") -> DataFrame:
    """Distance of every point to its k-th neighbour, the point itself
    counted first (so k=5 is the 4th other point); exact k-NN join."""
    from tablewise.operators.neighbors import knn
    nn = knn(df, df, row_id, row_id, features, k, metric)
    return nn.where(F.col("rank") == k).select(F.col("qid").alias("rid"), F.col("dist").alias("k_distance"))


def k_distance_curve(df: DataFrame, row_id: str, features: Sequence[str] | str, k: int = 5, metric: str = "euclidean") -> DataFrame:
    """The sorted k-distance curve (position, rid, k_distance), positions from 0, with its
    90 % and 95 % quantiles ``q90`` and ``q95``, the usual choices of eps."""
    from tablewise.functions.prefix import prefix_sum
    from tablewise.functions.quantiles import exact_quantiles, quantile_wide
    curve = cut_lineage(k_distance(df, row_id, features, k, metric))
    limits = quantile_wide(exact_quantiles(curve, ["k_distance"], (0.9, 0.95)), ["variable"], (0.9, 0.95), ("q90", "q95"))
    placed = prefix_sum(curve, [], ["k_distance", "rid"], out="position")
    return placed.select("position", "rid", "k_distance", limits.select("q90").scalar().alias("q90"),
                         limits.select("q95").scalar().alias("q95"))


# ---------------------------------------------------------------------- Ward

def _agglomerate(c: np.ndarray, w: np.ndarray, linkage: str = "ward") -> np.ndarray:
    """Weighted agglomeration (Lance-Williams) on m points with weights:
    ``ward``, ``single``, ``complete`` or ``average``.  Returns the linkage
    matrix (a, b, height, size) in merge order, ids as in scipy (new
    clusters numbered m, m+1, ...)."""
    m = len(c)
    size = w.astype(float).copy()
    d2 = ((c[:, None, :] - c[None, :, :]) ** 2).sum(-1)
    if linkage == "ward":
        # Ward distance between weighted singletons
        D = np.sqrt(2.0 * (size[:, None] * size[None, :]) / (size[:, None] + size[None, :]) * d2)
    else:
        D = np.sqrt(d2)
    return merge_matrix(D, size, linkage)


def merge_matrix(D: np.ndarray, size: np.ndarray, linkage: str) -> np.ndarray:
    """``_agglomerate`` from the distances and sizes of the clusters, both of which it overwrites."""
    m = len(D)
    np.fill_diagonal(D, np.inf)
    ids = list(range(m))
    active = np.ones(m, dtype=bool)
    Z = []
    for step in range(m - 1):
        flat = int(np.argmin(D))
        i, j = divmod(flat, m)
        if i > j:
            i, j = j, i
        h = D[i, j]
        ni, nj = size[i], size[j]
        nk = size
        if linkage == "ward":
            new = np.sqrt(np.maximum(((ni + nk) * D[i] ** 2 + (nj + nk) * D[j] ** 2 - nk * h ** 2) / (ni + nj + nk), 0))
        elif linkage == "single":
            new = np.minimum(D[i], D[j])
        elif linkage == "complete":
            new = np.maximum(D[i], D[j])
        elif linkage == "average":
            new = (ni * D[i] + nj * D[j]) / (ni + nj)
        else:
            raise ValueError(linkage)
        Z.append((ids[i], ids[j], h, ni + nj))
        new = np.where(active, new, np.inf)
        D[i, :] = new
        D[:, i] = new
        D[i, i] = np.inf
        active[j] = False
        D[j, :] = np.inf
        D[:, j] = np.inf
        size[i] = ni + nj
        ids[i] = m + step
    return np.array(Z, dtype=float)


def _cut(Z: np.ndarray, m: int, n_clusters: int) -> np.ndarray:
    """Leaf labels after undoing the last n_clusters-1 merges; labels are
    numbered by first leaf appearance."""
    parent = list(range(2 * m - 1))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    for s in range(m - n_clusters):
        a, b = int(Z[s, 0]), int(Z[s, 1])
        parent[find(a)] = m + s
        parent[find(b)] = m + s
    roots = [find(i) for i in range(m)]
    mapping: dict[int, int] = {}
    return np.array([mapping.setdefault(r, len(mapping)) for r in roots])


def summarised(df: DataFrame, row_id: str, features: Sequence[str] | str, max_points: int = MAX_WARD_POINTS) -> DataFrame:
    """(rid, x, micro): every row with the number of its nearest pivot, of at most ``max_points``;
    numbers follow the least row id of each pivot's rows."""
    from tablewise.operators.blocks import assigned, choose_pivots
    points = df.select(q(row_id).alias("rid"), feature_array(df, features).alias("x"))
    placed = cut_lineage(assigned(points, choose_pivots(points, max_points), "euclidean"))
    # at most max_points rows
    first = placed.groupBy("pivot").agg(F.min("rid").alias("first"))
    order = first.select("pivot", (F.row_number().over(Window.orderBy("first")) - 1).cast("long").alias("micro"))
    return placed.join(F.broadcast(order), "pivot").select("rid", "x", "micro")


def agglomerative_tree(points: DataFrame, linkage: str = "ward") -> DataFrame:
    """Merges (step, left, right, height, size) of the weighted means of ``points``
    (rid, x, micro), made by one task from that bounded table.  Clusters are numbered as
    usual: micro-clusters first, then a new number for each merge."""
    import pandas as pd
    means = (points.select("micro", F.posexplode("x").alias("pos", "v")).groupBy("micro", "pos").agg(F.avg("v").alias("m"), F.count("v").alias("n"))
             .groupBy("micro").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda t: t["m"]).alias("x")))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("micro")
        Z = _agglomerate(np.array(rows["x"].tolist(), float), rows["n"].to_numpy(float), linkage)
        Z = Z.reshape(-1, 4)
        return pd.DataFrame({"step": np.arange(len(Z)), "left": Z[:, 0].astype(int), "right": Z[:, 1].astype(int),
                             "height": Z[:, 2], "size": Z[:, 3].astype(int)})

    return cut_lineage(means.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(merge, "step long, left long, right long, height double, size long"))


def cut_tree(points: DataFrame, tree: DataFrame, n_clusters: int) -> DataFrame:
    """(rid, cluster) of every row for a cut of the tree into ``n_clusters``, numbered by their least row."""
    import pandas as pd
    columns = ["left", "right", "height", "size"]

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        Z = rows.sort_values("step")[columns].to_numpy(float)
        labels = _cut(Z, len(Z) + 1, min(n_clusters, len(Z) + 1))
        return pd.DataFrame({"micro": np.arange(len(labels)), "cluster": labels})

    # a row for each micro-cluster: bounded by max_points
    labels = tree.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(cut, "micro long, cluster long")
    return (points.join(F.broadcast(labels), "micro", "left")
            .select("rid", F.coalesce("cluster", F.lit(0)).cast("long").alias("cluster")))  # one micro-cluster has no merge


def agglomerative(df: DataFrame, row_id: str, features: Sequence[str] | str, n_clusters: int,
                  linkage: str = "ward", max_points: int = MAX_WARD_POINTS) -> tuple[DataFrame, DataFrame]:
    """Agglomerative clustering (``ward`` | ``single`` | ``complete`` | ``average``):
    (labels (row_id, cluster), merges).  Single linkage (``operators.linkage``: merges with row
    ids), complete and average linkage (``operators.pairwise``) are exact at every size; the last
    ``max_points`` clusters of the latter two merge in one task.  Ward merges the summary of at
    most ``max_points`` weighted means, exact with no more rows than that."""
    from tablewise.operators import linkage as single
    if linkage == "single":
        ranked = single.single_linkage(df, row_id, features)
        return single.cut_single(df, row_id, ranked, n_clusters), single.merge_table(ranked)
    if linkage != "ward":
        from tablewise.operators.pairwise import numbered_merges, pairwise_linkage
        rows, ranked = pairwise_linkage(df, row_id, features, linkage, max_points)
        labels = rows.join(single.cut_single(rows, "no", ranked, n_clusters), "no").select(F.col("rid").alias(row_id), "cluster")
        return labels, numbered_merges(rows, ranked)
    points = cut_lineage(summarised(df, row_id, features, max_points))
    tree = agglomerative_tree(points, linkage)
    return cut_tree(points, tree, n_clusters).withColumnRenamed("rid", row_id), tree


def ward(df: DataFrame, row_id: str, features: Sequence[str] | str, n_clusters: int,
         max_points: int = MAX_WARD_POINTS) -> tuple[DataFrame, DataFrame]:
    """Ward clustering; returns (labels (row_id, cluster), merges)."""
    return agglomerative(df, row_id, features, n_clusters, "ward", max_points)


def tree_silhouette_range(df: DataFrame, row_id: str, features: Sequence[str] | str, k_min: int = 2,
                          k_max: int = 10, linkage: str = "ward", sample_size: int | None = None) -> DataFrame:
    """Silhouette for every cut k_min..k_max of ONE tree."""
    from tablewise.operators.metrics import silhouettes
    points = cut_lineage(summarised(df, row_id, features))
    tree = agglomerative_tree(points, linkage)
    ks = range(k_min, min(k_max, tree.count() + 1) + 1)
    labelled = points.select("rid", F.col("micro").alias("own")).join(points.select("rid", "x"), "rid")
    for k in ks:
        # a row for each micro-cluster: bounded
        labels = cut_tree(points.select(F.col("micro").alias("rid"), "micro").distinct(), tree, k)
        labelled = labelled.join(F.broadcast(labels.select(F.col("rid").alias("own"), F.col("cluster").alias(f"cut_{k}"))), "own")
    scores = silhouettes(labelled, "x", [f"cut_{k}" for k in ks], "rid", sample_size) if len(ks) else []
    return df.sparkSession.createDataFrame([(k, s) for k, (s, _) in zip(ks, scores)], "k long, silhouette double")
