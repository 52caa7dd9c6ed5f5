"""Clustering and prediction quality metrics.

Features are handled as one ``array<double>`` per row, so per-row distances
are in-row expressions (``zip_with`` / ``aggregate``) without a shuffle.
Per-cluster centroids are a (clusters x dims) aggregate: map-side partial
sums keep the shuffle at one row per (cluster, dim) per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q

MAX_CLUSTERS = 10_000  # label tables above this size are not broadcast


def feature_array(df: DataFrame, features: Sequence[str] | str) -> Column:
    """One ``array<double>`` column from a list of numeric columns or an array column."""
    if isinstance(features, str):
        return F.transform(q(features), lambda v: v.cast("double"))
    return F.array(*[q(c).cast("double") for c in features])


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def l1_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v)


def centroids(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """Per label: n and the mean vector (``centroid`` array) -- element-wise
    mean via posexplode + partial aggregation."""
    x = df.select(q(label).alias("label"), feature_array(df, features).alias("x"))
    ex = x.select("label", F.posexplode("x").alias("pos", "v"))
    means = ex.groupBy("label", "pos").agg(F.avg("v").alias("m"), F.count("v").alias("n"))
    return (means.groupBy("label")
                 .agg(F.max("n").alias("n"),
                      F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid")))


def _check_clusters(cent: DataFrame) -> int:
    k = cent.count()
    if k > MAX_CLUSTERS:
        raise ValueError(f"{k} labels: too many clusters for a broadcast centroid table")
    return k


def with_centroid_distance(df: DataFrame, features: Sequence[str] | str, label: str,
                           cent: DataFrame | None = None) -> DataFrame:
    """Adds ``_x`` (features) and ``dist`` (Euclidean distance to own centroid)."""
    cent = cent if cent is not None else centroids(df, features, label)
    _check_clusters(cent)
    x = df.withColumn("_x", feature_array(df, features))
    j = x.join(F.broadcast(cent.select(F.col("label").alias("_lab"), "centroid")), q(label) == F.col("_lab"))
    return j.withColumn("dist", F.sqrt(sq_dist(F.col("_x"), F.col("centroid")))).drop("_lab")


def calinski_harabasz(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """(B / (k-1)) / (W / (n-k)); null when fewer than 2 clusters; 1.0 when W = 0."""
    cent = centroids(df, features, label)
    x = df.select(q(label).alias("label"), feature_array(df, features).alias("x"))
    ex = x.select("label", F.posexplode("x").alias("pos", "v"))
    cm = ex.groupBy("label", "pos").agg(F.avg("v").alias("m"), F.count("v").alias("n"))
    g = ex.groupBy("pos").agg(F.avg("v").alias("g"))
    # g has one row per dimension: a fixed bound, broadcast
    b = cm.join(F.broadcast(g), "pos").select((F.col("n") * (F.col("m") - F.col("g")) * (F.col("m") - F.col("g"))).alias("b"))
    w = with_centroid_distance(df, features, label, cent).select((F.col("dist") * F.col("dist")).alias("w"))
    k = cent.select(F.count(F.lit(1))).scalar()
    n = df.select(F.count(F.lit(1))).scalar()
    B = b.select(F.sum("b")).scalar()
    W = w.select(F.sum("w")).scalar()
    v = F.when(k < 2, F.lit(None).cast("double")).when(W == 0, F.lit(1.0)).otherwise((B / (k - 1)) / (W / (n - k)))
    return df.sparkSession.range(1).select(v.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """Mean over clusters of the greatest (s_i + s_j) / d(c_i, c_j), s being the mean distance
    to the own centroid.  Null under 2 clusters, 0 if all scatter is 0; coinciding centroids
    don't count against each other.  The centroid table meets itself on a constant
    number of chunks (labels are checked against ``MAX_CLUSTERS``)."""
    cent = centroids(df, features, label)
    k = _check_clusters(cent)
    scatter = with_centroid_distance(df, features, label, cent).groupBy(q(label).alias("label")).agg(F.avg("dist").alias("s"))
    table = cent.join(scatter, "label").select("label", "centroid", "s")
    others = table.select(F.col("label").alias("other"), F.col("centroid").alias("far"), F.col("s").alias("t"))
    # label <> other alone would be a product of two tables; each label is sent to the chunks of the others
    chunks = max(1, k // 64)
    sent = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    met = sent.join(others.withColumn("chunk", F.pmod(F.xxhash64("other"), F.lit(chunks)).cast("int")), "chunk").where("label <> other")
    gap = F.sqrt(sq_dist(F.col("centroid"), F.col("far")))
    worst = met.groupBy("label").agg(F.max(F.when(gap > 0, (F.col("s") + F.col("t")) / gap)).alias("r"))
    flat = F.sum(F.abs("s"))
    mean = worst.agg(F.avg(F.coalesce("r", F.lit(0.0)))).scalar() if k > 1 else F.lit(None).cast("double")
    return table.agg(flat.alias("flat")).select(F.when(F.lit(k) < 2, F.lit(None).cast("double")).when(F.col("flat") < 1e-8, 0.0)
                                               .otherwise(mean).alias("davies_bouldin"))


def silhouette(df: DataFrame, features: Sequence[str] | str, label: str, row_id: str,
               sample_size: int | None = None, seed: int = 42, metric: str = "euclidean") -> DataFrame:
    """Mean silhouette over all rows, from plain distances; (silhouette, n).

    Every home block (``operators.blocks``) sees all points, a batch at a time, and
    keeps one distance sum for each of its points and labels, so the answer needs
    no pair, no sample and no label table.  ``sample_size`` scores that many rows of
    least hash instead, if the caller asks for it.  Null unless there are >= 2
    labels and every label has >= 2 members."""
    told = silhouettes(df, features, [label], row_id, sample_size, seed, metric)
    return df.sparkSession.createDataFrame(told, "silhouette double, n long")


def silhouettes(df: DataFrame, features: Sequence[str] | str, labels: Sequence[str], row_id: str,
                sample_size: int | None = None, seed: int = 42, metric: str = "euclidean") -> list[tuple[float | None, int]]:
    """K25 for several partitions of the same rows, label columns that may hold nulls (a row
    without a label is not of that partition): (silhouette, n) of each; all distances are
    computed once."""
    from tablewise.operators.blocks import compact_features, mean_silhouettes
    points = df.select(q(row_id).alias("rid"), *[q(c).alias(f"label_{i}") for i, c in enumerate(labels)], compact_features(df, features).alias("x"))
    if sample_size:
        points = points.orderBy(F.xxhash64("rid", F.lit(seed)), "rid").limit(sample_size)
    return mean_silhouettes(points, [f"label_{i}" for i in range(len(labels))], metric)


def silhouette_squared(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """The silhouette of squared Euclidean distances, (silhouette_squared, n), in closed form: the mean
    squared distance of x to a cluster is |x|^2 - 2 x.S/n + Q/n, from the cluster's count n, vector
    sum S and sum of squares Q, so two scans do.  It is another number than ``silhouette``."""
    x = df.select(q(label).alias("label"), feature_array(df, features).alias("x"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    sums = (x.select("label", F.posexplode("x").alias("pos", "v")).groupBy("label", "pos")
            .agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.count("v").alias("n")))
    clusters = (sums.groupBy("label").agg(F.max("n").alias("n"), F.sum("q").alias("q"),
                                          F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda t: t["s"]).alias("s")))
    k = _check_clusters(clusters)
    table = clusters.select(F.collect_list(F.struct("label", "n", "q", "s"))).scalar()
    size = F.size("x").cast("double")
    own = F.filter("c", lambda t: t["label"] == F.col("label"))[0]
    mean = lambda t, d: F.try_divide(t["n"] * F.col("xx") - 2 * dot(F.col("x"), t["s"]) + t["q"], d.cast("double"))
    told = x.where(size > 0).select("label", "x", dot(F.col("x"), F.col("x")).alias("xx"), table.alias("c"))
    told = told.select(mean(own, own["n"] - 1).alias("a"), own["n"].alias("n"),
                       F.array_min(F.transform(F.filter("c", lambda t: t["label"] != F.col("label")), lambda t: mean(t, t["n"]))).alias("b"))
    score = F.when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(F.lit(0.0))
    out = told.agg(F.avg(score).alias("s"), F.min("n").alias("least"), F.count(F.lit(1)).alias("n"))
    return out.select(F.when((F.lit(k) >= 2) & (F.col("least") >= 2), F.col("s")).alias("silhouette_squared"), "n")


def partition_metrics(df: DataFrame, features: Sequence[str] | str, label: str, row_id: str,
                      name: str = "partition", sample_size: int | None = None) -> DataFrame:
    """One row: partition, n_clusters, silhouette, calinski_harabasz, davies_bouldin
    (metrics null under 2 clusters)."""
    k = df.select(F.count_distinct(q(label))).collect()[0][0]
    if k < 2:
        return df.sparkSession.createDataFrame([(name, k, None, None, None)],
                                               "partition string, n_clusters long, silhouette double, "
                                               "calinski_harabasz double, davies_bouldin double")
    s = silhouette(df, features, label, row_id, sample_size).select("silhouette")
    ch = calinski_harabasz(df, features, label)
    db = davies_bouldin(df, features, label)
    return (s.select(F.lit(name).alias("partition"), F.lit(k).cast("long").alias("n_clusters"), "silhouette",
                     ch.select("calinski_harabasz").scalar().alias("calinski_harabasz"),
                     db.select("davies_bouldin").scalar().alias("davies_bouldin")))


# ------------------------------------------------------------ classification

def confusion_long(pred: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """Confusion counts for the full class grid (absent cells 0), long form."""
    from tablewise.session import cut_lineage
    # pairs of classes, written once: the predictions are not made again for the classes
    counts = cut_lineage(pred.groupBy(q(label).alias("actual"), q(prediction).alias("predicted")).agg(F.count(F.lit(1)).alias("n")))
    if classes is None:
        classes = [r[0] for r in counts.select("actual").union(counts.select("predicted")).distinct()
                   .orderBy(1).limit(MAX_CLUSTERS + 1).collect()]
        if len(classes) > MAX_CLUSTERS:
            raise ValueError(f"more than {MAX_CLUSTERS} classes: the full grid of counts is not built")
    cls = F.array(*[F.lit(c) for c in classes])
    grid = (pred.sparkSession.range(1).select(F.explode(cls).alias("actual"))
                .select("actual", F.explode(cls).alias("predicted")))
    return grid.join(counts, ["actual", "predicted"], "left").select("actual", "predicted",
                                                                    F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """L4: precision, recall, F1 and support per class, plus accuracy, macro and
    weighted averages (undefined ratios -> 0, as scikit-learn's default)."""
    from tablewise.session import cut_lineage
    # pairs of classes, written once: four tables below come from them
    counts = cut_lineage(pred.groupBy(q(label).cast("string").alias("a"), q(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")))
    tp = counts.where(F.col("a") == F.col("p")).select(F.col("a").alias("cls"), F.col("n").alias("tp"))
    sup = counts.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("support"))
    pc = counts.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("pred_n"))
    per = (sup.join(pc, "cls", "full").join(tp, "cls", "left")
              .select("cls", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("support", F.lit(0)).alias("support"),
                      F.coalesce("pred_n", F.lit(0)).alias("pred_n")))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                     F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
                     F.col("support").cast("long").alias("support"), "tp")
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"), F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), (F.col("tp") / F.col("n")).alias("precision"),
                     (F.col("tp") / F.col("n")).alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    mac = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("n").cast("long").alias("support"))
    wei = tot.select(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("n")).alias("precision"),
                     (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(mac).unionByName(wei)


def accuracy(pred: DataFrame, label: str, prediction: str) -> Column:
    return F.avg((q(label) == q(prediction)).cast("double"))


def regression_metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """R^2, MSE, MAE in one aggregate, so that the predictions are made once."""
    y, p = q(label).cast("double"), q(prediction).cast("double")
    agg = pred.agg(F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
                   F.sum((y - p) * (y - p)).alias("_ssr"), (F.var_pop(y) * F.count(y)).alias("_sst"))
    return agg.select(F.when(F.col("_sst") > 0, 1 - F.col("_ssr") / F.col("_sst")).otherwise(F.lit(0.0)).alias("r2"),
                      "mse", "mae")


def largest_errors(pred: DataFrame, label: str, prediction: str, row_id: str, top: int = 20) -> DataFrame:
    """Rows by absolute error desc (row id asc on ties)."""
    err = F.abs(q(label).cast("double") - q(prediction).cast("double"))
    return pred.withColumn("abs_error", err).orderBy(F.desc("abs_error"), q(row_id)).limit(top)
