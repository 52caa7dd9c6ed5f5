"""Supervised training and evaluation.

Models are ``pyspark.ml`` estimators on one assembled vector column; splits,
folds and balancing are deterministic functions of the row id (a hash for
splits, a distributed within-class position for folds), so results do not
depend on partitioning.  k-NN models use the exact blocked k-NN join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.operators.metrics import feature_array


def split_hash(row_id: Column, seed: int = 42, kind: str = "xxhash") -> Column:
    """Deterministic value in [0, 1) per row: xxhash64 of (row id, seed), or the
    multiplicative hash ((id + seed) * 2654435761) mod 1000003 (SQL-portable)."""
    if kind == "arith":
        return F.pmod((row_id.cast("long") + F.lit(seed)) * F.lit(2654435761), F.lit(1000003)) / F.lit(1000003.0)
    return F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000.0)


def train_test_split(df: DataFrame, row_id: str, test_size: float = 0.2, seed: int = 42,
                     kind: str = "xxhash") -> tuple[DataFrame, DataFrame]:
    """L1: seeded, non-stratified split; a row's side never depends on partitioning."""
    h = split_hash(q(row_id), seed, kind)
    return df.where(h >= test_size), df.where(h < test_size)


def position_in_group(df: DataFrame, keys: Sequence[str], order_col: str, out: str = "pos") -> DataFrame:
    """0-based position of each row within its ``keys`` group by ``order_col``
    (distinct per group): a distributed prefix sum over range partitions,
    so a dominant group is never sorted by one task."""
    from tablewise.functions.prefix import prefix_sum
    return prefix_sum(df, list(keys), [order_col], out=out).drop("_total")


def stratified_folds(df: DataFrame, label: str, row_id: str, n_splits: int = 5) -> DataFrame:
    """L2 (classifiers): scikit-learn ``StratifiedKFold`` without shuffling:
    within each class, rows in row-id order fill folds 0..n-1 in contiguous
    chunks whose sizes interleave the sorted labels over the folds."""
    counts = sorted((r[0], r[1]) for r in df.groupBy(q(label)).count().collect())  # one row per class
    start, alloc = 0, {}
    for cls, n in counts:
        # class occupies sorted positions [start, start+n); fold i takes those p with p % n_splits == i
        sizes = [len(range((start + ((i - start) % n_splits)), start + n, n_splits)) for i in range(n_splits)]
        alloc[cls] = sizes
        start += n
    pos = position_in_group(df, [label], row_id)
    fold = None
    for cls, sizes in alloc.items():
        bounds = [sum(sizes[:i + 1]) for i in range(n_splits)]
        e = sum((F.when(F.col("pos") >= b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
        cond = q(label) == F.lit(cls)
        fold = F.when(cond, e) if fold is None else fold.when(cond, e)
    return pos.withColumn("fold", fold.cast("int")).drop("pos")


def contiguous_folds(df: DataFrame, row_id: str, n_splits: int = 5) -> DataFrame:
    """L2 (regressors): ``KFold`` without shuffling: contiguous chunks in row
    order, the first n % k folds one row larger."""
    n = df.count()
    sizes = [n // n_splits + (1 if i < n % n_splits else 0) for i in range(n_splits)]
    bounds = [sum(sizes[:i + 1]) for i in range(n_splits)]
    pos = position_in_group(df.withColumn("_all", F.lit(0)), ["_all"], row_id).drop("_all")
    e = sum((F.when(F.col("pos") >= b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    return pos.withColumn("fold", e.cast("int")).drop("pos")


def assemble(df: DataFrame, features: Sequence[str] | str, keep: Sequence[str] = ()) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.select(*[q(c) for c in keep], array_to_vector(feature_array(df, features)).alias("features"))


def make_estimator(name: str, label: str = "label", **params):
    """Estimator by name: naive_bayes (L9), decision_tree (L10; ``impurity="entropy"`` for the
    other criterion), capped_tree (L10 with at most ``max_features`` features tried at each
    node), random_forest (L11), logistic (L12), linear_svm (L13, one-vs-rest), mlp (L15),
    linear_regression (L18; elasticNetParam 0 ridge, 1 lasso, between them elastic net),
    tree_regressor, forest_regressor (L20).  The perceptron (L14) is ``perceptron``."""
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if name == "naive_bayes":
        return C.NaiveBayes(modelType="gaussian", **common, **params)
    if name == "decision_tree":
        return C.DecisionTreeClassifier(seed=params.pop("seed", 42), **common, **params)
    if name == "capped_tree":
        return C.RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy=str(params.pop("max_features")),
                                        seed=params.pop("seed", 42), **common, **params)
    if name == "random_forest":
        return C.RandomForestClassifier(numTrees=params.pop("numTrees", 10), seed=params.pop("seed", 42), **common, **params)
    if name == "logistic":
        return C.LogisticRegression(maxIter=params.pop("maxIter", 100), **common, **params)
    if name == "linear_svm":
        # each class has its own run of many short jobs, which leave most cores idle one after the other
        return C.OneVsRest(classifier=C.LinearSVC(regParam=params.pop("regParam", 0.0), maxIter=params.pop("maxIter", 100)),
                           parallelism=4, **common)
    if name == "mlp":
        layers = params.pop("layers")
        return C.MultilayerPerceptronClassifier(layers=layers, seed=params.pop("seed", 42),
                                                maxIter=params.pop("maxIter", 200), **common, **params)
    if name == "linear_regression":
        return R.LinearRegression(regParam=params.pop("regParam", 0.0), elasticNetParam=params.pop("elasticNetParam", 0.0),
                                  **common, **params)
    if name == "tree_regressor":
        return R.DecisionTreeRegressor(seed=params.pop("seed", 42), **common, **params)
    if name == "forest_regressor":
        return R.RandomForestRegressor(numTrees=params.pop("numTrees", 10), seed=params.pop("seed", 42), **common, **params)
    raise ValueError(name)


def fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str] | str, label: str, row_id: str,
                model: str, **params) -> DataFrame:
    """Fit on ``train``, predict ``test``: (row_id, label, prediction)."""
    if model == "perceptron":
        classes, weights = perceptron(train, features, label, row_id, **params)
        return perceptron_predict(test, features, label, row_id, classes, weights)
    est = make_estimator(model, "label", **params)
    tr, te = (assemble(x, features, [row_id, label]).select(q(row_id), q(label).cast("double").alias("label"), "features")
              for x in (train, test))
    m = est.fit(tr)
    return m.transform(te).select(q(row_id), "label", "prediction")


def perceptron(train: DataFrame, features: Sequence[str] | str, label: str, row_id: str, epochs: int = 20, seed: int = 42):
    """Rosenblatt's rule, one neuron for each class against the others: a row on the wrong side
    of a neuron's plane is added to its weights with its sign.  In an epoch each task goes
    through its own rows in a seeded order from the common weights, and the tasks'
    weights are averaged by their rows (iterative parameter mixing); training ends with an
    epoch without a mistake, or after ``epochs``.  Returns (classes, weights), the
    last weight of each row being the bias; both are as large as classes x features."""
    import numpy as np
    import pandas as pd

    from tablewise.operators.metrics import MAX_CLUSTERS
    from tablewise.session import cut_lineage
    classes = [r[0] for r in train.where(q(label).isNotNull()).select(q(label).cast("double")).distinct().orderBy(1).limit(MAX_CLUSTERS + 1).collect()]
    if len(classes) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} classes")
    rows = cut_lineage(train.where(q(label).isNotNull()).select(q(row_id).alias("rid"), q(label).cast("double").alias("y"),
                                                                feature_array(train, features).alias("x"))
                       .withColumn("at", F.xxhash64("rid", F.lit(seed))).sortWithinPartitions("at", "rid"))
    first = rows.select(F.size("x")).first()
    weights = np.zeros((len(classes), (first[0] if first else 0) + 1))

    def epoch(start):
        def run(batches):
            w, n, wrong = start.copy(), 0, 0
            for b in batches:
                for x, y in zip(b["x"], b["y"]):
                    x, sign = np.append(np.asarray(x, float), 1.0), np.where(np.array(classes) == y, 1.0, -1.0)
                    off = sign * (w @ x) <= 0
                    w[off] += sign[off, None] * x
                    n, wrong = n + 1, wrong + int(off.any())
            if n:
                yield pd.DataFrame({"n": [n], "wrong": [wrong], "w": [(w * n).ravel()]})
        return run

    for _ in range(epochs if classes else 0):
        # one row a task
        parts = rows.select("x", "y").mapInPandas(epoch(weights), "n long, wrong long, w array<double>")
        told = parts.select("n", "wrong", F.posexplode("w").alias("i", "v")).groupBy("i").agg(
            F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum("wrong").alias("wrong")).orderBy("i").collect()
        if not told[0]["wrong"]:
            break
        weights = np.array([r["v"] / r["n"] for r in told]).reshape(weights.shape)
    return classes, weights


def perceptron_predict(test: DataFrame, features: Sequence[str] | str, label: str, row_id: str, classes, weights) -> DataFrame:
    """(row_id, label, prediction): the class whose neuron answers most, the least class among equals."""
    from tablewise.functions.scalars import dot
    x = F.concat(feature_array(test, features), F.array(F.lit(1.0)))
    neurons = F.array(*[F.struct(F.lit(-i).alias("i"), F.array(*[F.lit(float(v)) for v in w]).alias("w"), F.lit(float(c)).alias("c"))
                        for i, (c, w) in enumerate(zip(classes, weights))])
    answers = F.transform(neurons, lambda t: F.struct(dot(F.col("x"), t["w"]).alias("s"), t["i"], t["c"]))
    return (test.select(q(row_id), q(label).cast("double").alias("label"), x.alias("x"))
            .select(q(row_id), "label", F.array_max(answers)["c"].alias("prediction")))


def linear_coefficients(df: DataFrame, features: Sequence[str], label: str, **params) -> DataFrame:
    """(feature, coefficient) of a linear model, the intercept as ``intercept``."""
    rows = assemble(df, features, [label]).select(q(label).cast("double").alias("label"), "features")
    m = make_estimator("linear_regression", "label", **params).fit(rows)
    told = [("intercept", float(m.intercept)), *zip(features, map(float, m.coefficients))]
    return df.sparkSession.createDataFrame(told, "feature string, coefficient double")


def flagged_predictions(pred: DataFrame) -> DataFrame:
    """Every point with whether its prediction is right."""
    return pred.withColumn("correct", F.col("label").eqNullSafe(F.col("prediction")))


def best_model(table: DataFrame) -> DataFrame:
    """The model of greatest accuracy, the first by name among equals."""
    return table.orderBy(F.desc("accuracy"), "model").limit(1)


def cross_val_predict(df: DataFrame, features: Sequence[str] | str, label: str, row_id: str, model: str,
                      n_splits: int = 5, classifier: bool = True, **params) -> DataFrame:
    """L2: out-of-fold predictions (union over folds)."""
    folded = (stratified_folds(df, label, row_id, n_splits) if classifier else contiguous_folds(df, row_id, n_splits)).persist()
    out = None
    for f in range(n_splits):
        p = fit_predict(folded.where(F.col("fold") != f), folded.where(F.col("fold") == f), features, label, row_id,
                        model, **dict(params)).withColumn("fold", F.lit(f))
        out = p if out is None else out.unionByName(p)
    return out


def fold_scores(oof: DataFrame, classifier: bool = True) -> DataFrame:
    """L3: accuracy (classifier) or R^2 (regressor) per fold, plus the mean."""
    if classifier:
        per = oof.groupBy("fold").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("score"))
    else:
        w = Window.partitionBy("fold")
        t = oof.withColumn("_m", F.avg("label").over(w))
        per = t.groupBy("fold").agg((1 - F.sum((F.col("label") - F.col("prediction")) ** 2)
                                     / F.sum((F.col("label") - F.col("_m")) ** 2)).alias("score"))
    mean = per.agg(F.avg("score").alias("score")).select(F.lit(-1).alias("fold"), "score")
    return per.unionByName(mean)


def model_table(results: dict[str, DataFrame]) -> DataFrame:
    """Accuracy per model, best first (ties by name)."""
    out = None
    for name, pred in results.items():
        a = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")).select(
            F.lit(name).alias("model"), "accuracy")
        out = a if out is None else out.unionByName(a)
    return out.orderBy(F.desc("accuracy"), "model")


def wrong_predictions(pred: DataFrame) -> DataFrame:
    """Rows whose prediction differs from the label."""
    return pred.withColumn("correct", F.col("label") == F.col("prediction")).where(~F.col("correct"))


def undersample(df: DataFrame, label: str, row_id: str, seed: int = 42) -> DataFrame:
    """Keep, per class, the ``min class count`` rows with the smallest
    seeded hash -- a balanced, deterministic subset."""
    m = df.groupBy(q(label)).count().agg(F.min("count")).collect()[0][0]
    h = df.withColumn("_h", F.xxhash64(q(row_id), F.lit(seed)))
    pos = position_in_group(h, [label], "_h")
    return pos.where(F.col("pos") < m).drop("pos", "_h")


def knn_classify(train: DataFrame, test: DataFrame, row_id: str, features: Sequence[str] | str, label: str,
                 k: int = 3, weights: str = "uniform") -> DataFrame:
    """Majority vote of the k nearest training rows (ties to the least
    label); ``weights='distance'`` weights votes by 1/distance."""
    from tablewise.operators.neighbors import knn
    nn = knn(test, train, row_id, row_id, features, k, extra=[label])
    if weights == "uniform":
        wv = F.lit(1.0)
    else:  # training rows at distance 0 take all the weight
        exact = F.min("dist").over(Window.partitionBy("qid")) == 0
        nn = nn.withColumn("_w", F.when(exact, (F.col("dist") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("dist"))))
        wv = F.col("_w")
    votes = nn.groupBy("qid", F.col(label).alias("cls")).agg(F.sum(wv).alias("v"))
    best = votes.groupBy("qid").agg(F.min_by("cls", F.struct(-F.col("v"), F.col("cls"))).alias("prediction"))
    truth = test.select(q(row_id).alias("qid"), q(label).alias("label"))
    return best.join(truth, "qid").select(F.col("qid").alias(row_id), "label", "prediction")


def knn_regress(train: DataFrame, test: DataFrame, row_id: str, features: Sequence[str] | str, target: str,
                k: int = 5) -> DataFrame:
    """Mean target of the k nearest training rows."""
    from tablewise.operators.neighbors import knn
    nn = knn(test, train, row_id, row_id, features, k, extra=[target])
    pred = nn.groupBy("qid").agg(F.avg(F.col(target).cast("double")).alias("prediction"))
    truth = test.select(q(row_id).alias("qid"), q(target).cast("double").alias("label"))
    return pred.join(truth, "qid").select(F.col("qid").alias(row_id), "label", "prediction")


def fitted_line(df: DataFrame, x: str, y: str, step: float = 0.01, margin: float = 0.5) -> DataFrame:
    """Least-squares line of y on x evaluated on an evenly spaced grid
    from min(x) - margin to max(x) + margin (``sequence`` grid)."""
    stats = df.agg(F.regr_slope(q(y), q(x)).alias("b"), F.regr_intercept(q(y), q(x)).alias("a"),
                   F.min(q(x)).alias("lo"), F.max(q(x)).alias("hi"))
    n = F.floor((F.col("hi") - F.col("lo") + 2 * margin) / step + 1e-9).cast("int")
    grid = stats.select("a", "b", "lo", F.explode(F.sequence(F.lit(0), n)).alias("i"))
    xv = F.round(F.col("lo") - margin + F.col("i") * step, 10)
    return grid.select(xv.alias("x"), (F.col("a") + F.col("b") * xv).alias("y_hat"))
