"""Registered supervised-learning queries.

k-NN predictions are exact and deterministic, so they and every metric
computed from them are checked against DuckDB, and so are the models with a closed
form: Gaussian naive Bayes, fitted and cross-validated, and least squares.
Other trained models (trees, forests, networks, solvers) have no SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import learn, metrics
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

SPLIT = """(select vec_id, label, embedding::double[] as x,
   ((vec_id + 42) * 2654435761) % 1000003 / 1000003.0 as h from embeddings)"""

KNN3 = f"""with e as {SPLIT},
tr as (select * from e where h >= 0.2), te as (select * from e where h < 0.2),
d as (select te.vec_id as qid, tr.vec_id as nid, tr.label as cls, list_distance(te.x, tr.x) as dist from te, tr),
r as (select *, row_number() over (partition by qid order by dist, nid) as rk from d),
v as (select qid, cls, count(*) as votes from r where rk <= 3 group by all),
b as (select qid, arg_min(cls, (-votes, cls)) as prediction from v group by qid),
p as (select b.qid as vec_id, te.label, b.prediction from b join te on te.vec_id = b.qid)"""

KNN5R = f"""with e as {SPLIT},
tr as (select * from e where h >= 0.2), te as (select * from e where h < 0.2),
d as (select te.vec_id as qid, tr.label::double as y, list_distance(te.x, tr.x) as dist, tr.vec_id as nid from te, tr),
r as (select *, row_number() over (partition by qid order by dist, nid) as rk from d),
b as (select qid, avg(y) as prediction from r where rk <= 5 group by qid),
p as (select b.qid as vec_id, te.label::double as label, b.prediction from b join te on te.vec_id = b.qid)"""


def _split(spark, sf):
    e = table(spark, sf, "embeddings")
    return learn.train_test_split(e, "vec_id", 0.2, 42, kind="arith")


def _knn3(spark, sf):
    tr, te = _split(spark, sf)
    return learn.knn_classify(tr, te, "vec_id", "embedding", "label", k=3)


def _knn5r(spark, sf):
    tr, te = _split(spark, sf)
    return learn.knn_regress(tr, te, "vec_id", "embedding", "label", k=5)


@register("l1_train_test_split", f"""
with e as {SPLIT}
select case when h < 0.2 then 'test' else 'train' end as side, count(*)::bigint as n from e group by 1
""")
def l1_train_test_split(spark, sf):
    tr, te = _split(spark, sf)
    return finish(tr.select(F.lit("train").alias("side")).unionByName(te.select(F.lit("test").alias("side")))
                  .groupBy("side").agg(F.count(F.lit(1)).alias("n")))


@register("l8_knn_classifier", KNN3 + "\nselect * from p")
def l8_knn_classifier(spark, sf):
    return finish(_knn3(spark, sf))


@register("l8_knn_distance_weights", KNN3.split(",\nv as")[0] + """,
z as (select *, min(dist) over (partition by qid) = 0 as exact from r where rk <= 3),
v as (select qid, cls, sum(case when exact then (dist = 0)::int::double else 1 / dist end) as votes from z group by all),
b as (select qid, arg_min(cls, (-votes, cls)) as prediction from v group by qid)
select b.qid as vec_id, te.label, b.prediction from b join te on te.vec_id = b.qid
""")
def l8_knn_distance_weights(spark, sf):
    tr, te = _split(spark, sf)
    return finish(learn.knn_classify(tr, te, "vec_id", "embedding", "label", k=3, weights="distance"))


@register("v14_flagged_predictions", KNN3 + "\nselect *, label = prediction as correct from p")
def v14_flagged_predictions(spark, sf):
    return finish(learn.flagged_predictions(_knn3(spark, sf)))


@register("l5_confusion_matrix", KNN3 + """,
g as (select a.c as actual, b.c as predicted from (select distinct label as c from p union select distinct prediction from p) a,
      (select distinct label as c from p union select distinct prediction from p) b),
c as (select label as actual, prediction as predicted, count(*) as n from p group by all)
select g.actual, g.predicted, coalesce(c.n, 0)::bigint as n from g left join c using (actual, predicted)
""")
def l5_confusion_matrix(spark, sf):
    return finish(metrics.confusion_long(_knn3(spark, sf), "label", "prediction"))


@register("l4_classification_report", KNN3 + """,
cls as (select label::varchar as c from p union select prediction::varchar from p),
per as (select c as class,
          coalesce((select count(*) from p where label::varchar = c and prediction::varchar = c) * 1.0
                   / nullif((select count(*) from p where prediction::varchar = c), 0), 0) as precision,
          coalesce((select count(*) from p where label::varchar = c and prediction::varchar = c) * 1.0
                   / nullif((select count(*) from p where label::varchar = c), 0), 0) as recall,
          (select count(*) from p where label::varchar = c)::bigint as support from cls),
per2 as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from per),
n as (select count(*) as n, count(*) filter (where label = prediction) as tp from p)
select class, precision, recall, f1, support from per2
union all select 'accuracy', tp * 1.0 / n, tp * 1.0 / n, tp * 1.0 / n, n::bigint from n
union all select 'macro avg', avg(precision), avg(recall), avg(f1), (select n from n)::bigint from per2
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), (select n from n)::bigint from per2
""")
def l4_classification_report(spark, sf):
    return finish(metrics.classification_report(_knn3(spark, sf), "label", "prediction"))


@register("l16_wrong_predictions", KNN3 + "\nselect *, false as correct from p where label <> prediction")
def l16_wrong_predictions(spark, sf):
    return finish(learn.wrong_predictions(_knn3(spark, sf)))


@register("l19_knn_regressor", KNN5R + "\nselect * from p")
def l19_knn_regressor(spark, sf):
    return finish(_knn5r(spark, sf))


@register("l21_regression_metrics", KNN5R + """
select 1 - sum((label - prediction) ^ 2) / sum((label - (select avg(label) from p)) ^ 2) as r2,
  avg((label - prediction) ^ 2) as mse, avg(abs(label - prediction)) as mae from p
""")
def l21_regression_metrics(spark, sf):
    return finish(metrics.regression_metrics(_knn5r(spark, sf), "label", "prediction"))


@register("l22_largest_errors", KNN5R + """
select *, abs(label - prediction) as abs_error from p order by abs_error desc, vec_id limit 20
""")
def l22_largest_errors(spark, sf):
    return finish(metrics.largest_errors(_knn5r(spark, sf), "label", "prediction", "vec_id", 20))


@register("l24_fitted_line", """
with s as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a,
                  min(l_quantity) as lo, max(l_quantity) as hi from lineitem),
g as (select a, b, lo, unnest(range(0, (floor((hi - lo + 1.0) / 0.01 + 1e-9))::bigint + 1)) as i from s)
select round(lo - 0.5 + i * 0.01, 10) as x, a + b * round(lo - 0.5 + i * 0.01, 10) as y_hat from g
""")
def l24_fitted_line(spark, sf):
    return finish(learn.fitted_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@register("l17_undersample_counts", """
with c as (select label, count(*) as n from embeddings group by 1)
select label, (select min(n) from c)::bigint as n from c
""")
def l17_undersample_counts(spark, sf):
    b = learn.undersample(table(spark, sf, "embeddings"), "label", "vec_id")
    return finish(b.groupBy("label").agg(F.count(F.lit(1)).alias("n")))


def _bayes_sql(train: str, test: str) -> str:
    """CTEs ending in p (vec_id, label, prediction): Gaussian naive Bayes fitted on one table of (vec_id, label, x), applied to another."""
    return f"""u as (select label, unnest(x) as v, generate_subscripts(x, 1) as pos from {train}),
g as (select label, pos, avg(v) as m, var_pop(v) + (select 1e-9 * max(s) from (select var_pop(v) as s from u group by pos)) as s from u group by all),
prior as (select label, ln(count(*)::double / (select count(*) from {train})) as lp from {train} group by 1),
t as (select vec_id, label, unnest(x) as v, generate_subscripts(x, 1) as pos from {test}),
l as (select t.vec_id, t.label as truth, g.label as cls, sum(-0.5 * ln(2 * pi() * s) - power(v - m, 2) / (2 * s)) as l from t join g using (pos) group by all),
p as (select vec_id, truth::double as label, arg_max(cls, l + lp)::double as prediction from l join prior on prior.label = cls group by vec_id, truth)"""


def _model_query(name, **params):
    def fn(spark, sf):
        tr, te = _split(spark, sf)
        return finish(learn.fit_predict(tr, te, "embedding", "label", "vec_id", name, **params))
    return fn


for _name, _params in [("naive_bayes", {}), ("decision_tree", {"maxDepth": 5}), ("random_forest", {"numTrees": 10}),
                       ("logistic", {"maxIter": 50}), ("linear_svm", {"maxIter": 20}),
                       ("perceptron", {"epochs": 10}), ("mlp", {"layers": [64, 16, 8, 10], "maxIter": 50}),
                       ("capped_tree", {"maxDepth": 5, "max_features": 8})]:
    _code = {"naive_bayes": "l9", "decision_tree": "l10", "random_forest": "l11", "logistic": "l12",
             "linear_svm": "l13", "perceptron": "l14", "mlp": "l15", "capped_tree": "l10"}[_name]
    _sql = f"with e as {SPLIT}, tr as (select * from e where h >= 0.2), te as (select * from e where h < 0.2), {_bayes_sql('tr', 'te')} select * from p"
    register(f"{_code}_{_name}", _sql if _name == "naive_bayes" else None)(_model_query(_name, **_params))

register("l10_entropy_tree")(_model_query("decision_tree", maxDepth=5, impurity="entropy"))


def _regression_query(name, **params):
    def fn(spark, sf):
        li = table(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        tr, te = learn.train_test_split(li, "rid", 0.2, 42)
        p = learn.fit_predict(tr, te, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "rid", name, **params)
        return finish(metrics.regression_metrics(p, "label", "prediction"))
    return fn


register("l18_linear_regression")(_regression_query("linear_regression"))
register("l18_ridge_regression")(_regression_query("linear_regression", regParam=0.1, elasticNetParam=0.0))
register("l18_lasso_regression")(_regression_query("linear_regression", regParam=0.1, elasticNetParam=1.0))
register("l18_elastic_net")(_regression_query("linear_regression", regParam=0.1, elasticNetParam=0.5))


@register("l18_least_squares", """
with t as (select l_quantity::double as f1, l_discount::double as f2, l_tax::double as f3, l_extendedprice::double as y from lineitem),
c as (select covar_pop(f1, f1) as a, covar_pop(f1, f2) as b, covar_pop(f1, f3) as c, covar_pop(f2, f2) as d, covar_pop(f2, f3) as e, covar_pop(f3, f3) as f,
        covar_pop(f1, y) as p, covar_pop(f2, y) as q, covar_pop(f3, y) as r, avg(f1) as m1, avg(f2) as m2, avg(f3) as m3, avg(y) as my from t),
k as (select *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) as det from c),
s as (select (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det as x1,
             (a * (q * f - e * r) - p * (b * f - e * c) + c * (b * r - q * c)) / det as x2,
             (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - d * c)) / det as x3, m1, m2, m3, my from k)
select 'intercept' as feature, round(my - x1 * m1 - x2 * m2 - x3 * m3, 4) as coefficient from s
union all select 'l_quantity', round(x1, 4) from s union all select 'l_discount', round(x2, 4) from s union all select 'l_tax', round(x3, 4) from s
""")
def l18_least_squares(spark, sf):
    told = learn.linear_coefficients(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return finish(told.withColumn("coefficient", F.round("coefficient", 4)))


register("l20_tree_regressor")(_regression_query("tree_regressor", maxDepth=5))
register("l20_forest_regressor")(_regression_query("forest_regressor", numTrees=10))


def _folds_sql() -> str:
    """Accuracy of naive Bayes in each of five stratified folds and their mean (fold -1)."""
    parts = ",\n".join(f"""tr{f} as (select vec_id, label, x from folded where fold <> {f}), te{f} as (select vec_id, label, x from folded where fold = {f}),
o{f} as (with {_bayes_sql(f"tr{f}", f"te{f}")} select {f} as fold, avg((label = prediction)::int::double) as score from p)""" for f in range(5))
    return f"""with e as (select vec_id, label, embedding::double[] as x, row_number() over (order by label, vec_id) - 1 as place,
        row_number() over (partition by label order by vec_id) - 1 as pos from embeddings),
c as (select label, i as fold, floor((st + n - 1 - i) / 5.0) - floor((st - 1 - i) / 5.0) as n
      from (select label, count(*) as n, min(place) as st from e group by label), range(0, 5) t(i)),
r as (select label, fold, sum(n) over (partition by label order by fold) as upto, n from c),
folded as (select e.*, r.fold from e join r on r.label = e.label and e.pos < r.upto and e.pos >= r.upto - r.n),
{parts},
s as ({" union all ".join(f"select * from o{f}" for f in range(5))})
select fold, score from s union all select -1, avg(score) from s"""


@register("l2_l3_cross_validation", _folds_sql())
def l2_l3_cross_validation(spark, sf):
    e = table(spark, sf, "embeddings")
    oof = learn.cross_val_predict(e, "embedding", "label", "vec_id", "naive_bayes", 5)
    return finish(learn.fold_scores(oof))


@register("l2_stratified_fold_sizes", """
with c as (select label, count(*) as n from embeddings group by 1),
s as (select label, n, coalesce(sum(n) over (order by label rows between unbounded preceding and 1 preceding), 0) as st
      from c),
f as (select label, i as fold, (floor((st + n - 1 - i) / 5.0) - floor((st - 1 - i) / 5.0))::bigint as n
      from s, range(0, 5) t(i))
select label, fold::int as fold, n from f where n > 0
""")
def l2_stratified_fold_sizes(spark, sf):
    f = learn.stratified_folds(table(spark, sf, "embeddings"), "label", "vec_id", 5)
    return finish(f.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")))


@register("l2_contiguous_folds", """
with p as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as pos, count(*) over () as n from orders),
s as (select o_orderkey, pos, n // 5 as small, n % 5 as more from p)
select o_orderkey, (case when pos < more * (small + 1) then pos // (small + 1) else more + (pos - more * (small + 1)) // small end)::int as fold from s
""")
def l2_contiguous_folds(spark, sf):
    return finish(learn.contiguous_folds(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5))


@register("l7_best_model")
def l7_best_model(spark, sf):
    return finish(learn.best_model(l6_l7_model_table(spark, sf)))


@register("l6_l7_model_table")
def l6_l7_model_table(spark, sf):
    tr, te = _split(spark, sf)
    res = {"knn3": learn.knn_classify(tr, te, "vec_id", "embedding", "label", 3),
           "naive_bayes": learn.fit_predict(tr, te, "embedding", "label", "vec_id", "naive_bayes"),
           "logistic": learn.fit_predict(tr, te, "embedding", "label", "vec_id", "logistic", maxIter=50)}
    return finish(learn.model_table({k: v.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
                                     for k, v in res.items()}))
