"""Registered clustering queries.

Exact metrics are checked against DuckDB over the whole ``embeddings`` table
(its ``label`` column is the partition being evaluated).  Randomised fits
(k-means, PCA) and Ward have no SQL oracle; DBSCAN, k-NN and the linkages are
also tested against brute force in ``tests/test_cluster.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import cluster, linkage, metrics
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

EMB = "(select vec_id, label, embedding::double[] as x from embeddings)"
LI3 = ["l_quantity", "l_discount", "l_tax"]


def emb(spark, sf):
    return table(spark, sf, "embeddings")


@register("k8_cluster_sizes", """
select label as cluster, count(*)::bigint as "count", count(*) * 100.0 / (select count(*) from embeddings) as pct
from embeddings group by 1
""")
def k8_cluster_sizes(spark, sf):
    return finish(cluster.cluster_sizes(emb(spark, sf), "label"))


@register("k9_cluster_profile", """
with long as (select l_returnflag, 'l_quantity' as feature, l_quantity as v from lineitem
              union all select l_returnflag, 'l_discount', l_discount from lineitem
              union all select l_returnflag, 'l_tax', l_tax from lineitem),
g as (select feature, avg(v) as global_mean from long group by 1),
c as (select l_returnflag as cluster, feature, avg(v) as mean from long group by all)
select c.cluster, c.feature, c.mean, g.global_mean, c.mean - g.global_mean as delta, abs(c.mean - g.global_mean) as abs_delta
from c join g using (feature)
""")
def k9_cluster_profile(spark, sf):
    return finish(cluster.cluster_profile(table(spark, sf, "lineitem"), LI3, "l_returnflag"))


@register("k10_top_features", """
with long as (select l_returnflag, 'l_quantity' as feature, l_quantity as v from lineitem
              union all select l_returnflag, 'l_discount', l_discount from lineitem
              union all select l_returnflag, 'l_tax', l_tax from lineitem),
g as (select feature, avg(v) as global_mean from long group by 1),
c as (select l_returnflag as cluster, feature, avg(v) as mean from long group by all),
p as (select c.cluster, c.feature, c.mean, g.global_mean, c.mean - g.global_mean as delta,
             abs(c.mean - g.global_mean) as abs_delta from c join g using (feature)),
u as (select *, 'above' as list from p where delta > 0 union all select *, 'below' from p where delta < 0),
r as (select *, row_number() over (partition by cluster, list order by abs_delta desc, feature) as rank from u)
select cluster, feature, mean, global_mean, delta, abs_delta, list, rank from r where rank <= 2
""")
def k10_top_features(spark, sf):
    p = cluster.cluster_profile(table(spark, sf, "lineitem"), LI3, "l_returnflag")
    t = cluster.top_features(p, n=2)
    return finish(t.select("cluster", "feature", "mean", "global_mean", "delta", "abs_delta", "list", "rank"))


@register("k26_calinski_harabasz", f"""
with e as {EMB},
u as (select vec_id, label, unnest(x) as v, generate_subscripts(x, 1) as pos from e),
c as (select label, pos, avg(v) as m, count(*) as n from u group by all),
g as (select pos, avg(v) as gm from u group by pos),
b as (select sum(n * (m - gm) * (m - gm)) as b from c join g using (pos)),
w as (select sum((v - m) * (v - m)) as w from u join c using (label, pos)),
k as (select count(distinct label) as k, count(*) as n from e)
select (b / (k - 1)) / (w / (n - k)) as calinski_harabasz from b, w, k
""")
def k26_calinski_harabasz(spark, sf):
    return finish(metrics.calinski_harabasz(emb(spark, sf), "embedding", "label"))


@register("k27_davies_bouldin", f"""
with e as {EMB},
u as (select vec_id, label, unnest(x) as v, generate_subscripts(x, 1) as pos from e),
c as (select label, pos, avg(v) as m from u group by all),
cv as (select label, list(m order by pos) as cen from c group by label),
s as (select e.label, avg(list_distance(e.x, cv.cen)) as s from e join cv using (label) group by 1),
pairs as (select a.label as i, b.label as j, (sa.s + sb.s) / list_distance(a.cen, b.cen) as r
          from cv a join cv b on a.label <> b.label join s sa on sa.label = a.label join s sb on sb.label = b.label),
d as (select i, max(r) as d from pairs group by i)
select avg(d) as davies_bouldin from d
""")
def k27_davies_bouldin(spark, sf):
    return finish(metrics.davies_bouldin(emb(spark, sf), "embedding", "label"))


def _silhouette_sql(points: str, gap: str = "list_distance(a.x, b.x)") -> str:
    """CTEs ending in ab (vec_id, a, b) over ``points`` (vec_id, label, x)."""
    return f"""p as ({points}),
cnt as (select label, count(*) as n from p group by 1),
d as (select a.vec_id, a.label as own, b.label as other, sum({gap}) as sd from p a join p b on true group by all),
m as (select d.vec_id, d.own, d.other, sd / (case when d.own = d.other then cnt.n - 1 else cnt.n end) as md
      from d join cnt on cnt.label = d.other),
ab as (select vec_id, max(md) filter (where own = other) as a, min(md) filter (where own <> other) as b from m group by 1)"""


SCORE = "case when greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end"


@register("k25_silhouette_squared", f"""
with e as {EMB}, {_silhouette_sql("select * from e", "list_distance(a.x, b.x) * list_distance(a.x, b.x)")}
select avg({SCORE}) as silhouette_squared, count(*)::bigint as n from ab
""")
def k25_silhouette_squared(spark, sf):
    return finish(metrics.silhouette_squared(emb(spark, sf), "embedding", "label"))


@register("k25_silhouette", f"""
with e as {EMB},
cnt as (select label, count(*) as n from e group by 1),
d as (select a.vec_id, a.label as own, b.label as other, sum(list_distance(a.x, b.x)) as sd
      from e a join e b on true group by all),
m as (select d.vec_id, d.own, d.other, sd / (case when d.own = d.other then cnt.n - 1 else cnt.n end) as md
      from d join cnt on cnt.label = d.other),
ab as (select vec_id, max(md) filter (where own = other) as a, min(md) filter (where own <> other) as b from m group by 1)
select avg(case when greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end) as silhouette, count(*)::bigint as n from ab
""")
def k25_silhouette(spark, sf):
    return finish(metrics.silhouette(emb(spark, sf), "embedding", "label", "vec_id"))


@register("k30_representatives", f"""
with e as {EMB},
u as (select vec_id, label, unnest(x) as v, generate_subscripts(x, 1) as pos from e),
c as (select label, pos, avg(v) as m from u group by all),
cv as (select label, list(m order by pos) as cen from c group by label),
d as (select e.vec_id as row_id, e.label as cluster, list_distance(e.x, cv.cen) as distance_to_centroid
      from e join cv using (label)),
r as (select *, row_number() over (partition by cluster order by distance_to_centroid, row_id) as example_rank from d)
select * from r where example_rank <= 3
""")
def k30_representatives(spark, sf):
    return finish(cluster.representatives(emb(spark, sf), "embedding", "vec_id", "label", 3))


@register("k29_characterize_clusters", """
with long as (select l_returnflag, 'l_quantity' as feature, l_quantity as v from lineitem
              union all select l_returnflag, 'l_discount', l_discount from lineitem
              union all select l_returnflag, 'l_tax', l_tax from lineitem),
g as (select feature, avg(v) as gm from long group by 1),
c as (select l_returnflag as cluster, feature, avg(v) as mean from long group by all),
p as (select cluster, feature, mean, mean - gm as delta,
        row_number() over (partition by cluster order by abs(mean - gm) desc, feature) as rank from c join g using (feature)),
s as (select l_returnflag as cluster, count(*) as n from lineitem group by 1)
select p.cluster, s.n::bigint as n_samples, s.n * 100.0 / (select count(*) from lineitem) as percentage, rank::bigint as rank,
  feature, mean, delta from p join s using (cluster) where rank <= 2
""")
def k29_characterize_clusters(spark, sf):
    out = cluster.characterize_clusters(table(spark, sf, "lineitem"), LI3, "l_returnflag", n=2)
    return finish(out)


@register("k32_k33_noise_summary", """
with l as (select case when label in (0, 1) then -1 else label end as cluster from embeddings),
c as (select cluster, count(*) as n from l group by 1)
select count(*) filter (where cluster <> -1)::bigint as n_clusters,
  coalesce(sum(n) filter (where cluster = -1), 0)::bigint as n_noise,
  coalesce(sum(n) filter (where cluster = -1), 0) * 100.0 / sum(n) as noise_pct,
  max(n) filter (where cluster <> -1) * 100.0 / sum(n) filter (where cluster <> -1) as largest_cluster_pct from c
""")
def k32_k33_noise_summary(spark, sf):
    e = emb(spark, sf).select(F.when(F.col("label").isin(0, 1), -1).otherwise(F.col("label")).alias("cluster"))
    return finish(cluster.noise_summary(e))


@register("k19_k_distance", f"""
with e as {EMB},
d as (select a.vec_id as rid, list_distance(a.x, b.x) as dist,
        row_number() over (partition by a.vec_id order by list_distance(a.x, b.x), b.vec_id) as r
      from e a join e b on true)
select rid, dist as k_distance from d where r = 5
""")
def k19_k_distance(spark, sf):
    return finish(cluster.k_distance(emb(spark, sf), "vec_id", "embedding", k=5))


@register("k19_k_distance_curve", f"""
with e as {EMB},
d as (select a.vec_id as rid, list_distance(a.x, b.x) as dist,
        row_number() over (partition by a.vec_id order by list_distance(a.x, b.x), b.vec_id) as r
      from e a join e b on true),
k as (select rid, dist as k_distance from d where r = 5)
select row_number() over (order by k_distance, rid) - 1 as position, rid, k_distance,
  (select quantile_cont(k_distance, 0.9) from k) as q90, (select quantile_cont(k_distance, 0.95) from k) as q95 from k
""")
def k19_k_distance_curve(spark, sf):
    return finish(cluster.k_distance_curve(emb(spark, sf), "vec_id", "embedding", k=5))


@register("k28_partition_metrics", f"""
with e as {EMB}, {_silhouette_sql("select * from e")},
u as (select vec_id, label, unnest(x) as v, generate_subscripts(x, 1) as pos from e),
c as (select label, pos, avg(v) as m, count(*) as n from u group by all),
g as (select pos, avg(v) as gm from u group by pos),
bw as (select sum(n * (m - gm) * (m - gm)) as b from c join g using (pos)),
w as (select sum((v - m) * (v - m)) as w from u join c using (label, pos)),
k as (select count(distinct label) as k, count(*) as n from e),
cv as (select label, list(m order by pos) as cen from c group by label),
s as (select e.label, avg(list_distance(e.x, cv.cen)) as s from e join cv using (label) group by 1),
r as (select x.label, max((sx.s + sy.s) / list_distance(x.cen, y.cen)) as r
      from cv x join cv y on x.label <> y.label join s sx on sx.label = x.label join s sy on sy.label = y.label group by 1)
select 'label' as partition, k as n_clusters, (select avg({SCORE}) from ab) as silhouette,
  (b / (k - 1)) / (w / (n - k)) as calinski_harabasz, (select avg(r) from r) as davies_bouldin from bw, w, k
""")
def k28_partition_metrics(spark, sf):
    return finish(metrics.partition_metrics(emb(spark, sf), "embedding", "label", "vec_id", name="label"))


@register("k1_k3_kmeans_labels")
def k1_k3_kmeans_labels(spark, sf):
    model, lab = cluster.kmeans(emb(spark, sf), "embedding", 5, seed=42, n_init=3, keep=["vec_id"])
    return finish(lab.select("vec_id", F.col("cluster").cast("long").alias("cluster")))


@register("k4_k7_kmeans_grid")
def k4_k7_kmeans_grid(spark, sf):
    g = cluster.kmeans_grid(emb(spark, sf), "embedding", "vec_id", [2, 3, 4, 5], n_init=1)
    return finish(g)


def _dbscan_ctes(eps: float, ms: int, metric: str = "euclidean", no: str = "") -> str:
    """CTEs that end in lab{no} (rid, cluster, is_core), after ``e``."""
    dist = ("list_distance(a.x, b.x)" if metric == "euclidean"
            else "list_sum(list_transform(range(1, len(a.x) + 1), lambda k: abs(a.x[k] - b.x[k])))")
    return f"""nb{no} as (select a.vec_id as i, b.vec_id as j from e a, e b where {dist} <= {eps}),
cnt{no} as (select i, count(*) as n from nb{no} group by i),
core{no} as (select i from cnt{no} where n >= {ms}),
ce{no} as (select nb.i, nb.j from nb{no} nb join core{no} c1 on nb.i = c1.i join core{no} c2 on nb.j = c2.i),
reach{no}(i, l) as (select i, i from core{no} union select ce.j, r.l from reach{no} r join ce{no} ce on ce.i = r.i),
comp{no} as (select i, min(l) as comp from reach{no} group by i),
num{no} as (select comp, dense_rank() over (order by comp) - 1 as cluster from (select distinct comp from comp{no})),
core_lab{no} as (select c.i, n.cluster from comp{no} c join num{no} n using (comp)),
border{no} as (select nb.i, min(cl.cluster) as cluster from nb{no} nb join core_lab{no} cl on nb.j = cl.i
           where nb.i not in (select i from core{no}) group by nb.i),
lab{no} as (select e.vec_id as rid, coalesce(cl.cluster, b.cluster, -1)::bigint as cluster, cl.i is not null as is_core
from e left join core_lab{no} cl on cl.i = e.vec_id left join border{no} b on b.i = e.vec_id)"""


def _dbscan_sql(eps: float, ms: int, metric: str = "euclidean") -> str:
    return f"with recursive e as {EMB},\n{_dbscan_ctes(eps, ms, metric)}\nselect * from lab"


def _score_sql(points: str, no: str) -> str:
    """A scalar subquery: silhouette of ``points`` (vec_id, label, x), null unless every one of
    two labels or more has two members."""
    return f"""(with {_silhouette_sql(points)}
select case when (select count(*) from cnt) >= 2 and (select min(n) from cnt) >= 2 then (select avg({SCORE}) from ab) end)"""


def _grid_sql(pairs: list[tuple[float, int]]) -> str:
    """CTEs ending in grid, one row for each (eps, min_samples)."""
    ctes, rows = [], []
    for k, (eps, ms) in enumerate(pairs):
        no = f"_{k}"
        labelled = f"select l.rid as vec_id, l.cluster as label, e.x from lab{no} l join e on e.vec_id = l.rid"
        ctes.append(_dbscan_ctes(eps, ms, "euclidean", no))
        rows.append(f"""select {eps}::double as eps, {ms}::bigint as min_samples, count(distinct cluster) filter (cluster <> -1)::bigint as n_clusters,
  count(*) filter (cluster = -1)::bigint as n_noise, count(*) filter (cluster = -1) * 100.0::double / count(*) as noise_pct,
  count(*) filter (is_core)::bigint as core_points,
  (select max(n) from (select count(*) as n from lab{no} where cluster <> -1 group by cluster)) * 100.0::double
    / nullif(count(*) filter (cluster <> -1), 0) as largest_cluster_pct,
  {_score_sql(labelled, no)} as silhouette_all, {_score_sql(labelled + " where l.cluster <> -1", no)} as silhouette_non_noise
from lab{no}""")
    return f"with recursive e as {EMB},\n" + ",\n".join(ctes) + ",\ngrid as (" + "\nunion all\n".join(rows) + ")"


@register("k13_dbscan_labels", _dbscan_sql(1.2, 5))
def k13_dbscan_labels(spark, sf):
    return finish(cluster.dbscan(emb(spark, sf), "vec_id", "embedding", eps=1.2, min_samples=5))


@register("k14_dbscan_manhattan", _dbscan_sql(7.7, 5, "manhattan"))
def k14_dbscan_manhattan(spark, sf):
    return finish(cluster.dbscan(emb(spark, sf), "vec_id", "embedding", eps=7.7, min_samples=5, metric="manhattan"))


@register("k15_k17_dbscan_grid", _grid_sql([(e, m) for e in (1.15, 1.2) for m in (3, 5)]) + "\nselect * from grid")
def k15_k17_dbscan_grid(spark, sf):
    g = cluster.dbscan_grid(emb(spark, sf), "vec_id", "embedding", [1.15, 1.2], [3, 5])
    return finish(g)


@register("k20_k23_ward")
def k20_k23_ward(spark, sf):
    return finish(cluster.ward(emb(spark, sf), "vec_id", "embedding", 6)[0])


@register("k23_ward_merges")
def k23_ward_merges(spark, sf):
    return finish(cluster.ward(emb(spark, sf), "vec_id", "embedding", 6)[1])


@register("k22_ward_cut")
def k22_ward_cut(spark, sf):
    return finish(linkage.suggest_distance_cut(cluster.ward(emb(spark, sf), "vec_id", "embedding", 6)[1]))


#: Prim over the distance matrix: tree(step, a, b, height), steps by height.
PRIM = f"""e as (select vec_id, x, row_number() over (order by vec_id) as i from {EMB}),
m as materialized (select a.i, list(list_distance(a.x, b.x) order by b.i) as r from e a join e b on true group by a.i),
prim(u, v, h, near, source) as (
  select null::bigint, 1::bigint, null::double, list_transform(r, lambda y, j: case when j = 1 then null else y end),
    list_transform(r, lambda y: 1::bigint) from m where i = 1
  union all
  select source[nx], nx, near[nx], list_transform(near, lambda y, j: case when y is null or j = nx then null else least(y, r[j]) end),
    list_transform(source, lambda s, j: case when r[j] < near[j] then nx else s end)
  from (select *, list_position(near, list_min(near))::bigint as nx from prim where list_min(near) is not null) p join m on m.i = nx),
tree as (select row_number() over (order by h, least(x.vec_id, y.vec_id), greatest(x.vec_id, y.vec_id)) - 1 as step,
    least(x.vec_id, y.vec_id) as a, greatest(x.vec_id, y.vec_id) as b, h as height
  from prim join e x on x.i = u join e y on y.i = v where u is not null)"""


@register("k21_single_linkage", f"""
with recursive {PRIM},
kept as (select a, b from tree where step < (select count(*) from e) - 5 union all select b, a from tree where step < (select count(*) from e) - 5),
reach(i, l) as (select vec_id, vec_id from e union select k.b, r.l from reach r join kept k on k.a = r.i),
comp as (select i, min(l) as l from reach group by i)
select i as vec_id, dense_rank() over (order by l) - 1 as cluster from comp
""")
def k21_single_linkage(spark, sf):
    return finish(cluster.agglomerative(emb(spark, sf), "vec_id", "embedding", 5, "single")[0])


@register("k23_single_merges", f"""
with recursive {PRIM},
sides_ as (select step, a, b from tree union all select step, b, a from tree),
under(step, side, i) as (select step, a, a from tree union all select step, b, b from tree
  union select u.step, u.side, t.b from under u join sides_ t on t.a = u.i and t.step < u.step),
sides as (select step, side, min(i) as least, count(*) as n from under group by all)
select t.step, min(s.least) as "left", max(s.least) as "right", any_value(t.height) as height, sum(s.n)::bigint as size
from tree t join sides s using (step) group by t.step
""")
def k23_single_merges(spark, sf):
    return finish(linkage.merge_table(linkage.single_linkage(emb(spark, sf), "vec_id", "embedding")))


@register("k22_single_cut", f"""
with recursive {PRIM},
j as (select step, height, lead(height) over (order by step) as next from tree)
select (height + next) / 2 as threshold, step as "index", next - height as jump, (select count(*) from e) - step - 1 as n_clusters
from j where next is not null order by next - height desc, step limit 1
""")
def k22_single_cut(spark, sf):
    return finish(linkage.suggest_distance_cut(linkage.single_linkage(emb(spark, sf), "vec_id", "embedding")))


@register("k31_pca")
def k31_pca(spark, sf):
    proj, ratio = cluster.pca(emb(spark, sf), "embedding", 2, keep=["vec_id", "label"])
    return finish(proj)


_DELTAS = """with l as (select *, case when l_returnflag = 'R' then 1.0 else 0.0 end as is_returned, 1.0 as constant from lineitem),
long as (select l_linestatus, 'l_quantity' as feature, l_quantity::double as v from l union all select l_linestatus, 'l_discount', l_discount::double from l
         union all select l_linestatus, 'is_returned', is_returned::double from l union all select l_linestatus, 'constant', 1.0 from l),
g as (select feature, avg(v) as global_mean from long group by 1),
p as (select c.cluster, c.feature, c.mean, g.global_mean, c.mean - g.global_mean as delta, abs(c.mean - g.global_mean) as abs_delta
      from (select l_linestatus as cluster, feature, avg(v) as mean from long group by all) c join g using (feature)),
t as (select *, case sign(delta) when 1 then 1 when 0 then 2 else 3 end as place from p),
r as (select * exclude (place), case feature
  when 'is_returned' then ['maior prevalência de is_returned', 'prevalência semelhante de is_returned', 'menor prevalência de is_returned'][place]
  when 'l_quantity' then ['l_quantity acima da média', 'l_quantity próximo da média', 'l_quantity abaixo da média'][place]
  else ['tendência acima da média em ' || feature, feature || ' semelhante à média', 'tendência abaixo da média em ' || feature][place] end as reading from t)"""


def _delta_profile(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("is_returned", (F.col("l_returnflag") == "R").cast("double")).withColumn("constant", F.lit(1.0))
    return cluster.cluster_profile(li, ["l_quantity", "l_discount", "is_returned", "constant"], "l_linestatus")


@register("k11_describe_deltas", _DELTAS + " select * from r")
def k11_describe_deltas(spark, sf):
    return finish(cluster.describe_deltas(_delta_profile(spark, sf), {"l_quantity": "continuous", "is_returned": "binary"}))


@register("k10_narrative_features", _DELTAS + """,
n as (select *, row_number() over (partition by cluster order by abs_delta desc, feature) as rank from r where feature in ('l_quantity', 'is_returned'))
select * from n where rank <= 4
""")
def k10_narrative_features(spark, sf):
    return finish(cluster.narrative_features(_delta_profile(spark, sf), {"l_quantity": "continuous", "is_returned": "binary"}))


@register("k12_centroid_distances")
def k12_centroid_distances(spark, sf):
    rows = []
    for k in (2, 3, 4):
        model, _ = cluster.kmeans(emb(spark, sf), "embedding", k, n_init=1, keep=["vec_id"])
        mx, mean, mn = cluster.centroid_distances(model.clusterCenters())
        rows.append((k, cluster.kmeans_inertia(model), mx, mean, mn))
    return finish(spark.createDataFrame(rows, "k long, inertia double, max_centroid_distance double, "
                                              "mean_centroid_distance double, min_centroid_distance double"))


_CANDIDATES = "n_clusters >= 2 and noise_pct <= 60 and silhouette_non_noise is not null"


@register("k16_k17_best_dbscan", _grid_sql([(e, m) for e in (1.12, 1.15) for m in (3, 4)]) + f"""
, good as (select *, row_number() over (order by silhouette_non_noise desc, noise_pct, n_clusters desc, core_points desc, eps, min_samples) as r
           from grid where {_CANDIDATES}),
any_ as (select *, row_number() over (order by n_clusters desc, noise_pct, core_points desc, eps, min_samples) as r from grid)
select * exclude (r), 'best' as choice from good where r = 1
union all select * exclude (r), 'best' from any_ where r = 1 and not exists (select 1 from good)
union all select * exclude (r), 'practical' from good where r <= 5
""")
def k16_k17_best_dbscan(spark, sf):
    g = cluster.dbscan_grid(emb(spark, sf), "vec_id", "embedding", [1.12, 1.15], [3, 4])
    best = cluster.choose_best_configuration(g).withColumn("choice", F.lit("best"))
    top = cluster.practical_configurations(g, 5).withColumn("choice", F.lit("practical"))
    return finish(best.unionByName(top))


@register("k21_linkages")
def k21_linkages(spark, sf):
    out = None
    for link in ("single", "complete", "average"):
        lab, _ = cluster.agglomerative(emb(spark, sf), "vec_id", "embedding", 5, link)
        s = cluster.cluster_sizes(lab, "cluster").withColumn("linkage", F.lit(link))
        out = s if out is None else out.unionByName(s)
    return finish(out)


@register("k24_tree_silhouette_range")
def k24_tree_silhouette_range(spark, sf):
    return finish(cluster.tree_silhouette_range(emb(spark, sf), "vec_id", "embedding", 2, 6))


@register("j3_attach_labels", """
select l.vec_id, l.label, e.label as original_label from embeddings e join embeddings l using (vec_id)
""")
def j3_attach_labels(spark, sf):
    e = emb(spark, sf)
    labels = e.select("vec_id", "label")
    return finish(e.select("vec_id", F.col("label").alias("original_label")).join(labels, "vec_id"))
