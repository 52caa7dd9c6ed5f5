"""Registered association queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import assoc
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table


@register("c19_influence_returnflag", """
with t as (select l_returnflag as category, case when l_linestatus = 'O' then 1 else 0 end as y from lineitem),
g as (select avg(y) as r from t)
select 'l_returnflag' as variable, category, count(*)::bigint as n,
       avg(y) as rate, avg(y) * 100 as rate_pct,
       (avg(y) - (select r from g)) * 100 as delta_pp,
       avg(y) / (select r from g) as relative_risk
from t group by category
""")
def c19_influence_returnflag(spark, sf):
    li = table(spark, sf, "lineitem")
    return finish(assoc.influence(li, ["l_returnflag"], "l_linestatus"))


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _pearson_sql(tbl, cols):
    parts = [f"select '{a}' as var1, '{b}' as var2, corr({a}, {b}) as correlation from {tbl}" for a, b in _pairs(cols)]
    parts += [f"select '{b}', '{a}', corr({a}, {b}) from {tbl}" for a, b in _pairs(cols)]
    parts += [f"select '{c}', '{c}', 1.0" for c in cols]
    return "\nunion all\n".join(parts)


@register("c1_pearson_matrix", _pearson_sql("lineitem", LI_NUM))
def c1_pearson_matrix(spark, sf):
    return finish(assoc.pearson_long(table(spark, sf, "lineitem"), LI_NUM))


def _spearman_sql(tbl, cols):
    ranks = ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as r_{c}" for c in cols)
    parts = [f"select '{a}' as var1, '{b}' as var2, corr(r_{a}, r_{b}) as correlation from r" for a, b in _pairs(cols)]
    parts += [f"select '{b}', '{a}', corr(r_{a}, r_{b}) from r" for a, b in _pairs(cols)]
    parts += [f"select '{c}', '{c}', 1.0" for c in cols]
    return f"with r as (select {ranks} from {tbl})\n" + "\nunion all\n".join(parts)


@register("c2_spearman_matrix", _spearman_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def c2_spearman_matrix(spark, sf):
    return finish(assoc.spearman_long(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@register("c2_spearman_pairwise_nulls", """
with t as (select d.n_chars::double as n_chars, l.quality::double as quality, l.toxic::double as toxic
           from documents d left join labels l on d.doc_id = l.doc_id),
p1 as (select n_chars, quality from t where n_chars is not null and quality is not null),
r1 as (select rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as a,
              rank() over (order by quality) + (count(*) over (partition by quality) - 1) / 2.0 as b from p1),
p2 as (select n_chars, toxic from t where n_chars is not null and toxic is not null),
r2 as (select rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as a,
              rank() over (order by toxic) + (count(*) over (partition by toxic) - 1) / 2.0 as b from p2),
p3 as (select quality, toxic from t where quality is not null and toxic is not null),
r3 as (select rank() over (order by quality) + (count(*) over (partition by quality) - 1) / 2.0 as a,
              rank() over (order by toxic) + (count(*) over (partition by toxic) - 1) / 2.0 as b from p3)
select 'n_chars' as var1, 'quality' as var2, corr(a, b) as correlation from r1
union all select 'quality', 'n_chars', corr(a, b) from r1
union all select 'n_chars', 'toxic', corr(a, b) from r2
union all select 'toxic', 'n_chars', corr(a, b) from r2
union all select 'quality', 'toxic', corr(a, b) from r3
union all select 'toxic', 'quality', corr(a, b) from r3
union all select 'n_chars', 'n_chars', 1.0 union all select 'quality', 'quality', 1.0 union all select 'toxic', 'toxic', 1.0
""")
def c2_spearman_pairwise_nulls(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lb = table(spark, sf, "labels")
    t = d.join(lb, "doc_id", "left").select("n_chars", "quality", "toxic")
    return finish(assoc.spearman_long(t, ["n_chars", "quality", "toxic"]))


@register("c3_c6_top_correlation_pairs", f"""
with m as ({_pearson_sql('lineitem', LI_NUM)}),
p as (select var1, var2, correlation, abs(correlation) as abs_correlation,
        case when correlation > 0 then 'positiva' when correlation < 0 then 'negativa' else 'nula' end as sign,
        case when correlation is null or isnan(correlation) then 'indeterminada' when abs(correlation) < 0.3 then 'muito fraca'
             when abs(correlation) < 0.5 then 'fraca' when abs(correlation) < 0.7 then 'moderada'
             when abs(correlation) < 0.9 then 'forte' else 'muito forte' end as strength
      from m where list_position({LI_NUM!r}, var1) < list_position({LI_NUM!r}, var2))
select *, abs_correlation >= 0.8 as redundant from p order by abs_correlation desc nulls last, var1, var2 limit 5
""".replace("[", "[").replace("'l_", "'l_"))
def c3_c6_top_correlation_pairs(spark, sf):
    m = assoc.pearson_long(table(spark, sf, "lineitem"), LI_NUM)
    p = assoc.correlation_pairs(m, LI_NUM, top_k=5)
    return finish(p.withColumn("redundant", F.col("abs_correlation") >= 0.8))


def _cramers_sql(src, x, y, mode="zero"):
    if mode == "zero":
        v = """case when r <= 1 or k <= 1 then 0.0 when n <= 1 then 0.0
  when least(k - (k-1)*(k-1)/(n-1), r - (r-1)*(r-1)/(n-1)) - 1 <= 0 then 0.0
  else sqrt(greatest(0.0, chi2 / n - (k-1)*(r-1)/(n-1)) / (least(k - (k-1)*(k-1)/(n-1), r - (r-1)*(r-1)/(n-1)) - 1)) end"""
    else:
        v = """case when r <= 1 or k <= 1 then null
  when least(r - (r-1)*(r-1)/greatest(n-1, 1), k - (k-1)*(k-1)/greatest(n-1, 1)) - 1 <= 0 then null
  else sqrt(greatest(0.0, chi2 / n - (k-1)*(r-1)/greatest(n-1, 1))
       / (least(r - (r-1)*(r-1)/greatest(n-1, 1), k - (k-1)*(k-1)/greatest(n-1, 1)) - 1)) end"""
    return f"""(with base as ({src}),
cells as (select x, y, count(*)::double as o from base group by x, y),
rs as (select x, sum(o) as ri from cells group by x), cs as (select y, sum(o) as cj from cells group by y),
a as (select sum(o) as n, count(distinct cells.x)::double as r, count(distinct cells.y)::double as k,
             sum(o * o / (ri * cj)) as s from cells join rs using (x) join cs using (y)),
b as (select n, r, k, n * (s - 1) as chi2 from a)
select '{x}' as var1, '{y}' as var2, {v} as cramers_v from b)"""


CAT = [("orders", "o_orderstatus", "o_orderpriority")]


@register("c7_cramers_v", _cramers_sql("select o_orderstatus as x, o_orderpriority as y from orders", "o_orderstatus", "o_orderpriority")
          .strip()[1:-1] + "")
def c7_cramers_v(spark, sf):
    o = table(spark, sf, "orders")
    return finish(assoc.cramers_v(o, "o_orderstatus", "o_orderpriority").select("var1", "var2", "cramers_v"))


EV_CAT = ["event_type", "user_bucket", "hour_bucket"]
EV_SRC = "select event_type, cast(user_id % 7 as varchar) as user_bucket, cast(hour(ts) // 6 as varchar) as hour_bucket from events"


def _c8_sql():
    parts = []
    for a, b in _pairs(EV_CAT):
        src = f"select {a} as x, {b} as y from ({EV_SRC}) where {a} is not null and {b} is not null"
        parts.append(f"select * from {_cramers_sql(src, a, b)}")
        parts.append(f"select '{b}', '{a}', cramers_v from {_cramers_sql(src, a, b)}")
    parts += [f"select '{c}', '{c}', 1.0" for c in EV_CAT]
    return "\nunion all\n".join(parts)


def _ev_cat(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_type", (F.col("user_id") % 7).cast("string").alias("user_bucket"),
                    F.floor(F.hour("ts") / 6).cast("string").alias("hour_bucket"))


@register("c8_cramers_v_matrix", _c8_sql())
def c8_cramers_v_matrix(spark, sf):
    return finish(assoc.cramers_v_long(_ev_cat(spark, sf), EV_CAT))


@register("c10_association_ranking", f"""
with t as (select o_orderpriority, o_orderstatus, case when o_totalprice > 150000 then 'Yes' else 'No' end as big from orders),
u as (select * from {_cramers_sql("select o_orderpriority as x, case when big = 'No' then '0' else '1' end as y from t", "o_orderpriority", "big", "nan")}
      union all select * from {_cramers_sql("select o_orderstatus as x, case when big = 'No' then '0' else '1' end as y from t", "o_orderstatus", "big", "nan")})
select var1 as variable, var2 as target, cramers_v,
  case when cramers_v is null or isnan(cramers_v) then 'indeterminada' when cramers_v < 0.3 then 'muito fraca'
       when cramers_v < 0.5 then 'fraca' when cramers_v < 0.7 then 'moderada' when cramers_v < 0.9 then 'forte'
       else 'muito forte' end as strength from u
""")
def c10_association_ranking(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus",
                                          F.when(F.col("o_totalprice") > 150000, "Yes").otherwise("No").alias("big"))
    return finish(assoc.association_ranking(o, ["o_orderpriority", "o_orderstatus"], "big"))


@register("c12_crosstab", """
select l_returnflag as x, l_linestatus as y, count(*)::bigint as n from lineitem group by all
""")
def c12_crosstab(spark, sf):
    return finish(assoc.crosstab_long(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"))


@register("c13_normalized_crosstab", """
with c as (select l_returnflag as x, l_linestatus as y, count(*) as n from lineitem group by all),
r as (select x, sum(n) as row_n from c group by x),
g as (select r.x, r.row_n, v.y from r, (values ('F'), ('O')) v(y))
select g.x, g.y, coalesce(c.n, 0) * 100.0 / g.row_n as pct from g left join c on g.x = c.x and g.y = c.y
""")
def c13_normalized_crosstab(spark, sf):
    return finish(assoc.normalized_crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"]))


@register("c14_crosstab_margins", """
select coalesce(l_returnflag, 'All') as x, coalesce(l_linestatus, 'All') as y, count(*)::bigint as n
from lineitem group by cube (l_returnflag, l_linestatus)
""")
def c14_crosstab_margins(spark, sf):
    return finish(assoc.crosstab_margins(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"))


@register("c15_numeric_target_ranking", """
with t as (select *, case when l_linestatus = 'O' then 1.0 else 0.0 end as y from lineitem),
u as (select 'l_quantity' as variable, corr(l_quantity, y) as pearson_r, avg(l_quantity) filter (where y = 0) as mean_0,
        avg(l_quantity) filter (where y = 1) as mean_1 from t
      union all select 'l_discount', corr(l_discount, y), avg(l_discount) filter (where y = 0),
        avg(l_discount) filter (where y = 1) from t
      union all select 'l_extendedprice', corr(l_extendedprice, y), avg(l_extendedprice) filter (where y = 0),
        avg(l_extendedprice) filter (where y = 1) from t)
select variable, 'l_linestatus' as target, pearson_r,
  case when pearson_r is null or isnan(pearson_r) then 'indeterminada' when abs(pearson_r) < 0.3 then 'muito fraca'
       when abs(pearson_r) < 0.5 then 'fraca' when abs(pearson_r) < 0.7 then 'moderada'
       when abs(pearson_r) < 0.9 then 'forte' else 'muito forte' end as strength,
  mean_0, mean_1, mean_1 - mean_0 as mean_diff from u
""")
def c15_numeric_target_ranking(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("const", F.lit(1.0))
    return finish(assoc.numeric_target_ranking(li, ["l_quantity", "l_discount", "l_extendedprice", "const"], "l_linestatus"))


@register("c16_numeric_by_target", """
with long as (select event_type, 'value' as variable, value from events
              union all select event_type, 'user_id', user_id::double from events)
select event_type as target_class, variable, count(value)::bigint as "count", avg(value) as mean,
  quantile_cont(value, 0.5) as median, stddev_samp(value) as std, min(value) as "min", max(value) as "max"
from long group by all
""")
def c16_numeric_by_target(spark, sf):
    return finish(assoc.numeric_by_target(table(spark, sf, "events"), ["value", "user_id"], "event_type"))


@register("c17_binary_mean_diff", """
with f as (select l_linestatus as cls, min(l_orderkey * 10 + l_linenumber) as first from lineitem group by 1),
o as (select cls, row_number() over (order by first, cls) as r from f),
a as (select (select cls from o where r = 1) as ca, (select cls from o where r = 2) as cb),
u as (select 'l_quantity' as variable, avg(l_quantity) filter (where l_linestatus = ca) as mean_a,
             avg(l_quantity) filter (where l_linestatus = cb) as mean_b from lineitem, a
      union all select 'l_tax', avg(l_tax) filter (where l_linestatus = ca), avg(l_tax) filter (where l_linestatus = cb)
      from lineitem, a)
select variable, (select ca from a) as class_a, (select cb from a) as class_b, mean_a, mean_b, mean_b - mean_a as diff from u
""")
def c17_binary_mean_diff(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return finish(assoc.binary_mean_diff(li, ["l_quantity", "l_tax"], "l_linestatus", "rid"))


@register("c18_multiclass_mean_deviation", """
select event_type as target_class, 'value' as variable, avg(value) as class_mean,
  (select avg(value) from events) as global_mean, avg(value) - (select avg(value) from events) as deviation
from events group by 1
""")
def c18_multiclass_mean_deviation(spark, sf):
    e = table(spark, sf, "events")
    return finish(assoc.target_mean_diff(e, ["value"], "event_type", "event_id"))


@register("c19_influence_multi", """
with t as (select o_orderpriority, o_orderstatus, case when o_totalprice > 150000 then 1 else 0 end as y from orders),
g as (select avg(y) as r from t),
long as (select 'o_orderpriority' as variable, o_orderpriority as category, y from t
         union all select 'o_orderstatus', o_orderstatus, y from t)
select variable, category, count(*)::bigint as n, avg(y) as rate, avg(y) * 100 as rate_pct,
  (avg(y) - (select r from g)) * 100 as delta_pp, avg(y) / (select r from g) as relative_risk from long group by all
""")
def c19_influence_multi(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus",
                                          F.when(F.col("o_totalprice") > 150000, "yes").otherwise("no").alias("big"))
    return finish(assoc.influence(o, ["o_orderpriority", "o_orderstatus"], "big"))


@register("c9_c11_categorical_associations", f"""
with m as ({_c8_sql()}),
p as (select var1, var2, cramers_v from m
      where list_position(['event_type', 'user_bucket', 'hour_bucket'], var1)
            < list_position(['event_type', 'user_bucket', 'hour_bucket'], var2))
select var1, var2, cramers_v,
  case when cramers_v is null or isnan(cramers_v) then 'indeterminada' when abs(cramers_v) < 0.3 then 'muito fraca'
       when abs(cramers_v) < 0.5 then 'fraca' when abs(cramers_v) < 0.7 then 'moderada'
       when abs(cramers_v) < 0.9 then 'forte' else 'muito forte' end as strength,
  cramers_v > 0.01 as above_threshold
from p
""")
def c9_c11_categorical_associations(spark, sf):
    a = assoc.categorical_associations(_ev_cat(spark, sf), EV_CAT)
    return finish(a.withColumn("above_threshold", F.col("cramers_v") > 0.01))
