"""Registered profiling queries (R*, G*, P15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import profile
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(tbl: str, cols: list[str]) -> str:
    parts = [f"""select '{c}' as variable, count({c})::bigint as "count", (count(*) - count({c}))::bigint as missing,
  round((count(*) - count({c})) * 100.0 / count(*), 4) as missing_pct, avg({c}) as mean,
  quantile_cont({c}, 0.5) as median, stddev_samp({c}) as std, min({c})::double as "min",
  quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3, max({c})::double as "max",
  quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as iqr, skewness({c}) as skew, kurtosis({c}) as kurtosis,
  count(distinct {c})::bigint as "distinct" from {tbl}""" for c in cols]
    return "\nunion all\n".join(parts)


@register("r2_describe_numeric", _describe_sql("lineitem", LI_NUM))
def r2_describe_numeric(spark, sf):
    return finish(profile.describe_numeric(table(spark, sf, "lineitem").select(*LI_NUM)))


@register("r2_describe_events_value", _describe_sql("events", ["value"]))
def r2_describe_events_value(spark, sf):
    return finish(profile.describe_numeric(table(spark, sf, "events").select("value")))


@register("r3_moment_summary", """
select 'c_acctbal' as variable, round(avg(c_acctbal), 4) as mean, round(quantile_cont(c_acctbal, 0.5), 4) as median,
  round(stddev_samp(c_acctbal), 4) as std, round(skewness(c_acctbal), 4) as skew,
  round(kurtosis(c_acctbal), 4) as kurtosis from customer
""")
def r3_moment_summary(spark, sf):
    return finish(profile.moment_summary(table(spark, sf, "customer").select("c_acctbal")))


@register("r5_describe_categorical", """
with long as (select 'o_orderstatus' as variable, o_orderstatus as value from orders
              union all select 'o_orderpriority', o_orderpriority from orders),
vc as (select variable, value, count(*) as freq from long where value is not null group by all)
select variable, sum(freq)::bigint as "count", count(*)::bigint as "distinct",
  arg_min(value, (-freq, value)) as top, max(freq)::bigint as top_freq,
  round(max(freq) * 100.0 / sum(freq), 4) as top_pct
from vc group by variable
""")
def r5_describe_categorical(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    return finish(profile.describe_categorical(o))


@register("r6_value_counts", """
select role as value, count(*)::bigint as "count", count(*) * 100.0 / (select count(*) from conversations) as pct
from conversations where role is not null group by role
""")
def r6_value_counts(spark, sf):
    c = table(spark, sf, "conversations")
    return finish(profile.value_counts(c, "role", normalize=True))


@register("r12_constant_columns", """
with long as (select 'c_mktsegment' as "column", c_mktsegment as value from customer
              union all select 'c_nationkey', cast(c_nationkey as varchar) from customer
              union all select 'always', 'x' from customer),
vc as (select "column", value, count(*) as freq from long group by all),
g as (select "column", count(*) as n_values, sum(freq) as rows, max(freq) as top_freq,
             arg_min(value, (-freq, value)) as top_value from vc group by 1)
select "column", n_values::bigint as n_values, top_freq * 1.0 / rows as top_share, top_value,
       n_values = 1 as constant, n_values > 1 and top_freq * 1.0 / rows >= 0.95 as quasi_constant from g
""")
def r12_constant_columns(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", F.lit("x").alias("always"))
    return finish(profile.constant_columns(c))


@register("r13_high_cardinality", """
with d as (select 'c_custkey' as "column", count(distinct c_custkey) as n from customer
           union all select 'c_name', count(distinct c_name) from customer
           union all select 'c_mktsegment', count(distinct c_mktsegment) from customer
           union all select 'c_nationkey', count(distinct c_nationkey) from customer)
select "column", n::bigint as "distinct", n * 1.0 / (select count(*) from customer) as ratio from d
where n >= 100 or n * 1.0 / (select count(*) from customer) >= 0.9
""")
def r13_high_cardinality(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return finish(profile.high_cardinality(c))


@register("r15_extreme_values", """
with long as (select 'l_extendedprice' as variable, l_extendedprice as value from lineitem
              union all select 'l_quantity', l_quantity from lineitem),
s as (select variable, value, row_number() over (partition by variable order by value) as r from long),
l as (select variable, value, row_number() over (partition by variable order by value desc) as r from long)
select variable, 'smallest' as side, value from s where r <= 5
union all select variable, 'largest', value from l where r <= 5
""")
def r15_extreme_values(spark, sf):
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    e = profile.extreme_values(li, n=5)
    s = e.select("variable", F.lit("smallest").alias("side"), F.explode("smallest").alias("value"))
    lg = e.select("variable", F.lit("largest").alias("side"), F.explode("largest").alias("value"))
    return finish(s.unionByName(lg))


@register("r18_target_distribution", """
select l_linestatus as value, count(*)::bigint as "count",
       round(count(*) * 100.0 / (select count(*) from lineitem), 2) as pct
from lineitem group by 1
""")
def r18_target_distribution(spark, sf):
    vc = profile.value_counts(table(spark, sf, "lineitem"), "l_linestatus", normalize=True)
    return finish(vc.withColumn("pct", F.round("pct", 2)))


@register("r19_table_identity", """
with g as (select count(*) as c from lineitem group by all_columns := (l_returnflag, l_linestatus, l_quantity))
select sum(c)::bigint as rows, 3::bigint as columns, (sum(c) - count(*))::bigint as duplicates,
       count(*)::bigint as unique_rows from g
""".replace("group by all_columns := (l_returnflag, l_linestatus, l_quantity)",
            "group by l_returnflag, l_linestatus, l_quantity"))
def r19_table_identity(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return finish(profile.table_identity(li))


@register("p15_table_info", """
select 'n_nationkey' as "column", count(n_nationkey)::bigint as non_null, 'int' as dtype from nation
union all select 'n_name', count(n_name)::bigint, 'string' from nation
union all select 'n_regionkey', count(n_regionkey)::bigint, 'int' from nation
""")
def p15_table_info(spark, sf):
    return finish(profile.table_info(table(spark, sf, "nation")))


@register("g1_group_aggregate", """
with long as (select l_returnflag, 'l_quantity' as variable, l_quantity as value from lineitem
              union all select l_returnflag, 'l_discount', l_discount from lineitem)
select l_returnflag, variable, count(value)::bigint as "count", avg(value) as mean,
  quantile_cont(value, 0.5) as median, stddev_samp(value) as std, min(value) as "min", max(value) as "max"
from long group by all
""")
def g1_group_aggregate(spark, sf):
    li = table(spark, sf, "lineitem")
    return finish(profile.group_aggregate(li, ["l_returnflag"], ["l_quantity", "l_discount"]))


@register("g2_distinct_count", """
select count(distinct o_custkey)::bigint as customers, count(distinct o_orderpriority)::bigint as priorities from orders
""")
def g2_distinct_count(spark, sf):
    o = table(spark, sf, "orders")
    return finish(o.agg(F.count_distinct("o_custkey").alias("customers"),
                        F.count_distinct("o_orderpriority").alias("priorities")))


@register("g3_pivot_mean", """
select o_orderpriority,
  avg(o_totalprice) filter (where o_orderstatus = 'F') as "F",
  avg(o_totalprice) filter (where o_orderstatus = 'O') as "O",
  avg(o_totalprice) filter (where o_orderstatus = 'P') as "P"
from orders group by 1
""")
def g3_pivot_mean(spark, sf):
    o = table(spark, sf, "orders")
    return finish(profile.pivot_mean(o, "o_orderpriority", "o_orderstatus", "o_totalprice", ["F", "O", "P"]))


@register("p14_head_tail", """
(select o_orderkey, o_totalprice from orders order by o_orderkey limit 5)
union all (select o_orderkey, o_totalprice from orders order by o_orderkey desc limit 5)
""")
def p14_head_tail(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return finish(profile.first_rows(o, "o_orderkey", 5).unionByName(profile.first_rows(o, "o_orderkey", 5, tail=True)))


@register("r11_mixed_types", """
with long as (select 'props_k' as "column", trim(json_extract_string(props, '$.k')) as v from events
              union all select 'event_type', trim(event_type) from events),
k as (select distinct "column", case when regexp_full_match(v, '[+-]?[0-9]+') then 'int'
        when try_cast(v as double) is not null then 'float'
        when lower(v) in ('true', 'false') then 'bool' else 'str' end as kind from long where v is not null)
select "column", array_to_string(list_sort(list(kind)), ',') as kinds, count(*) > 1 as mixed from k group by 1
""")
def r11_mixed_types(spark, sf):
    e = table(spark, sf, "events").select(F.get_json_object("props", "$.k").alias("props_k"), "event_type")
    m = profile.mixed_types(e)
    return finish(m.select("column", F.array_join("kinds", ",").alias("kinds"), "mixed"))


@register("r17_table_findings", """
with g as (select count(*) as s from customer group by c_mktsegment, c_nationkey),
dup as (select 'duplicates' as finding, 'table' as subject, printf('%d surplus duplicate rows', sum(s) - count(*)) as detail
        from g having sum(s) - count(*) > 0),
d as (select 'c_mktsegment' as c, count(distinct c_mktsegment) as n from customer
      union all select 'c_nationkey', count(distinct c_nationkey) from customer),
card as (select 'high_cardinality' as finding, c as subject,
           printf('%d distinct (ratio %.4f)', n, n * 1.0 / (select count(*) from customer)) as detail from d
         where n >= 20 or n * 1.0 / (select count(*) from customer) >= 0.9)
select * from dup union all select * from card
""")
def r17_table_findings(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return finish(profile.table_findings(c, max_distinct=20))


_FOUND = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_IQR_SHARES = " union all ".join(f"""select '{c}' as c, (select count(*) from lineitem, (select quantile_cont({c}, 0.25) as a, quantile_cont({c}, 0.75) as b from lineitem)
   where {c} < a - 1.5 * (b - a) or {c} > b + 1.5 * (b - a)) * 100.0 / count(*) as p from lineitem""" for c in _FOUND)
_PAIRS = " union all ".join(f"select '{a}~{b}' as s, corr({a}, {b}) as r, '{a}' as a, '{b}' as b from lineitem"
                            for i, a in enumerate(_FOUND) for b in _FOUND[i + 1:])


@register("r17_exploratory_findings", f"""
with t as (select l_linestatus as c, count(*) as n from lineitem group by 1), o as ({_IQR_SHARES}), p as ({_PAIRS})
select 'target_share' as finding, c as subject, printf('%.2f%%', n * 100.0::double / (select sum(n) from t)) as detail from t where (select count(*) from t) = 2
union all select * from (select 'correlation', s, printf('%.4f', r) from p order by abs(r) desc, a, b limit 5)
union all select * from (select 'outliers', c, printf('%.2f%%', round(p, 4)) from o order by round(p, 4) desc, c limit 5)
union all select 'implausible', 'l_discount', count(*)::varchar from lineitem where l_discount < 0.02 or l_discount > 0.08
""")
def r17_exploratory_findings(spark, sf):
    return finish(profile.exploratory_findings(table(spark, sf, "lineitem"), _FOUND, "l_linestatus", {"l_discount": (0.02, 0.08), "l_quantity": (0, 60)}))


@register("r8_column_kinds", """
select 'o_orderstatus' as "column", case when (select count(distinct o_orderstatus) from orders) = 2 then 'binary' else 'categorical' end as role
union all select 'o_orderpriority', 'ordinal' union all select 'o_totalprice', 'numeric' union all select 'big', 'binary'
""")
def r8_column_kinds(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice", (F.col("o_totalprice") > 100000).cast("int").alias("big"))
    return finish(profile.binary_ordinal_roles(o, ["o_orderpriority"]))


@register("r14_describe_number", """
select 'l_extendedprice' as "column", 'double' as dtype, count(*)::bigint as total, 0::bigint as missing, 0.0 as missing_pct,
  count(distinct l_extendedprice)::bigint as "distinct", round(min(l_extendedprice), 4) as "min", round(quantile_cont(l_extendedprice, 0.25), 4) as q1,
  round(quantile_cont(l_extendedprice, 0.5), 4) as median, round(avg(l_extendedprice), 4) as mean, round(quantile_cont(l_extendedprice, 0.75), 4) as q3,
  round(max(l_extendedprice), 4) as "max", round(stddev_samp(l_extendedprice), 4) as std,
  (select array_to_string(list(v order by f, v), ',') from (select l_extendedprice::varchar as v, min(l_orderkey * 10 + l_linenumber) as f
     from lineitem group by 1 order by f, v limit 5)) as examples
from lineitem
""")
def r14_describe_number(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    d = profile.describe_variable(li, "l_extendedprice", "rid", 5)
    return finish(d.drop("mode").withColumn("examples", F.array_join("examples", ",")))


@register("r7_r9_column_roles", """
select 'o_orderkey' as "column", true as numeric, false as text, false as "boolean", false as categorical,
  false as suspicious_text, (select count(distinct o_orderkey) from orders)::bigint as "distinct"
union all select 'o_orderstatus', false, true, false, true,
  (select count(distinct o_orderstatus) < count(*) and count(distinct o_orderstatus) > 0 from orders),
  (select count(distinct o_orderstatus) from orders)::bigint
union all select 'o_custkey', true, false, false, (select count(distinct o_custkey) <= 30 from orders), false,
  (select count(distinct o_custkey) from orders)::bigint
""")
def r7_r9_column_roles(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return finish(profile.column_roles(o, 30))


@register("r8_r10_analytic_types", """
select 'o_orderstatus' as "column", 'categórica nominal/ordinal' as analytic_type,
  (select count(distinct o_orderstatus) from orders)::bigint as "distinct"
union all select 'o_orderpriority', 'categórica ordinal', (select count(distinct o_orderpriority) from orders)::bigint
union all select 'o_totalprice', 'numérica contínua', (select count(distinct o_totalprice) from orders)::bigint
union all select 'big', 'binária', 2::bigint
""")
def r8_r10_analytic_types(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice",
                                          (F.col("o_totalprice") > 100000).cast("int").alias("big"))
    return finish(profile.analytic_types(o, 15, hints={"o_orderpriority": "ordinal"}))


@register("r14_describe_variable", """
select 'o_orderstatus' as "column", 'string' as dtype, count(*)::bigint as total,
  (count(*) - count(o_orderstatus))::bigint as missing, round((count(*) - count(o_orderstatus)) * 100.0 / count(*), 2) as missing_pct,
  count(distinct o_orderstatus)::bigint as "distinct",
  (select o_orderstatus from orders group by 1 order by count(*) desc, 1 limit 1) as mode
from orders
""")
def r14_describe_variable(spark, sf):
    d = profile.describe_variable(table(spark, sf, "orders"), "o_orderstatus", "o_orderkey")
    return finish(d.select("column", "dtype", "total", "missing", "missing_pct", "distinct", "mode"))


@register("r16_variable_findings", """
with t as (select l_quantity, l_extendedprice, l_linestatus, l_returnflag, l_linenumber, cast(l_orderkey as varchar) as l_order,
             case when l_quantity > 25 then l_returnflag end as l_holes from lineitem),
n as (select count(*) as n from t),
num as (select 'l_quantity' as v, min(l_quantity) as lo, max(l_quantity) as hi, avg(l_quantity) as m, quantile_cont(l_quantity, 0.5) as med from t
        union all select 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), avg(l_extendedprice), quantile_cont(l_extendedprice, 0.5) from t),
lev as (select 'l_returnflag' as v, count(distinct l_returnflag) as k from t union all select 'l_linestatus', count(distinct l_linestatus) from t
        union all select 'l_order', count(distinct l_order) from t union all select 'l_holes', count(distinct l_holes) from t),
top as (select max(c) as c, count(*) as k from (select count(*) as c from t group by l_linestatus) as x)
select v as variable, 'complete' as rule, null::double as a, null::double as b
  from (values ('l_quantity'), ('l_extendedprice'), ('l_linestatus'), ('l_returnflag'), ('l_linenumber'), ('l_order')) as x(v)
union all select 'l_holes', 'missing', count(*) - count(l_holes), (count(*) - count(l_holes)) * 100.0 / count(*) from t
union all select 'l_linestatus', 'dominant_class', c * 100.0 / n, null from top, n where k = 2
union all select 'l_linenumber', 'ordinal', null, null
union all select v, 'range', lo, hi from num
union all select v, 'asymmetry', m, med from num where case when m <> 0 then abs(m - med) > 0.15 * abs(m) else abs(med) > 0 end
union all select v, 'constant', k, null from lev where k = 1
union all select v, 'low_cardinality', k, null from lev where k between 2 and 5
union all select v, 'high_cardinality', k, null from lev where k > 50
""")
def r16_variable_findings(spark, sf):
    t = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag", "l_linenumber", F.col("l_orderkey").cast("string").alias("l_order"),
        F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("l_holes"))
    return finish(profile.variable_findings(t, {
        "l_quantity": "numeric", "l_extendedprice": "numeric", "l_linestatus": "binary", "l_returnflag": "nominal",
        "l_linenumber": "ordinal", "l_order": "nominal", "l_holes": "nominal"}))


@register("d6_candidate_subset", """
select count(*)::bigint as duplicated_rows from lineitem
where (l_returnflag, l_linestatus, l_discount, l_tax) in (
  select (l_returnflag, l_linestatus, l_discount, l_tax) from lineitem group by all having count(*) > 1)
""")
def d6_candidate_subset(spark, sf):
    from tablewise.operators import quality
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_discount", "l_tax",
                                             "l_quantity")
    sub = quality.candidate_subset(li, max_cols=5, max_distinct=20)
    s = quality.duplicate_subsets_summary(li, [sub])
    return finish(s.select("duplicated_rows"))


@register("p2_p3_p12_p13_columns_and_slices", """
select o_orderkey as order_key, o_totalprice is null as price_missing, o_custkey from orders
where o_orderkey >= 100 and o_orderkey <= 200
""")
def p2_p3_p12_p13_columns_and_slices(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "order_key"})
    o = profile.slice_rows(o, "order_key", 100, 200, inclusive=True)
    return finish(o.select("order_key", F.col("o_totalprice").isNull().alias("price_missing"), "o_custkey"))
