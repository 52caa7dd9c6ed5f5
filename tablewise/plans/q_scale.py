"""Registered scaling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import scale
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table


@register("n1_minmax_scale", """
select l_orderkey, l_linenumber,
  (l_extendedprice - (select min(l_extendedprice) from lineitem))
    / ((select max(l_extendedprice) from lineitem) - (select min(l_extendedprice) from lineitem)) as l_extendedprice,
  0.0 as const_col
from lineitem
""")
def n1_minmax_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                             F.lit(7.0).alias("const_col"))
    return finish(scale.minmax_scale(li, ["l_extendedprice", "const_col", "absent_col"]))


@register("n2_zscore_scale", """
select o_orderkey, (o_totalprice - (select avg(o_totalprice) from orders))
  / (select stddev_pop(o_totalprice) from orders) as o_totalprice from orders
""")
def n2_zscore_scale(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return finish(scale.zscore_scale(o, ["o_totalprice"]))


@register("n3_decimal_scale", """
with m as (select max(abs(l_extendedprice)) as a, max(abs(l_discount)) as b, max(abs(l_quantity)) as c from lineitem)
select l_orderkey, l_linenumber,
  l_extendedprice / power(10.0, ceil(log10((select a from m) + 1e-12))) as l_extendedprice,
  l_discount / power(10.0, ceil(log10((select b from m) + 1e-12))) as l_discount,
  l_quantity / power(10.0, ceil(log10((select c from m) + 1e-12))) as l_quantity
from lineitem
""")
def n3_decimal_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity")
    return finish(scale.decimal_scale(li, ["l_extendedprice", "l_discount", "l_quantity"]))


@register("n4_fit_transform", """
select o_orderkey, (o_totalprice - (select avg(o_totalprice) from orders where o_orderstatus = 'F'))
  / (select stddev_pop(o_totalprice) from orders where o_orderstatus = 'F') as o_totalprice
from orders where o_orderstatus <> 'F'
""")
def n4_fit_transform(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stats = scale.fit(o.where(F.col("o_orderstatus") == "F"), ["o_totalprice"])
    out = scale.transform(o.where(F.col("o_orderstatus") != "F"), stats, "zscore", ["o_totalprice"])
    return finish(out.select("o_orderkey", "o_totalprice"))


@register("n5_compare_versions", """
with mm as (select (c_acctbal - (select min(c_acctbal) from customer))
                   / ((select max(c_acctbal) from customer) - (select min(c_acctbal) from customer)) as v from customer),
zs as (select (c_acctbal - (select avg(c_acctbal) from customer)) / (select stddev_pop(c_acctbal) from customer) as v
       from customer),
u as (select 'minmax' as version, v from mm union all select 'zscore', v from zs)
select 'c_acctbal' as "column", version, min(v) as "min", max(v) as "max", avg(v) as mean,
       stddev_samp(v) as std, quantile_cont(v, 0.5) as median from u group by version
""")
def n5_compare_versions(spark, sf):
    c = table(spark, sf, "customer").select("c_acctbal")
    return finish(scale.compare_versions({"minmax": scale.minmax_scale(c), "zscore": scale.zscore_scale(c)},
                                         ["c_acctbal"]))
