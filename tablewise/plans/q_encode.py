"""Registered encoding and discretisation queries (E1-E17, P-block)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.functions import core
from tablewise.operators import encode
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
PRIORITY_GROUPS = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "low", "5-LOW": "low"}
QTY_BINS = ((10, "small"), (25, "medium"), (40, "large"), (None, "bulk"))


@register("e1_map_values", """
select o_orderkey, case o_orderstatus when 'F' then 'closed' when 'O' then 'open' end as status from orders
""")
def e1_map_values(spark, sf):
    o = table(spark, sf, "orders")
    return finish(o.select("o_orderkey", encode.map_values(F.col("o_orderstatus"), {"F": "closed", "O": "open"}).alias("status")))


@register("e2_group_levels", """
select case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'high' when o_orderpriority = '3-MEDIUM' then 'medium'
            when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'low' end as priority_group, count(*)::bigint as n
from orders group by 1
""")
def e2_group_levels(spark, sf):
    o = table(spark, sf, "orders")
    g = o.select(encode.map_values(F.col("o_orderpriority"), PRIORITY_GROUPS).alias("priority_group"))
    return finish(g.groupBy("priority_group").agg(F.count(F.lit(1)).alias("n")))


@register("e3_threshold_bins", """
select case when l_quantity < 10 then 'small' when l_quantity < 25 then 'medium' when l_quantity < 40 then 'large'
            else 'bulk' end as qty_bin, count(*)::bigint as n from lineitem group by 1
""")
def e3_threshold_bins(spark, sf):
    li = table(spark, sf, "lineitem")
    b = li.select(encode.threshold_bins(F.col("l_quantity"), QTY_BINS).alias("qty_bin"))
    return finish(b.groupBy("qty_bin").agg(F.count(F.lit(1)).alias("n")))


@register("e4_size_price_bins", """
select p_partkey,
  case when p_size < 10 then 'S' when p_size < 25 then 'M' when p_size < 40 then 'L' else 'XL' end as size_bin,
  case when p_retailprice < 1000 then 'cheap' when p_retailprice < 1500 then 'mid' else 'dear' end as price_bin
from part
""")
def e4_size_price_bins(spark, sf):
    p = table(spark, sf, "part")
    return finish(p.select("p_partkey",
                           encode.threshold_bins(F.col("p_size"), ((10, "S"), (25, "M"), (40, "L"), (None, "XL"))).alias("size_bin"),
                           encode.threshold_bins(F.col("p_retailprice"), ((1000, "cheap"), (1500, "mid"), (None, "dear"))).alias("price_bin")))


@register("e5_consumption_bins", """
select l_orderkey, l_linenumber,
  case when l_discount * 100 = 0 then 'Never' when l_discount * 100 <= 5 then 'Low'
       when l_discount * 100 <= 10 then 'Moderate' else 'High' end as alcohol_rule,
  case when l_tax * 100 = 0 then 'Never' when l_tax * 100 < 10 then 'Low'
       when l_tax * 100 < 20 then 'Moderate' else 'High' end as generic_rule
from lineitem
""")
def e5_consumption_bins(spark, sf):
    li = table(spark, sf, "lineitem")
    return finish(li.select("l_orderkey", "l_linenumber",
                            encode.consumption_bins(F.col("l_discount") * 100, "alcohol").alias("alcohol_rule"),
                            encode.consumption_bins(F.col("l_tax") * 100, "generic").alias("generic_rule")))


@register("e6_categorical_variant", """
select o_orderkey, case o_orderstatus when 'F' then 'closed' when 'O' then 'open' end as o_orderstatus,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'high' when o_orderpriority = '3-MEDIUM' then 'medium'
       when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'low' end as o_orderpriority,
  case when o_totalprice < 50000 then 'low' when o_totalprice < 150000 then 'mid' else 'high' end as o_totalprice
from orders
""")
def e6_categorical_variant(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey")
    spec = {"o_orderstatus": ("map", {"F": "closed", "O": "open"}), "o_orderpriority": ("map", PRIORITY_GROUPS),
            "o_totalprice": ("bins", ((50000, "low"), (150000, "mid"), (None, "high")))}
    return finish(encode.prepare_variant(o, spec, drop=["o_custkey"]))


@register("e7_numeric_variant", """
select l_orderkey, l_linenumber, case l_linestatus when 'F' then 0 when 'O' then 1 end::bigint as l_linestatus,
  try_cast(l_returnflag as double) as l_returnflag, l_quantity from lineitem
""")
def e7_numeric_variant(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity")
    spec = {"l_linestatus": ("binary",), "l_returnflag": ("binary",)}
    return finish(encode.prepare_variant(li, spec))


@register("e8_binary_encode", """
select o_orderkey, try_cast(o_orderstatus as double) as o_orderstatus,
  case when o_totalprice > 100000 then 'yes' else 'no' end = 'yes' as big_flag_raw,
  case when o_totalprice > 100000 then 1 else 0 end::bigint as big from orders
""")
def e8_binary_encode(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        (F.when(F.col("o_totalprice") > 100000, "yes").otherwise("no") == "yes").alias("big_flag_raw"),
        F.when(F.col("o_totalprice") > 100000, "Yes").otherwise("No").alias("big"))
    return finish(encode.binary_encode(o, ["o_orderstatus", "big"]))


@register("e10_ordinal_codes", """
select o_orderkey, list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority) - 1
  as priority_code0, list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], o_orderpriority)
  as priority_code1 from orders
""")
def e10_ordinal_codes(spark, sf):
    o = table(spark, sf, "orders")
    return finish(o.select("o_orderkey", encode.ordinal_code(F.col("o_orderpriority"), PRIORITY_ORDER, 0).alias("priority_code0"),
                           encode.ordinal_code(F.col("o_orderpriority"), PRIORITY_ORDER, 1).alias("priority_code1")))


@register("e12_factorize", """
with f as (select c_mktsegment, min(c_custkey) as first from customer group by 1),
r as (select c_mktsegment, row_number() over (order by first, c_mktsegment) - 1 as code from f)
select c.c_custkey, coalesce(r.code, -1)::bigint as c_mktsegment_code from customer c left join r using (c_mktsegment)
""")
def e12_factorize(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return finish(encode.factorize(c, "c_mktsegment", "c_custkey").select("c_custkey", "c_mktsegment_code"))


@register("e14_cut_edges", """
select p_partkey, case when p_retailprice > 900 and p_retailprice <= 1200 then 'a'
  when p_retailprice > 1200 and p_retailprice <= 1500 then 'b' when p_retailprice > 1500 and p_retailprice <= 2100 then 'c'
  end as price_cut from part
""")
def e14_cut_edges(spark, sf):
    p = table(spark, sf, "part")
    return finish(p.select("p_partkey", encode.cut_edges(F.col("p_retailprice"), [900, 1200, 1500, 2100], ["a", "b", "c"]).alias("price_cut")))


@register("e15_cut_equal_width", """
with m as (select min(o_totalprice) as mn, max(o_totalprice) as mx from orders)
select o_orderkey, greatest(least(ceil((o_totalprice - mn) / ((mx - mn) / 5)) - 1, 4), 0)::bigint as o_totalprice_bin
from orders, m
""")
def e15_cut_equal_width(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return finish(encode.cut_equal_width(o, "o_totalprice", 5).select("o_orderkey", "o_totalprice_bin"))


@register("e16_qcut", """
with e as (select quantile_cont(c_acctbal, 1.0 / 3) as a, quantile_cont(c_acctbal, 2.0 / 3) as b from customer)
select c_custkey, ((c_acctbal > a)::int + (c_acctbal > b)::int)::bigint as c_acctbal_qbin from customer, e
""")
def e16_qcut(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return finish(encode.qcut(c, "c_acctbal", 3).select("c_custkey", "c_acctbal_qbin"))


@register("e17_domain_order", """
with f as (select o_orderpriority as level, min(o_orderkey) as first from orders group by 1)
select level, (row_number() over (order by case when level = '1-URGENT' then 1 when level = '3-MEDIUM' then 2 else 3 end,
  first, level) - 1)::bigint as level_order from f
""")
def e17_domain_order(spark, sf):
    o = table(spark, sf, "orders")
    return finish(encode.domain_order(o, "o_orderpriority", "o_orderkey", ["1-URGENT", "3-MEDIUM", "9-ABSENT"]))


@register("p1_p16_names_and_text", """
select n_nationkey, regexp_replace(regexp_replace(regexp_replace(lower(trim(n_name)), '[^a-z0-9]', '_', 'g'), '_+', '_', 'g'),
  '^_+|_+$', '', 'g') as safe, regexp_replace(trim('  ' || n_name || '   x  '), '\\s+', ' ', 'g') as cleaned,
  case when length(n_name) > 8 then substr(n_name, 1, 5) || '...' else n_name end as shown from nation
""")
def p1_p16_names_and_text(spark, sf):
    n = table(spark, sf, "nation")
    return finish(n.select("n_nationkey", core.safe_name(F.col("n_name")).alias("safe"),
                           core.clean_text(F.concat(F.lit("  "), F.col("n_name"), F.lit("   x  "))).alias("cleaned"),
                           core.display_value(F.col("n_name"), max_len=8).alias("shown")))
