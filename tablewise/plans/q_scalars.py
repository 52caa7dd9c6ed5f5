"""Registered scalar/array-function queries (X1-X14) and source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewise.functions import scalars as X
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.session import checkpoint_dir
from tablewise.sources import files
from tablewise.sources.tables import table


@register("x1_x5_scalar_functions", """
select l_orderkey, l_linenumber,
  floor((l_linenumber - 4) / 3.0)::bigint as floordiv,
  (((l_linenumber - 4) % 3) + 3) % 3 as pymod,
  round(l_discount * 100 + 0.5) as round_half_up,
  power(l_quantity, 2) as squared,
  -l_quantity as negated,
  length(l_returnflag || l_linestatus) as flag_len,
  contains(l_shipmode_free, 'F') as has_f,
  upper(lower(l_returnflag)) = l_returnflag as case_roundtrip,
  starts_with(l_linestatus, 'F') as starts_f,
  printf('%.2f', l_extendedprice) as price_text,
  lpad(cast(l_linenumber as varchar), 3, '0') as padded
from (select *, l_returnflag || l_linestatus as l_shipmode_free from lineitem)
""")
def x1_x5_scalar_functions(spark, sf):
    li = table(spark, sf, "lineitem")
    k = F.col("l_linenumber") - 4
    both = F.concat("l_returnflag", "l_linestatus")
    return finish(li.select(
        "l_orderkey", "l_linenumber",
        X.floordiv(k, F.lit(3)).alias("floordiv"),
        X.pymod(k, F.lit(3)).cast("long").alias("pymod"),
        F.round(F.col("l_discount") * 100 + 0.5).alias("round_half_up"),
        F.pow("l_quantity", 2).alias("squared"),
        (-F.col("l_quantity")).alias("negated"),
        F.length(both).cast("long").alias("flag_len"),
        F.contains(both, F.lit("F")).alias("has_f"),
        (F.upper(F.lower("l_returnflag")) == F.col("l_returnflag")).alias("case_roundtrip"),
        F.startswith("l_linestatus", F.lit("F")).alias("starts_f"),
        F.format_string("%.2f", "l_extendedprice").alias("price_text"),
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0").alias("padded")))


@register("x6_x14_array_functions", """
with e as (select vec_id, embedding::double[] as x from embeddings)
select vec_id, len(x)::bigint as n, x[1] as first, list_sum(x[1:4]) as head_sum, list_max(x) as mx, list_min(x) as mn,
  list_avg(x) as mean, sqrt(list_avg(list_transform(x, lambda v: (v - list_avg(x)) * (v - list_avg(x))))) as std,
  list_dot_product(x, x) as dot_self, list_sum(list_transform(x, lambda v: case when v < 0.5 then 0.0 else v end)) as clipped_sum,
  len(list_filter(x, lambda v: v > 0.5))::bigint as n_big, len(list_distinct(list_transform(x, lambda v: round(v, 1))))::bigint as n_distinct_1dp
from e
""")
def x6_x14_array_functions(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    x = F.col("x")
    return finish(e.select(
        "vec_id", F.size(x).cast("long").alias("n"), F.element_at(x, 1).alias("first"),
        X.array_sum(F.slice(x, 1, 4)).alias("head_sum"), F.array_max(x).alias("mx"), F.array_min(x).alias("mn"),
        X.array_mean(x).alias("mean"), X.array_std(x).alias("std"), X.dot(x, x).alias("dot_self"),
        X.array_sum(F.transform(x, lambda v: F.when(v < 0.5, F.lit(0.0)).otherwise(v))).alias("clipped_sum"),
        F.size(F.filter(x, lambda v: v > 0.5)).cast("long").alias("n_big"),
        F.size(F.array_distinct(F.transform(x, lambda v: F.round(v, 1)))).cast("long").alias("n_distinct_1dp")))


@register("x7_x8_sets_and_maps", """
with t as (select c_custkey, [c_mktsegment, 'BUILDING', 'MACHINERY'] as a, ['BUILDING', 'HOUSEHOLD'] as b from customer)
select c_custkey, len(list_distinct(a))::bigint as n_distinct,
  len(list_intersect(a, b))::bigint as n_common,
  len(list_filter(list_distinct(a), lambda v: not list_contains(b, v)))::bigint as n_only_a,
  len(list_distinct(list_concat(a, b)))::bigint as n_union
from t
""")
def x7_x8_sets_and_maps(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.array("c_mktsegment", F.lit("BUILDING"), F.lit("MACHINERY")).alias("a"),
        F.array(F.lit("BUILDING"), F.lit("HOUSEHOLD")).alias("b"))
    return finish(c.select("c_custkey", F.size(F.array_distinct("a")).cast("long").alias("n_distinct"),
                           F.size(F.array_intersect("a", "b")).cast("long").alias("n_common"),
                           F.size(F.array_except("a", "b")).cast("long").alias("n_only_a"),
                           F.size(F.array_union("a", "b")).cast("long").alias("n_union")))


@register("x2_rounding", """
select l_orderkey, l_linenumber, round_even(l_linenumber + 0.5, 0) as half_even, round(l_linenumber + 0.5) as half_up,
  round_even(l_extendedprice / 100, 0) as price_even, floor(l_discount * 10)::bigint as floored, ceil(l_discount * 10)::bigint as ceiled,
  trunc(-l_extendedprice)::bigint as truncated, abs(l_discount - 0.05) as distance from lineitem
""")
def x2_rounding(spark, sf):
    li = table(spark, sf, "lineitem")
    half = F.col("l_linenumber") + F.lit(0.5)
    return finish(li.select(
        "l_orderkey", "l_linenumber", X.pyround(half).alias("half_even"), F.round(half).alias("half_up"),
        X.pyround(F.col("l_extendedprice") / 100).alias("price_even"), F.floor(F.col("l_discount") * 10).alias("floored"),
        F.ceil(F.col("l_discount") * 10).alias("ceiled"), (-F.col("l_extendedprice")).cast("long").alias("truncated"),
        F.abs(F.col("l_discount") - 0.05).alias("distance")))


@register("x3_x5_text_functions", """
select c_custkey, c_name[2:5] as piece, c_name[-3:] as tail, reverse(c_name) as reversed, replace(c_name, 'Customer', 'C') as replaced,
  regexp_matches(c_custkey::varchar, '^[0-9]+$') as numeric_text, ends_with(c_mktsegment, 'E') as ends_e,
  (length(c_name) - length(replace(c_name, '0', '')))::bigint as zeros, string_split(c_name, '#')[2] as number, trim('  ' || c_mktsegment || ' ') as trimmed,
  len(string_split(c_name, '0'))::bigint as pieces, format('{:x}', c_custkey) as hex_id, printf('%.8e', c_acctbal::double) as scientific,
  format('{:,}', c_custkey * 12345) as thousands, position('#' in c_name)::bigint as at from customer
""")
def x3_x5_text_functions(spark, sf):
    c = table(spark, sf, "customer")
    name, key = F.col("c_name"), F.col("c_custkey")
    return finish(c.select(
        "c_custkey", F.substring(name, 2, 4).alias("piece"), F.right(name, F.lit(3)).alias("tail"), F.reverse(name).alias("reversed"),
        F.replace(name, F.lit("Customer"), F.lit("C")).alias("replaced"), key.cast("string").rlike("^[0-9]+$").alias("numeric_text"),
        F.endswith("c_mktsegment", F.lit("E")).alias("ends_e"), (F.length(name) - F.length(F.replace(name, F.lit("0"), F.lit("")))).alias("zeros"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("number"), F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.size(F.split(name, "0")).alias("pieces"), F.lower(F.hex(key)).alias("hex_id"),
        F.format_string("%.8e", F.col("c_acctbal").cast("double")).alias("scientific"), F.format_number(key * 12345, 0).alias("thousands"),
        F.instr(name, "#").alias("at")))


@register("x6_list_edits", """
with t as (select p_partkey, [p_size, p_partkey % 7, 3, p_size] as a from part)
select p_partkey, array_to_string(list_append(a, 9), ',') as appended, array_to_string(a[1:1] || [99] || a[2:], ',') as inserted,
  array_to_string(list_filter(a, lambda v: v <> 3), ',') as removed, array_to_string(list_reverse(a), ',') as reversed,
  array_to_string(list_sort(a), ',') as sorted, array_to_string(a || [1, 2], ',') as joined, list_position(a, 3)::bigint as place,
  list_contains(a, 5) as has_five, a[-1]::bigint as last, array_to_string(a[2:3], ',') as middle from t
""")
def x6_list_edits(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.array(F.col("p_size").cast("long"), (F.col("p_partkey") % 7).cast("long"),
                                                             F.lit(3).cast("long"), F.col("p_size").cast("long")).alias("a"))
    told = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    return finish(p.select(
        "p_partkey", told(F.array_append("a", F.lit(9).cast("long"))).alias("appended"),
        told(F.array_insert("a", 2, F.lit(99).cast("long"))).alias("inserted"), told(F.array_remove("a", F.lit(3).cast("long"))).alias("removed"),
        told(F.reverse("a")).alias("reversed"), told(F.array_sort("a")).alias("sorted"),
        told(F.concat("a", F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))).alias("joined"), F.array_position("a", F.lit(3).cast("long")).alias("place"),
        F.array_contains("a", F.lit(5).cast("long")).alias("has_five"), F.element_at("a", -1).alias("last"), told(F.slice("a", 2, 2)).alias("middle")))


@register("x8_maps", """
with m as (select o_custkey, map_from_entries(list({'k': p, 'v': n} order by p)) as m
           from (select o_custkey, o_orderpriority as p, count(*)::bigint as n from orders group by all) group by 1)
select o_custkey, len(map_keys(m))::bigint as size, array_to_string(map_keys(m), ',') as keys, array_to_string(map_values(m), ',') as "values", coalesce(m['1-URGENT'], 0) as urgent,
  list_contains(map_keys(m), '5-LOW') as has_low, list_sum(map_values(m))::bigint as total,
  array_to_string(list_sort(map_keys(m) || ['extra']), ',') as with_extra, array_to_string(list_filter(map_keys(m), lambda k: m[k] > 1), ',') as often from m
""")
def x8_maps(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    m = o.groupBy("o_custkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("m"))
    put = F.map_concat("m", F.create_map(F.lit("extra"), F.lit(0).cast("long")))
    return finish(m.select(
        "o_custkey", F.size("m").alias("size"), F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.array_join(F.transform(F.map_values("m"), lambda v: v.cast("string")), ",").alias("values"),
        F.coalesce(F.try_element_at("m", F.lit("1-URGENT")), F.lit(0)).alias("urgent"), F.map_contains_key("m", "5-LOW").alias("has_low"),
        F.aggregate(F.map_values("m"), F.lit(0).cast("long"), lambda s, v: s + v).alias("total"), F.array_join(F.array_sort(F.map_keys(put)), ",").alias("with_extra"),
        F.array_join(F.map_keys(F.map_filter("m", lambda k, v: v > 1)), ",").alias("often")))


@register("x10_x14_array_arithmetic", """
with e as (select vec_id, embedding::double[] as x from embeddings),
y as (select *, list_transform(x, lambda v: v * 2 - 0.1) as y from e)
select vec_id, list_sum(list_transform(range(1, 65), lambda i: x[i] + y[i])) as added, list_sum(list_transform(range(1, 65), lambda i: x[i] * y[i])) as products,
  len(list_filter(range(1, 65), lambda i: x[i] > y[i]))::bigint as greater, list_sum(list_transform(y, lambda v: case when v < 0 then 0.0 else v end)) as clipped,
  list_sum(list_transform(range(0, 5), lambda i: (0.0 + i * 0.25) * x[i + 1])) as weighted, list_sum(list_transform(x, lambda v: v / 4)) as quarters from y
""")
def x10_x14_array_arithmetic(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    e = e.withColumn("y", X.scalar_op(F.col("x"), lambda v: v * 2 - 0.1))
    x, y = F.col("x"), F.col("y")
    return finish(e.select(
        "vec_id", X.array_sum(X.elementwise(x, y, lambda a, b: a + b)).alias("added"), X.array_sum(X.elementwise(x, y, lambda a, b: a * b)).alias("products"),
        F.size(F.filter(X.elementwise(x, y, lambda a, b: a > b), lambda v: v)).alias("greater"), X.array_sum(X.clip_negative(y)).alias("clipped"),
        X.dot(X.linspace(0.0, 1.0, 5), F.slice(x, 1, 5)).alias("weighted"), X.array_sum(X.scalar_op(x, lambda v: v / 4)).alias("quarters")))


@register("s9_sample_n", """
select o_orderkey, o_totalprice from orders order by ((o_orderkey + 42) * 2654435761) % 1000003, o_orderkey limit 100
""")
def s9_sample_n(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return finish(files.sample_n(o, "o_orderkey", 100, kind="arith"))


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tablewise-scratch/{uuid.uuid4().hex}"


@register("s1_s6_csv_round_trip", """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
""")
def s1_s6_csv_round_trip(spark, sf):
    path = _scratch(spark)
    files.write_csv(table(spark, sf, "customer"), path)
    back = files.read_csv(spark, path)
    return finish(back.select("c_custkey", "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment"))


@register("s3_s4_robust_csv_read", """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
""")
def s3_s4_robust_csv_read(spark, sf):
    path = _scratch(spark)
    table(spark, sf, "customer").write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    sep = files.sniff_separator(spark, path)
    df = files.safe_read_csv(spark, path) if sep == ";" else files.read_csv(spark, path, sep=sep)
    return finish(df.select("c_custkey", "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment"))


@register("s1_numbers_beside_na", """
select c_custkey, case when c_custkey % 7 <> 0 then c_nationkey::bigint end as nation, case when c_custkey % 5 <> 0 then c_acctbal::double end as balance,
  c_custkey % 2 = 0 as even, case when c_custkey % 3 <> 0 then c_mktsegment end as segment from customer
""")
def s1_numbers_beside_na(spark, sf):
    path = _scratch(spark)
    na = lambda n, token, c: F.when(F.col("c_custkey") % n == 0, token).otherwise(c.cast("string"))
    (table(spark, sf, "customer").select(
        "c_custkey", na(7, "NA", F.col("c_nationkey")).alias("nation"), na(5, "n/a", F.col("c_acctbal").cast("double")).alias("balance"),
        (F.col("c_custkey") % 2 == 0).alias("even"), na(3, "NULL", F.col("c_mktsegment")).alias("segment"))
     .write.option("header", True).csv(path))
    back = files.read_csv(spark, path)
    assert [t for _, t in back.dtypes] == ["bigint", "bigint", "double", "boolean", "string"], back.dtypes
    return finish(back)


@register("s3_cp1252_read", """
select c_custkey, c_name || ' €' as "name of the customer", c_mktsegment || '™ “' || c_custkey || '”' as segment from customer
""")
def s3_cp1252_read(spark, sf):
    path = _scratch(spark)
    wrong, right = files._cp1252_texts()
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(" €")).alias("name of the customer"),
                    F.concat("c_mktsegment", F.lit("™ “"), F.col("c_custkey").cast("string"), F.lit("”")).alias("segment"))
    rows = rows.select("c_custkey", *[F.translate(F.col(f"`{n}`"), right, wrong).alias(n) for n in rows.columns[1:]])
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return finish(files.safe_read_csv(spark, path, encodings=("utf-8", "cp1252")))


@register("s7_publish_variants")
def s7_publish_variants(spark, sf):
    from tablewise.operators import scale
    path = _scratch(spark)
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    files.publish_variants({"raw": c, "minmax": scale.minmax_scale(c, ["c_acctbal"]),
                            "zscore": scale.zscore_scale(c, ["c_acctbal"])}, path)
    back = spark.read.parquet(path)
    return finish(back.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean")))


@register("s8_model_save_load")
def s8_model_save_load(spark, sf):
    from pyspark.ml.clustering import KMeansModel
    from tablewise.operators import cluster
    model, _ = cluster.kmeans(table(spark, sf, "embeddings"), "embedding", 3, n_init=1, keep=["vec_id"])
    path = _scratch(spark)
    model.write().overwrite().save(path)
    loaded = KMeansModel.load(path)
    vec = cluster._vectors(table(spark, sf, "embeddings"), "embedding", ["vec_id"])
    return finish(loaded.transform(vec).select("vec_id", F.col("cluster").cast("long").alias("cluster")))


@register("p4_p5_select_drop", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem
""")
def p4_p5_select_drop(spark, sf):
    from tablewise.functions.core import numeric_columns
    li = table(spark, sf, "lineitem").drop("l_shipdate")
    return finish(li.select(*numeric_columns(li)))


@register("p6_p9_derived_columns", """
select o_orderkey, o_totalprice / 1000.0 as price_k,
  case when o_totalprice >= 200000 then 'good' else 'bad' end as grade,
  try_cast(o_orderstatus as double) as status_num, cast(o_custkey as varchar) as cust_text from orders
""")
def p6_p9_derived_columns(spark, sf):
    o = table(spark, sf, "orders")
    return finish(o.select("o_orderkey", F.try_divide(F.col("o_totalprice"), F.lit(1000.0)).alias("price_k"),
                           F.when(F.col("o_totalprice") >= 200000, "good").otherwise("bad").alias("grade"),
                           F.col("o_orderstatus").try_cast("double").alias("status_num"),
                           F.col("o_custkey").cast("string").alias("cust_text")))


@register("j1_u1_full_outer_union", """
with a as (select n_regionkey as k, count(*) as nations from nation group by 1),
b as (select r_regionkey as k, r_name from region)
select coalesce(a.k, b.k) as k, a.nations::bigint as nations, b.r_name from a full join b on a.k = b.k
union all select 99, null, 'extra'
""")
def j1_u1_full_outer_union(spark, sf):
    a = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(F.count(F.lit(1)).alias("nations"))
    b = table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    j = a.join(b, "k", "full").select(F.col("k").cast("int").alias("k"), "nations", "r_name")
    extra = spark.createDataFrame([(99, None, "extra")], "k int, nations long, r_name string")
    return finish(j.unionByName(extra))


@register("j2_u3_semi_and_set_ops", """
select 'semi' as op, count(*)::bigint as n from customer where c_custkey in (select o_custkey from orders)
union all select 'intersect', count(*)::bigint from (select o_custkey from orders intersect select c_custkey from customer)
union all select 'except', count(*)::bigint from (select c_custkey from customer except select o_custkey from orders)
""")
def j2_u3_semi_and_set_ops(spark, sf):
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    cnt = F.count(F.lit(1)).alias("n")
    semi = c.join(o, c.c_custkey == o.o_custkey, "left_semi").agg(cnt).select(F.lit("semi").alias("op"), "n")
    inter = o.select("o_custkey").intersect(c.select("c_custkey")).agg(cnt).select(F.lit("intersect").alias("op"), "n")
    exc = c.select("c_custkey").subtract(o.select("o_custkey")).agg(cnt).select(F.lit("except").alias("op"), "n")
    return finish(semi.unionByName(inter).unionByName(exc))


@register("t1_t4_sort_rank_lag", """
with t as (select o_custkey, o_orderkey, o_totalprice,
  row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rk,
  o_totalprice - lag(o_totalprice) over (partition by o_custkey order by o_orderkey) as diff from orders)
select o_custkey, o_orderkey, o_totalprice, rk::bigint as rk, diff from t where rk <= 2
""")
def t1_t4_sort_rank_lag(spark, sf):
    from pyspark.sql import Window
    o = table(spark, sf, "orders")
    w1 = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    w2 = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    t = o.select("o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w1).alias("rk"),
                 (F.col("o_totalprice") - F.lag("o_totalprice").over(w2)).alias("diff"))
    return finish(t.where(F.col("rk") <= 2))


@register("b1_b4_value_callbacks", """
select o_orderkey, o_totalprice / 1000.0 as price_k, o_totalprice * 2 as doubled,
  case o_orderstatus when 'F' then 'finished' when 'O' then 'open' end as status_name from orders
""")
def b1_b4_value_callbacks(spark, sf):
    from tablewise.functions import udf
    o = table(spark, sf, "orders")
    return finish(o.select("o_orderkey", udf.apply_values("o_totalprice", lambda v: v / 1000.0).alias("price_k"),
                           udf.apply_series("o_totalprice", lambda s: s * 2).alias("doubled"),
                           udf.map_dict("o_orderstatus", {"F": "finished", "O": "open"}).alias("status_name")))


@register("b2_row_callback", """
select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge from lineitem
""")
def b2_row_callback(spark, sf):
    from tablewise.functions import udf
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")

    def charge(b):
        b = b.copy()
        b["charge"] = b["l_extendedprice"] * (1 - b["l_discount"]) * (1 + b["l_tax"])
        return b[["l_orderkey", "l_linenumber", "charge"]]
    return finish(udf.apply_rows(li, charge, "l_orderkey long, l_linenumber int, charge double"))


@register("b3_group_callback", """
select l_returnflag, count(*)::bigint as n, avg(l_quantity) as mean_qty, max(l_extendedprice) as max_price
from lineitem group by 1
""")
def b3_group_callback(spark, sf):
    import pandas as pd
    from tablewise.functions import udf
    li = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sq"), F.max("l_extendedprice").alias("mx"))

    # pre-aggregated partials per (flag, status), then a pandas callback per flag
    def per_flag(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"l_returnflag": [g["l_returnflag"].iloc[0]], "n": [int(g["n"].sum())],
                             "mean_qty": [g["sq"].sum() / g["n"].sum()], "max_price": [g["mx"].max()]})
    return finish(udf.apply_groups(li, ["l_returnflag"], per_flag,
                                   "l_returnflag string, n long, mean_qty double, max_price double"))


@register("x9_x10_sequences", """
select p_partkey, list_sum(list_transform(range(0, 5), lambda i: 1.0 + i * (p_size - 1.0) / 4)) as linspace_sum,
  len(list_filter(range(1, p_size + 1), lambda v: v % 2 = 0))::bigint as n_even,
  case when p_size > 25 then 'big' else 'small' end as size_class from part
""")
def x9_x10_sequences(spark, sf):
    p = table(spark, sf, "part")
    lin = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.lit(1.0) + i * (F.col("p_size") - 1.0) / 4)
    return finish(p.select("p_partkey", X.array_sum(lin).alias("linspace_sum"),
                           F.size(F.filter(F.sequence(F.lit(1), F.col("p_size")), lambda v: v % 2 == 0)).cast("long").alias("n_even"),
                           F.when(F.col("p_size") > 25, "big").otherwise("small").alias("size_class")))
