"""Registered plot-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import plotdata
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table


def _hist_sql(tbl, col, bins, by=None):
    g = f"{by}, " if by else ""
    return f"""(with r as (select min({col}) as lo, max({col}) as hi from {tbl}),
c as (select {g}least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1})::int as bin, count(*) as n
      from {tbl}, r where {col} is not null group by all),
k as ({f"select distinct {by} from c" if by else "select 1 as one"}),
grid as (select {g}unnest(range(0, {bins})) as bin from k)
select {g}'{col}' as variable, grid.bin::int as bin, lo + grid.bin * (hi - lo) / {bins} as lower,
  lo + (grid.bin + 1) * (hi - lo) / {bins} as upper, coalesce(n, 0)::bigint as "count"
from grid cross join r left join c using ({g}bin))"""


@register("v1_histogram", "select * from " + _hist_sql("lineitem", "l_extendedprice", 10)
          + " union all select * from " + _hist_sql("events", "value", 20).replace("from events, r", "from events, r"))
def v1_histogram(spark, sf):
    a = plotdata.histogram(table(spark, sf, "lineitem"), ["l_extendedprice"], 10)
    b = plotdata.histogram(table(spark, sf, "events"), ["value"], 20)
    return finish(a.unionByName(b))


@register("v10_faceted_histogram", "select * from " + _hist_sql("lineitem", "l_quantity", 5, "l_returnflag"))
def v10_faceted_histogram(spark, sf):
    return finish(plotdata.histogram(table(spark, sf, "lineitem"), ["l_quantity"], 5, by=["l_returnflag"]))


@register("v2_ordinal_histogram", """
with lv as (select * from (values (1, '5-LOW'), (2, '4-NOT SPECIFIED'), (3, '3-MEDIUM'), (4, '2-HIGH'), (5, '1-URGENT'),
                          (6, '0-NONE')) v(position, level)),
c as (select o_orderpriority as level, count(*) as n from orders group by 1)
select (position - 1)::int as position, level, coalesce(n, 0)::bigint as "count" from lv left join c using (level)
""")
def v2_ordinal_histogram(spark, sf):
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT", "0-NONE"]
    return finish(plotdata.ordinal_histogram(table(spark, sf, "orders"), "o_orderpriority", order))


@register("v3_category_shares", """
select coalesce(cast(l.quality as varchar), 'Missing') as category, count(*)::bigint as "count",
  count(*) * 100.0 / (select count(*) from documents) as pct
from documents d left join labels l on d.doc_id = l.doc_id group by 1
""")
def v3_category_shares(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return finish(plotdata.category_shares(d, "quality"))


@register("v4_box_stats", """
with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
                  quantile_cont(value, 0.75) as q3 from events group by 1)
select e.event_type, 'value' as variable, q1, median, q3,
  min(value) filter (where value >= q1 - 1.5 * (q3 - q1)) as whisker_low,
  max(value) filter (where value <= q3 + 1.5 * (q3 - q1)) as whisker_high,
  count(*) filter (where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1))::bigint as fliers
from events e join q using (event_type) group by all
""")
def v4_box_stats(spark, sf):
    return finish(plotdata.box_stats(table(spark, sf, "events"), "value", by=["event_type"]))


@register("v5_scatter_sample", """
with s as (select *, ((o_orderkey + 42) * 2654435761) % 1000003 / 1000003.0 as h from orders order by h, o_orderkey limit 200)
select o_orderkey as row_id, 'o_totalprice' as x_var, 'o_custkey' as y_var, o_totalprice::double as x,
  o_custkey::double as y, o_orderstatus as hue from s
""")
def v5_scatter_sample(spark, sf):
    o = table(spark, sf, "orders")
    return finish(plotdata.scatter_sample(o, [("o_totalprice", "o_custkey")], "o_orderkey", 200, hue="o_orderstatus",
                                          kind="arith"))


@register("v6_hexbin_counts", """
with r as (select min(l_quantity) as ax, max(l_quantity) as bx, min(l_extendedprice) as ay, max(l_extendedprice) as by_
           from lineitem)
select least(floor((l_quantity - ax) / ((bx - ax) / 20)), 19)::int as bin_x,
       least(floor((l_extendedprice - ay) / ((by_ - ay) / 20)), 19)::int as bin_y, count(*)::bigint as "count"
from lineitem, r group by all
""")
def v6_hexbin_counts(spark, sf):
    return finish(plotdata.hexbin_counts(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20))


@register("v7_kde", """
with s as (select count(value) as n, stddev_samp(value) as sd, min(value) as lo, max(value) as hi from events),
s2 as (select *, sd * power(n, -0.2) as h from s),
g as (select i, lo - 3 * h + i * ((hi + 3 * h) - (lo - 3 * h)) / 199 as x, n, h from s2, (select unnest(range(0, 200)) as i))
select g.i::int as i, x, sum(exp(-0.5 * power((x - value) / h, 2)) / (h * sqrt(2 * pi()))) / n as density
from events, g where value is not null group by g.i, x, n
""")
def v7_kde(spark, sf):
    return finish(plotdata.kde_1d(table(spark, sf, "events"), "value", 200))


@register("v7_kde_2d", """
with r as (select c_acctbal::double as u, (c_custkey % 97)::double as v from customer where c_acctbal is not null),
s as (select count(*) as n, stddev_samp(u) * power(count(*), -1.0 / 6) as hx, stddev_samp(v) * power(count(*), -1.0 / 6) as hy,
        min(u) as ulo, max(u) as uhi, min(v) as vlo, max(v) as vhi from r),
g as (select i, j, ulo - 3 * hx + i * ((uhi + 3 * hx) - (ulo - 3 * hx)) / 29 as x, vlo - 3 * hy + j * ((vhi + 3 * hy) - (vlo - 3 * hy)) / 29 as y, n, hx, hy
      from s, (select unnest(range(0, 30)) as i), (select unnest(range(0, 30)) as j))
select i::int as i, j::int as j, x, y, sum(exp(-0.5 * (power((x - u) / hx, 2) + power((y - v) / hy, 2)))) / (hx * hy * 2 * pi()) / n as density
from r, g group by i, j, x, y, n, hx, hy
""")
def v7_kde_2d(spark, sf):
    c = table(spark, sf, "customer").withColumn("v", F.col("c_custkey") % 97)
    return finish(plotdata.kde_2d(c, "c_acctbal", "v", 30))


@register("v11_counts_by_hue", """
select event_type as x, cast(user_id % 3 as bigint) as hue, count(*)::bigint as "count",
  list_position(['view', 'click', 'purchase'], event_type) as position
from events where event_type in ('view', 'click', 'purchase') group by all
""")
def v11_counts_by_hue(spark, sf):
    e = table(spark, sf, "events").withColumn("hue", F.col("user_id") % 3)
    return finish(plotdata.counts_by_hue(e, "event_type", "hue", ["view", "click", "purchase"]))


@register("v12_regression_line", """
select regr_slope(l_extendedprice, l_quantity) as slope, regr_intercept(l_extendedprice, l_quantity) as intercept,
  regr_r2(l_extendedprice, l_quantity) as r2 from lineitem
""")
def v12_regression_line(spark, sf):
    return finish(plotdata.regression_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@register("v13_pca_scatter")
def v13_pca_scatter(spark, sf):
    from tablewise.operators import cluster
    proj, _ = cluster.pca(table(spark, sf, "embeddings"), "embedding", 2, keep=["vec_id", "label"])
    return finish(plotdata.scatter_sample(proj, [("pc1", "pc2")], "vec_id", 300, hue="label"))


@register("v8_pair_grid_histograms", "select * from " + _hist_sql("lineitem", "l_quantity", 10, "l_linestatus")
          + " union all select * from " + _hist_sql("lineitem", "l_discount", 10, "l_linestatus").replace(
              "with r as (select min(l_discount) as lo, max(l_discount) as hi from lineitem)",
              "with r as (select min(l_discount) as lo, max(l_discount) as hi from lineitem)"))
def v8_pair_grid_histograms(spark, sf):
    li = table(spark, sf, "lineitem")
    return finish(plotdata.histogram(li, ["l_quantity", "l_discount"], 10, by=["l_linestatus"]))
