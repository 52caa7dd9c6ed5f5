"""Registered outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import outliers
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

COLS = ["value"]
LI = ["l_extendedprice", "l_quantity"]


def _lim(tbl, c):
    return (f"(select quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) from {tbl})",
            f"(select quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) from {tbl})")


def _iqr_summary_sql(tbl, cols, den_all=True):
    parts = []
    for c in cols:
        lo, hi = _lim(tbl, c)
        den = "count(*)" if den_all else f"count({c})"
        parts.append(f"""select '{c}' as "column", count({c})::bigint as "count", (count(*) - count({c}))::bigint as missing,
  quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as iqr,
  {lo} as lower_limit, {hi} as upper_limit,
  count(*) filter (where {c} < {lo} or {c} > {hi})::bigint as outlier_count,
  round(count(*) filter (where {c} < {lo} or {c} > {hi}) * 100.0 / {den}, 4) as outlier_pct,
  min({c})::double as "min", max({c})::double as "max", avg({c}) as mean, quantile_cont({c}, 0.5) as median from {tbl}""")
    return "\nunion all\n".join(parts)


@register("o1_iqr_summary", _iqr_summary_sql("events", COLS))
def o1_iqr_summary(spark, sf):
    return finish(outliers.iqr_summary(table(spark, sf, "events"), COLS))


@register("o2_iqr_summary_valid", _iqr_summary_sql("lineitem", LI, den_all=False))
def o2_iqr_summary_valid(spark, sf):
    return finish(outliers.iqr_summary(table(spark, sf, "lineitem"), LI, denominator="valid"))


@register("o3_iqr_flags", f"""
select event_id, coalesce(value < {_lim('events', 'value')[0]} or value > {_lim('events', 'value')[1]}, false)
  as value_outlier_iqr from events
""")
def o3_iqr_flags(spark, sf):
    return finish(outliers.iqr_flags(table(spark, sf, "events"), COLS, keep=["event_id"]))


@register("o4_outlying_values", f"""
select event_id, value from events
where value < {_lim('events', 'value')[0]} or value > {_lim('events', 'value')[1]}
""")
def o4_outlying_values(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return finish(outliers.outlying_values(e, "value"))


ZS = """(abs((value - (select avg(value) from events)) / (select stddev_samp(value) from events)) > 3.0)"""
MAD = """(abs(0.6745 * (value - (select median(value) from events)) / (select mad(value) from events)) > 3.5)"""


@register("o5_zscore_summary", f"""
select 'value' as "column", 3.0 as zscore_threshold, count(*) filter (where {ZS})::bigint as n_outliers,
  round(count(*) filter (where {ZS}) * 100.0 / count(*), 4) as pct_outliers from events
""")
def o5_zscore_summary(spark, sf):
    e = table(spark, sf, "events")
    f = outliers.zscore_flags(e, COLS)
    return finish(outliers.flag_summary(f, COLS, "_zscore_outlier", 3.0, "zscore_threshold"))


@register("o6_mad_summary", f"""
select 'value' as "column", 3.5 as mad_threshold, count(*) filter (where {MAD})::bigint as n_outliers,
  round(count(*) filter (where {MAD}) * 100.0 / count(*), 4) as pct_outliers,
  (select median(value) from events) as median, (select mad(value) from events) as mad from events
""")
def o6_mad_summary(spark, sf):
    e = table(spark, sf, "events")
    st = outliers.mad_stats(e, COLS)
    f = outliers.mad_flags(e, COLS, stats=st)
    s = outliers.flag_summary(f, COLS, "_mad_outlier", 3.5, "mad_threshold")
    return finish(s.join(st, "column"))


@register("o7_plausible_range", """
select 'l_quantity' as "column", 1.0 as min_expected, 45.0 as max_expected, min(l_quantity) as observed_min,
  max(l_quantity) as observed_max, count(*) filter (where l_quantity < 1)::bigint as below,
  count(*) filter (where l_quantity > 45)::bigint as above,
  count(*) filter (where l_quantity < 1 or l_quantity > 45)::bigint as total_out,
  round(count(*) filter (where l_quantity < 1 or l_quantity > 45) * 100.0 / count(*), 4) as pct_out from lineitem
union all
select 'l_discount', 0.0, 0.08, min(l_discount), max(l_discount), count(*) filter (where l_discount < 0)::bigint,
  count(*) filter (where l_discount > 0.08)::bigint, count(*) filter (where l_discount < 0 or l_discount > 0.08)::bigint,
  round(count(*) filter (where l_discount < 0 or l_discount > 0.08) * 100.0 / count(*), 4) from lineitem
""")
def o7_plausible_range(spark, sf):
    rules = {"l_quantity": (1, 45), "l_discount": (0, 0.08), "absent": (0, 1)}
    return finish(outliers.plausible_range_check(table(spark, sf, "lineitem"), rules))


def _li_flag(c):
    lo, hi = _lim("lineitem", c)
    return f"coalesce({c} < {lo} or {c} > {hi}, false)::int"


@register("o8_row_outlier_distribution", f"""
with c as (select ({' + '.join(_li_flag(c) for c in ['l_extendedprice', 'l_quantity', 'l_discount'])}) as n_outliers
           from lineitem)
select n_outliers, count(*)::bigint as rows, count(*) * 100.0 / (select count(*) from c) as pct from c group by 1
""")
def o8_row_outlier_distribution(spark, sf):
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    li = table(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    fl = outliers.iqr_flags(li, cols, keep=["rid"])
    counts = outliers.row_outlier_counts(fl, [c + "_outlier_iqr" for c in cols], "rid")
    return finish(outliers.row_outlier_distribution(counts).withColumn("n_outliers", F.col("n_outliers").cast("long")))


@register("o9_top_outlier_rows", f"""
select l_orderkey * 10 + l_linenumber as rid,
  ({' + '.join(_li_flag(c) for c in ['l_extendedprice', 'l_quantity'])})::bigint as n_outliers
from lineitem order by n_outliers desc, rid limit 100
""")
def o9_top_outlier_rows(spark, sf):
    cols = ["l_extendedprice", "l_quantity"]
    li = table(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    fl = outliers.iqr_flags(li, cols, keep=["rid"])
    counts = outliers.row_outlier_counts(fl, [c + "_outlier_iqr" for c in cols], "rid")
    return finish(outliers.top_outlier_rows(counts, "rid", 100))


@register("o10_outlier_audit", f"""
select event_id, coalesce(value < {_lim('events', 'value')[0]} or value > {_lim('events', 'value')[1]}, false) as value_outlier_iqr,
  coalesce({ZS}, false) as value_zscore_outlier, coalesce({MAD}, false) as value_mad_outlier from events
""")
def o10_outlier_audit(spark, sf):
    return finish(outliers.outlier_audit(table(spark, sf, "events"), COLS, "event_id"))


@register("o11_outliers_by_target", f"""
with f as (select event_type, coalesce(value < {_lim('events', 'value')[0]} or value > {_lim('events', 'value')[1]}, false)::int
  as o from events)
select 'value' as variable, event_type as target_class, round((1 - avg(o)) * 100, 4) as pct_not_outlier,
  round(avg(o) * 100, 4) as pct_outlier_iqr from f group by 2
""")
def o11_outliers_by_target(spark, sf):
    return finish(outliers.outliers_by_target(table(spark, sf, "events"), COLS, "event_type"))


@register("o12_histogram_outlier_segments", f"""
with r as (select min(value) as lo, max(value) as hi from events),
l as (select {_lim('events', 'value')[0]} as ll, {_lim('events', 'value')[1]} as ul),
c as (select least(floor((value - lo) / ((hi - lo) / 30)), 29)::int as bin, count(*) as n,
        count(*) filter (where value < ll or value > ul) as o from events, r, l group by 1),
g as (select unnest(range(0, 30)) as bin)
select 'value' as variable, g.bin::int as bin, lo + g.bin * (hi - lo) / 30 as lower, lo + (g.bin + 1) * (hi - lo) / 30 as upper,
  coalesce(n, 0)::bigint as "count", coalesce(o, 0)::bigint as outliers,
  lo + g.bin * (hi - lo) / 30 < ll as below_lower_limit, lo + (g.bin + 1) * (hi - lo) / 30 > ul as above_upper_limit
from g cross join r cross join l left join c using (bin)
""")
def o12_histogram_outlier_segments(spark, sf):
    return finish(outliers.histogram_outlier_segments(table(spark, sf, "events"), "value", 30))
