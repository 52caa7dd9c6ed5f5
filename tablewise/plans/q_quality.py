"""Registered missing-data, duplicate and gate queries (M*, D*, F*).

The driver tables have no nulls; ``documents LEFT JOIN labels`` gives real
nulls (unlabelled documents), and a value-derived marker column gives
disguised-missing tokens.  Every query runs over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewise.operators import quality
from tablewise.plans.common import finish
from tablewise.plans.registry import register
from tablewise.sources.tables import table

TOKENS_SQL = "('', ' ', 'na', 'n/a', 'nan', 'null', 'none', 'unknown', '?', '-', '--', 'not available', 'not applicable')"

DOCS_SQL = """(select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
        case when d.n_chars < 200 then ' N/A ' else d.lang end as lang_marked,
        cast(l.quality as varchar) as quality_text
   from documents d left join labels l on d.doc_id = l.doc_id)"""


def docs_labeled(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    lb = table(spark, sf, "labels")
    j = d.join(lb, "doc_id", "left")
    return j.select("doc_id", "lang", "source", "n_chars", "quality", "toxic",
                    F.when(F.col("n_chars") < 200, F.lit(" N/A ")).otherwise(F.col("lang")).alias("lang_marked"),
                    F.col("quality").cast("string").alias("quality_text"))


DOC_COLS = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
            ("quality", "int"), ("toxic", "int"), ("lang_marked", "string"), ("quality_text", "string")]


def _m1_sql():
    parts = [f"""select '{c}' as "column", (count(*) - count({c}))::bigint as missing_count,
       round((count(*) - count({c})) * 100.0 / count(*), 4) as missing_pct, '{t}' as dtype,
       count(distinct {c})::bigint as unique_non_null from t""" for c, t in DOC_COLS]
    return f"with t as {DOCS_SQL}\n" + "\nunion all\n".join(parts)


@register("m1_real_missing_summary", _m1_sql())
def m1_real_missing_summary(spark, sf):
    return finish(quality.real_missing_summary(docs_labeled(spark, sf)))


TEXT_COLS = ["lang", "source", "lang_marked", "quality_text"]


def _m2_sql():
    parts = [f"select '{c}' as col, coalesce(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '') as tok from t"
             for c in TEXT_COLS]
    names = " union all ".join(f"select '{c}' as col" for c in TEXT_COLS)
    return f"""with t as {DOCS_SQL},
long as ({' union all '.join(parts)}),
pt as (select col, tok, count(*) as cnt from long where tok in {TOKENS_SQL} group by col, tok),
rk as (select *, row_number() over (partition by col order by cnt desc, tok) as r from pt),
agg as (select col, sum(cnt) as c, string_agg(case when r <= 5 then tok || ': ' || cnt end, '; ' order by r) as ex
        from rk group by col),
names as ({names})
select n.col as "column", coalesce(a.c, 0)::bigint as disguised_missing_count,
       round(coalesce(a.c, 0) * 100.0 / (select count(*) from t), 4) as disguised_missing_pct,
       coalesce(a.ex, '') as examples
from names n left join agg a on n.col = a.col"""


@register("m2_disguised_missing_summary", _m2_sql())
def m2_disguised_missing_summary(spark, sf):
    df = docs_labeled(spark, sf)
    return finish(quality.disguised_missing_summary(df, TEXT_COLS))


@register("m3_disguised_token_counts", f"""
with t as {DOCS_SQL},
long as (select 'lang_marked' as "column", lower(trim(lang_marked)) as token from t where lang_marked is not null
         union all select 'source', lower(trim(source)) from t where source is not null)
select "column", token, count(*)::bigint as "count" from long
where token in ('', 'na', 'n/a', 'null', 'none', 'unknown', '?', '-', '--') group by all
""")
def m3_disguised_token_counts(spark, sf):
    return finish(quality.disguised_token_counts(docs_labeled(spark, sf), ["lang_marked", "source"]))


@register("m4_disguised_examples", f"""
with t as {DOCS_SQL},
long as (select doc_id, 'lang_marked' as "column", lang_marked as value from t
         union all select doc_id, 'quality_text', quality_text from t),
f as (select *, row_number() over (partition by "column" order by doc_id) as r from long
      where coalesce(lower(trim(value)), '') in {TOKENS_SQL})
select doc_id, "column", value from f where r <= 50
""")
def m4_disguised_examples(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang_marked", "quality_text")
    return finish(quality.disguised_examples(df, "doc_id", ["lang_marked", "quality_text"]))


def _row_missing_sql():
    cols = [c for c, _ in DOC_COLS if c != "doc_id"]
    real = " + ".join(f"({c} is null)::int" for c in cols)
    disg = " + ".join(f"(coalesce(lower(trim({c})), '') in {TOKENS_SQL})::int" for c in TEXT_COLS)
    return f"""with t as {DOCS_SQL}
select doc_id as row_id, ({real})::bigint as real_missing, ({disg})::bigint as disguised_missing,
       ({real} + {disg})::bigint as total_missing
from t order by total_missing desc, row_id limit 20"""


@register("m5_missing_by_row", _row_missing_sql())
def m5_missing_by_row(spark, sf):
    return finish(quality.missing_by_row(docs_labeled(spark, sf), "doc_id", top=20))


def _m6_sql():
    cols = [c for c, _ in DOC_COLS]
    cells = " + ".join(f"({c} is null)::int" for c in cols)
    anyr = " or ".join(f"{c} is null" for c in cols)
    anyc = " + ".join(f"(max(({c} is null)::int))" for c in cols)
    return f"""with t as {DOCS_SQL}
select count(*)::bigint as rows, sum({cells})::bigint as null_cells,
       count(*) filter (where {anyr})::bigint as rows_with_null, ({anyc})::bigint as columns_with_null from t"""


@register("m6_table_missing_totals", _m6_sql())
def m6_table_missing_totals(spark, sf):
    return finish(quality.table_missing_totals(docs_labeled(spark, sf)))


def _m7_sql():
    cols = ["source", "quality", "lang_marked", "quality_text"]
    texts = {"source", "lang_marked", "quality_text"}
    parts = [f"""select lang as target_class, '{c}' as "column", ({c} is null)::int as r,
       {f"(coalesce(lower(trim({c})), '') in {TOKENS_SQL})::int" if c in texts else '0'} as d from t""" for c in cols]
    return f"""with t as {DOCS_SQL}, long as ({' union all '.join(parts)})
select target_class, "column", sum(r)::bigint as real_missing, sum(d)::bigint as disguised_missing,
       (sum(r) + sum(d))::bigint as total_missing from long group by all"""


@register("m7_missing_by_target", _m7_sql())
def m7_missing_by_target(spark, sf):
    df = docs_labeled(spark, sf).select("lang", "source", "quality", "lang_marked", "quality_text")
    return finish(quality.missing_by_target(df, "lang"))


@register("m8_sentinel_to_null", f"""
with t as {DOCS_SQL}
select doc_id, nullif(lang_marked, ' N/A ') as lang_marked from t
""")
def m8_sentinel_to_null(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang_marked")
    return finish(quality.sentinel_to_null(df, ["lang_marked"], " N/A "))


@register("m9_impute_mean", f"""
with t as {DOCS_SQL}
select doc_id, coalesce(quality, (select avg(quality) from t)) as quality,
       coalesce(toxic, (select avg(toxic) from t)) as toxic from t
""")
def m9_impute_mean(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double"))
    return finish(quality.impute_mean(df, ["quality", "toxic"]))


@register("m10_impute_mode", f"""
with t as {DOCS_SQL},
m as (select quality_text as v, count(*) as c from t where quality_text is not null group by 1)
select doc_id, coalesce(quality_text, (select v from m order by c desc, v limit 1)) as quality_text from t
""")
def m10_impute_mode(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "quality_text")
    return finish(quality.impute_mode(df, ["quality_text"]))


@register("m11_impute_group_mean", f"""
with t as {DOCS_SQL},
g as (select lang, avg(quality) as m from t group by lang)
select t.doc_id, t.lang, coalesce(t.quality, g.m, (select avg(quality) from t)) as quality
from t left join g on t.lang is not distinct from g.lang
""")
def m11_impute_group_mean(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", F.col("quality").cast("double"))
    return finish(quality.impute_group_mean(df, ["quality"], "lang"))


@register("m12_fill_label", f"""
with t as {DOCS_SQL}
select doc_id, coalesce(quality_text, 'Missing') as quality_text from t
""")
def m12_fill_label(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "quality_text")
    return finish(quality.fill_label(df, ["quality_text"]))


# ---------------------------------------------------------------- duplicates

LI_DUP = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]


@register("d1_exact_duplicates_summary", """
with g as (select count(*) as s from lineitem group by l_quantity, l_discount, l_tax, l_returnflag),
a as (select sum(s) as rows, count(*) as u, sum(case when s > 1 then s else 0 end) as d,
             count(*) filter (where s > 1) as grp, max(case when s > 1 then s end) as mx from g)
select coalesce(d, 0)::bigint as duplicated_rows, round(d * 100.0 / rows, 4) as duplicated_rows_pct,
       grp::bigint as duplicate_groups, coalesce(mx, 0)::bigint as largest_group,
       (rows - u)::bigint as surplus_duplicates, u::bigint as unique_rows from a
""")
def d1_exact_duplicates_summary(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_DUP)
    return finish(quality.exact_duplicates_summary(li))


@register("d2_document_copies", """
with g as (select count(*) as s from documents group by text)
select sum(s)::bigint - count(*)::bigint as surplus_duplicates,
       sum(case when s > 1 then s else 0 end)::bigint as duplicated_rows from g
""")
def d2_document_copies(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    s = quality.exact_duplicates_summary(docs)
    return finish(s.select("surplus_duplicates", "duplicated_rows"))


@register("d3_top_duplicate_groups", """
select l_quantity, l_discount, l_tax, l_returnflag, count(*)::bigint as group_size
from lineitem group by all having count(*) > 1
order by group_size desc, l_quantity nulls first, l_discount nulls first, l_tax nulls first, l_returnflag nulls first
limit 20
""")
def d3_top_duplicate_groups(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_DUP)
    return finish(quality.top_duplicate_groups(li, top=20))


@register("d4_duplicate_rows", """
with g as (select text, count(*) as group_size from documents group by text having count(*) > 1)
select d.doc_id, d.text, g.group_size::bigint as group_size from documents d join g on d.text is not distinct from g.text
""")
def d4_duplicate_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return finish(quality.duplicate_rows(docs, "doc_id", ["text"]))


SUBSETS = [["l_returnflag", "l_linestatus", "l_quantity"],
           ["l_quantity", "l_discount", "l_tax"],
           ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity"],
           ["not_a_column", "l_tax"]]


def _d5_sql():
    parts = []
    for sub in SUBSETS[:3]:
        cols = ", ".join(sub)
        parts.append(f"""select '{", ".join(sub)}' as subset_columns,
  (select coalesce(sum(case when s > 1 then s else 0 end), 0) from (select count(*) as s from lineitem group by {cols}))::bigint
  as duplicated_rows""")
    return f"""with u as ({' union all '.join(parts)})
select subset_columns, duplicated_rows, round(duplicated_rows * 100.0 / (select count(*) from lineitem), 4)
  as duplicated_rows_pct from u"""


@register("d5_duplicate_subsets", _d5_sql())
def d5_duplicate_subsets(spark, sf):
    return finish(quality.duplicate_subsets_summary(table(spark, sf, "lineitem"), SUBSETS))


@register("d7_duplicates_by_target", """
with g as (select l_linestatus, count(*) as s from lineitem group by l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)
select l_linestatus as target_class, sum(s)::bigint as rows,
       sum(case when s > 1 then s else 0 end)::bigint as duplicate_rows,
       round(sum(case when s > 1 then s else 0 end) * 100.0 / sum(s), 4) as duplicate_pct
from g group by 1
""")
def d7_duplicates_by_target(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_DUP, "l_linestatus")
    return finish(quality.duplicates_by_target(li, "l_linestatus"))


@register("f8_drop_all_null_columns", f"""
with t as {DOCS_SQL}
select doc_id, lang, quality from t
""")
def f8_drop_all_null_columns(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "quality", F.lit(None).cast("double").alias("empty"))
    return finish(quality.drop_null_columns(df, how="all"))


@register("f7_drop_any_null_columns", f"""
with t as {DOCS_SQL}
select doc_id, lang from t
""")
def f7_drop_any_null_columns(spark, sf):
    df = docs_labeled(spark, sf).select("doc_id", "lang", "quality")
    return finish(quality.drop_null_columns(df, how="any"))


@register("f9_validation_gates", f"""
with t as {DOCS_SQL}
select 'categorical' as "check", false as passed, 2::bigint as n_violations
union all select 'numeric', false, 1::bigint
union all select 'no_missing', (select count(*) filter (where quality is null or toxic is null) = 0 from t),
  (select (count(*) - count(quality)) + (count(*) - count(toxic)) from t)::bigint
""")
def f9_validation_gates(spark, sf):
    df = docs_labeled(spark, sf).select("lang", "quality", "toxic")
    return finish(quality.validate(df))


@register("f4_filter_below_mean", """
select o_orderkey, o_totalprice from orders where o_totalprice < (select avg(o_totalprice) from orders)
""")
def f4_filter_below_mean(spark, sf):
    o = table(spark, sf, "orders")
    m = o.select(F.avg("o_totalprice")).scalar()
    return finish(o.where(F.col("o_totalprice") < m).select("o_orderkey", "o_totalprice"))


@register("f1_f3_f5_filters", """
select o_orderstatus, count(*)::bigint as n,
       count(*) filter (where o_totalprice >= 100000)::bigint as n_large
from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and (o_orderstatus = 'F' or o_totalprice > 50000)
group by 1
""")
def f1_f3_f5_filters(spark, sf):
    o = table(spark, sf, "orders")
    f = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") &
                ((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 50000)))
    return finish(f.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                                 F.count_if(F.col("o_totalprice") >= 100000).alias("n_large")))


@register("f6_drop_null_rows", f"""
with t as {DOCS_SQL}
select doc_id, quality, toxic from t where quality is not null and toxic is not null
""")
def f6_drop_null_rows(spark, sf):
    return finish(docs_labeled(spark, sf).select("doc_id", "quality", "toxic").na.drop("any"))
