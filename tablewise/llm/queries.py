"""Registered queries of the training-data operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The word pattern in DuckDB's dialect.
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@register("op2_minhash_near_dedup", sql=f"""
with recursive w as (
  select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as v
  from documents),
s as (
  select doc_id, list_distinct(case when len(v) = 0 then [] when len(v) = 1 then v
         else list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1]) end) as s from w),
u as (select doc_id, unnest(s) as g from s),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select p.x, p.y from p join s a on a.doc_id = p.x join s b on b.doc_id = p.y
      where 100 * i >= 80 * (len(a.s) + len(b.s) - i)),
e as (select x, y from l union select y, x from l),
r(x, y) as (select doc_id, doc_id from documents union select r.x, e.y from r join e on r.y = e.x)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.c as component_id, s.doc_id = m.c as kept
from s join (select x, min(y) as c from r group by x) m on m.x = s.doc_id
""")
def op2(spark, sf_dir):
    from tablewise.llm.neardup import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


@register("op7_rlz_substring_dedup", sql=f"""
with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} as v from documents),
p as (select doc_id, len(v) as n, unnest(range(1, len(v) - 33)) as s, v from w where len(v) >= 35),
g as (select doc_id, s, md5(array_to_string(v[s:s + 34], ' ')) as h from p),
d as (select doc_id, s from g where h in (select h from g group by h having count(*) > 1)),
c as (select distinct doc_id, s + unnest(range(0, 35)) as i from d),
x as (select w.doc_id, any_value(w.v) as v, list(c.i) filter (c.i is not null) as gone from w left join c on c.doc_id = w.doc_id group by w.doc_id)
select doc_id, cast(len(v) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(v) + 1), lambda i: not coalesce(list_contains(gone, i), false)), lambda i: v[i]), ' '), '')) as kept_sha256
from x
""")
def op7(spark, sf_dir):
    from tablewise.llm.rlz import repeat_digests
    return repeat_digests(read(spark, sf_dir, "documents"), window=35)


@register("op6_adaptive_quality")
def op6(spark, sf_dir):
    from tablewise.llm.quality import quality_report
    return quality_report(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op10_source_mixing")
def op10(spark, sf_dir):
    from tablewise.llm.mixing import mix
    return mix(read(spark, sf_dir, "documents"))


@register("op1_secret_ownership", sql=r"""
with p(kind, k, pat) as (values
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]{24,}'), (3, 'owned', '[A-Za-z0-9+/_-]{20,}')),
t as (select doc_id, source, replace(coalesce(text, ''), chr(1), chr(2)) as text from documents),
m as (select doc_id, source, kind, k, pat, string_split(regexp_replace(text, pat, chr(1) || '\0' || chr(1), 'g'), chr(1)) as parts
      from t, p where regexp_matches(text, pat)),
u as (select *, unnest(range(2, len(parts) + 1, 2)) as i from m),
v as (select doc_id, source, kind, k, parts[i] as x, coalesce(list_sum(list_transform(parts[1:i - 1], lambda y: length(y))), 0)::bigint as a,
        case when kind = 0 then regexp_extract(parts[i], pat, 2) else parts[i] end as secret from u),
w as (select *, a + length(x) as b from v
      where case kind when 0 then length(secret) >= 6 when 1 then length(x) >= 20 when 2 then true
        else regexp_matches(secret, '[0-9]') and regexp_matches(secret, '[A-Za-z]') and len(list_distinct(string_split(secret, ''))) >= 10 end),
c as (select * from w where kind < 3 or not exists (
      select 1 from w as o where o.kind < 3 and o.doc_id = w.doc_id and o.a < w.b and w.a < o.b)),
f as (select secret, count(*) >= 3 as copied from (select distinct secret, source from c) group by secret),
s as (select c.*, copied from c join f using (secret)),
g as (select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
        string_agg(k || ':' || a || ':' || b, ',' order by a, kind) filter (kind < 3) as base,
        string_agg(k || ':' || a || ':' || b, ',' order by a, kind) filter (kind < 3 or not copied) as spans,
        count(*) filter (not copied) as n_live, count(*) filter (copied and kind < 3) as n_copied from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied
from documents d left join g on g.doc_id = d.doc_id
""")
def op1(spark, sf_dir):
    from tablewise.llm.secret_scan import KINDS, listed, scan_secrets
    out = scan_secrets(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"),
                      F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                      F.col("live").alias("n_live"), F.col("copied").alias("n_copied"))


@register("op4_fuzzy_line_dedup")
def op4(spark, sf_dir):
    from tablewise.llm.linededup import line_digests
    return line_digests(read(spark, sf_dir, "documents"))


@register("op9_benchmark_decontamination")
def op9(spark, sf_dir):
    from tablewise.llm.decontam import contaminated
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max("similarity").alias("similarity"), F.count(F.lit(1)).alias("n_passages"))


@register("op8_warc_zip", sql="""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha1(b) as h from p),
m as (select h, max(page_id) as head, count(*) as times from d where n >= 1000 group by h)
select d.page_id, cast(n as bigint) as payload_bytes, d.h as payload_digest,
  case when n >= 1000 and times > 1 and d.page_id <> head then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and times > 1 and d.page_id <> head then head end as refers_to
from d left join m on m.h = d.h
""")
def op8(spark, sf_dir):
    from tablewise.llm.warczip import round_trip
    return round_trip(read(spark, sf_dir, "pages"))


def _licence_sql() -> str:
    from tablewise.llm.licences import TEMPLATES, template_bigrams
    rows = ", ".join("('{}', [{}])".format(k, ", ".join(f"'{g}'" for g in template_bigrams(v))) for k, v in sorted(TEMPLATES.items()))
    low, high = "ceil(80.0 * len(g) / 120)", "floor(120.0 * len(g) / 80)"
    return rf"""
with t(name, g) as (values {rows}),
lim as (select min({low}) as lo, max({high}) as hi from t),
r as (select doc_id, unnest(list_distinct(string_split(coalesce(text, ''), chr(10))
        || regexp_split_to_array(coalesce(text, ''), '\n[\x20\x09]*\n') || [coalesce(text, '')])) as u from documents),
w as (select doc_id, string_split(trim(regexp_replace(lower(u), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), ' ') as w from r),
b as (select doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from w, lim
      where len(w) >= lo + 1),
c as (select doc_id, b from b, lim where len(b) between lo and hi),
m as (select doc_id, name, 2.0::double * len(list_intersect(b, g)) / (len(b) + len(g)) as d from c join t on len(b) between {low} and {high}),
k as (select doc_id, list(distinct name order by name) as licences, first(name order by d desc, name) as best, max(d) as dice from m where d * 100 >= 80 group by doc_id),
n as (select doc_id, count(*) as units from c group by doc_id)
select x.doc_id, coalesce(n.units, 0) as units, coalesce(array_to_string(k.licences, ','), '') as licences, k.best, k.dice
from documents x left join n on n.doc_id = x.doc_id left join k on k.doc_id = x.doc_id
"""


@register("op5_licence_dice", sql=_licence_sql())
def op5(spark, sf_dir):
    from tablewise.llm.licences import match_licences
    return match_licences(read(spark, sf_dir, "documents")).withColumn("licences", F.array_join("licences", ","))


@register("op3_preference_format", sql="""
with o as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
             max(case when role = 'assistant' then turn end) over (partition by conv_id) as stop from conversations where conv_id is not null),
t as (select * from o where turn <= stop),
e as (select conv_id, role, text, floor(conv_id / 1000) as k from t where turn = stop),
s as (select conv_id, coalesce(lag(role) over w, last(role) over f) as role, coalesce(lag(text) over w, last(text) over f) as text from e
      window w as (partition by k order by conv_id),
             f as (partition by k order by conv_id rows between unbounded preceding and unbounded following)),
r as (select conv_id, turn, stop, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as x, role, text from t),
j as (select r.*, s.role as role2, s.text as text2, r.role = s.role and r.text = s.text as same,
        '<|im_start|>' || s.role || chr(10) || s.text || '<|im_end|>' || chr(10) as y from r join s using (conv_id))
select conv_id as pair,
  cast(count(*) filter (turn < stop or same) as bigint) as n_common,
  coalesce(string_agg(x, '' order by turn) filter (turn < stop or same), '') as prompt,
  coalesce(string_agg(x, '') filter (turn = stop and not same), '') as chosen,
  coalesce(string_agg(y, '') filter (turn = stop and not same), '') as rejected,
  coalesce(string_agg('22:' || cast(length(x) as varchar), '') filter (turn = stop and not same), '') as chosen_mask,
  coalesce(string_agg('22:' || cast(length(y) as varchar), '') filter (turn = stop and not same), '') as rejected_mask
from j group by conv_id
""")
def op3(spark, sf_dir):
    from tablewise.llm.preference import conversations, format_preferences, swapped_endings
    out = format_preferences(swapped_endings(conversations(read(spark, sf_dir, "conversations"))))
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.withColumns({c: told(c) for c in ("chosen_mask", "rejected_mask")})


@register("op12_simhash_tiles")
def op12(spark, sf_dir):
    from tablewise.llm.simhash import simhash_groups
    return simhash_groups(read(spark, sf_dir, "documents"), shingle=3, radius=3)


#: Folder of the public tokenizers' vocabularies.
TOKENIZERS = "/opt/tokenizers"


@register("op13_tokenizer_alignment")
def op13(spark, sf_dir):
    from tablewise.llm.alignment import align
    return align(read(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")[0]


@register("op11_prefix_trie", sql=f"""
with o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
t as (select conv_id, md5(length(role) || ':' || role || text) as h, len({_WORDS.format("text")}) as words, role, turn from o),
n as (select conv_id, h, words, row_number() over (partition by conv_id order by turn nulls first, role, h) as n from t),
c as (select conv_id, conv_id - conv_id % 20 as base, xor(4294967295::ubigint, list_reduce(
        [4294967295::ubigint] || list_transform(string_split(cast(conv_id as varchar), ''), lambda x: unicode(x)::ubigint),
        lambda r, b: list_reduce([xor(r, b)] || list_value(0, 0, 0, 0, 0, 0, 0, 0)::ubigint[],
                                 lambda d, z: xor(d >> 1, 3988292384::ubigint * (d & 1::ubigint))))) % 4 as take
      from (select distinct conv_id from n)),
lent as (select c.conv_id, n.n as d, n.h, n.words from c join n on n.conv_id = c.base and n.n <= c.take),
k as (select conv_id, count(*) as k from lent group by conv_id),
turns as (select * from lent union all
  select n.conv_id, n.n - c.take + coalesce(k, 0), n.h, n.words from n join c using (conv_id) left join k using (conv_id) where n.n > c.take),
m as (select conv_id, d, md5(string_agg(h, '') over (partition by conv_id order by d)) as key, words,
        d = max(d) over (partition by conv_id) as ends from turns
      union all select conv_id, 0, '', 0, conv_id not in (select conv_id from turns) from c),
nodes as (select key, min(conv_id) as c, max(d) as d, count(*) as n, max(words) as w,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as e from m group by key),
up as (select x.key, p.key as parent from nodes x join m p on p.conv_id = x.c and p.d = x.d - 1),
kids as (select parent as key, count(*) as kids from up group by parent),
v as (select x.*, coalesce(kids, 0) as kids from nodes x left join kids using (key)),
s as (select a.key, sum(case when kids = 0 then 1 else 0 end) as leaves, sum((v.n - 1) * v.w) as saved
      from v join m a on a.conv_id = v.c and a.d <= v.d group by a.key)
select v.c as conv_id, cast(v.d as bigint) as depth, p.c as parent_conv_id, cast(v.n as bigint) as n_convs, cast(v.kids as bigint) as n_children,
  cast(s.leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, v.e as ends_sha256
from v join s using (key) left join up using (key) left join nodes p on p.key = up.parent
""")
def op11(spark, sf_dir):
    from tablewise.llm.trie import prefix_trie
    return prefix_trie(read(spark, sf_dir, "conversations")).drop("node")
