"""Missing data, duplicates and validation gates.

Per-column profiles are computed in one pass: either one aggregate with one
expression per column, or one unpivot + groupBy (for distinct counts, whose
exact form is one shuffle of (column, value) with map-side dedupe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.core import numeric_columns, pct, q, text_columns, unpivot

# Disguised-missing tokens (lower-cased, trimmed), as in the reference.
MISSING_TOKENS = ("", " ", "na", "n/a", "nan", "null", "none", "unknown", "?", "-", "--",
                  "not available", "not applicable")
# The strict token set of the earlier profiling script.
MISSING_TOKENS_STRICT = ("", "na", "n/a", "null", "none", "unknown", "?", "-", "--")


def _strip_lower(c: Column) -> Column:
    """Python ``str.strip().lower()``: strips all whitespace, not only spaces."""
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def _meta(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Small metadata table (one row per column name) built from the schema."""
    return df.sparkSession.createDataFrame(rows, schema)


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct non-null count per column: (column, distinct)."""
    cols = list(cols) if cols is not None else list(df.columns)
    long = unpivot(df, cols, [], "column", "value", "string")
    d = long.where(F.col("value").isNotNull()).select("column", "value").distinct().groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"))
    names = _meta(df, [(c,) for c in cols], "column string")
    return names.join(d, "column", "left").select("column", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def real_missing_summary(df: DataFrame) -> DataFrame:
    """Column, missing_count, missing_pct (4 dp), dtype, unique_non_null;
    ordered by count desc, name asc."""
    cols = list(df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(q(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    st = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    miss = agg.selectExpr("__n", f"stack({len(cols)}, {st}) as (column, missing_count)")
    types = _meta(df, [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")
    out = (miss.join(types, "column").join(distinct_counts(df, cols), "column")
               .select("column", "missing_count", pct(F.col("missing_count"), F.col("__n")).alias("missing_pct"),
                       "dtype", F.col("distinct").alias("unique_non_null")))
    return out.orderBy(F.desc("missing_count"), "column")


def disguised_missing_summary(df: DataFrame, cols: Sequence[str] | None = None,
                              tokens: Sequence[str] = MISSING_TOKENS, top: int = 5,
                              include_null: bool = True) -> DataFrame:
    """M2 (M3 with ``tokens=MISSING_TOKENS_STRICT, include_null=False``): per
    text column the count of values whose stripped lower form is a missing
    token; a true null counts as ``""`` when ``include_null``.  ``examples``
    lists the top tokens as ``"tok: n; ..."`` (count desc, token asc)."""
    cols = list(cols) if cols is not None else text_columns(df)
    n = F.count(F.lit(1))
    total = df.select(n.alias("n")).scalar()
    long = unpivot(df, cols, [], "column", "value", "string")
    norm = _strip_lower(F.col("value"))
    if include_null:
        norm = F.coalesce(norm, F.lit(""))
    flagged = long.select("column", norm.alias("tok")).where(F.col("tok").isin(list(tokens)))
    per_tok = flagged.groupBy("column", "tok").agg(n.alias("cnt"))
    w = Window.partitionBy("column").orderBy(F.desc("cnt"), "tok")
    ranked = per_tok.withColumn("_r", F.row_number().over(w))
    agg = ranked.groupBy("column").agg(
        F.sum("cnt").alias("disguised_missing_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_r") <= top, F.struct("_r", "tok", "cnt")))),
                                 lambda s: F.concat(s["tok"], F.lit(": "), s["cnt"].cast("string"))), "; ").alias("examples"))
    names = _meta(df, [(c,) for c in cols], "column string")
    out = names.join(agg, "column", "left").select(
        "column", F.coalesce("disguised_missing_count", F.lit(0)).alias("disguised_missing_count"),
        pct(F.coalesce("disguised_missing_count", F.lit(0)), total).alias("disguised_missing_pct"),
        F.coalesce("examples", F.lit("")).alias("examples"))
    return out.orderBy(F.desc("disguised_missing_count"), "column")


def disguised_token_counts(df: DataFrame, cols: Sequence[str] | None = None,
                           tokens: Sequence[str] = MISSING_TOKENS_STRICT) -> DataFrame:
    """M3: strict variant, true nulls excluded: (column, token, count)."""
    cols = list(cols) if cols is not None else text_columns(df)
    long = unpivot(df, cols, [], "column", "value", "string").where(F.col("value").isNotNull())
    return (long.select("column", _strip_lower(F.col("value")).alias("token"))
                .where(F.col("token").isin(list(tokens)))
                .groupBy("column", "token").agg(F.count(F.lit(1)).alias("count")))


def disguised_examples(df: DataFrame, row_id: str, cols: Sequence[str] | None = None,
                       tokens: Sequence[str] = MISSING_TOKENS, limit: int = 50) -> DataFrame:
    """M4: up to ``limit`` flagged rows per column (smallest row ids) with the original value.

    Top-k per column by row id: ``row_number`` over the flagged rows only."""
    cols = list(cols) if cols is not None else text_columns(df, exclude=[row_id])
    long = unpivot(df, cols, [row_id], "column", "value", "string")
    norm = F.coalesce(_strip_lower(F.col("value")), F.lit(""))
    flagged = long.where(norm.isin(list(tokens)))
    from tablewise.functions.topk import top_n_per_group
    return top_n_per_group(flagged, ["column"], [row_id], limit).drop("rank")


def _row_missing_exprs(df: DataFrame, tokens: Sequence[str], exclude: Sequence[str] = ()):
    cols = [c for c in df.columns if c not in exclude]
    real = sum((q(c).isNull().cast("int") for c in cols), F.lit(0))
    texts = [c for c in text_columns(df) if c not in exclude]
    disg = sum((F.coalesce(_strip_lower(q(c)), F.lit("")).isin(list(tokens)).cast("int") for c in texts), F.lit(0))
    return real, disg


def missing_by_row(df: DataFrame, row_id: str, top: int | None = 20, tokens: Sequence[str] = MISSING_TOKENS,
                   double_count: bool = True) -> DataFrame:
    """M5: per row real, disguised and total missing, ordered total desc, row id asc.

    ``double_count=True`` keeps the reference's rule (a null text cell counts as
    real and as disguised); ``False`` counts each cell once."""
    real, disg = _row_missing_exprs(df, tokens, exclude=[row_id])
    out = df.select(q(row_id).alias("row_id"), real.alias("real_missing"), disg.alias("disguised_missing"))
    if double_count:
        total = F.col("real_missing") + F.col("disguised_missing")
    else:
        texts = [c for c in text_columns(df) if c != row_id]
        overlap = sum((q(c).isNull().cast("int") for c in texts), F.lit(0))
        out = df.select(q(row_id).alias("row_id"), real.alias("real_missing"), disg.alias("disguised_missing"),
                        overlap.alias("_o"))
        total = F.col("real_missing") + F.col("disguised_missing") - F.col("_o")
    out = out.withColumn("total_missing", total).drop("_o")
    out = out.orderBy(F.desc("total_missing"), "row_id")
    return out.limit(top) if top else out


def table_missing_totals(df: DataFrame) -> DataFrame:
    """M6: null cells, rows with any null, columns with any null (one aggregate)."""
    cols = list(df.columns)
    cell = sum((q(c).isNull().cast("long") for c in cols), F.lit(0))
    any_row = F.greatest(*[q(c).isNull() for c in cols]) if len(cols) > 1 else q(cols[0]).isNull()
    agg = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(cell).alias("null_cells"),
                 F.count_if(any_row).alias("rows_with_null"),
                 *[F.max(q(c).isNull().cast("int")).alias(f"c{i}") for i, c in enumerate(cols)])
    any_col = sum((F.coalesce(F.col(f"c{i}"), F.lit(0)) for i in range(len(cols))), F.lit(0))
    return agg.select("rows", F.coalesce("null_cells", F.lit(0)).alias("null_cells"), "rows_with_null",
                      any_col.cast("long").alias("columns_with_null"))


def missing_by_target(df: DataFrame, target: str, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """M7: real, disguised and total missing per (target class, column)."""
    cols = [c for c in df.columns if c != target]
    texts = set(text_columns(df))
    exprs = []
    for c in cols:
        real = q(c).isNull().cast("int")
        disg = (F.coalesce(_strip_lower(q(c)), F.lit("")).isin(list(tokens)).cast("int")
                if c in texts else F.lit(0))
        exprs.append(F.struct(F.lit(c).alias("column"), real.alias("r"), disg.alias("d")))
    long = df.select(q(target).alias("target_class"), F.explode(F.array(*exprs)).alias("s"))
    return (long.groupBy("target_class", "s.column")
                .agg(F.sum("s.r").alias("real_missing"), F.sum("s.d").alias("disguised_missing"))
                .withColumn("total_missing", F.col("real_missing") + F.col("disguised_missing")))


# ------------------------------------------------------------ imputation

def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel: str = "Unknown") -> DataFrame:
    """M8: replace a sentinel value by null."""
    return df.select(*[F.nullif(q(c), F.lit(sentinel)).alias(c) if c in cols else q(c) for c in df.columns])


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M9: mean imputation; the means are scalar subqueries (one merged aggregate)."""
    means = {c: df.select(F.avg(q(c))).scalar() for c in cols}
    return df.select(*[F.coalesce(q(c), means[c]).alias(c) if c in cols else q(c) for c in df.columns])


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mode imputation, smallest of tied modes (``mode(deterministic)``)."""
    from tablewise.functions.core import mode_of
    modes = {c: mode_of(df, c) for c in cols}
    return df.select(*[F.coalesce(q(c), modes[c]).alias(c) if c in cols else q(c) for c in df.columns])


def impute_group_mean(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Mean per group, global mean as fallback (window partitioned by the group).

    The per-group mean is a groupBy joined back on the group key, so a hot
    group costs a skewed join key rather than one huge window partition."""
    gm = df.groupBy(q(by).alias("_g")).agg(*[F.avg(q(c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    glob = {c: df.select(F.avg(q(c))).scalar() for c in cols}
    j = df.join(gm, F.col("_g").eqNullSafe(q(by)), "left")
    return j.select(*[F.coalesce(q(c), F.col(f"_m{cols.index(c)}"), glob[c]).alias(c) if c in cols else q(c)
                      for c in df.columns])


def fill_label(df: DataFrame, cols: Sequence[str], label: str = "Missing") -> DataFrame:
    """Fill nulls of text columns with a label level."""
    return df.na.fill(label, subset=list(cols))


# ------------------------------------------------------------ duplicates

def _group_sizes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    # groupBy keys are null-safe (nulls group together), like pandas duplicated()
    return df.groupBy(*[q(c) for c in cols]).agg(F.count(F.lit(1)).alias("group_size"))


def exact_duplicates_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in duplicate groups (keep=False), pct (4 dp), groups, largest
    group, surplus rows (keep='first') and unique rows; zeros when none."""
    cols = list(cols) if cols is not None else list(df.columns)
    g = _group_sizes(df, cols)
    a = g.agg(F.sum("group_size").alias("rows"), F.count(F.lit(1)).alias("unique_rows"),
              F.sum(F.when(F.col("group_size") > 1, F.col("group_size")).otherwise(0)).alias("duplicated_rows"),
              F.count_if(F.col("group_size") > 1).alias("duplicate_groups"),
              F.max(F.when(F.col("group_size") > 1, F.col("group_size"))).alias("_mx"))
    return a.select(F.coalesce("duplicated_rows", F.lit(0)).cast("long").alias("duplicated_rows"),
                    F.coalesce(pct(F.col("duplicated_rows"), F.col("rows")), F.lit(0.0)).alias("duplicated_rows_pct"),
                    "duplicate_groups", F.coalesce("_mx", F.lit(0)).cast("long").alias("largest_group"),
                    (F.coalesce("rows", F.lit(0)) - F.col("unique_rows")).cast("long").alias("surplus_duplicates"),
                    "unique_rows")


def top_duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None, top: int = 20) -> DataFrame:
    """D3: largest duplicate groups (size desc, then values asc)."""
    cols = list(cols) if cols is not None else list(df.columns)
    g = _group_sizes(df, cols).where(F.col("group_size") > 1)
    return g.orderBy(F.desc("group_size"), *[q(c).asc_nulls_first() for c in cols]).limit(top)


def duplicate_rows(df: DataFrame, row_id: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Every row of a duplicate group, with its row id and group size.

    Groups of size > 1 are found by aggregation, then joined back null-safely;
    a hot group is a skewed join key, which AQE splits."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c != row_id]
    g = _group_sizes(df, cols).where(F.col("group_size") > 1)
    g = g.select(*[q(c).alias("_k" + str(i)) for i, c in enumerate(cols)], "group_size")
    cond = None
    for i, c in enumerate(cols):
        e = q(c).eqNullSafe(F.col("_k" + str(i)))
        cond = e if cond is None else cond & e
    return df.join(g, cond, "inner").select(*[q(c) for c in df.columns], "group_size")


def duplicate_subsets_summary(df: DataFrame, subsets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows in duplicate groups for each column subset (subsets with absent
    columns skipped); order duplicated rows desc."""
    total = df.select(F.count(F.lit(1))).scalar()
    parts = []
    for sub in subsets:
        if not set(sub).issubset(df.columns):
            continue
        g = _group_sizes(df, sub)
        parts.append(g.agg(F.sum(F.when(F.col("group_size") > 1, F.col("group_size")).otherwise(0)).alias("duplicated_rows"))
                      .select(F.lit(", ".join(sub)).alias("subset_columns"), "duplicated_rows"))
    if not parts:
        return df.sparkSession.createDataFrame([], "subset_columns string, duplicated_rows long, duplicated_rows_pct double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.select("subset_columns", F.col("duplicated_rows").cast("long").alias("duplicated_rows"),
                       pct(F.col("duplicated_rows"), total).alias("duplicated_rows_pct"))
               .orderBy(F.desc("duplicated_rows"), "subset_columns"))


def candidate_subset(df: DataFrame, max_cols: int = 5, max_distinct: int = 20) -> list[str]:
    """Generic subset = first <= max_cols columns with <= max_distinct
    distinct values (null counted as a value)."""
    cnt = distinct_counts(df).collect()
    nulls = df.agg(*[F.max(q(c).isNull().cast("int")).alias(c) for c in df.columns]).collect()[0].asDict()
    d = {r["column"]: r["distinct"] + (nulls[r["column"]] or 0) for r in cnt}
    return [c for c in df.columns if d[c] <= max_distinct][:max_cols]


def duplicates_by_target(df: DataFrame, target: str) -> DataFrame:
    """Rows, duplicate rows (keep=False over all columns) and pct per target class."""
    g = _group_sizes(df, list(df.columns))
    return (g.groupBy(q(target).alias("target_class"))
             .agg(F.sum("group_size").alias("rows"),
                  F.sum(F.when(F.col("group_size") > 1, F.col("group_size")).otherwise(0)).alias("duplicate_rows"))
             .withColumn("duplicate_pct", pct(F.col("duplicate_rows"), F.col("rows"))))


# ------------------------------------------------------------ gates

def drop_null_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """F7 (``how='any'``) / F8 (``how='all'``): drop columns with any / only nulls."""
    cols = list(df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0]
    n = row["__n"]
    keep = [c for i, c in enumerate(cols) if (row[f"c{i}"] == n if how == "any" else row[f"c{i}"] > 0)]
    return df.select(*[q(c) for c in keep])


def validate(df: DataFrame, checks: Sequence[str] = ("categorical", "numeric", "no_missing"),
             cols: Sequence[str] | None = None, raise_error: bool = False) -> DataFrame:
    """gates as a table (check, passed, n_violations).  ``categorical``:
    every column is text; ``numeric``: every column is numeric;
    ``no_missing``: no null cell."""
    cols = list(cols) if cols is not None else list(df.columns)
    sub = df.select(*[q(c) for c in cols])
    rows = []
    if "categorical" in checks:
        bad = [c for c in cols if c not in set(text_columns(sub))]
        rows.append(("categorical", len(bad) == 0, len(bad)))
    if "numeric" in checks:
        bad = [c for c in cols if c not in set(numeric_columns(sub))]
        rows.append(("numeric", len(bad) == 0, len(bad)))
    if "no_missing" in checks:
        n = sub.select(sum((q(c).isNull().cast("long") for c in cols), F.lit(0)).alias("m")).agg(F.sum("m")).collect()[0][0] or 0
        rows.append(("no_missing", n == 0, int(n)))
    if raise_error:
        failed = [r[0] for r in rows if not r[1]]
        if failed:
            raise ValueError(f"validation failed: {failed}")
    return df.sparkSession.createDataFrame(rows, "check string, passed boolean, n_violations long")


def require(condition: bool, message: str) -> None:
    """eager parameter precondition."""
    if not condition:
        raise ValueError(message)
