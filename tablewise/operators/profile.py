"""Column profiling.

Numeric summaries are one aggregate over all columns (moments, min/max) plus
one exact-quantile job (``functions.quantiles``); categorical summaries are
one unpivot + ``groupBy(column, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import (display_value, kurt_unbiased, numeric_columns, pct, q,
                                      skew_unbiased, std_sample, text_columns, unpivot)
from tablewise.functions.topk import top_n_per_group
from tablewise.functions.quantiles import quantile_table
from tablewise.operators.quality import distinct_counts


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, skip_empty: bool = True) -> DataFrame:
    """R2: count, missing, missing_pct, mean, median, std (ddof=1), min, q1, q3,
    max, iqr, skew (G1), kurtosis (G2), distinct per numeric column.
    Quantiles are exact with linear interpolation."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = unpivot(df, cols, [], "variable", "value")
    moments = [
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.count(F.lit(1)).alias("_rows"), F.avg("value").alias("mean"),
        std_sample(F.col("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        skew_unbiased(F.col("value")).alias("skew"), kurt_unbiased(F.col("value")).alias("kurtosis"),
        F.count_distinct("value").alias("distinct")]
    out = quantile_table(long, ["variable"], "value", (0.25, 0.5, 0.75), ("q1", "median", "q3"), moments, few_groups=True)
    if skip_empty:
        out = out.where(F.col("count") > 0)
    return out.select("variable", "count", "missing", pct(F.col("missing"), F.col("_rows")).alias("missing_pct"),
                      "mean", "median", "std", "min", "q1", "q3", "max",
                      (F.col("q3") - F.col("q1")).alias("iqr"), "skew", "kurtosis", "distinct")


def moment_summary(df: DataFrame, cols: Sequence[str] | None = None, dp: int = 4) -> DataFrame:
    """Mean, median, std, skew, kurtosis rounded to ``dp``."""
    d = describe_numeric(df, cols)
    return d.select("variable", *[F.round(c, dp).alias(c) for c in ("mean", "median", "std", "skew", "kurtosis")])


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count (non-null), distinct, top value, top frequency and its pct of
    non-null rows; ties on frequency go to the smallest value."""
    cols = list(cols) if cols is not None else text_columns(df)
    long = unpivot(df, cols, [], "variable", "value", "string").where(F.col("value").isNotNull())
    vc = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("freq"))
    return (vc.groupBy("variable")
              .agg(F.sum("freq").alias("count"), F.count(F.lit(1)).alias("distinct"),
                   F.min_by("value", F.struct(-F.col("freq"), F.col("value"))).alias("top"),
                   F.max("freq").alias("top_freq"))
              .withColumn("top_pct", pct(F.col("top_freq"), F.col("count"))))


def value_counts(df: DataFrame, col: str, dropna: bool = True, normalize: bool = False,
                 top: int | None = None) -> DataFrame:
    """Counts per value, count desc then value asc; optional null
    bucket, share in percent (over counted rows) and top-k."""
    base = df if not dropna else df.where(q(col).isNotNull())
    vc = base.groupBy(q(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        tot = base.select(F.count(F.lit(1))).scalar()
        vc = vc.withColumn("pct", F.col("count") * 100.0 / tot)
    vc = vc.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return vc.limit(top) if top else vc


def column_roles(df: DataFrame, max_distinct_categorical: int = 30) -> DataFrame:
    """Role flags per column: numeric, text, boolean, categorical (text,
    boolean, or numeric with <= max distinct), suspicious text (0 < distinct < rows)."""
    d = {r["column"]: r["distinct"] for r in distinct_counts(df).collect()}
    n = df.count()
    rows = []
    for f in df.schema.fields:
        num = isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType))
        txt = isinstance(f.dataType, T.StringType)
        boo = isinstance(f.dataType, T.BooleanType)
        cat = txt or boo or (num and d[f.name] <= max_distinct_categorical)
        rows.append((f.name, num, txt, boo, cat, bool(txt and 0 < d[f.name] < n), d[f.name]))
    return df.sparkSession.createDataFrame(
        rows, "column string, numeric boolean, text boolean, boolean boolean, categorical boolean, "
              "suspicious_text boolean, distinct long")


def binary_ordinal_roles(df: DataFrame, ordinal_hints: Sequence[str] = ()) -> DataFrame:
    """Numeric / binary (exactly 2 distinct) / ordinal (hinted) / categorical."""
    d = {r["column"]: r["distinct"] for r in distinct_counts(df).collect()}
    nums = set(numeric_columns(df))
    rows = []
    for c in df.columns:
        if c in ordinal_hints:
            role = "ordinal"
        elif d[c] == 2:
            role = "binary"
        elif c in nums:
            role = "numeric"
        else:
            role = "categorical"
        rows.append((c, role))
    return df.sparkSession.createDataFrame(rows, "column string, role string")


# Analytic type labels.
TYPE_LABELS = {
    "binary": "binária", "binary_cat": "categórica binária", "ordinal": "categórica ordinal",
    "continuous": "numérica contínua", "discrete": "numérica discreta / possivelmente categórica",
    "nominal": "categórica nominal/ordinal", "high_card": "texto / categórica de alta cardinalidade",
    "unknown": "não determinado",
}


def analytic_types(df: DataFrame, max_distinct: int = 15, hints: dict[str, str] | None = None) -> DataFrame:
    """Analytic type per column: name hints (a parameter table of
    name -> type key) first, then boolean / numeric / text by distinct count
    (<= 2 binary, <= max_distinct discrete or nominal, else continuous / high cardinality)."""
    hints = {k.lower(): v for k, v in (hints or {}).items()}
    d = {r["column"]: r["distinct"] for r in distinct_counts(df).collect()}
    rows = []
    for f in df.schema.fields:
        n = d[f.name]
        key = hints.get(f.name.lower())
        if key is None:
            if isinstance(f.dataType, T.BooleanType):
                key = "binary"
            elif f.name in numeric_columns(df):
                key = "binary" if n <= 2 else ("discrete" if n <= max_distinct else "continuous")
            elif isinstance(f.dataType, T.StringType):
                key = "binary" if n <= 2 else ("nominal" if n <= max_distinct else "high_card")
            else:
                key = "unknown"
        rows.append((f.name, TYPE_LABELS[key], n))
    return df.sparkSession.createDataFrame(rows, "column string, analytic_type string, distinct long")


def mixed_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """For raw text columns, the set of value kinds found (int, float,
    bool, text); a column with more than one kind is mixed.  Runs over every
    value (no sample), one aggregate per column set."""
    cols = list(cols) if cols is not None else text_columns(df)
    long = unpivot(df, cols, [], "column", "value", "string").where(F.col("value").isNotNull())
    v = F.trim(F.col("value"))
    kind = (F.when(v.rlike(r"^[+-]?\d+$"), "int")
             .when(v.try_cast("double").isNotNull() & ~F.lower(v).isin("nan", "inf", "-inf", "infinity"), "float")
             .when(F.lower(v).isin("true", "false"), "bool").otherwise("str"))
    kinds = long.select("column", kind.alias("kind")).distinct()
    return (kinds.groupBy("column").agg(F.array_sort(F.collect_list("kind")).alias("kinds"))
                 .withColumn("mixed", F.size("kinds") > 1))


def constant_columns(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Per column the dominant value share (nulls count as a value);
    flag constant (one value) and quasi-constant (share >= threshold)."""
    cols = list(df.columns)
    long = unpivot(df, cols, [], "column", "value", "string")
    vc = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    g = vc.groupBy("column").agg(F.count(F.lit(1)).alias("n_values"), F.sum("freq").alias("rows"),
                                 F.max("freq").alias("top_freq"),
                                 F.min_by("value", F.struct(-F.col("freq"), F.col("value"))).alias("top_value"))
    share = F.col("top_freq") / F.col("rows")
    return g.select("column", "n_values", share.alias("top_share"), display_value(F.col("top_value")).alias("top_value"),
                    (F.col("n_values") == 1).alias("constant"),
                    ((F.col("n_values") > 1) & (share >= threshold)).alias("quasi_constant"))


def high_cardinality(df: DataFrame, ratio: float = 0.9, absolute: int = 100) -> DataFrame:
    """Columns with distinct >= absolute or distinct/rows >= ratio."""
    n = df.select(F.count(F.lit(1))).scalar()
    d = distinct_counts(df)
    r = F.col("distinct") / n
    return d.select("column", "distinct", r.alias("ratio")).where((F.col("distinct") >= absolute) | (r >= ratio))


def extreme_values(df: DataFrame, cols: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """The n smallest and n largest values per numeric column as ascending lists.

    Two rank limits, each of which keeps n rows per column and task before the shuffle."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = unpivot(df, cols, [], "variable", "value").where(F.col("value").isNotNull()).select("variable", "value")
    sides = [top_n_per_group(long, ["variable"], ["value"], n, asc).groupBy("variable").agg(
        F.array_sort(F.collect_list("value")).alias(name)) for name, asc in (("smallest", True), ("largest", False))]
    return sides[0].join(sides[1], "variable")


def describe_variable(df: DataFrame, col: str, order_col: str, max_values: int = 15) -> DataFrame:
    """Per-variable description: dtype, missing, missing pct, distinct,
    mode (smallest tied), first-seen examples; numeric columns add quartiles,
    text columns add the top values with counts and pct."""
    f = df.schema[col]
    tot = F.count(F.lit(1))
    from tablewise.functions.core import mode_of
    base = df.agg(tot.alias("total"), F.count_if(q(col).isNull()).alias("missing"),
                  F.count_distinct(q(col)).alias("distinct")).withColumn("mode", mode_of(df, col).cast("string"))
    firsts = (df.where(q(col).isNotNull()).groupBy(q(col).cast("string").alias("v"))
                .agg(F.min(q(order_col)).alias("_f")).withColumn("_g", F.lit(0)))
    # first-seen examples: the rank limit keeps <= max_values levels per task
    ex = top_n_per_group(firsts, ["_g"], ["_f", "v"], max_values).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "v"))), lambda s: s["v"]).alias("ex"))
    out = base.withColumn("examples", ex.select("ex").scalar())
    out = out.select(F.lit(col).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), "total", "missing",
                     F.round(F.col("missing") * 100.0 / F.col("total"), 2).alias("missing_pct"), "distinct", "mode", "examples")
    if f.name in numeric_columns(df):
        x = q(col).cast("double")
        long = df.select(F.lit(col).alias("variable"), x.alias("value"))
        told = quantile_table(long, ["variable"], "value", (0.25, 0.5, 0.75), ("q1", "median", "q3"), [
            F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"), F.stddev_samp("value").alias("std")],
            few_groups=True)
        row = told.select(F.struct("min", "q1", "median", "mean", "q3", "max", "std")).scalar()
        out = out.withColumns({c: F.round(row[c], 4) for c in ("min", "q1", "median", "mean", "q3", "max", "std")})
    else:
        vc = (df.groupBy(display_value(q(col)).alias("v")).agg(F.count(F.lit(1)).alias("c"))
                .withColumn("_g", F.lit(0)).withColumn("_nc", -F.col("c")))
        top = top_n_per_group(vc, ["_g"], ["_nc", "v"], max_values).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "v", "c"))),
                        lambda s: F.struct(s["v"].alias("value"), s["c"].alias("count"))).alias("t"))
        out = out.withColumn("top_values", top.select("t").scalar())
    return out


def variable_findings(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Rule-based findings of variables whose analytic type is given
    (``numeric``, ``binary``, ``ordinal`` or ``nominal``): (variable, rule, a, b).

    missing (count, pct) or complete; dominant_class (pct of all rows) of a
    binary variable of two levels; ordinal; range (min, max) and asymmetry
    (mean, median; they differ by more than 15 % of the mean) of a numeric one;
    constant, and for columns that are not numbers low_cardinality (2 to 5
    levels) and high_cardinality (more than 50), with the number of levels."""
    plain = set(numeric_columns(df))
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.agg(*(F.struct(F.count_if(q(c).isNull()).alias("missing"), F.count_distinct(q(c)).alias("levels")).alias(c) for c in kinds))
    shape = counts.select(F.explode(F.array(*(F.struct(
        F.lit(c).alias("variable"), F.lit(k).alias("kind"), F.lit(c in plain).alias("number"), q(c)["missing"].alias("missing"),
        q(c)["levels"].alias("levels")) for c, k in kinds.items()))).alias("s")).select("s.*")
    continuous = [c for c, k in kinds.items() if k == "numeric"]
    binary = [c for c, k in kinds.items() if k == "binary"]
    for names, make in ((continuous, _continuous), (binary, _dominant)):
        if names:
            shape = shape.join(make(df, names), "variable", "left")
        else:
            shape = shape.withColumns({c: F.lit(None).cast("double") for c in (_MEASURES if make is _continuous else ("top",))})
    rule = lambda cond, name, a=F.lit(None), b=F.lit(None): F.when(cond, F.struct(
        F.lit(name).alias("rule"), a.cast("double").alias("a"), b.cast("double").alias("b")))
    m, med = F.col("mean"), F.col("median")
    rules = F.array(
        rule(F.col("missing") == 0, "complete"),
        rule(F.col("missing") > 0, "missing", F.col("missing"), F.col("missing") * 100.0 / total),
        rule((F.col("kind") == "binary") & (F.col("levels") == 2), "dominant_class", F.col("top") * 100.0 / total),
        rule(F.col("kind") == "ordinal", "ordinal"),
        rule(F.col("low").isNotNull(), "range", F.col("low"), F.col("high")),
        rule(F.when(m != 0, F.abs(m - med) > 0.15 * F.abs(m)).otherwise(F.abs(med) > 0), "asymmetry", m, med),
        rule(F.col("levels") == 1, "constant", F.col("levels")),
        rule(~F.col("number") & F.col("levels").between(2, 5), "low_cardinality", F.col("levels")),
        rule(~F.col("number") & (F.col("levels") > 50), "high_cardinality", F.col("levels")))
    return shape.select("variable", F.explode(F.array_compact(rules)).alias("r")).select("variable", "r.*")


_MEASURES = ("low", "high", "mean", "median")


def _continuous(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = unpivot(df, cols, [], "variable", "value").where(F.col("value").isNotNull())
    x = F.col("value").cast("double")
    return quantile_table(long, ["variable"], "value", (0.5,), ("median",),
                          [F.min(x).alias("low"), F.max(x).alias("high"), F.avg(x).alias("mean")], few_groups=True)


def _dominant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = unpivot(df, cols, [], "variable", "value", "string").where(F.col("value").isNotNull())
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("variable").agg(F.max("n").alias("top"))


def table_identity(df: DataFrame) -> DataFrame:
    """Rows, columns, surplus duplicates and unique rows."""
    g = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    a = g.agg(F.sum("_c").alias("rows"), F.count(F.lit(1)).alias("unique_rows"))
    return a.select(F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.lit(len(df.columns)).alias("columns"),
                    (F.coalesce("rows", F.lit(0)) - F.col("unique_rows")).alias("duplicates"), "unique_rows")


def table_info(df: DataFrame) -> DataFrame:
    """Column, dtype, non-null count (one aggregate)."""
    cols = list(df.columns)
    agg = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    st = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = agg.selectExpr(f"stack({len(cols)}, {st}) as (column, non_null)")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, dtype string")
    return long.join(types, "column")


def group_aggregate(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """G1: count, mean, median (exact, distributed), std, min, max per group and column (long form)."""
    long = unpivot(df, cols, list(by), "variable", "value")
    return quantile_table(long, [*by, "variable"], "value", (0.5,), ("median",), [
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")])


def pivot_mean(df: DataFrame, index: str, columns: str, values: str, levels: Sequence | None = None) -> DataFrame:
    """Pivot table with mean (levels given to avoid a distinct probe)."""
    g = df.groupBy(q(index))
    return (g.pivot(columns, list(levels)) if levels is not None else g.pivot(columns)).agg(F.avg(q(values)))


def first_rows(df: DataFrame, row_id: str, n: int = 5, tail: bool = False) -> DataFrame:
    """Head / tail by row id (``TakeOrderedAndProject``)."""
    return df.orderBy(q(row_id).desc() if tail else q(row_id).asc()).limit(n)


def slice_rows(df: DataFrame, row_id: str, start, stop, inclusive: bool = False) -> DataFrame:
    """Positional (end-exclusive) or label (end-inclusive) slice on row id."""
    c = q(row_id)
    return df.where((c >= start) & ((c <= stop) if inclusive else (c < stop)))




def table_findings(df: DataFrame, top_missing: int = 5, max_distinct_ratio: float = 0.9,
                   max_distinct: int = 100, quasi: float = 0.95) -> DataFrame:
    """Table-level findings as rows (finding, subject, detail): surplus
    duplicates, top missing columns, constant / quasi-constant columns, high
    cardinality and mixed value kinds -- a union of the rule queries."""
    from tablewise.operators.quality import exact_duplicates_summary, real_missing_summary
    dup = exact_duplicates_summary(df).where(F.col("surplus_duplicates") > 0).select(
        F.lit("duplicates").alias("finding"), F.lit("table").alias("subject"),
        F.format_string("%d surplus duplicate rows", "surplus_duplicates").alias("detail"))
    miss = (real_missing_summary(df).where(F.col("missing_count") > 0).orderBy(F.desc("missing_count"), "column")
            .limit(top_missing).select(F.lit("missing").alias("finding"), F.col("column").alias("subject"),
                                       F.format_string("%d missing (%.2f%%)", "missing_count", "missing_pct").alias("detail")))
    const = constant_columns(df, quasi).where(F.col("constant") | F.col("quasi_constant")).select(
        F.when(F.col("constant"), "constant").otherwise("quasi_constant").alias("finding"), F.col("column").alias("subject"),
        F.format_string("top value share %.4f", "top_share").alias("detail"))
    card = high_cardinality(df, max_distinct_ratio, max_distinct).select(
        F.lit("high_cardinality").alias("finding"), F.col("column").alias("subject"),
        F.format_string("%d distinct (ratio %.4f)", "distinct", "ratio").alias("detail"))
    texts = text_columns(df)
    out = dup.unionByName(miss).unionByName(const).unionByName(card)
    if texts:
        mixed = mixed_types(df, texts).where("mixed").select(
            F.lit("mixed_types").alias("finding"), F.col("column").alias("subject"),
            F.array_join("kinds", ", ").alias("detail"))
        out = out.unionByName(mixed)
    return out


def exploratory_findings(df: DataFrame, cols: Sequence[str] | None = None, target: str | None = None,
                         rules: dict[str, tuple] | None = None, top: int = 5) -> DataFrame:
    """What stands out in a table, as rows (finding, subject, detail): the class shares of a
    target of two classes, the ``top`` strongest correlations, the ``top`` columns by share of
    IQR outliers, and the columns with values outside their plausible range."""
    from tablewise.operators.assoc import correlation_pairs, pearson_long
    from tablewise.operators.outliers import iqr_summary, plausible_range_check
    cols = list(cols) if cols is not None else numeric_columns(df)
    row = lambda finding, subject, detail: [F.lit(finding).alias("finding"), subject.alias("subject"), detail.alias("detail")]
    parts = []
    if target and target in df.columns:
        shares = df.where(q(target).isNotNull()).groupBy(q(target).cast("string").alias("c")).agg(F.count(F.lit(1)).alias("n"))
        total = shares.select(F.struct(F.sum("n").alias("n"), F.count("n").alias("k"))).scalar()
        parts.append(shares.where(total["k"] == 2).select(*row("target_share", F.col("c"), F.format_string("%.2f%%", F.col("n") * 100.0 / total["n"]))))
    if len(cols) > 1:
        pairs = correlation_pairs(pearson_long(df, cols), cols, top_k=top).where(F.col("correlation").isNotNull())
        parts.append(pairs.select(*row("correlation", F.concat_ws("~", "var1", "var2"), F.format_string("%.4f", "correlation"))))
    if cols:
        worst = iqr_summary(df, cols).orderBy(F.desc_nulls_last("outlier_pct"), "column").limit(top)
        parts.append(worst.select(*row("outliers", F.col("column"), F.format_string("%.2f%%", "outlier_pct"))))
    if rules:
        out = plausible_range_check(df, rules).where(F.col("total_out") > 0)
        parts.append(out.select(*row("implausible", F.col("column"), F.format_string("%d", F.col("total_out").cast("long")))))
    if not parts:
        return df.sparkSession.createDataFrame([], "finding string, subject string, detail string")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found
