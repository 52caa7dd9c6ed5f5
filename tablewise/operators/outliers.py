"""Outliers and plausibility.

Two passes, both distributed: (1) statistics per column -- exact quantiles
through ``functions.quantiles`` (no single-task percentile buffer) and
moments in one aggregate; (2) one narrow projection or conditional count
that reads the limits as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import pct, q, unpivot
from tablewise.functions.quantiles import frozen, median_and_mad, quantile_table

# Default plausible ranges (normalised survey column names).
PLAUSIBILITY_RULES = {
    "height_cm": (120, 230),
    "weight_kg": (30, 250),
    "bmi": (10, 80),
    "alcohol_consumption": (0, 30),
    "fruit_consumption": (0, 180),
    "green_vegetables_consumption": (0, 180),
    "friedpotato_consumption": (0, 180),
}


def iqr_limits(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column q1, q3, iqr, lower = q1 - k*iqr, upper = q3 + k*iqr (exact quantiles)."""
    long = unpivot(df, cols, [], "column", "value")
    qs = quantile_table(long, ["column"], "value", (0.25, 0.5, 0.75), ("q1", "median", "q3"), few_groups=True)
    iqr = F.col("q3") - F.col("q1")
    return qs.select("column", "q1", "median", "q3", iqr.alias("iqr"),
                     (F.col("q1") - k * iqr).alias("lower_limit"), (F.col("q3") + k * iqr).alias("upper_limit"))


def _outside(x: Column, limits: Column, c: str) -> Column:
    """Whether x lies strictly outside column c's limits (a ``frozen`` table of limits)."""
    return (x < limits[c]["lower_limit"]) | (x > limits[c]["upper_limit"])


def _mad_outlier(x: Column, stats: Column, c: str, threshold: float) -> Column:
    med, mad = stats[c]["median"], stats[c]["mad"]
    mz = F.when(mad.isNull() | (mad == 0), F.lit(0.0)).otherwise(0.6745 * (x - med) / mad)
    return F.coalesce(F.abs(mz) > threshold, F.lit(False))


def iqr_flags(df: DataFrame, cols: Sequence[str], k: float = 1.5, keep: Sequence[str] = (),
              limits: DataFrame | None = None, suffix: str = "_outlier_iqr") -> DataFrame:
    """O3: one boolean flag per column (strictly outside the limits; null -> false)."""
    lim = frozen(limits if limits is not None else iqr_limits(df, cols, k), "column")
    flags = [F.coalesce(_outside(q(c).cast("double"), lim, c), F.lit(False)).alias(c + suffix) for c in cols]
    return df.select(*[q(c) for c in keep], *flags)


def iqr_summary(df: DataFrame, cols: Sequence[str], k: float = 1.5, denominator: str = "all") -> DataFrame:
    """O1 (``denominator='all'``: pct over all rows incl. null) / O2
    (``'valid'``: over non-null rows): count, missing, q1, q3, iqr, limits,
    outlier count and pct (4 dp), min, max, mean, median; order pct desc."""
    lim = iqr_limits(df, cols, k)
    long = unpivot(df, cols, [], "column", "value")
    j = long.join(F.broadcast(lim), "column")  # lim: one row per column, a fixed bound
    out_mask = (F.col("value") < F.col("lower_limit")) | (F.col("value") > F.col("upper_limit"))
    g = j.groupBy("column", "q1", "q3", "iqr", "lower_limit", "upper_limit", "median").agg(
        F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.count(F.lit(1)).alias("_rows"), F.count_if(out_mask).alias("outlier_count"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    den = F.col("_rows") if denominator == "all" else F.col("count")
    return (g.select("column", "count", "missing", "q1", "q3", "iqr", "lower_limit", "upper_limit", "outlier_count",
                     pct(F.col("outlier_count"), den).alias("outlier_pct"), "min", "max", "mean", "median")
             .orderBy(F.desc("outlier_pct"), "column"))


def outlying_values(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows whose value of ``col`` lies outside the IQR limits."""
    return df.where(_outside(q(col).cast("double"), frozen(iqr_limits(df, [col], k), "column"), col))


def zscore_flags(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, keep: Sequence[str] = ()) -> DataFrame:
    """|z| > threshold with sample std (ddof=1); std 0/null -> z = 0."""
    flags = []
    for c in cols:
        x = q(c).cast("double")
        m = df.select(F.avg(x)).scalar()
        s = df.select(F.stddev_samp(x)).scalar()
        z = F.when(s.isNull() | (s == 0), F.lit(0.0)).otherwise((x - m) / s)
        flags.append(F.coalesce(F.abs(z) > threshold, F.lit(False)).alias(c + "_zscore_outlier"))
    return df.select(*[q(c) for c in keep], *flags)


def mad_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column median and MAD = median(|x - median|), both exact and distributed."""
    return median_and_mad(unpivot(df, cols, [], "column", "value"), ["column"], "value", few_groups=True)


def mad_flags(df: DataFrame, cols: Sequence[str], threshold: float = 3.5, keep: Sequence[str] = (),
              stats: DataFrame | None = None) -> DataFrame:
    """Modified z = 0.6745 (x - median) / MAD, |mz| > threshold; MAD 0/null -> 0."""
    told = frozen(stats if stats is not None else mad_stats(df, cols), "column")
    flags = [_mad_outlier(q(c).cast("double"), told, c, threshold).alias(c + "_mad_outlier") for c in cols]
    return df.select(*[q(c) for c in keep], *flags)


def flag_summary(flags: DataFrame, cols: Sequence[str], suffix: str, threshold: float, label: str) -> DataFrame:
    """Count and pct (4 dp) of flagged rows per column, order pct desc (O5/O6 tables)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c + suffix)).alias(f"n{i}") for i, c in enumerate(cols)]
    st = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    long = flags.agg(*aggs).selectExpr("_n", f"stack({len(cols)}, {st}) as (column, n_outliers)")
    return (long.select("column", F.lit(threshold).alias(label), "n_outliers",
                        pct(F.col("n_outliers"), F.col("_n")).alias("pct_outliers"))
                .orderBy(F.desc("pct_outliers"), "column"))


def plausible_range_check(df: DataFrame, rules: Mapping[str, tuple], denominator: str = "all") -> DataFrame:
    """Observed min/max and counts below / above an expected range per
    column (rules for absent columns skipped).  One aggregate for all columns."""
    cols = [c for c in rules if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, min_expected double, max_expected double, "
                                                   "observed_min double, observed_max double, below long, above long, "
                                                   "total_out long, pct_out double")
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        lo, hi = rules[c]
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.count_if(x < lo).alias(f"b{i}"),
                 F.count_if(x > hi).alias(f"a{i}"), F.count(x).alias(f"v{i}")]
    st = ", ".join(f"'{c}', {float(rules[c][0])}D, {float(rules[c][1])}D, mn{i}, mx{i}, b{i}, a{i}, v{i}"
                   for i, c in enumerate(cols))
    long = df.agg(*aggs).selectExpr(
        "_n", f"stack({len(cols)}, {st}) as (column, min_expected, max_expected, observed_min, observed_max, below, above, valid)")
    den = F.col("_n") if denominator == "all" else F.col("valid")
    return (long.select("column", "min_expected", "max_expected", "observed_min", "observed_max", "below", "above",
                        (F.col("below") + F.col("above")).alias("total_out"),
                        pct(F.col("below") + F.col("above"), den).alias("pct_out"))
                .orderBy(F.desc("pct_out"), "column"))


def row_outlier_counts(flags: DataFrame, flag_cols: Sequence[str], row_id: str) -> DataFrame:
    """Number of flags per row."""
    n = sum((F.col(c).cast("int") for c in flag_cols), F.lit(0))
    return flags.select(q(row_id), n.alias("n_outliers"))


def row_outlier_distribution(counts: DataFrame) -> DataFrame:
    """Frequency of per-row flag counts and share of rows with at least one."""
    tot = counts.select(F.count(F.lit(1))).scalar()
    return (counts.groupBy("n_outliers").agg(F.count(F.lit(1)).alias("rows"))
                  .withColumn("pct", F.col("rows") * 100.0 / tot))


def top_outlier_rows(counts: DataFrame, row_id: str, top: int = 100) -> DataFrame:
    """Rows with most IQR flags (count desc, row id asc)."""
    return counts.orderBy(F.desc("n_outliers"), q(row_id)).limit(top)


def outlier_audit(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """IQR, z-score and MAD flags side by side in ONE projection (the
    flag builders all read scalar subqueries; no join on row id)."""
    lim, stats = frozen(iqr_limits(df, cols), "column"), frozen(mad_stats(df, cols), "column")
    exprs = [q(row_id)]
    for c in cols:
        x = q(c).cast("double")
        exprs.append(F.coalesce(_outside(x, lim, c), F.lit(False)).alias(c + "_outlier_iqr"))
        mean, sd = df.select(F.avg(x)).scalar(), df.select(F.stddev_samp(x)).scalar()
        z_ = F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise((x - mean) / sd)
        exprs.append(F.coalesce(F.abs(z_) > 3.0, F.lit(False)).alias(c + "_zscore_outlier"))
        exprs.append(_mad_outlier(x, stats, c, 3.5).alias(c + "_mad_outlier"))
    return df.select(*exprs)


def outliers_by_target(df: DataFrame, cols: Sequence[str], target: str, k: float = 1.5) -> DataFrame:
    """Per (variable, target class) the pct of IQR outliers and its complement (4 dp)."""
    flags = iqr_flags(df, cols, k, keep=[target], suffix="")
    long = flags.select(q(target).alias("target_class"),
                        F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("f")) for c in cols])).alias("s"))
    g = long.groupBy("s.variable", "target_class").agg(F.avg(F.col("s.f").cast("double")).alias("_p"))
    return g.select("variable", "target_class", F.round((1 - F.col("_p")) * 100, 4).alias("pct_not_outlier"),
                    F.round(F.col("_p") * 100, 4).alias("pct_outlier_iqr"))


def histogram_outlier_segments(df: DataFrame, col: str, bins: int = 30, k: float = 1.5) -> DataFrame:
    """Histogram bins (V1) with the IQR limits drawn on them: per bin the
    count, the count of values outside the limits, and whether the bin
    reaches below the lower or above the upper limit."""
    from tablewise.operators.plotdata import histogram
    h = histogram(df, [col], bins)
    lim = frozen(iqr_limits(df, [col], k), "column")[col]
    lo, hi = lim["lower_limit"], lim["upper_limit"]
    x = q(col).cast("double")
    mn, mx = df.select(F.min(x)).scalar(), df.select(F.max(x)).scalar()
    b = F.least(F.floor((x - mn) / ((mx - mn) / bins)), F.lit(bins - 1)).cast("int")
    outs = (df.where((x < lo) | (x > hi)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("outliers")))
    return (h.join(outs, "bin", "left")
             .select("variable", "bin", "lower", "upper", "count", F.coalesce("outliers", F.lit(0)).alias("outliers"),
                     (F.col("lower") < lo).alias("below_lower_limit"), (F.col("upper") > hi).alias("above_upper_limit")))
