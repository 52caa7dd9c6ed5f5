"""Scaling.

``fit`` computes every statistic of every column in ONE aggregate (a 1-row
DataFrame that can be persisted, N4); ``transform`` reads that row through
scalar subqueries, so scaling is a single narrow projection inside
whole-stage codegen -- no join, no shuffle of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q, resolve_columns, unpivot


def fit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fitted statistics for all scalers as one row: per column min, max,
    mean, population std and max |x|."""
    cols = resolve_columns(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_pop(x).alias(f"{c}__std"), F.max(F.abs(x)).alias(f"{c}__maxabs")]
    return df.agg(*aggs)


def _stat(stats: DataFrame, c: str, s: str) -> Column:
    return stats.select(F.col(f"`{c}__{s}`")).scalar()


def minmax_expr(x: Column, mn: Column, mx: Column) -> Column:
    rng = mx - mn
    # scikit-learn: a constant column scales to 0 (range replaced by 1)
    return F.when(rng == 0, x - mn).otherwise((x - mn) / rng)


def zscore_expr(x: Column, mean: Column, std: Column) -> Column:
    # population std (ddof=0); a constant column scales to 0
    return F.when((std == 0) | std.isNull(), x - mean).otherwise((x - mean) / std)


def decimal_expr(x: Column, maxabs: Column, strict: bool = False) -> Column:
    """x / 10^j with j = ceil(log10(max|x| + 1e-12)) (parity) or, with
    ``strict``, floor(log10(max|x|)) + 1 so that max |x'| < 1 always holds.
    All-zero column -> 0.0 (every row); all-null column unchanged."""
    j = (F.floor(F.log10(maxabs)) + 1) if strict else F.ceil(F.log10(maxabs + F.lit(1e-12)))
    return (F.when(maxabs.isNull(), x).when(maxabs == 0, F.lit(0.0))
             .otherwise(x / F.pow(F.lit(10.0), j)))


def transform(df: DataFrame, stats: DataFrame, kind: str, cols: Sequence[str] | None = None,
              strict: bool = False) -> DataFrame:
    """Apply a fitted scaler (``minmax`` | ``zscore`` | ``decimal``) to any
    table with the same columns; other columns pass through untouched."""
    cols = resolve_columns(df, cols)
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(q(c))
            continue
        x = q(c).cast("double")
        if kind == "minmax":
            e = minmax_expr(x, _stat(stats, c, "min"), _stat(stats, c, "max"))
        elif kind == "zscore":
            e = zscore_expr(x, _stat(stats, c, "mean"), _stat(stats, c, "std"))
        elif kind == "decimal":
            e = decimal_expr(x, _stat(stats, c, "maxabs"), strict)
        else:
            raise ValueError(kind)
        out.append(e.alias(c))
    return df.select(*out)


def minmax_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Min-max to [0, 1]; constant -> 0; missing names ignored."""
    cols = resolve_columns(df, cols)
    return transform(df, fit(df, cols), "minmax", cols)


def zscore_scale(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Z-score with population std; constant -> 0."""
    cols = resolve_columns(df, cols)
    return transform(df, fit(df, cols), "zscore", cols)


def decimal_scale(df: DataFrame, cols: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Decimal scaling (see ``decimal_expr``)."""
    cols = resolve_columns(df, cols)
    return transform(df, fit(df, cols), "decimal", cols, strict)


def compare_versions(versions: dict[str, DataFrame], cols: Sequence[str]) -> DataFrame:
    """Min, max, mean, std (ddof=1), median per (column, version)."""
    out = None
    for name, frame in versions.items():
        present = [c for c in cols if c in frame.columns]
        long = unpivot(frame, present, [], "column", "value").withColumn("version", F.lit(name))
        out = long if out is None else out.unionByName(long)
    from tablewise.functions.quantiles import quantile_table
    return quantile_table(out, ["column", "version"], "value", (0.5,), ("median",), [
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")],
        few_groups=True)
