"""Data behind the reference's plots.  Drawing itself is
not built; every function returns the table a chart would be drawn from.

Bin edges come from scalar subqueries (min / max / quantiles), so binning
is one narrow projection followed by one ``groupBy``; full grids of bins
or levels are generated with ``sequence`` / literal arrays and ``explode``
rather than joins with a generated range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q, unpivot
from tablewise.functions.quantiles import quantile_table, same_group
from tablewise.operators.learn import split_hash


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over each column's [min, max] (numpy
    rule: last bin closed), optionally per group ``by``; all bins present
    (empty bins count 0).  Returns by + (variable, bin, lower, upper, count)."""
    long = unpivot(df, cols, list(by), "variable", "value").where(F.col("value").isNotNull())
    rng = long.groupBy("variable").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    # rng has one row per column: a fixed bound, broadcast
    j = long.join(F.broadcast(rng), "variable")
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(bins // 2)).otherwise(  # numpy centres a constant column
        
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)))
    counts = j.groupBy(*by, "variable", idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    keys = counts.select(*by, "variable").distinct() if by else rng.select("variable")
    grid = keys.join(F.broadcast(rng), "variable").select(*by, "variable", "lo", "hi",
                                                          F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*by, "variable", "bin"], "left")
    w = (F.col("hi") - F.col("lo")) / bins
    return out.select(*by, "variable", "bin", (F.col("lo") + F.col("bin") * w).alias("lower"),
                      (F.col("lo") + (F.col("bin") + 1) * w).alias("upper"),
                      F.coalesce("count", F.lit(0)).alias("count"))


def ordinal_histogram(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """V2: counts in declared order, unknown values dropped, absent levels 0."""
    counts = df.groupBy(q(col).alias("level")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(v) for v in order])).alias("position", "level"))
    return grid.join(counts, "level", "left").select("position", "level", F.coalesce("count", F.lit(0)).alias("count"))


def category_shares(df: DataFrame, col: str, missing: str = "Missing") -> DataFrame:
    """V3: counts and shares (pct) per category, nulls as ``Missing``."""
    c = F.coalesce(q(col).cast("string"), F.lit(missing))
    tot = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(c.alias("category")).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "pct", F.col("count") * 100.0 / tot)


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """V4: q1, median, q3, whiskers (furthest points within whisker x IQR of
    the box) and flier count, optionally per group.  Quantiles are exact."""
    long = df.select(*[q(b) for b in by], F.lit(col).alias("variable"), q(col).cast("double").alias("value"))
    keys = [*by, "variable"]
    qs = quantile_table(long, keys, "value", (0.25, 0.5, 0.75), ("q1", "median", "q3"), few_groups=not by)
    j = same_group(long, F.broadcast(qs) if not by else qs, keys)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - whisker * iqr, F.col("q3") + whisker * iqr
    return j.groupBy(*by, "variable", "q1", "median", "q3").agg(
        F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("whisker_high"),
        F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("fliers"))


def scatter_sample(df: DataFrame, pairs: Sequence[tuple[str, str]], row_id: str, n: int = 1000,
                   hue: str | None = None, seed: int = 42, kind: str = "xxhash") -> DataFrame:
    """For each (x, y) pair the same seeded sample of at most n rows
    (smallest hash of the row id); ``hue`` carried along."""
    h = split_hash(q(row_id), seed, kind)
    sample = df.withColumn("_h", h).orderBy("_h", q(row_id)).limit(n)
    parts = []
    for a, b in pairs:
        parts.append(sample.select(q(row_id).alias("row_id"), F.lit(a).alias("x_var"), F.lit(b).alias("y_var"),
                                   q(a).cast("double").alias("x"), q(b).cast("double").alias("y"),
                                   (q(hue).cast("string") if hue else F.lit(None).cast("string")).alias("hue")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hexbin_counts(df: DataFrame, x: str, y: str, gridsize: int = 20) -> DataFrame:
    """V6: two-dimensional square-bin counts over the [min, max] ranges."""
    xs, ys = q(x).cast("double"), q(y).cast("double")
    mnx, mxx = df.select(F.min(xs)).scalar(), df.select(F.max(xs)).scalar()
    mny, mxy = df.select(F.min(ys)).scalar(), df.select(F.max(ys)).scalar()
    bx = F.least(F.floor((xs - mnx) / ((mxx - mnx) / gridsize)), F.lit(gridsize - 1))
    by_ = F.least(F.floor((ys - mny) / ((mxy - mny) / gridsize)), F.lit(gridsize - 1))
    return (df.where(xs.isNotNull() & ys.isNotNull())
              .groupBy(bx.cast("int").alias("bin_x"), by_.cast("int").alias("bin_y")).agg(F.count(F.lit(1)).alias("count")))


def _grid_axis(df: DataFrame, x: Column, n: Column, power: float, points: int, cut: float, cutoff: float):
    """Scott's bandwidth (sample std x n ** power) and an even grid over [min - cut h, max + cut h]:
    (h, position of a grid point, first and last grid point that a value reaches)."""
    st = df.select(F.struct(F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    h = F.nullif(st["sd"] * F.pow(n.cast("double"), F.lit(power)), F.lit(0.0))
    start = st["lo"] - cut * h
    step = (st["hi"] + cut * h - start) / (points - 1)
    first = F.greatest(F.lit(0), F.ceil((x - cutoff * h - start) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((x + cutoff * h - start) / step)).cast("int")
    return h, lambda i: start + i * step, first, last


def _reached(first: Column, last: Column) -> Column:
    return F.explode(F.when(first <= last, F.sequence(first, last)))


def _kernel(at: Column, x: Column, h: Column) -> Column:
    return F.exp(-0.5 * F.pow((at - x) / h, 2)) / (h * math.sqrt(2 * math.pi))


def kde_1d(df: DataFrame, col: str, grid_points: int = 200, cut: float = 3.0, cutoff: float = 8.0) -> DataFrame:
    """V7: Gaussian KDE with Scott's bandwidth h (n^(-1/5) x sample std) on an even grid over
    [min - cut h, max + cut h]: (i, x, density).  No value is binned: each one is
    added to the grid points within ``cutoff`` bandwidths, the fewer the more rows there
    are; what lies beyond is less than exp(-cutoff^2 / 2), 1.3e-14, of its kernel's
    peak.  A column without spread has no density (null)."""
    x = q(col).cast("double")
    n = df.select(F.count(x)).scalar()
    h, at, first, last = _grid_axis(df, x, n, -0.2, grid_points, cut, cutoff)
    near = df.where(x.isNotNull()).select(x.alias("v"), _reached(first, last).alias("i"))
    sums = near.groupBy("i").agg(F.sum(_kernel(at(F.col("i")), F.col("v"), h)).alias("s"))
    grid = df.sparkSession.range(grid_points).select(F.col("id").cast("int").alias("i"))
    return grid.join(F.broadcast(sums), "i", "left").select(
        "i", at(F.col("i")).alias("x"), F.when(h.isNotNull(), F.coalesce("s", F.lit(0.0)) / n).alias("density"))


def kde_2d(df: DataFrame, x: str, y: str, grid_points: int = 50, cut: float = 3.0, cutoff: float = 8.0) -> DataFrame:
    """V7 in two dimensions: product of Gaussian kernels, bandwidths n^(-1/6) x sample std of
    each column over the complete rows, on an even grid_points x grid_points grid:
    (i, j, x, y, density).  Cutoff and error as in ``kde_1d``, for each axis."""
    xs, ys = q(x).cast("double"), q(y).cast("double")
    rows = df.where(xs.isNotNull() & ys.isNotNull()).select(xs.alias("u"), ys.alias("v"))
    n = rows.select(F.count(F.lit(1))).scalar()
    hx, at_x, first_x, last_x = _grid_axis(rows, F.col("u"), n, -1 / 6, grid_points, cut, cutoff)
    hy, at_y, first_y, last_y = _grid_axis(rows, F.col("v"), n, -1 / 6, grid_points, cut, cutoff)
    near = rows.select("u", "v", _reached(first_x, last_x).alias("i"))
    # the kernel along x is worked out once for all grid points along y
    near = near.select("v", "i", _kernel(at_x(F.col("i")), F.col("u"), hx).alias("k"), first_y.alias("a"), last_y.alias("b"))
    near = near.select("v", "i", "k", _reached(F.col("a"), F.col("b")).alias("j"))
    sums = near.groupBy("i", "j").agg(F.sum(F.col("k") * _kernel(at_y(F.col("j")), F.col("v"), hy)).alias("s"))
    cell = F.col("id").cast("int")
    grid = df.sparkSession.range(grid_points * grid_points).select(
        F.expr(f"cast(id div {grid_points} as int)").alias("i"), (cell % grid_points).alias("j"))
    return grid.join(F.broadcast(sums), ["i", "j"], "left").select(
        "i", "j", at_x(F.col("i")).alias("x"), at_y(F.col("j")).alias("y"),
        F.when(hx.isNotNull() & hy.isNotNull(), F.coalesce("s", F.lit(0.0)) / n).alias("density"))


def counts_by_hue(df: DataFrame, x: str, hue: str, order: Sequence[str] | None = None) -> DataFrame:
    """Counts by category and hue, restricted to (and ordered by) ``order``."""
    base = df if order is None else df.where(q(x).isin(list(order)))
    out = base.groupBy(q(x).alias("x"), q(hue).alias("hue")).agg(F.count(F.lit(1)).alias("count"))
    if order is not None:
        pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("x"))
        out = out.withColumn("position", pos)
    return out


def regression_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope and intercept of the least-squares line, and r."""
    return df.agg(F.regr_slope(q(y), q(x)).alias("slope"), F.regr_intercept(q(y), q(x)).alias("intercept"),
                  F.regr_r2(q(y), q(x)).alias("r2"))
