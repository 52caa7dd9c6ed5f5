"""Exact, distributed quantiles with linear interpolation (pandas / numpy default), in two scans.

Spark's ``percentile`` is exact but keeps a map of every distinct value in one
buffer.  Here a value is found by bracket and refine:

1. One aggregate of mergeable sketches gives for each group its count and, for
   each probability, two values that the wanted positions p * (n - 1) lie between:
   the sketched quantiles ``_MARGIN`` rank errors to either side.  Groups of at
   most ``ACCURACY`` values keep all of them.
2. A second scan counts the values below each bracket and keeps only those
   inside, some 6 in 10,000, as (value, count).  Their running counts give the values at
   floor and ceil of the position.

Groups of data are joined back to the rows they were sketched from: their table is
written once and, if it is small, broadcast, so that the rows of few groups are not
sorted in as many tasks.  Otherwise nothing runs while the plan is built.  Should a sketch ever miss by more than
its margin, the query fails with an error and does not answer wrongly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.core import q, unpivot
from tablewise.session import cut_lineage

#: 1 / rank error of the sketches, as a share of the rows.
ACCURACY = 10_000
_MARGIN = 3.0 / ACCURACY
#: Quantiles that stand for a group when the deviations from its median are bracketed.
_GRID = 1000
#: Groups whose sketched quantiles are broadcast.
_MOST_GROUPS = 10_000


def same_group(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on groups of the same names, where a null group is a group."""
    renamed = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    on = [q(k).eqNullSafe(q(f"_on_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*(f"_on_{k}" for k in keys))


def _sketched(long: DataFrame, keys: Sequence[str], v: Column, probs: Sequence[float], aggs: Sequence[Column]) -> DataFrame:
    """keys, _n, _least, _most, _q (sketched quantiles at ``probs``) and ``aggs``."""
    return long.groupBy(*[q(k) for k in keys]).agg(
        F.count(v).alias("_n"), F.min(v).alias("_least"), F.max(v).alias("_most"),
        F.percentile_approx(v, F.array(*[F.lit(float(p)) for p in probs]), F.lit(ACCURACY)).alias("_q"), *aggs)


def _ends(probs: Sequence[float]) -> list[float]:
    return [min(1.0, max(0.0, p + side * _MARGIN)) for p in probs for side in (-1, 1)]


def _bracket(i: int, p: float) -> tuple[Column, Column]:
    """Least and greatest value that the positions of probability p can have."""
    all_kept = F.col("_n") <= ACCURACY
    low = F.col("_least") if p - _MARGIN <= 0 else F.when(all_kept, F.col("_least")).otherwise(F.col("_q")[2 * i])
    high = F.col("_most") if p + _MARGIN >= 1 else F.when(all_kept, F.col("_most")).otherwise(F.col("_q")[2 * i + 1])
    return low, high


def _counted(rows: DataFrame, keys: Sequence[str], parts: Sequence[Column]) -> DataFrame:
    """(keys, _n, i, v, c): each row's parts, structs of i, keep and v, counted by value."""
    x = rows.select(*[q(k) for k in keys], "_n", F.explode(F.array(*parts)).alias("_x")).where("_x.keep")
    return x.groupBy(*[q(k) for k in keys], "_n", F.col("_x.i").alias("i"), F.col("_x.v").alias("v")).agg(F.count(F.lit(1)).alias("c"))


def _part(i: int, keep: Column, v: Column) -> Column:
    return F.struct(F.lit(i).alias("i"), keep.alias("keep"), v.alias("v"))


def _picked(counts: DataFrame, keys: Sequence[str], p: Column, value: str = "v") -> DataFrame:
    """(keys, i, quantile) from counted values; the null value stands for all that lie below."""
    run = Window.partitionBy(*[q(k) for k in keys], "i").orderBy(F.col(value).asc_nulls_first())
    placed = counts.withColumn("_end", F.sum("c").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    h = p * (F.col("_n") - 1)
    holds = lambda at: (at >= F.col("_end") - F.col("c")) & (at < F.col("_end")) & F.col(value).isNotNull()
    found = placed.groupBy(*[q(k) for k in keys], "i").agg(
        F.max(F.when(holds(F.floor(h)), F.col(value))).alias("_lo"), F.max(F.when(holds(F.ceil(h)), F.col(value))).alias("_hi"),
        F.max(h).alias("_h"))
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_h") - F.floor("_h"))
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    return found.select(*[q(k) for k in keys], "i", F.when(exact.isNull(), missed).otherwise(exact).alias("quantile"))


def _settled(groups: DataFrame, few_groups: bool) -> tuple[DataFrame, bool]:
    """The sketched groups and whether they are few; written once where that has to be counted."""
    if few_groups:
        return groups, True
    groups = cut_lineage(groups)
    return groups, groups.limit(_MOST_GROUPS + 1).count() <= _MOST_GROUPS


def _shared(df: DataFrame, few_groups: bool) -> DataFrame:
    """One row a group: broadcast where the groups are known to be few, such as columns."""
    return F.broadcast(df) if few_groups else df


def _quantiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], aggs: Sequence[Column],
               few_groups: bool) -> tuple[DataFrame, DataFrame, bool]:
    """The groups with ``aggs``, (keys, i, quantile) for the i-th probability, and whether the groups are few."""
    v = q(value).cast("double")
    groups, few_groups = _settled(_sketched(long, keys, v, _ends(probs), aggs), few_groups)
    rows = same_group(long.where(v.isNotNull()).select(*[q(k) for k in keys], v.alias("_v")),
                       _shared(groups.select(*[q(k) for k in keys], "_n", "_least", "_most", "_q"), few_groups), keys)
    parts = []
    for i, p in enumerate(probs):
        low, high = _bracket(i, p)
        parts.append(_part(i, F.col("_v") <= high, F.when(F.col("_v") >= low, F.col("_v"))))
    at = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
    return groups, _picked(_counted(rows, keys, parts), keys, at), few_groups


def quantile_table(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
                   aggs: Sequence[Column] = (), few_groups: bool = False) -> DataFrame:
    """One row per group of ``keys``: ``aggs``, computed by the scan that sketches, and the
    quantiles of ``value`` as ``names`` (null for a group without a value).

    ``few_groups`` says that the groups are columns or the like, few whatever the
    data, so that their table is broadcast."""
    keys = list(keys)
    groups, found, few_groups = _quantiles(long, keys, value, probs, aggs, few_groups)
    wide = found.groupBy(*[q(k) for k in keys]).agg(
        *[F.max(F.when(F.col("i") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)])
    return same_group(groups.drop("_n", "_least", "_most", "_q"), _shared(wide, few_groups), keys, "left")


def exact_quantiles_long(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                         few_groups: bool = False) -> DataFrame:
    """Quantiles per group of ``keys`` over ``value`` in a long table.

    Returns keys + (prob, quantile); a group without a value has none."""
    keys = list(keys)
    found = _quantiles(long, keys, value, probs, (), few_groups)[1]
    at = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
    return found.select(*[q(k) for k in keys], at.alias("prob"), "quantile")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of several columns (optionally per group ``by``): returns
    by + (variable, prob, quantile)."""
    long = unpivot(df, cols, list(by), "variable", "value")
    return exact_quantiles_long(long, [*by, "variable"], "value", probs, few_groups=not by)


def median_and_mad(long: DataFrame, keys: Sequence[str], value: str, few_groups: bool = False) -> DataFrame:
    """Median and MAD, the median of |x - median|, per group, in the same two scans.

    Where the deviations' median can lie follows from the sketch as well: the
    deviations of ``_GRID`` sketched quantiles have, within their rank errors, the
    distribution of all.  The second scan keeps the values that far from the
    median on either side, and counts those between, which deviate less."""
    keys = list(keys)
    v = q(value).cast("double")
    groups = _sketched(long, keys, v, [*_ends([0.5]), *[j / _GRID for j in range(_GRID + 1)]], ())
    low, high = _bracket(0, 0.5)
    centre, wide = F.col("_q")[2 + _GRID // 2], F.col("_high") - F.col("_low")
    deviations = F.sort_array(F.transform(F.slice("_q", 3, _GRID + 1), lambda x: F.abs(x - centre)))
    room = int(_GRID * (2 / _GRID + 4 * _MARGIN)) + 4  # rank errors of the grid and of the sketch, on both sides
    groups, few_groups = _settled(groups.select(*[q(k) for k in keys], "_n", low.alias("_low"), high.alias("_high"), "_least", "_most", "_q"), few_groups)
    kept_all = F.col("_n") <= ACCURACY
    groups = groups.select(
        *[q(k) for k in keys], "_n", "_low", "_high",
        F.when(kept_all, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.get(deviations, F.lit(_GRID // 2 - room)) - wide)).alias("_near"),
        F.when(kept_all, F.lit(float("inf"))).otherwise(F.get(deviations, F.lit(_GRID // 2 + room)) + wide).alias("_far"))
    rows = same_group(long.where(v.isNotNull()).select(*[q(k) for k in keys], v.alias("_v")), _shared(groups, few_groups), keys)
    x = F.col("_v")
    # how far a value can be from the median at most and at least
    most = F.greatest(F.abs(x - F.col("_low")), F.abs(x - F.col("_high")))
    least = F.when((x >= F.col("_low")) & (x <= F.col("_high")), F.lit(0.0)).otherwise(
        F.least(F.abs(x - F.col("_low")), F.abs(x - F.col("_high"))))
    counts = _counted(rows, keys, [_part(0, x <= F.col("_high"), F.when(x >= F.col("_low"), x)),
                                   _part(1, least <= F.col("_far"), F.when(most >= F.col("_near"), x))])
    median = _picked(counts.where("i = 0"), keys, F.lit(0.5)).select(*[q(k) for k in keys], F.col("quantile").alias("median"))
    off = same_group(counts.where("i = 1"), _shared(median, few_groups), keys).withColumn("d", F.abs(F.col("v") - F.col("median")))
    folded = off.groupBy(*[q(k) for k in keys], "_n", "i", "d").agg(F.sum("c").alias("c"))
    mad = _picked(folded, keys, F.lit(0.5), "d").select(*[q(k) for k in keys], F.col("quantile").alias("mad"))
    return same_group(median, _shared(mad, few_groups), keys, "left")


def quantile_wide(qlong: DataFrame, keys: Sequence[str], probs: Sequence[float],
                  names: Sequence[str]) -> DataFrame:
    """Pivot (keys, prob, quantile) to one column per probability."""
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for p, n in zip(probs, names)]
    return qlong.groupBy(*keys).agg(*aggs)


def percentile_expr(c, probs: Sequence[float]):
    """Single-aggregate exact percentile (Spark built-in) for low-cardinality
    columns; returns an array column in ``probs`` order."""
    return F.percentile(q(c) if isinstance(c, str) else c, F.array(*[F.lit(float(p)) for p in probs]))


def frozen(table: DataFrame, key: str) -> Column:
    """A table of few rows as one constant map, key -> row, read by one subquery however
    often it is used: ``frozen(limits, "column")["price"]["lower_limit"]``."""
    return table.select(F.map_from_entries(F.collect_list(F.struct(q(key), F.struct(*[q(c) for c in table.columns if c != key]))))).scalar()
