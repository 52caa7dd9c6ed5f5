"""Distributed exclusive prefix sums over a global order, per key group.

``Window.partitionBy(keys).orderBy(v)`` would put a whole key group in one
task (and ``Window.orderBy(v)`` the whole table).  Here each key group is cut
into ranges of its primary order column at approximate quantile bounds
(``percentile_approx``: one pass with mergeable sketches), the range index
``_pid`` being a deterministic function of the row's value -- so every
re-execution of any branch of the plan assigns the same range.  Running
sums are a window over (keys, _pid); the per-range totals (ranges x groups
rows) become offsets with a small window and a join.  A key group holding a
third of the table is spread over ``partitions`` ranges.  Groups proven small
by a count (<= ``SMALL_GROUP`` rows) take a plain window instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


SMALL_GROUP = 1_000_000  # rows one window task may sort (spillable; checked before use)


def _same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of the same names, where a null group is a group."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    cond = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_on_{c}`")) for c in on]
    return left.join(renamed, cond).drop(*(f"_on_{c}" for c in on))


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | None = None,
               out: str = "before", partitions: int | None = None, small_group: int | None = None,
               size_hint: int | None = None) -> DataFrame:
    """Adds ``out`` = sum of ``weight`` (1 when None) over rows of the same key
    group that sort strictly before this row by ``order`` (give a unique order
    for a deterministic result), and ``_total`` = the group total.  The first
    order column must be numeric; rows with equal values share a range."""
    keys, order = list(keys), list(order)
    spark = df.sparkSession
    n = max(1, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    primary = F.col(order[0]).cast("double")
    w = F.col(weight) if weight else F.lit(1)
    base = df.withColumn("_w", w.cast("long"))
    small_group = SMALL_GROUP if small_group is None else small_group
    # proven-small groups: one window per group (a bounded sort per task)
    largest = size_hint if size_hint is not None else (
        base.groupBy(*keys).count().agg(F.max("count")).collect()[0][0] or 0)
    if largest <= small_group:
        grp = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        run = grp.orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        return (base.withColumn(out, F.coalesce(F.sum("_w").over(run), F.lit(0)).cast("long"))
                    .withColumn("_total", F.sum("_w").over(grp)).drop("_w"))
    probs = [i / n for i in range(1, n)]
    if not probs:
        x = base.withColumn("_pid", F.lit(0))
    elif keys:
        bounds = base.groupBy(*keys).agg(F.percentile_approx(primary, probs, 10000).alias("_b"))
        x = _same(base, bounds, keys)
        x = x.withColumn("_pid", F.size(F.filter("_b", lambda t: t <= primary))).drop("_b")
    else:
        b = base.agg(F.percentile_approx(primary, probs, 10000)).collect()[0][0] or []  # n - 1 values
        arr = F.array(*[F.lit(float(v)) for v in b]) if b else F.array().cast("array<double>")
        x = base.withColumn("_pid", F.size(F.filter(arr, lambda t: t <= primary)))
    wl = Window.partitionBy(*keys, "_pid").orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    loc = x.withColumn("_local", F.coalesce(F.sum("_w").over(wl), F.lit(0)).cast("long"))
    totals = x.groupBy(*keys, "_pid").agg(F.sum("_w").alias("_t"))
    grp = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    offs = totals.select(*keys, "_pid",
                         F.coalesce(F.sum("_t").over(grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_off"),
                         F.sum("_t").over(grp).alias("_total"))
    # offs has (ranges x key groups) rows; without keys at most ``partitions`` rows (broadcast)
    j = _same(loc, offs, [*keys, "_pid"]) if keys else loc.join(F.broadcast(offs), "_pid")
    return j.withColumn(out, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off", "_w")
