"""Correlation, contingency and target association.

Design notes for scale:
* Pearson for all pairs is ONE aggregate (``corr`` per pair, partial + final),
  then a narrow ``stack`` to long form.
* Spearman ranks come from a distributed prefix sum over distinct values
  (range partitioning + per-partition offsets), never a single-task window.
* Cramér's V for many columns is ONE shuffle: rows are pre-aggregated by
  distinct value combination, exploded to (pair, x, y) cells and counted;
  chi-square uses chi2 = n * (sum o^2 / (r_i c_j) - 1), which needs only the
  non-empty cells, so the r x c grid is never materialised.
* Target tables group by (variable, category) after one unpivot, sharing one
  shuffle for every categorical column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewise.functions.core import (q, safe_corr, scalar, sign_label, strength_label, unpivot)
from tablewise.operators.encode import binary_target


# ---------------------------------------------------------------- Pearson

def pearson_long(df: DataFrame, cols: Sequence[str], include_diagonal: bool = True) -> DataFrame:
    """Pearson matrix in long form (var1, var2, correlation), pairwise
    complete (Spark's ``corr`` skips a row when either side is null)."""
    cols = list(cols)
    if len(cols) < 2:
        raise ValueError("Not enough numeric columns to compute correlations.")
    aggs, keys = [], []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            aggs.append(safe_corr(q(a).cast("double"), q(b).cast("double")).alias(f"c{len(keys)}"))
            keys.append((a, b))
    row = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', c{k}" for k, (a, b) in enumerate(keys))
    upper = row.selectExpr(f"stack({len(keys)}, {stack}) as (var1, var2, correlation)")
    lower = upper.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "correlation")
    out = upper.unionByName(lower)
    if include_diagonal:
        diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "var1 string, var2 string, correlation double")
        out = out.unionByName(diag)
    return out


# --------------------------------------------------------------- Spearman

def average_rank(values: DataFrame, value_col: str, weight_col: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Average (tie-aware) rank of every distinct value: rank = count(< v) + (count(v)+1)/2.

    Distributed prefix sum: distinct values are range-partitioned, each
    partition sums locally, partition totals (one row per partition) give
    offsets.  No window spans the whole table."""
    w = F.col(weight_col) if weight_col else F.lit(1)
    counts = values.where(q(value_col).isNotNull()).groupBy(q(value_col).alias("v")).agg(F.sum(w).alias("cnt"))
    from tablewise.functions.prefix import prefix_sum
    pos = prefix_sum(counts, [], ["v"], weight="cnt", out="before", partitions=partitions)
    return pos.select("v", (F.col("before") + (F.col("cnt") + 1) / 2.0).alias("rank"))


MOST_RANKS = 50_000  # ranks of one column that are broadcast


def spearman_long(df: DataFrame, cols: Sequence[str], include_diagonal: bool = True) -> DataFrame:
    """Spearman matrix (average ranks; pairwise-complete rows re-ranked per pair).

    Columns without nulls are ranked once; a pair touching a column with nulls is
    ranked on its complete rows only, as pandas does.  All of them share one table
    of ranks, keyed (set of columns, column, value), which is written once.  Where the
    ranks of a set are few, or it is the one of all columns without nulls, its rows meet them column
    by column, the few ranks of a column by broadcast, so that only columns of many values are
    shuffled; the rows of other sets are spread into their values, meet their ranks in one join
    and are put together again by one regroup."""
    from tablewise.functions.prefix import prefix_sum
    from tablewise.session import cut_lineage
    cols = list(cols)
    spark = df.sparkSession
    seen = df.agg(*[F.count_if(q(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    full = [c for i, c in enumerate(cols) if seen[f"n{i}"] == 0]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if a not in full or b not in full]
    sets = ([tuple(full)] if len(full) > 1 else []) + pairs
    parts = []
    if sets:
        base = df.select(F.monotonically_increasing_id().alias("rid"), *[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
        x = {c: F.col(f"x{i}") for i, c in enumerate(cols)}
        entry = lambda g, i, c, members: F.struct(
            F.lit(g).alias("g"), F.lit(i).alias("i"),
            (x[c] if members is full else F.when(x[members[0]].isNotNull() & x[members[1]].isNotNull(), x[c])).alias("v"))
        entries = (base.select("rid", F.explode(F.array(*[entry(g, i, c, full if m == tuple(full) else m)
                                                          for g, m in enumerate(sets) for i, c in enumerate(m)])).alias("e"))
                   .select("rid", "e.*").where("v is not null"))
        counts = entries.groupBy("g", "i", "v").agg(F.count(F.lit(1)).alias("times"))
        ranks = cut_lineage(prefix_sum(cut_lineage(counts), ["g", "i"], ["v"], weight="times", out="before").select(
            "g", "i", "v", (F.col("before") + (F.col("times") + 1) / 2.0).alias("rank")))
        width = max(map(len, sets))
        many = {(r["g"], r["i"]): r["n"] for r in ranks.groupBy("g", "i").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a column of a set
        # column by column: the set without nulls, and any set whose ranks are all broadcast
        direct = [g for g, m in enumerate(sets) if m == tuple(full) or all(many.get((g, i), 0) <= MOST_RANKS for i in range(len(m)))]
        wides = []
        for g in direct:
            rows = base.select(*[x[c].alias(f"v{i}") for i, c in enumerate(sets[g])])
            rows = rows.where(" and ".join(f"v{i} is not null" for i in range(len(sets[g]))))
            for i in sorted(range(len(sets[g])), key=lambda i: many.get((g, i), 0)):
                rank = ranks.where((F.col("g") == g) & (F.col("i") == i)).select(F.col("v").alias(f"v{i}"), F.col("rank").alias(f"r{i}"))
                rows = rows.join(F.broadcast(rank) if many.get((g, i), 0) <= MOST_RANKS else rank, f"v{i}").drop(f"v{i}")
            wides.append(rows.select(F.lit(g).alias("g"), *[(F.col(f"r{i}") if i < len(sets[g]) else F.lit(None).cast("double")).alias(f"r{i}")
                                                            for i in range(width)]))
        if len(direct) < len(sets):
            wides.append(entries.where(~F.col("g").isin(direct)).join(ranks, ["g", "i", "v"]).groupBy("rid", "g").agg(
                *[F.max(F.when(F.col("i") == i, F.col("rank"))).alias(f"r{i}") for i in range(width)]).drop("rid"))
        wide = wides[0]
        for more in wides[1:]:
            wide = wide.unionByName(more)
        # one aggregate over all sets; a set of fewer columns has null ranks beyond them
        told = wide.groupBy("g").agg(*[safe_corr(F.col(f"r{i}"), F.col(f"r{j}")).alias(f"c_{i}_{j}") for i in range(width) for j in range(i + 1, width)])
        at = [F.struct(F.lit(g).alias("at"), F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"c_{i}_{j}").alias("correlation"))
              for g, m in enumerate(sets) for i, a in enumerate(m) for j, b in enumerate(m) if i < j]
        # a set without a complete row has no group: its correlation is null
        groups = spark.createDataFrame([(g,) for g in range(len(sets))], "g int").join(F.broadcast(told), "g", "left")
        half = groups.select("g", F.explode(F.array(*at)).alias("p")).where("g = p.at").select("p.var1", "p.var2", "p.correlation")
        parts = [half, half.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "correlation")]
    if include_diagonal or not parts:
        ones = [(c, c, 1.0) for c in cols] if include_diagonal else []
        parts.append(spark.createDataFrame(ones, "var1 string, var2 string, correlation double"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# ------------------------------------------------------------ pairs

def correlation_pairs(long: DataFrame, order: Sequence[str], top_k: int | None = None) -> DataFrame:
    """Upper triangle in column order, abs value, sign and strength,
    ordered by abs desc (ties by var1, var2); optional top-k."""
    pos = {c: i for i, c in enumerate(order)}
    m = F.create_map(*[F.lit(x) for kv in pos.items() for x in kv])
    out = (long.where(m[F.col("var1")] < m[F.col("var2")])
               .select("var1", "var2", "correlation",
                       F.abs("correlation").alias("abs_correlation"),
                       sign_label(F.col("correlation")).alias("sign"),
                       strength_label(F.col("correlation")).alias("strength")))
    out = out.orderBy(F.desc_nulls_last("abs_correlation"), "var1", "var2")
    return out.limit(top_k) if top_k else out


def redundant_pairs(pairs: DataFrame, threshold: float = 0.80) -> DataFrame:
    """Pairs whose |correlation| reaches the threshold."""
    return pairs.where(F.col("abs_correlation") >= threshold)


# ----------------------------------------------------------- Cramér's V

def _cramers_from_cells(cells: DataFrame, keys: Sequence[str], degenerate: str) -> DataFrame:
    """cells: keys + (x, y, o).  Returns keys + cramers_v."""
    kx = list(keys) + ["x"]
    ky = list(keys) + ["y"]
    c = (cells.withColumn("ri", F.sum("o").over(Window.partitionBy(*kx)))
              .withColumn("cj", F.sum("o").over(Window.partitionBy(*ky))))
    agg = c.groupBy(*keys).agg(
        F.sum("o").cast("double").alias("n"),
        F.count_distinct("x").alias("r"),
        F.count_distinct("y").alias("k"),
        F.sum(F.col("o").cast("double") * F.col("o") / (F.col("ri") * F.col("cj"))).alias("s"))
    n, r, k = F.col("n"), F.col("r"), F.col("k")
    chi2 = n * (F.col("s") - 1)
    if degenerate == "zero":
        nm1 = n - 1
        phi = F.greatest(F.lit(0.0), chi2 / n - (k - 1) * (r - 1) / nm1)
        rc = r - (r - 1) * (r - 1) / nm1
        kc = k - (k - 1) * (k - 1) / nm1
        den = F.least(kc - 1, rc - 1)
        v = (F.when((r <= 1) | (k <= 1), F.lit(0.0))
              .when(n <= 1, F.lit(0.0))
              .when(den <= 0, F.lit(0.0))
              .otherwise(F.sqrt(phi / den)))
    else:
        nm1 = F.greatest(n - 1, F.lit(1.0))
        phi = F.greatest(F.lit(0.0), chi2 / n - (k - 1) * (r - 1) / nm1)
        rc = r - (r - 1) * (r - 1) / nm1
        kc = k - (k - 1) * (k - 1) / nm1
        den = F.least(rc - 1, kc - 1)
        v = (F.when((r <= 1) | (k <= 1), F.lit(None).cast("double"))
              .when(den <= 0, F.lit(None).cast("double"))
              .otherwise(F.sqrt(phi / den)))
    return agg.select(*keys, v.alias("cramers_v"), n.cast("long").alias("n"))


def cramers_v(df: DataFrame, x: str, y: str, nulls: str = "drop", degenerate: str = "zero") -> DataFrame:
    """Bias-corrected Cramér's V of two columns, one row.

    ``nulls='drop'`` removes incomplete rows, ``nulls='level'`` makes null a
    ``Missing`` level (heart-disease variant); ``degenerate='zero'`` returns
    0.0 for a 1-row/1-column table, ``'nan'`` returns null."""
    xs, ys = q(x).cast("string"), q(y).cast("string")
    if nulls == "level":
        xs, ys = F.coalesce(xs, F.lit("Missing")), F.coalesce(ys, F.lit("Missing"))
    base = df.select(xs.alias("x"), ys.alias("y"))
    if nulls == "drop":
        base = base.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = base.groupBy("x", "y").agg(F.count(F.lit(1)).alias("o")).withColumn("var1", F.lit(x)).withColumn("var2", F.lit(y))
    return _cramers_from_cells(cells, ["var1", "var2"], degenerate)


def cramers_v_long(df: DataFrame, cols: Sequence[str], include_diagonal: bool = True,
                   degenerate: str = "zero") -> DataFrame:
    """Cramér's V for all column pairs (pairwise null drop) in one shuffle.

    Rows are first combined by distinct value combination (partial
    aggregation keeps a hot combination to one row per map task), then
    exploded to one cell per column pair."""
    cols = list(cols)
    combos = df.groupBy(*[q(c).cast("string").alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("_w"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                             F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs])
    cells = (combos.select(F.explode(arr).alias("p"), "_w")
                   .where(F.col("p.x").isNotNull() & F.col("p.y").isNotNull())
                   .groupBy("p.var1", "p.var2", "p.x", "p.y").agg(F.sum("_w").alias("o")))
    v = _cramers_from_cells(cells, ["var1", "var2"], degenerate).select("var1", "var2", "cramers_v")
    out = v.unionByName(v.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "cramers_v"))
    if include_diagonal:
        out = out.unionByName(df.sparkSession.createDataFrame(
            [(c, c, 1.0) for c in cols], "var1 string, var2 string, cramers_v double"))
    return out


def categorical_associations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Ranked pair list with strength label."""
    v = cramers_v_long(df, cols, include_diagonal=False)
    pos = {c: i for i, c in enumerate(cols)}
    m = F.create_map(*[F.lit(x) for kv in pos.items() for x in kv])
    return (v.where(m[F.col("var1")] < m[F.col("var2")])
             .withColumn("strength", strength_label(F.col("cramers_v")))
             .orderBy(F.desc_nulls_last("cramers_v"), "var1", "var2"))


def association_ranking(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Cramér's V of each categorical column against the target (nulls as a
    ``Missing`` level, degenerate -> null), order V desc, name asc.  One
    unpivot + one groupBy for all columns."""
    t = binary_target(df, target)
    long = unpivot(df.select(*[q(c) for c in cols], t.alias("__t")), cols, ["__t"], "variable", "x", "string")
    cells = (long.select("variable", F.coalesce("x", F.lit("Missing")).alias("x"),
                         F.coalesce(F.col("__t").cast("string"), F.lit("Missing")).alias("y"))
                 .groupBy("variable", "x", "y").agg(F.count(F.lit(1)).alias("o")))
    v = _cramers_from_cells(cells, ["variable"], "nan")
    return (v.select("variable", F.lit(target).alias("target"), "cramers_v",
                     strength_label(F.col("cramers_v")).alias("strength"))
             .orderBy(F.desc_nulls_last("cramers_v"), "variable"))


def select_above(ranking: DataFrame, threshold: float = 0.1, col: str = "cramers_v") -> DataFrame:
    """C11: variables whose association exceeds the threshold."""
    return ranking.where(F.col(col) > threshold)


# ----------------------------------------------------------- crosstabs

def crosstab_long(df: DataFrame, x: str, y: str) -> DataFrame:
    """Contingency counts in long form (x, y, n)."""
    return (df.where(q(x).isNotNull() & q(y).isNotNull())
              .groupBy(q(x).cast("string").alias("x"), q(y).cast("string").alias("y"))
              .agg(F.count(F.lit(1)).alias("n")))


def normalized_crosstab(df: DataFrame, x: str, y: str, y_levels: Sequence[str] | None = None,
                        missing_level: bool = True, max_levels: int = 1000) -> DataFrame:
    """Row-normalised crosstab in percent with the full grid (absent cells 0).

    Every observed row level is expanded over the column levels with an
    ``explode`` of a literal array (no join); column levels are declared or
    probed, and the probe is bounded by ``max_levels``."""
    xs = q(x).cast("string")
    if missing_level:
        xs = F.coalesce(xs, F.lit("Missing"))
    base = df.where(q(y).isNotNull()).select(xs.alias("x"), q(y).cast("string").alias("y")).where(F.col("x").isNotNull())
    counts = base.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    if y_levels is None:
        got = [r[0] for r in counts.select("y").distinct().orderBy("y").limit(max_levels + 1).collect()]
        if len(got) > max_levels:
            raise ValueError(f"column {y} has more than {max_levels} levels")
        y_levels = got
    rows = counts.groupBy("x").agg(F.sum("n").alias("row_n"))
    grid = rows.select("x", "row_n", F.explode(F.array(*[F.lit(v) for v in y_levels])).alias("y"))
    out = grid.join(counts, ["x", "y"], "left")
    return out.select("x", "y", (F.coalesce(F.col("n"), F.lit(0)) * 100.0 / F.col("row_n")).alias("pct"))


def crosstab_margins(df: DataFrame, x: str, y: str, total: str = "All") -> DataFrame:
    """C14: crosstab with margins via ``cube``; margins labelled ``All``."""
    c = (df.where(q(x).isNotNull() & q(y).isNotNull())
           .cube(q(x).cast("string").alias("x"), q(y).cast("string").alias("y"))
           .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g")))
    return c.select(F.when(F.col("_g").bitwiseAND(2) > 0, F.lit(total)).otherwise(F.col("x")).alias("x"),
                    F.when(F.col("_g").bitwiseAND(1) > 0, F.lit(total)).otherwise(F.col("y")).alias("y"),
                    "n")


# ------------------------------------------------------ numeric vs target

def numeric_target_ranking(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r with the 0/1 target, strength, class means and their
    difference; columns with under two distinct values are skipped.  One
    aggregate for all columns, then a narrow stack."""
    t = binary_target(df, target).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        ok = x.isNotNull() & t.isNotNull()
        xv = F.when(ok, x)
        aggs += [safe_corr(xv, F.when(ok, t)).alias(f"r{i}"),
                 F.avg(F.when(ok & (t == 0), x)).alias(f"m0_{i}"),
                 F.avg(F.when(ok & (t == 1), x)).alias(f"m1_{i}"),
                 (F.min(xv) < F.max(xv)).alias(f"d{i}")]
    row = df.agg(*aggs)
    st = ", ".join(f"'{c}', r{i}, m0_{i}, m1_{i}, d{i}" for i, c in enumerate(cols))
    long = row.selectExpr(f"stack({len(cols)}, {st}) as (variable, pearson_r, mean_0, mean_1, varies)")
    return (long.where("varies").drop("varies")
                .select("variable", F.lit(target).alias("target"), "pearson_r",
                        strength_label(F.col("pearson_r")).alias("strength"), "mean_0", "mean_1",
                        (F.col("mean_1") - F.col("mean_0")).alias("mean_diff"))
                .orderBy(F.desc_nulls_last("pearson_r"), "variable"))


def numeric_by_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Mean, median, std (ddof=1), min, max per (target class, variable), long form."""
    from tablewise.functions.quantiles import quantile_table
    long = unpivot(df.where(q(target).isNotNull()), cols, [target], "variable", "value").withColumnRenamed(
        target, "target_class")
    return quantile_table(long, ["target_class", "variable"], "value", (0.5,), ("median",), [
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")])


def target_mean_diff(df: DataFrame, cols: Sequence[str], target: str, order_col: str) -> DataFrame:
    """Per variable and class: class mean, global mean and deviation.
    For a binary target also returns diff = mean(b) - mean(a) where a, b are
    the first-appearing classes (by ``order_col``); order |diff| desc."""
    long = unpivot(df, cols, [target, order_col], "variable", "value")
    g = long.groupBy("variable").agg(F.avg("value").alias("global_mean"))
    c = (long.where(F.col(target).isNotNull())
             .groupBy("variable", F.col(target).cast("string").alias("target_class"))
             .agg(F.avg("value").alias("class_mean")))
    out = c.join(g, "variable").withColumn("deviation", F.col("class_mean") - F.col("global_mean"))
    return out


def binary_mean_diff(df: DataFrame, cols: Sequence[str], target: str, order_col: str) -> DataFrame:
    """C17: mean(b) - mean(a) per variable for the two first-appearing classes."""
    firsts = (df.where(q(target).isNotNull()).groupBy(q(target).cast("string").alias("cls"))
                .agg(F.min(q(order_col)).alias("f")).orderBy("f", "cls").limit(2).collect())
    if len(firsts) < 2:
        raise ValueError("target needs two classes")
    a, b = firsts[0]["cls"], firsts[1]["cls"]
    tc = q(target).cast("string")
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.avg(F.when(tc == a, x)).alias(f"a{i}"), F.avg(F.when(tc == b, x)).alias(f"b{i}")]
    st = ", ".join(f"'{c}', a{i}, b{i}" for i, c in enumerate(cols))
    long = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {st}) as (variable, mean_a, mean_b)")
    return (long.select("variable", F.lit(a).alias("class_a"), F.lit(b).alias("class_b"), "mean_a", "mean_b",
                        (F.col("mean_b") - F.col("mean_a")).alias("diff"))
                .orderBy(F.desc_nulls_last(F.abs("diff")), "variable"))


# -------------------------------------------------------------- influence

def influence(df: DataFrame, cols: Sequence[str] | str, target: str, target_expr: Column | None = None,
              order_col: str | None = None, declared: dict | None = None) -> DataFrame:
    """Per (variable, category): n, positive rate, pct, delta vs the global
    rate in points, relative risk.  Rows with null category or null target are
    dropped from the groups; the global rate is over all non-null targets.

    One unpivot + one ``groupBy`` for every column; the global rate is a
    scalar subquery (no join)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    t = target_expr if target_expr is not None else binary_target(df, target)
    base = df.select(*[q(c).cast("string").alias(c) for c in cols], t.alias("__t"))
    glob = scalar(base, F.avg("__t"))
    long = unpivot(base, cols, ["__t"], "variable", "category", "string")
    g = (long.where(F.col("category").isNotNull() & F.col("__t").isNotNull())
             .groupBy("variable", "category")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("__t").alias("rate")))
    return g.select("variable", "category", "n", "rate",
                    (F.col("rate") * 100).alias("rate_pct"),
                    ((F.col("rate") - glob) * 100).alias("delta_pp"),
                    F.try_divide(F.col("rate"), F.when(glob != 0, glob)).alias("relative_risk"))
