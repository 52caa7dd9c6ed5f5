"""Encoding, mapping and discretisation.

Value maps are literal ``map`` expressions (tiny, embedded in the plan);
bin edges and quantile edges are scalar subqueries, so every transform is one
narrow projection over the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q, scalar

# Survey-specific maps and orders used by the reference.
AGE_GROUPS = {
    "18-24": "Young Adult", "25-29": "Young Adult", "30-34": "Young Adult", "35-39": "Young Adult",
    "40-44": "Adult", "45-49": "Adult", "50-54": "Adult", "55-59": "Adult", "60-64": "Adult",
    "65-69": "Senior", "70-74": "Senior", "75-79": "Senior", "80+": "Senior",
}
DIABETES_MAP = {
    "No": "No",
    "No, pre-diabetes or borderline diabetes": "No",
    "Yes, but female told only during pregnancy": "Yes",
    "Yes": "Yes",
}
ORDINAL_ORDER = {
    "General_Health": ["Poor", "Fair", "Good", "Very Good", "Excellent"],
    "Checkup": ["Never", "5 or more years ago", "Within the past 5 years",
                "Within the past 2 years", "Within the past year"],
    "Age_Category": ["Young Adult", "Adult", "Senior"],
}
# Binary token tables (E8 includes the sex tokens, E9 does not).
NEGATIVE_TOKENS = ("no", "n", "false", "0", "female", "f")
POSITIVE_TOKENS = ("yes", "y", "true", "1", "male", "m")
TARGET_NEGATIVE_TOKENS = ("no", "n", "false", "0")
TARGET_POSITIVE_TOKENS = ("yes", "y", "true", "1")
# Threshold bins (left-closed, "value < edge").
BMI_BINS = ((18.5, "Underweight"), (25, "Normal"), (30, "Overweight"), (35, "Obesity I"), (None, "Obesity II+"))
HEIGHT_BINS = ((160, "Short"), (170, "Medium"), (180, "Tall"), (None, "Very Tall"))
WEIGHT_BINS = ((60, "Light"), (75, "Moderate"), (90, "Heavy"), (None, "Very Heavy"))
# Consumption rules; zero is "Never", then (edge, closed_right) steps.
CONSUMPTION_RULES = {
    "alcohol": ((5, True, "Low"), (10, True, "Moderate")),
    "fried_potato": ((2, True, "Low"), (5, True, "Moderate")),
    "generic": ((10, False, "Low"), (20, False, "Moderate")),
}


def map_values(c: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; unmapped -> null."""
    if not mapping:
        return F.lit(None)
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(lit_map, c)


def threshold_bins(c: Column, bins: Sequence[tuple]) -> Column:
    """Left-closed thresholds ``value < edge``; last entry edge None = else."""
    e = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in bins:
        e = e.when(c < edge, F.lit(label)) if edge is not None else e.otherwise(F.lit(label))
    return e


def consumption_bins(c: Column, kind: str = "generic") -> Column:
    """E5: zero -> Never, then rule-dependent steps, else High."""
    e = F.when(c.isNull(), F.lit(None).cast("string")).when(c == 0, F.lit("Never"))
    for edge, closed, label in CONSUMPTION_RULES[kind]:
        e = e.when((c <= edge) if closed else (c < edge), F.lit(label))
    return e.otherwise(F.lit("High"))


def ordinal_code(c: Column, order: Sequence[str], base: int = 0) -> Column:
    """E10 (base 0) / E11 (base 1): position in the declared order; unknown -> null."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), c)
    return F.when(pos > 0, pos - 1 + base).cast("int")


def probe_domains(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Distinct non-null values of each column when there are at most two,
    else the two extremes plus a ``"<more>"`` marker.

    Two constant-memory aggregate jobs for all columns (min/max, then "any
    third value"), so the probe never buffers a domain in one task."""
    if not cols:
        return {}
    s = {c: q(c).cast("string") for c in cols}
    r1 = df.agg(*[f(s[c]).alias(f"{n}{i}") for i, c in enumerate(cols)
                  for f, n in ((F.min, "mn"), (F.max, "mx"))]).collect()[0]
    third = [F.max(F.when(s[c].isNotNull() & (s[c] != F.lit(r1[f"mn{i}"])) & (s[c] != F.lit(r1[f"mx{i}"])), 1))
             .alias(f"t{i}") for i, c in enumerate(cols) if r1[f"mn{i}"] is not None]
    r2 = df.agg(*third).collect()[0].asDict() if third else {}
    out = {}
    for i, c in enumerate(cols):
        mn, mx = r1[f"mn{i}"], r1[f"mx{i}"]
        if mn is None:
            out[c] = []
        elif mn == mx:
            out[c] = [mn]
        else:
            out[c] = [mn, mx] + (["<more>"] if r2.get(f"t{i}") else [])
    return out


def _binary_pair(values: list, neg: Sequence[str], pos: Sequence[str], strict_two: bool,
                 first_token_wins: bool) -> tuple | None:
    vals = [v for v in values if v != "<more>"]
    more = len(values) != len(vals)
    zero = one = None
    for v in vals:
        k = str(v).strip().lower()
        if k in neg:
            zero = v
        if k in pos and (first_token_wins is False or zero != v):
            one = v
    if zero is None or one is None:
        if more or len(vals) != 2:
            return None
        zero, one = sorted(vals, key=str)
    return zero, one


def binary_encode(df: DataFrame, cols: Sequence[str], domains: dict | None = None) -> DataFrame:
    """Exactly two distinct values -> 0/1 (token tables first, else sorted
    order); any other column is coerced to double with ``try_cast``."""
    domains = domains if domains is not None else probe_domains(df, cols)
    out = []
    for name in df.columns:
        if name not in cols:
            out.append(q(name))
            continue
        vals = domains[name]
        pair = None if len(vals) != 2 else _binary_pair(vals, NEGATIVE_TOKENS, POSITIVE_TOKENS, True, False)
        if pair is None:
            out.append(q(name).cast("string").try_cast("double").alias(name))
        else:
            zero, one = pair
            s = q(name).cast("string")
            out.append(F.when(s == zero, 0).when(s == one, 1).cast("int").alias(name))
    return df.select(*out)


def binary_target(df: DataFrame, col: str) -> Column:
    """0/1 expression for a binary target; token tables need not be the only
    values, else exactly two classes in sorted order; raises otherwise."""
    s = q(col).cast("string")
    token = F.lower(F.trim(s))
    negative, positive = token.isin(list(TARGET_NEGATIVE_TOKENS)), token.isin(list(TARGET_POSITIVE_TOKENS))
    # tokens of both sides anywhere in the column decide; other values become null
    found = df.agg(F.bool_or(negative).alias("no"), F.bool_or(positive).alias("yes")).first()
    if found["no"] and found["yes"]:
        return F.when(negative, 0).when(positive, 1).cast("int")
    vals = probe_domains(df, [col])[col]
    if len(vals) != 2 or "<more>" in vals:
        raise ValueError("Target column must contain exactly two classes.")
    zero, one = sorted(vals, key=str)
    return F.when(s == zero, 0).when(s == one, 1).cast("int")


def factorize(df: DataFrame, col: str, order_col: str, out: str | None = None) -> DataFrame:
    """Code by first appearance (smallest ``order_col``), null -> -1.

    The level table (one row per distinct value) is joined back; Catalyst
    broadcasts it when its estimated size is under the threshold and falls
    back to a shuffle join otherwise (high-cardinality columns)."""
    from tablewise.functions.core import first_rank
    out = out or col + "_code"
    codes = first_rank(df, col, order_col, "_code").withColumnRenamed(col, "_lvl")
    j = df.join(codes, q(col) == F.col("_lvl"), "left")
    return j.select(*[q(c) for c in df.columns], F.coalesce(F.col("_code"), F.lit(-1)).cast("int").alias(out))


def cut_edges(c: Column, edges: Sequence[float], labels: Sequence[str] | None = None,
              right: bool = True, include_lowest: bool = False) -> Column:
    """``pd.cut`` with explicit edges; right-closed by default, lowest
    edge excluded unless ``include_lowest``; outside -> null."""
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    e = F.when(c.isNull(), F.lit(None))
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if right:
            cond = ((c >= lo) if (include_lowest and i == 0) else (c > lo)) & (c <= hi)
        else:
            cond = (c >= lo) & ((c <= hi) if (include_lowest and i == len(edges) - 2) else (c < hi))
        e = e.when(cond, F.lit(labels[i]))
    return e


def cut_equal_width(df: DataFrame, col: str, bins: int, out: str | None = None) -> DataFrame:
    """``pd.cut(s, n)``: n equal widths over [min, max]; the first edge is
    widened by 0.1 % of the range so the minimum falls in bin 0; right-closed.
    Returns the bin index 0..n-1."""
    out = out or col + "_bin"
    x = q(col).cast("double")
    mn, mx = scalar(df, F.min(x)), scalar(df, F.max(x))
    width = (mx - mn) / bins
    # right-closed: index = ceil((x - min) / width) - 1, the minimum goes to bin 0
    idx = F.greatest(F.ceil((x - mn) / width) - 1, F.lit(0))
    idx = F.when(mx == mn, F.lit(0)).otherwise(F.least(idx, F.lit(bins - 1)))
    return df.withColumn(out, F.when(x.isNotNull(), idx.cast("int")))


def qcut(df: DataFrame, col: str, q_: int, out: str | None = None) -> DataFrame:
    """``pd.qcut``: edges are exact linear-interpolated quantiles; bins are
    right-closed with the lowest included.  Returns the bin index; duplicate
    edges are not allowed (as in pandas, which raises)."""
    out = out or col + "_qbin"
    from tablewise.functions.quantiles import quantile_table
    x = q(col).cast("double")
    long = df.select(F.lit(col).alias("variable"), x.alias("value"))
    names = [f"e{i}" for i in range(1, q_)]
    table = quantile_table(long, ["variable"], "value", [i / q_ for i in range(1, q_)], names,
                           [F.min("value").alias("least"), F.max("value").alias("most")], few_groups=True)
    edges = table.select(F.array("least", *names, "most")).scalar()
    # pandas refuses equal edges, the least and greatest value included
    twice = table.select(F.size(F.array_distinct(F.array("least", *names, "most"))) <= q_).scalar()
    # index = number of inner edges strictly below x (right-closed bins)
    idx = sum((F.when(x > edges[i], 1).otherwise(0) for i in range(1, q_)), F.lit(0))
    idx = F.when(twice, F.raise_error(F.lit("Bin edges must be unique")).cast("int")).otherwise(idx)
    return df.withColumn(out, F.when(x.isNotNull(), idx.cast("int")))


def domain_order(df: DataFrame, col: str, order_col: str, declared: Sequence[str] | None = None) -> DataFrame:
    """Output order of a column's levels: declared order first (only levels
    present), then extra levels by first appearance; alphabetical when no
    order is declared.  Returns (level, level_order).  The ranking window runs
    over the level table (one row per distinct level of a categorical
    column), not over the data."""
    from pyspark.sql import Window
    lv = (df.where(q(col).isNotNull())
            .groupBy(q(col).cast("string").alias("level"))
            .agg(F.min(q(order_col)).alias("_first")))
    if declared:
        pos = F.array_position(F.array(*[F.lit(v) for v in declared]), F.col("level"))
        key = [F.when(pos > 0, pos).otherwise(F.lit(len(declared) + 1)), F.col("_first"), F.col("level")]
    else:
        key = [F.col("level")]
    return lv.select("level", (F.row_number().over(Window.orderBy(*key)) - 1).alias("level_order"))


def prepare_variant(df: DataFrame, spec: Mapping[str, tuple], drop: Sequence[str] = ()) -> DataFrame:
    """A whole-table variant as ONE projection.

    ``spec`` maps a column to a rule: ``("map", dict)``, ``("bins", bins)``,
    ``("consumption", kind)``, ``("ordinal", order)`` (0-based),
    ``("binary",)`` (E8 rule, one shared domain probe) or ``("numeric",)``
    (``try_cast`` to double).  Unlisted columns pass through; ``drop``
    removes columns (feature-set switch P4)."""
    binaries = [c for c, r in spec.items() if r[0] == "binary" and c in df.columns]
    domains = probe_domains(df, binaries) if binaries else {}
    out = []
    for c in df.columns:
        if c in drop:
            continue
        rule = spec.get(c)
        x = q(c)
        if rule is None:
            out.append(x)
        elif rule[0] == "map":
            out.append(map_values(x, rule[1]).alias(c))
        elif rule[0] == "bins":
            out.append(threshold_bins(x, rule[1]).alias(c))
        elif rule[0] == "consumption":
            out.append(consumption_bins(x, rule[1]).alias(c))
        elif rule[0] == "ordinal":
            out.append(ordinal_code(x, rule[1]).alias(c))
        elif rule[0] == "numeric":
            out.append(x.cast("string").try_cast("double").alias(c))
        elif rule[0] == "binary":
            vals = domains[c]
            pair = None if len(vals) != 2 else _binary_pair(vals, NEGATIVE_TOKENS, POSITIVE_TOKENS, True, False)
            if pair is None:
                out.append(x.cast("string").try_cast("double").alias(c))
            else:
                s = x.cast("string")
                out.append(F.when(s == pair[0], 0).when(s == pair[1], 1).cast("int").alias(c))
        else:
            raise ValueError(rule)
    return df.select(*out)


def survey_categorical_spec() -> dict:
    """E6 rule set of the reference's survey table."""
    return {"Diabetes": ("map", DIABETES_MAP), "Age_Category": ("map", AGE_GROUPS),
            "BMI": ("bins", BMI_BINS), "Height_(cm)": ("bins", HEIGHT_BINS), "Weight_(kg)": ("bins", WEIGHT_BINS),
            "Alcohol_Consumption": ("consumption", "alcohol"), "Fruit_Consumption": ("consumption", "generic"),
            "Green_Vegetables_Consumption": ("consumption", "generic"),
            "FriedPotato_Consumption": ("consumption", "generic")}
