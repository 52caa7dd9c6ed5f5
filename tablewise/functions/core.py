"""Column-expression helpers shared by every operator.

Everything here builds native Catalyst expressions (no Python UDFs), so the
callers stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose Spark type is numeric (P5, ``select_dtypes(number)``)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)) and f.name not in ex]


def resolve_columns(df: DataFrame, cols: Sequence[str] | None, numeric: bool = True) -> list[str]:
    """Intersect the requested list with the table; default all numeric."""
    if cols is None:
        return numeric_columns(df) if numeric else list(df.columns)
    present = set(df.columns)
    return [c for c in cols if c in present]


def q(name: str) -> Column:
    """Column reference that tolerates any character in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
            var: str = "variable", val: str = "value", dtype: str | None = "double") -> DataFrame:
    """Wide -> long.  Narrow (an Expand), so no shuffle; values cast to one type."""
    cast = [(q(c).cast(dtype) if dtype else q(c)).alias(c) for c in cols]
    wide = df.select(*[q(i) for i in ids], *cast)
    return wide.unpivot(list(ids), list(cols), var, val)


def scalar(df: DataFrame, expr: Column) -> Column:
    """Global aggregate as a scalar subquery.  Several of them over the same
    input are merged by Catalyst into one aggregate job; rows then see the
    value as a constant, with no join (J4, F4)."""
    return df.select(expr).scalar()


def pct(num: Column, den: Column, dp: int | None = 4) -> Column:
    v = F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double"))
    return F.round(v, dp) if dp is not None else v


def skew_unbiased(c: Column) -> Column:
    """Adjusted Fisher-Pearson skewness G1 (pandas ``skew``): Spark's
    ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_unbiased(c: Column) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``kurt``) from Spark's
    population excess kurtosis g2."""
    n = F.count(c).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def std_sample(c: Column) -> Column:
    """ddof=1 std, null when fewer than two values (pandas)."""
    return F.when(F.count(c) > 1, F.stddev_samp(c))


# Association strength labels and their cut points, as in the reference.
STRENGTH_CUTS = (0.30, 0.50, 0.70, 0.90)
STRENGTH_LABELS = ("muito fraca", "fraca", "moderada", "forte", "muito forte")
STRENGTH_UNDEFINED = "indeterminada"
# Correlation sign labels.
SIGN_LABELS = ("positiva", "negativa", "nula")


def strength_label(c: Column) -> Column:
    """Strength of |value| by cut points .30 .50 .70 .90; null/NaN -> undefined."""
    a = F.abs(c)
    e = F.when(c.isNull() | F.isnan(c), F.lit(STRENGTH_UNDEFINED))
    for cut, lab in zip(STRENGTH_CUTS, STRENGTH_LABELS):
        e = e.when(a < cut, F.lit(lab))
    return e.otherwise(F.lit(STRENGTH_LABELS[-1]))


def sign_label(c: Column) -> Column:
    """C4: sign of a correlation."""
    return (F.when(c > 0, F.lit(SIGN_LABELS[0])).when(c < 0, F.lit(SIGN_LABELS[1]))
            .otherwise(F.lit(SIGN_LABELS[2])))


def safe_name(c: Column, default: str = "variavel") -> Column:
    """Lower-case, non-alphanumerics to '_', collapse repeats, trim '_'."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[^\p{L}\p{N}]", "_")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.when(F.length(s) > 0, s).otherwise(F.lit(default))


def clean_text(c: Column) -> Column:
    """P10: trim and collapse inner whitespace."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def display_value(c: Column, max_len: int = 80, missing: str = "VALOR_EM_FALTA") -> Column:
    """Display form of a value; null -> marker, collapse spaces, cut long text."""
    s = F.regexp_replace(F.trim(c.cast("string")), r"\s+", " ")
    cut = F.concat(F.substring(s, 1, max_len - 3), F.lit("..."))
    return F.when(c.isNull(), F.lit(missing)).when(F.length(s) > max_len, cut).otherwise(s)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Ingest rule: floating NaN becomes NULL so aggregates skip it as pandas does."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(F.nanvl(q(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(q(f.name))
    return df.select(*out)


def first_rank(df: DataFrame, key: str, order_col: str, rank_col: str = "code",
               base: int = 0) -> DataFrame:
    """Rank distinct values of ``key`` by their first appearance (min order_col).

    The level table (one row per distinct value) is ranked with a distributed
    prefix sum over range partitions, so a high-cardinality column is never
    ranked by a single task."""
    from tablewise.functions.prefix import prefix_sum
    firsts = df.where(q(key).isNotNull()).groupBy(q(key).alias(key)).agg(F.min(q(order_col)).alias("_first"))
    pos = prefix_sum(firsts, [], ["_first", key], out="pos")
    return pos.select(q(key), (F.col("pos") + base).alias(rank_col))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over pairwise-complete rows that yields null (not an
    ANSI divide-by-zero error) when either side is constant."""
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def mode_of(df: DataFrame, col: str) -> Column:
    """Most frequent non-null value (smallest among ties) as a scalar
    subquery.  Counting is a distributed ``groupBy``; the final pick is a
    ``min_by`` whose partial buffers hold one candidate each -- unlike the
    ``mode`` aggregate, no task buffers the whole domain."""
    vc = df.where(q(col).isNotNull()).groupBy(q(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return vc.agg(F.min_by("_v", F.struct(-F.col("_c"), F.col("_v")))).scalar()
