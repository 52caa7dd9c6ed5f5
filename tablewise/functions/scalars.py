"""Scalar and array helpers with Python / NumPy semantics.

Most of the notebooks' scalar operations are Spark built-ins used directly;
the helpers here cover the places where the Python meaning differs from the
SQL one (floor division, modulo sign, rounding mode, population std of an
array, size-checked element-wise arithmetic).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floordiv(a: Column, b: Column) -> Column:
    """Python ``a // b`` (floors toward -inf; Spark ``div`` truncates)."""
    return F.floor(F.try_divide(a.cast("double"), b.cast("double"))).cast("long")


def pymod(a: Column, b: Column) -> Column:
    """Python ``a % b``: result takes the sign of the divisor."""
    r = F.when(b != 0, a % b)
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def pyround(a: Column, digits: int = 0) -> Column:
    """Python ``round`` (half to even) -- Spark ``bround``."""
    return F.bround(a, digits)


def array_mean(a: Column) -> Column:
    """Mean of a numeric array."""
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, v: s + v), F.size(a).cast("double"))


def array_std(a: Column) -> Column:
    """NumPy ``std`` (population, ddof=0) of a numeric array."""
    m = array_mean(a)
    ss = F.aggregate(a, F.lit(0.0), lambda s, v: s + (v - m) * (v - m))
    return F.sqrt(F.try_divide(ss, F.size(a).cast("double")))


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def elementwise(a: Column, b: Column, op) -> Column:
    """X11: element-wise arithmetic of two arrays; unequal sizes raise (NumPy
    raises on shape mismatch) via ``raise_error``."""
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, op)).otherwise(
        F.raise_error(F.lit("operands could not be broadcast together")))


def scalar_op(a: Column, fn) -> Column:
    """Element-wise with a scalar, or a masked assignment, via ``transform``."""
    return F.transform(a, fn)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equally sized arrays."""
    return array_sum(elementwise(a, b, lambda x, y: x * y))


def clip_negative(a: Column) -> Column:
    """``n[n < 0] = 0``."""
    return F.transform(a, lambda v: F.when(v < 0, F.lit(0.0)).otherwise(v))


def linspace(start: float, stop: float, num: int) -> Column:
    """``numpy.linspace`` as an array column."""
    if num == 1:
        return F.array(F.lit(float(start)))
    step = (stop - start) / (num - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)), lambda i: F.lit(float(start)) + i * F.lit(step))
