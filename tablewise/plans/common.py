"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.functions.core import q

#: Significant digits that two engines' sums agree on, and the decimals beyond which all is noise.
DIGITS, DECIMALS = 9, 12


def significant(c: Column) -> Column:
    """``c`` rounded to ``DIGITS`` significant digits, ``DECIMALS`` decimals at most."""
    places = F.greatest(F.lit(0.0), F.least(F.lit(float(DECIMALS)), DIGITS - 1 - F.floor(F.log10(F.abs(c)))))
    unit = F.pow(F.lit(10.0), places)
    return F.when(F.abs(c) < 5 * 10.0 ** (-DECIMALS - 1), F.lit(0.0)).otherwise(F.rint(c * unit) / unit)


def finish(df: DataFrame) -> DataFrame:
    """Round floating outputs (summation order differs between engines) and
    cast integral outputs to bigint, so results compare across engines."""
    out = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(significant(c.cast("double")).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
