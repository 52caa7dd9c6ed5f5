"""User-callback surface.

Native expressions come first everywhere in the library; these wrappers
are for callbacks a user supplies.  All are Arrow-batched (pandas UDF,
``mapInPandas``, ``applyInPandas``) -- never row-at-a-time Python UDFs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewise.functions.core import q


def apply_values(col: Column | str, fn: Callable, return_type: str = "double") -> Column:
    """B1: ``Series.apply(fn)`` / ``map(fn)``: ``fn`` maps one value; applied
    to Arrow batches with ``Series.map`` inside a scalar pandas UDF."""
    @F.pandas_udf(return_type)
    def _apply(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None or (isinstance(v, float) and v != v) else fn(v))
    return _apply(q(col) if isinstance(col, str) else col)


def apply_series(col: Column | str, fn: Callable[[pd.Series], pd.Series], return_type: str = "double") -> Column:
    """B1 (vectorised): ``fn`` maps a whole pandas Series batch."""
    return F.pandas_udf(fn, return_type)(q(col) if isinstance(col, str) else col)


def apply_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """B2: ``DataFrame.apply(axis='columns')``: ``fn`` maps a pandas batch of rows."""
    def run(batches):
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def apply_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                 schema: str) -> DataFrame:
    """Per-group callback (``groupby(...).apply``) with ``applyInPandas``.
    A group is materialised in one task, so callers should pre-aggregate
    when a single key can hold a large share of the table."""
    return df.groupBy(*[q(k) for k in keys]).applyInPandas(fn, schema)


def map_dict(col: Column | str, mapping: dict) -> Column:
    """``Series.map(dict)`` as a literal map lookup (no Python at run time)."""
    from tablewise.operators.encode import map_values
    return map_values(q(col) if isinstance(col, str) else col, mapping)
