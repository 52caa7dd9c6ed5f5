"""Bounded top-n per group.

``rank <= n`` over ``row_number()`` lets Spark keep n rows per group in every
input partition before the shuffle (its window group limit), so a group holding
a third of the table sends n rows a task to the final window.  Nulls in the
order columns come last in either direction, so the answer does not depend on
how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int,
                    ascending: Sequence[bool] | bool = True, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n within each group by ``order`` (later order columns
    break ties); returns the input columns plus ``rank_col``."""
    asc = [ascending] * len(order) if isinstance(ascending, bool) else list(ascending)
    w = Window.partitionBy(*group).orderBy(*(
        F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(order, asc)))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
