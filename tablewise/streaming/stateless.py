"""Structured Streaming versions of the stateless operators.

Profiling is batch-only, but a fitted transformation -- a scaler's statistics,
frozen outlier limits, an encoding map -- applies row by row, so it runs
unchanged on a stream.  Statistics are fitted once on a batch table, frozen
as literals (one bounded row), and the stream writes with a checkpoint
location so a restarted query resumes exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.functions.core import q
from tablewise.operators import scale


def read_parquet_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def frozen_scaler(stats: DataFrame, kind: str, cols: Sequence[str], strict: bool = False):
    """Turn fitted statistics (``scale.fit``) into a function of a (streaming)
    DataFrame with the statistics as literals."""
    row = stats.collect()[0].asDict()  # one row by construction

    def apply(df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c not in cols:
                out.append(q(c))
                continue
            x = q(c).cast("double")
            if kind == "minmax":
                e = scale.minmax_expr(x, F.lit(row[f"{c}__min"]), F.lit(row[f"{c}__max"]))
            elif kind == "zscore":
                e = scale.zscore_expr(x, F.lit(row[f"{c}__mean"]), F.lit(row[f"{c}__std"]))
            else:
                e = scale.decimal_expr(x, F.lit(row[f"{c}__maxabs"]), strict)
            out.append(e.alias(c))
        return df.select(*out)
    return apply


def frozen_iqr_flags(limits: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()):
    """O3 on a stream: IQR limits fitted on a batch table, frozen as literals."""
    lim = {r["column"]: (r["lower_limit"], r["upper_limit"]) for r in limits.collect()}  # one row per column

    def apply(df: DataFrame) -> DataFrame:
        flags = [F.coalesce((q(c) < lim[c][0]) | (q(c) > lim[c][1]), F.lit(False)).alias(c + "_outlier_iqr") for c in cols]
        return df.select(*[q(k) for k in keep], *flags)
    return apply


def run_available(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet"):
    """Process everything available now and stop (``availableNow`` trigger)."""
    q_ = (stream.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    q_.awaitTermination()
    return q_
