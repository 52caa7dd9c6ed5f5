"""Stateless operators applied to a stream give the batch result."""

import os
import tempfile

SF = "/root/testdata/sf0.001"


def test_streamed_zscore_equals_batch(spark):
    from pyspark.sql import functions as F
    from tablewise.operators import outliers, scale
    from tablewise.sources.tables import table
    from tablewise.streaming import stateless
    li = table(spark, SF, "lineitem")
    stats = scale.fit(li, ["l_extendedprice"])
    stream = stateless.read_parquet_stream(spark, SF, li.schema, glob="lineitem.parquet")
    scaled = stateless.frozen_scaler(stats, "zscore", ["l_extendedprice"])(stream)
    lim = outliers.iqr_limits(li, ["l_quantity"])
    flagged = stateless.frozen_iqr_flags(lim, ["l_quantity"], keep=["l_orderkey", "l_linenumber"])(stream)
    d = tempfile.mkdtemp(prefix="tw-stream-")
    stateless.run_available(scaled.select("l_orderkey", "l_linenumber", "l_extendedprice"),
                            os.path.join(d, "out"), os.path.join(d, "ck"))
    stateless.run_available(flagged, os.path.join(d, "out2"), os.path.join(d, "ck2"))
    got = spark.read.parquet(os.path.join(d, "out"))
    want = scale.transform(li, stats, "zscore", ["l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_extendedprice")
    r = lambda d: d.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 9).alias("v"))
    assert got.count() == li.count() and r(got).exceptAll(r(want)).count() == 0
    f_got = spark.read.parquet(os.path.join(d, "out2"))
    f_want = outliers.iqr_flags(li, ["l_quantity"], keep=["l_orderkey", "l_linenumber"])
    assert f_got.exceptAll(f_want).count() == 0 and f_got.count() == li.count()
