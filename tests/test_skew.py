"""Skew: one key holding a third (or more) of the rows, and the distributed
range path of the prefix sums forced on, give the same results as pandas."""

import numpy as np
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def force_ranges(monkeypatch):
    import tablewise.functions.prefix as prefix
    monkeypatch.setattr(prefix, "SMALL_GROUP", 10)


def _skewed(spark):
    from pyspark.sql import functions as F
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # 'hot' holds every line number <= 3 (about half of the rows)
    return li.select(F.when(F.col("l_linenumber") <= 3, F.lit("hot")).otherwise(F.col("l_returnflag")).alias("g"),
                     "l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber")


def test_quantiles_range_path_hot_key(spark, force_ranges):
    from tablewise.functions.quantiles import exact_quantiles
    df = _skewed(spark)
    got = {(r["g"], r["variable"], r["prob"]): r["quantile"] for r in
           exact_quantiles(df, ["l_extendedprice", "l_quantity"], (0.1, 0.25, 0.5, 0.9), by=["g"]).collect()}
    pdf = df.toPandas()
    for (g, var, p), v in got.items():
        want = np.percentile(pdf.loc[pdf.g == g, var].to_numpy(), p * 100)
        assert abs(v - want) < 1e-6 * max(1, abs(want)), (g, var, p, v, want)
    assert len(got) == pdf.g.nunique() * 2 * 4


def test_positions_range_path_hot_key(spark, force_ranges):
    from pyspark.sql import functions as F
    from tablewise.operators.learn import position_in_group
    df = _skewed(spark).withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.rand(1) / 10)
    got = position_in_group(df, ["g"], "rid").select("g", "rid", "pos").toPandas()
    got = got.sort_values(["g", "rid"])
    want = got.groupby("g").cumcount()
    assert (got["pos"].to_numpy() == want.to_numpy()).all()


def test_top_n_hot_group(spark):
    from pyspark.sql import functions as F
    from tablewise.functions.topk import top_n_per_group
    df = _skewed(spark).withColumn("rid", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    got = top_n_per_group(df, ["g"], ["l_extendedprice", "rid"], 3, ascending=[False, True]).toPandas()
    pdf = df.toPandas().sort_values(["g", "l_extendedprice", "rid"], ascending=[True, False, True])
    want = pdf.groupby("g").head(3)
    assert sorted(zip(got.g, got.rid)) == sorted(zip(want.g, want.rid))
