"""Bracketed quantiles against NumPy, null groups, file types and encodings, the perceptron rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewise.functions import quantiles as Q
from tablewise.operators import learn, plotdata, profile
from tablewise.sources import files

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed", "small"])
def test_quantiles_and_mad_beyond_the_sketch(spark, shape):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(size=60_001), "ties": rng.integers(0, 4, 60_000) * 1.5, "skewed": np.exp(rng.normal(size=45_000) * 4),
         "small": rng.normal(size=7)}[shape]
    df = spark.createDataFrame([(float(v),) for v in x], "v double").withColumn("variable", F.lit("v")).repartition(5)
    table = Q.quantile_table(df, ["variable"], "v", PROBS, [f"p{i}" for i in range(len(PROBS))], [F.count("v").alias("n")], few_groups=True).first()
    assert table.n == len(x)
    assert np.allclose([table[f"p{i}"] for i in range(len(PROBS))], np.quantile(x, PROBS), rtol=1e-12, atol=1e-12)
    told = Q.median_and_mad(df, ["variable"], "v", few_groups=True).first()
    assert np.allclose([told.median, told.mad], [np.median(x), np.median(np.abs(x - np.median(x)))], rtol=1e-12, atol=1e-12)


def test_null_groups_keep_their_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "g string, v double")
    got = {r.g: r.median for r in profile.group_aggregate(df, ["g"], ["v"]).collect()}
    assert got == {None: 2.0, "a": 5.0, "b": None}
    boxes = {r.g: r.median for r in plotdata.box_stats(df, "v", ["g"]).collect()}
    assert boxes == {None: 2.0, "a": 5.0, "b": None}


def test_types_beside_na(spark, tmp_path):
    (tmp_path / "t.csv").write_text("whole,number,truth,text,none,odd\n1,1.5,True,x,NA,1d\nNA,NA,,n/a,,2\n3,-2e3,False,1,NULL,3\n")
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "string", "double", "string"]
    assert [r.whole for r in df.collect()] == [1, None, 3] and [r.number for r in df.collect()] == [1.5, None, -2000.0]


def test_cp1252_after_the_head_and_a_long_header(spark, tmp_path):
    names = [f"column number {i} of many" for i in range(400)]
    rows = [";".join(["1"] * 399 + ["plain"])] * 50 + [";".join(["2"] * 399 + ["price 5 €, “quoted” ™"])]
    (tmp_path / "t.csv").write_bytes("\n".join([";".join(names), *rows]).encode("cp1252"))
    path = str(tmp_path / "t.csv")
    assert len(files.header_line(spark, path)) > 8192 and files.sniff_separator(spark, path, "cp1252") == ";"
    df = files.safe_read_csv(spark, path, encodings=("utf-8", "cp1252"))
    assert df.columns == names and "price 5 €, “quoted” ™" in [r[399] for r in df.collect()]


def test_density_without_spread_is_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert {r.density for r in plotdata.kde_1d(df, "v", 5).collect()} == {None}


def test_perceptron_parts_separable_classes(spark):
    rng = np.random.default_rng(0)
    X = np.concatenate([rng.normal(size=(60, 2)) + c for c in ((0, 12), (12, -6), (-12, -6))])
    df = spark.createDataFrame([(i, float(i // 60), [float(v) for v in x]) for i, x in enumerate(X)], "id long, y double, x array<double>").repartition(3)
    pred = learn.fit_predict(df, df, "x", "y", "id", "perceptron", epochs=30)
    assert pred.where("label <> prediction").count() == 0


def test_elastic_net_lies_between(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = 4 * x[:, 0] + 0.05 * x[:, 1] + rng.normal(size=300) * 0.1
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, y double")
    fit = lambda **p: {r.feature: r.coefficient for r in learn.linear_coefficients(df, ["a", "b", "c"], "y", **p).collect()}
    plain, net = fit(), fit(regParam=0.5, elasticNetParam=0.5)
    assert abs(plain["a"] - 4) < 0.05 and 0 < net["a"] < plain["a"] and net["c"] == 0.0
