"""Small-frame checks of the semantic traps listed in SURVEY §0 and §7.7."""

import math

import pytest
from pyspark.sql import functions as F


def test_zscore_uses_population_std(spark):
    from tablewise.operators import scale
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    got = [r.x for r in scale.zscore_scale(df, ["x"]).orderBy("x").collect()]
    mean, sd = 2.5, math.sqrt(1.25)  # ddof = 0
    assert got == pytest.approx([(v - mean) / sd for v in (1, 2, 3, 4)])


def test_constant_column_scales_to_zero(spark):
    from tablewise.operators import scale
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.x for r in scale.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0]
    assert [r.x for r in scale.zscore_scale(df, ["x"]).collect()] == [0.0, 0.0]


def test_decimal_scaling_parity_and_strict(spark):
    from tablewise.operators import scale
    df = spark.createDataFrame([(1e4,), (5.0,)], "x double")
    parity = sorted(r.x for r in scale.decimal_scale(df, ["x"]).collect())
    strict = sorted(r.x for r in scale.decimal_scale(df, ["x"], strict=True).collect())
    assert parity[-1] == 1.0            # ceil(log10(1e4 + 1e-12)) = 4 -> exactly 1.0
    assert strict[-1] == pytest.approx(0.1)


def test_outlier_zscore_uses_sample_std(spark):
    from tablewise.operators import outliers
    vals = [0.0] * 9 + [10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    n_flagged = outliers.zscore_flags(df, ["x"], threshold=2.9).where("x_zscore_outlier").count()
    # ddof=1: z(10) = (10 - 1) / 3.162 = 2.846 < 2.9 ; ddof=0 would give 3.0 and flag it
    assert n_flagged == 0


def test_bias_corrected_skew_kurtosis(spark):
    from tablewise.operators import profile
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (10.0,)], "x double")
    r = profile.describe_numeric(df).collect()[0]
    # pandas: Series([1, 2, 3, 4, 10]).skew() / .kurt() (bias-corrected G1 / G2)
    assert r.skew == pytest.approx(1.697056274847714, abs=1e-9)
    assert r.kurtosis == pytest.approx(3.152, abs=1e-9)


def test_null_text_counts_as_disguised(spark):
    from tablewise.operators import quality
    df = spark.createDataFrame([(1, None), (2, " N/A "), (3, "ok")], "id long, t string")
    r = quality.disguised_missing_summary(df, ["t"]).collect()[0]
    assert r.disguised_missing_count == 2          # null counted as "" (and as real missing)
    rows = {x.row_id: x.total_missing for x in quality.missing_by_row(df, "id", top=None).collect()}
    assert rows[1] == 2 and rows[2] == 1
    single = {x.row_id: x.total_missing for x in quality.missing_by_row(df, "id", top=None, double_count=False).collect()}
    assert single[1] == 1


def test_elbow_parity_returns_smallest_k(spark):
    from tablewise.operators import cluster
    g = spark.createDataFrame([(2, 100.0, 0.0), (3, 60.0, 40.0), (4, 55.0, 8.3)],
                              "k long, inertia double, inertia_drop_pct double")
    assert cluster.recommend_k_elbow(g, 10, skip_first=False) == 2
    assert cluster.recommend_k_elbow(g, 10, skip_first=True) == 4


def test_cramers_v_degenerate_modes(spark):
    from tablewise.operators import assoc
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "c string, t string")
    zero = assoc.cramers_v(df, "c", "t", degenerate="zero").collect()[0].cramers_v
    nan = assoc.cramers_v(df, "c", "t", degenerate="nan").collect()[0].cramers_v
    assert zero == 0.0 and nan is None


def test_mode_smallest_of_ties_and_names(spark):
    from tablewise.operators import quality
    from tablewise.sources.files import normalize_names
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert [r.v for r in quality.impute_mode(df, ["v"]).collect()][-1] == "a"
    assert normalize_names(["Height_(cm)", " Weight (kg) ", "BMI"]) == ["height_cm", "weight_kg", "bmi"]


def test_synthetic_generators_shapes(spark):
    from tablewise.sources.files import synthetic
    assert synthetic(spark, "moons", 100).count() == 100
    assert set(synthetic(spark, "blobs", 90, centers=3).columns) == {"id", "x0", "x1", "label"}
    reg = synthetic(spark, "regression", 2000, noise=0.01).agg(F.regr_slope("y", "x")).collect()[0][0]
    assert reg == pytest.approx(3.0, abs=0.01)
