"""Cases of round 1 that gave wrong answers: nulls, partitioning, late bytes, exact matches."""

import pytest
from pyspark.sql import functions as F

from tablewise.functions.prefix import prefix_sum
from tablewise.functions.topk import top_n_per_group
from tablewise.operators import encode, learn
from tablewise.sources import files

BIG = 9007199254740993  # 2**53 + 1


def test_top_n_keeps_longs_and_ignores_partitioning(spark):
    rows = [("a", BIG, 3.0), ("a", None, None), ("a", 5, 1.0)]
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "g string, i long, v double").repartition(parts)
        got = [(r.i, r.v, r.rank) for r in top_n_per_group(df, ["g"], ["v"], 3).orderBy("rank").collect()]
        assert got == [(5, 1.0, 1), (BIG, 3.0, 2), (None, None, 3)]
        assert top_n_per_group(df, ["g"], ["v"], 1, ascending=False).first().i == BIG


def test_prefix_sum_keeps_the_null_group(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(60)], "g string, v long")
    for small in (0, 1000):
        rows = prefix_sum(df, ["g"], ["v"], small_group=small, partitions=4).collect()
        assert len(rows) == 60 and {r.g for r in rows} == {None, "a"}
        assert all(r.before == r.v // 2 for r in rows)


def test_binary_target_with_other_values(spark):
    df = spark.createDataFrame([("No",), ("maybe",), ("YES",), (None,), ("n",)], "t string")
    assert [r[0] for r in df.select(encode.binary_target(df, "t")).collect()] == [0, None, 1, None, 0]
    with pytest.raises(ValueError):
        encode.binary_target(df.where("t <> 'YES'").unionAll(spark.createDataFrame([("x",), ("z",)], "t string")), "t")


def test_qcut_refuses_equal_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "x double")
    with pytest.raises(Exception, match="Bin edges must be unique"):
        encode.qcut(df, "x", 4).collect()


def test_distance_weights_at_zero(spark):
    train = spark.createDataFrame([(1, [0.0], "a"), (2, [0.4], "b"), (3, [0.5], "b")], "i long, x array<double>, y string")
    test = spark.createDataFrame([(9, [0.0], "a")], "i long, x array<double>, y string")
    assert learn.knn_classify(train, test, "i", "x", "y", 3, weights="distance").first().prediction == "a"
    assert learn.knn_classify(train, test, "i", "x", "y", 3).first().prediction == "b"


def test_late_latin1_byte(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"name;n\n" + b"plain;1\n" * 2000 + "maçã;2\n".encode("latin1"))
    got = files.safe_read_csv(spark, str(path))
    assert got.where(F.col("n") == 2).first().name == "maçã"
    path = tmp_path / "cut.csv"
    path.write_bytes(b"name;n\n" + b"x" * 4088 + "é;1\n".encode())  # the character straddles the head
    assert files.safe_read_csv(spark, str(path)).first().name.endswith("xé")
