import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import cols as C
from tabforge.sources.io import nan_to_null


@pytest.fixture(scope="module")
def tiny_wide(spark):
    nan = float("nan")
    data = [(1, 1.0, 5.0, None, 7, nan), (2, 2.0, 5.0, None, 7, 1.0), (3, None, 5.0, None, 7, 3.0)]
    return spark.createDataFrame(data, "key long, a double, const double, gone double, k int, n double")


def test_names_by_position_range_and_text(tiny_wide):
    assert C.cols_pos(tiny_wide, 1, -2) == ["a", "const", "gone"]
    assert C.cols_range(tiny_wide, "a", "gone") == ["a", "const", "gone"]
    assert C.cols_range(tiny_wide, None, "a") == ["key", "a"]
    assert C.cols_like(tiny_wide, suffix="n", contains="g") == []
    assert C.cols_like(tiny_wide, contains="on") == ["const", "gone"]


def test_drop_all_null_keeps_partly_filled(tiny_wide):
    assert C.drop_all_null(tiny_wide).columns == ["key", "a", "const", "k", "n"]


def test_near_constant_counts_nulls_as_rows_not_values(spark):
    df = spark.createDataFrame([(1, None if i < 50 else 1, "w" if i else "v") for i in range(200)], "c int, half int, t string")
    assert C.near_constant_cols(df, 99.0) == ["c", "t"]
    assert C.near_constant_cols(df, 70.0) == ["c", "half", "t"]
    assert C.near_constant_cols(df, 99.5) == ["c"]
    assert C.drop_near_constant(df).columns == ["half"]


def test_near_constant_limit_is_strict(spark):
    df = spark.createDataFrame([(0 if i == 0 else 1,) for i in range(100)], "c int")
    assert C.near_constant_cols(df, 99.0) == []
    assert C.near_constant_cols(df, 98.9) == ["c"]


def test_low_variance_is_population_variance(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0), (5.0, 1.0)], "a double, b double")
    assert C.low_variance_cols(df, ["a", "b"], 8 / 3) == ["a", "b"]
    assert C.low_variance_cols(df, ["a", "b"], 2.6) == ["b"]


def test_downcast_picks_smallest_safe_type(spark):
    df = spark.createDataFrame([(127, 128, 40000, 2**40, 0.5), (-128, 0, 0, 0, 1.0)], "a long, b long, c long, d long, e double")
    out = C.downcast(df, df.columns, floats=True)
    assert [t for _, t in out.dtypes] == ["tinyint", "smallint", "int", "bigint", "float"]
    assert out.agg(F.sum("c")).first()[0] == 40000


def test_impute_and_infinity(tiny_wide, spark):
    out = {r["key"]: r for r in C.impute(tiny_wide, ["a", "n"]).collect()}
    assert out[3]["a"] == 1.5 and out[1]["n"] == 2.0
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (2.0,), (None,)], "x double")
    assert [r[0] for r in C.finite_or(df, ["x"]).collect()] == [0.0, 0.0, 2.0, None]


def test_align_reorder_and_errors(tiny_wide):
    like = tiny_wide.select("key", "a")
    assert C.align(tiny_wide.select("a", "k", "key"), like).columns == ["key", "a"]
    assert C.extra_columns(tiny_wide.select("a", "k", "key"), like) == ["k"]
    with pytest.raises(ValueError):
        C.align(tiny_wide.select("a"), like)
    with pytest.raises(ValueError):
        C.reorder(tiny_wide, [["key"], ["a"]])


def test_strip_suffix_clash(spark):
    df = spark.createDataFrame([(1, 2)], "r_mean int, t_mean int")
    assert C.strip_suffix(df, "_mean").columns == ["r", "t"]
    with pytest.raises(ValueError):
        C.strip_suffix(spark.createDataFrame([(1, 2)], "r_mean int, r int"), "_mean")


def test_nan_to_null(tiny_wide):
    out = nan_to_null(tiny_wide)
    assert out.agg(F.avg("n")).first()[0] == 2.0
    assert not math.isnan(out.agg(F.max("n")).first()[0])


def test_lookup(tiny_wide):
    assert C.lookup(tiny_wide, "key", 2).first()["a"] == 2.0
    assert C.lookup_position(tiny_wide, "key", 2).first()["key"] == 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert C.near_constant_cols(empty) == []
    assert C.drop_all_null(empty).columns == []
