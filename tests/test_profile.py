import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import profile as P
from tabforge.operators.ranking import exact_quantiles


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=500)
    data = [(i, float(v), float(2 * v + 1), float(rng.exponential()), "ab"[i % 2]) for i, v in enumerate(x)]
    return spark.createDataFrame(data, "key long, x double, y double, z double, g string").repartition(5).cache()


def column(df, c):
    return np.array([r[0] for r in df.select(c).orderBy("key").collect()], dtype=float)


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.9, 1.0]])
def test_quantiles_match_numpy(numbers, probs):
    got = exact_quantiles(numbers, ["x", "z"], probs)
    for c in ("x", "z"):
        assert np.allclose(got[c], np.quantile(column(numbers, c), probs))


def test_quantiles_with_a_hot_value_nulls_and_nothing(spark):
    data = [(1.0,)] * 50 + [(float(i),) for i in range(2, 52)] + [(None,)] * 9
    df = spark.createDataFrame(data, "v double").withColumn("e", F.lit(None).cast("double"))
    got = exact_quantiles(df, ["v", "e"], [0.25, 0.5, 0.75])
    assert np.allclose(got["v"], np.quantile([v for (v,) in data if v is not None], [0.25, 0.5, 0.75]))
    assert got["e"] == [None, None, None]


def test_describe_one_row(spark):
    d = P.describe(spark.createDataFrame([(4.0,)], "v double")).first()
    assert (d["n"], d["mean"], d["std"], d["lo"], d["q50"], d["hi"]) == (1, 4.0, None, 4.0, 4.0, 4.0)


def test_describe_approximate(numbers):
    d = {r["col"]: r for r in P.describe(numbers, ["x"], exact=False).collect()}
    assert abs(d["x"]["q50"] - np.median(column(numbers, "x"))) < 0.05


def test_correlations(numbers):
    r = {(a, b): v for a, b, v in P.corr_long(numbers, ["x", "y", "z"]).collect()}
    assert math.isclose(r["x", "y"], 1.0) and math.isclose(r["x", "x"], 1.0)
    assert math.isclose(r["x", "z"], np.corrcoef(column(numbers, "x"), column(numbers, "z"))[0, 1], abs_tol=1e-12)
    top = P.top_corr_pairs(numbers, ["z", "y", "x"]).collect()
    assert [(t["a"], t["b"]) for t in top] == [("y", "x")]
    low = {(r["a"], r["b"]) for r in P.corr_lower_triangle(numbers, ["x", "y", "z"]).collect()}
    assert low == {("y", "x"), ("z", "x"), ("z", "y")}


def test_correlation_with_gaps_takes_complete_pairs(spark):
    data = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 1.0, 5.0)]
    r = {(a, b): v for a, b, v in P.corr_long(spark.createDataFrame(data, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert math.isclose(r["a", "b"], np.corrcoef([1, 3, 4], [2, 7, 1])[0, 1])
    assert r["c", "c"] is None and r["a", "c"] is None


def test_wide_correlation_equals_narrow(spark):
    rng = np.random.default_rng(5)
    cols = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(float(v) for v in rng.normal(size=20)) for _ in range(60)], cols)
    wide = {(a, b): v for a, b, v in P.corr_long(df, cols).collect()}
    narrow = {(a, b): v for a, b, v in P.corr_long(df, cols[:3]).collect()}
    assert all(math.isclose(wide[p], v, abs_tol=1e-9) for p, v in narrow.items())


def test_histogram_counts_everything(numbers):
    h = P.histogram(numbers, "z", 10).orderBy("bin").collect()
    counts, edges = np.histogram(column(numbers, "z"), bins=10)
    assert [r["n"] for r in h] == list(counts)
    assert np.allclose([r["bin_lo"] for r in h], edges[:-1])
    by = P.histogram(numbers, "z", 10, by="g").collect()
    assert len(by) == 20 and sum(r["n"] for r in by) == 500


def test_histogram_edges(spark):
    same = P.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4)
    assert sorted((r["bin"], r["n"]) for r in same.collect()) == [(0, 2), (1, 0), (2, 0), (3, 0)]
    assert P.histogram(spark.createDataFrame([], "v double"), "v", 4).count() == 0


def test_kde_is_a_density(numbers):
    grid = list(np.linspace(-8, 8, 161))
    d = P.kde(numbers, "x", "g", grid).where("g = 'a'").orderBy("x").collect()
    x = column(numbers.where("g = 'a'"), "x")
    width = x.std(ddof=1) * len(x) ** -0.2
    direct = [np.exp(-0.5 * ((g - x) / width) ** 2).sum() / (len(x) * width * np.sqrt(2 * np.pi)) for g in grid]
    assert np.allclose([r["density"] for r in d], direct)
    assert abs(sum(r["density"] for r in d) * 0.1 - 1) < 1e-3


def test_ellipse_matches_eigen(numbers, spark):
    e = P.cov_ellipse(numbers, "x", "z", "g", 3).where("g = 'b'").first()
    part = numbers.where("g = 'b'")
    values, vectors = np.linalg.eigh(np.cov(column(part, "x"), column(part, "z")))
    assert np.allclose([e["width"], e["height"]], 6 * np.sqrt(values[::-1]))
    angle = math.degrees(math.atan2(vectors[1, 1], vectors[0, 1]))
    assert min(abs(e["angle"] - angle), abs(abs(e["angle"] - angle) - 180)) < 1e-6
    single = P.cov_ellipse(spark.createDataFrame([(1.0, 2.0, "g")], "x double, z double, g string"), "x", "z", "g").first()
    assert single["centre_x"] == 1.0 and single["width"] is None and single["angle"] is None


def test_counts_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, -1.0), ("a", 1, 0.0), ("b", None, 2.0), (None, 3, None)], "g string, v int, w double")
    assert {r["g"]: r["n"] for r in P.nunique_by(df, "g", "v").collect()} == {"a": 1, "b": 0}
    assert [tuple(r) for r in P.value_counts(df, "g").collect()] == [("a", 2), ("b", 1)]
    assert {r["col"]: r["n_null"] for r in P.null_counts(df).collect()} == {"g": 1, "v": 1, "w": 1}
    assert {r["col"]: r["has_negative"] for r in P.cols_with_negative(df).collect()} == {"v": False, "w": True}
    assert {r["col"]: r["mode_pct"] for r in P.mode_frequency(df).collect()} == {"g": 50.0, "v": 50.0, "w": 25.0}
    assert {r["g"]: r["n"] for r in P.group_count(df, "g", "v").collect()} == {"a": 2, "b": 0}


def test_entity_against_group(spark):
    df = spark.createDataFrame([(1, "B", 0.0, 5.0), (2, "B", 10.0, 5.0), (3, "M", 20.0, 1.0)], "id int, g string, a double, b double")
    p = {r["feature"]: r for r in P.entity_profile(df, "id", 3, "g", "B", {"mean": {"a": "a", "b": "b"}}).collect()}
    assert (p["a"]["group_mean"], p["a"]["entity"]) == (0.5, 2.0)
    assert p["b"]["entity"] is None
    above = {r["feature"]: r["above"] for r in P.above_group_mean(df, "id", 3, "g", "B", ["a", "b"]).collect()}
    assert above == {"a": True, "b": False}


def test_range_scale(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "g string, v double")
    assert sorted(((r["g"], r["v"]) for r in P.range_scale_by(df, ["v"], "g").collect()), key=str) == [("a", 0.5), ("a", 1.5), ("b", None)]


def test_too_many_classes(spark):
    with pytest.raises(ValueError, match="classes"):
        P.classes_of(spark.range(50), "id", 10)
