"""One rule for missing cells below and above every width limit, kept rows, and malformed files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.encode import split_phrases
from tabforge.models import discriminant, knn
from tabforge.models.bayes import GaussianNB
from tabforge.operators import joins, metrics, profile
from tabforge.operators.split import kfold
from tabforge.plans import ensemble, tune
from tabforge.sources import io


@pytest.fixture(scope="module")
def holed(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(200):
        x = rng.normal(size=20) + (i % 2) * 2
        cells = [None if (i + j) % 11 == 0 else float(v) for j, v in enumerate(x)]
        rows.append((i, i % 2, 5.0, *cells))
    names = ", ".join(f"x{j} double" for j in range(20))
    return spark.createDataFrame(rows, f"key long, label int, same double, {names}").cache()


@pytest.mark.parametrize("limit", [1, 100])
def test_correlations_do_not_depend_on_width(holed, monkeypatch, limit):
    monkeypatch.setattr(profile, "PAIRWISE_LIMIT", limit)
    cols = [f"x{j}" for j in range(20)] + ["same"]
    found = {(r.a, r.b): r.r for r in profile.corr_long(holed, cols).collect()}
    table = holed.toPandas()[cols].astype(float)
    want = table.corr()
    for a in cols:
        for b in cols:
            if "same" in (a, b):
                assert found[a, b] is None
            else:
                assert found[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
    assert profile.top_corr_pairs(holed, cols, 0.99).count() == 0
    assert {r.r for r in profile.corr_long(holed.limit(0), cols[:3]).collect()} == {None}


@pytest.mark.parametrize("limit", [1, 100])
@pytest.mark.parametrize("kind", [discriminant.Lda, discriminant.Qda])
def test_discriminants_fit_complete_rows(holed, monkeypatch, limit, kind):
    monkeypatch.setattr(discriminant, "PAIR_LIMIT", limit)
    cols = [f"x{j}" for j in range(5)]
    whole = holed.dropna(subset=cols)
    a, b = (kind(cols).fit(df).transform(whole).orderBy("key") for df in (holed, whole))
    assert [r.prediction for r in a.collect()] == [r.prediction for r in b.collect()]


def test_a_gap_hides_no_neighbour(holed):
    cols = ["x0", "x1", "x2"]
    whole = holed.dropna(subset=cols)
    with_nan = holed.withColumn("x1", F.when(F.col("key") == 3, F.lit(float("nan"))).otherwise(F.col("x1")))
    for df, rest in ((holed, whole), (with_nan, whole.where("key <> 3"))):
        a = knn.neighbors(df, df, cols, "key", "label", 3, skip="key")
        b = knn.neighbors(rest, rest, cols, "key", "label", 3, skip="key")
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_missing_prediction_is_wrong(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, None), (0, None), (None, 1)], "label int, prediction int")
    assert metrics.accuracy(df).first()["accuracy"] == 0.25
    assert {tuple(r) for r in metrics.confusion(df).collect()} == {(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 1)}
    with pytest.raises(ValueError):
        metrics.confusion(df, max_classes=1)


def test_unseen_groups_keep_their_rows(spark, two_blobs):
    df = two_blobs.withColumn("g", F.when(F.col("key") % 4 != 3, (F.col("key") % 4).cast("string")))
    seen = df.where("g IN ('0', '1')")
    model = ensemble.per_group_fit(GaussianNB, seen, "g", ["a", "b"])
    out = model.transform(df)
    assert out.count() == df.count()
    assert out.where("prediction IS NULL").count() == df.where("g IS NULL OR g = '2'").count()
    inner, outer = ensemble.per_group_oof(GaussianNB, seen, df, "g", "key", "label", ["a", "b"], 3)
    assert inner.count() == seen.count() and outer.count() == df.count()
    assert outer.where("p_0 IS NULL").count() == df.where("g IS NULL OR g = '2'").count()


def test_bad_rows_count_whatever_is_selected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\noops,y\n3,z\n")
    path = str(tmp_path / "a.csv")
    assert io.read_csv(spark, path, "a int, b string", on_bad="drop").select("b").count() == 2
    assert io.read_csv(spark, path, "a int, b string", on_bad="drop").count() == 2
    with pytest.raises(Exception, match="malformed"):
        io.read_csv(spark, path, "a int, b string", on_bad="fail").select("b").collect()
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv(spark, path, "b string, a string", on_bad="null").collect()


def test_fingerprint_sees_nested_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).selectExpr("id", "id % 2 AS x", "'k' AS y").write.partitionBy("x", "y").parquet(path)
    before = io.inputs_fingerprint(spark, [path])
    spark.range(1).write.mode("append").parquet(f"{path}/x=0/y=k")
    assert io.inputs_fingerprint(spark, [path]) != before


def test_folds_of_text_and_null_keys(spark):
    df = spark.createDataFrame([(c,) for c in "hgfedcba"] + [(None,)], "key string")
    found = {r.key: r.fold for r in kfold(df, "key", 3, how="blocks").collect()}
    assert found == {None: 0, "a": 0, "b": 0, "c": 1, "d": 1, "e": 1, "f": 2, "g": 2, "h": 2}


def test_sweep_by_log_loss(two_blobs):
    space = {GaussianNB(["a", "b"]).smoothing: [1e-9, 0.1]}
    est = GaussianNB(["a", "b"])
    rows = tune.sweep(est, {est.smoothing: [1e-9, 0.1]}, two_blobs, two_blobs, metric="log_loss").collect()
    assert len(rows) == len(next(iter(space.values()))) and all(r.test_log_loss > 0 for r in rows)


def test_histogram_of_nothing(two_blobs):
    some, none = profile.histogram(two_blobs, "a", 4), profile.histogram(two_blobs.limit(0), "a", 4)
    assert none.columns == some.columns and none.count() == 0


def test_null_keys_are_dealt_out(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id % 20 END AS k")
    dim = spark.createDataFrame([(0, "a"), (10, "b"), (None, "never")], "k long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.enrich(df, dim, "k")
        assert out.columns == ["k", "id", "v"] or set(out.columns) == {"k", "id", "v"}
        assert out.count() == 1000 and out.where("v IS NOT NULL").count() == 100
        salted = joins.enrich(df, dim, "k", salts=4)
        assert "_salt" in salted._jdf.queryExecution().executedPlan().toString()
        assert salted.where("v IS NOT NULL").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_ranges_many_bins(spark):
    ranges = spark.range(2000).selectExpr("id AS r", "id * 1.0 AS lo", "id + 1.5 AS hi")
    df = spark.range(500).selectExpr("id", "id * 3.9 AS x")
    out = joins.range_join(df, "x", ranges)
    want = sorted((i, r) for i in range(500) for r in range(2000) if r <= i * 3.9 < r + 1.5)
    assert sorted((x.id, x.r) for x in out.collect()) == want


def test_glue_checks_keys_once(spark):
    a, b = spark.range(5).selectExpr("id", "id AS x"), spark.range(5).selectExpr("id", "id AS y")
    assert joins.glue([a, b], "id").count() == 5
    with pytest.raises(ValueError):
        joins.glue([a, b.where("id < 4")], "id")
    with pytest.raises(ValueError):
        joins.glue([a, b.union(b.limit(1))], "id")


def test_phrases_trim_any_blank(spark):
    df = spark.createDataFrame([(" Como family - x   y٣z",)], "t string")
    assert df.select(split_phrases("t")).first()[0] == ["Como family", "x", "y", "z"]


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_quantiles_at_any_limit(spark, monkeypatch, limit):
    from tabforge.operators import ranking

    monkeypatch.setattr(ranking, "MAX_SORTED", limit)
    rng = np.random.default_rng(4)
    xs = np.concatenate([rng.normal(size=500), np.full(400, 0.25), [np.inf]])
    rows = [(float(x), None if i % 3 else float(i), None) for i, x in enumerate(xs)] + [(float("nan"), None, None)]
    df = spark.createDataFrame(rows, "x double, y double, z double").repartition(4)
    probs = [0.0, 0.1, 0.5, 0.77, 0.99]
    found = ranking.exact_quantiles(df, ["x", "y", "z"], probs)
    assert found["x"] == pytest.approx(np.quantile(xs, probs).tolist())
    assert found["y"] == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], probs).tolist())
    assert found["z"] == [None] * 5
