import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabforge.models import learner as L
from tabforge.models import reduce as R
from tabforge.models.bayes import GaussianNB, GaussianNBModel
from tabforge.models.boost import AdaBoost, Boosted
from tabforge.models.discriminant import Lda, Qda, class_moments
from tabforge.models.features import extra_trees, rbf_svm, rbm_logistic
from tabforge.models.knn import KnnClassifier
from tabforge.models.scale import MinMaxBy, Standardize

AB, ABCD = ["a", "b"], ["a", "b", "c", "d"]


def accuracy(est, df, label="label"):
    out = est.fit(df).transform(df)
    return out.agg(F.avg((F.col(label) == F.col("prediction")).cast("double"))).first()[0]


MAKERS = {
    "naive bayes": lambda c: GaussianNB(c),
    "lda": lambda c: Lda(c),
    "qda": lambda c: Qda(c),
    "logistic": lambda c: L.logistic(c, C=100.0),
    "logistic per class": lambda c: L.logistic(c, C=5.0, one_vs_rest=True),
    "linear svm": lambda c: L.linear_svm(c, max_iter=15),
    "rbf svm": lambda c: rbf_svm(c, gamma=0.05, size=64, max_iter=20),
    "rbf svm probability": lambda c: rbf_svm(c, C=100.0, gamma=0.05, size=64, probability=True, max_iter=20),
    "tree": lambda c: L.decision_tree(c),
    "forest": lambda c: L.random_forest(c, trees=5, keyCol="key"),
    "bagging": lambda c: L.bagging(c, trees=5),
    "extra trees": lambda c: extra_trees(c, trees=5),
    "boosted": lambda c: Boosted(c, rounds=3, maxDepth=2),
    "boosted, stopped": lambda c: Boosted(c, keyCol="key", rounds=4, maxDepth=2, validation=0.3, balanced=True),
    "ada": lambda c: AdaBoost(c, rounds=7, maxDepth=2),
    "perceptron": lambda c: L.perceptron(c, hidden=[5], max_iter=60),
    "rbm": lambda c: rbm_logistic(c, units=6, epochs=3, rate=0.5),
    "neighbours": lambda c: KnnClassifier(inputCols=c, keyCol="key", k=3),
}


@pytest.mark.parametrize("name", MAKERS)
def test_two_classes_beat_the_majority(two_blobs, name):
    assert accuracy(MAKERS[name](AB), two_blobs) > 0.9


@pytest.mark.parametrize("name", ["naive bayes", "lda", "qda", "logistic", "forest", "extra trees", "boosted", "ada", "neighbours"])
def test_three_text_classes(three_blobs, name):
    est = MAKERS[name](ABCD)
    model = est.fit(three_blobs)
    out = model.transform(three_blobs.drop("label"))
    assert dict(out.dtypes)["prediction"] == "string"
    assert out.count() == 240 and not [c for c in out.columns if c.startswith("_")]
    scored = out.join(three_blobs.select("key", "label"), "key")
    assert scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.95
    if "probability" in out.columns:
        for r in out.select("probability").limit(50).collect():
            assert len(r[0]) == 3 and min(r[0]) >= 0 and math.isclose(sum(r[0]), 1.0, abs_tol=1e-9)


def test_naive_bayes_against_numpy(two_blobs):
    rows = two_blobs.orderBy("key").collect()
    x, y = np.array([[r["a"], r["b"]] for r in rows]), np.array([r["label"] for r in rows])
    scores = []
    for k in (0, 1):
        part = x[y == k]
        v = part.var(axis=0) + 1e-9 * x.var(axis=0).max()
        scores.append(np.log((y == k).mean()) - 0.5 * (np.log(2 * np.pi * v) + (x - part.mean(axis=0)) ** 2 / v).sum(axis=1))
    p = np.exp(scores[1] - np.logaddexp(*scores))
    got = GaussianNB(AB).fit(two_blobs).transform(two_blobs).orderBy("key").collect()
    assert np.allclose([r["probability"][1] for r in got], p)


def test_naive_bayes_wide_path_is_the_same(spark):
    rng = np.random.default_rng(8)
    cols = [f"c{i}" for i in range(70)]
    data = [(*[float(v) for v in rng.normal(i % 3, 1.0, 70)], i % 3) for i in range(90)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols) + ", label int")
    import tabforge.models.bayes as B

    model = GaussianNB(cols).fit(df)
    arrays = [r["probability"] for r in model.transform(df).collect()]
    limit, B.WIDE_TERMS = B.WIDE_TERMS, 10**6
    try:
        assert np.allclose(arrays, [r["probability"] for r in model.transform(df).collect()])
    finally:
        B.WIDE_TERMS = limit


def reference_scores(x, y, quadratic):
    out = []
    labels = sorted(set(y))
    n = len(y)
    pooled = sum(np.cov(x[y == k].T, bias=True) * (y == k).sum() for k in labels) / (n - len(labels))
    for k in labels:
        part = x[y == k]
        s = np.cov(part.T) if quadratic else pooled
        d = x - part.mean(axis=0)
        out.append(np.log(len(part) / n) - 0.5 * quadratic * np.linalg.slogdet(s)[1] - 0.5 * (d @ np.linalg.inv(s) * d).sum(axis=1))
    s = np.array(out).T
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("d", [3, 15, 25])
@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminants_against_numpy(spark, d, quadratic):
    """Both ways to get the moments and both ways to score."""
    rng = np.random.default_rng(d)
    y = np.arange(200) % 2
    x = rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + y[:, None] * 0.7 + 100.0
    cols = [f"c{i}" for i in range(d)]
    data = [(i, *[float(v) for v in x[i]], int(y[i])) for i in range(200)]
    df = spark.createDataFrame(data, "key long, " + ", ".join(f"{c} double" for c in cols) + ", label int")
    est = Qda(cols) if quadratic else Lda(cols)
    got = np.array([r["probability"] for r in est.fit(df).transform(df).orderBy("key").collect()])
    assert np.allclose(got, reference_scores(x, y, quadratic), atol=1e-6)


def test_moments_do_not_depend_on_partitions(three_blobs):
    a = class_moments(three_blobs.repartition(1), ABCD, "label")
    b = class_moments(three_blobs.repartition(7), ABCD, "label")
    assert all(np.allclose(x[2], y[2]) and np.allclose(x[3], y[3]) for x, y in zip(a, b))


def test_small_class_gets_a_ridge(three_blobs):
    model = Qda(ABCD).fit(three_blobs)
    assert model.ridged() == ["z"]


def test_models_are_saved(two_blobs, tmp_path):
    model = GaussianNB(AB).fit(two_blobs)
    model.save(str(tmp_path / "nb"))
    again = GaussianNBModel.load(str(tmp_path / "nb"))
    assert again.transform(two_blobs).collect() == model.transform(two_blobs).collect()
    both = Pipeline(stages=[Standardize(AB), L.logistic(AB)]).fit(two_blobs)
    tree = L.decision_tree(AB).fit(two_blobs)
    tree.save(str(tmp_path / "tree"))
    assert PipelineModel.load(str(tmp_path / "tree")).transform(two_blobs).collect() == tree.transform(two_blobs).collect()
    assert both.transform(two_blobs).count() == 300


def test_one_class_is_refused(two_blobs):
    with pytest.raises(ValueError, match="two classes"):
        L.logistic(AB).fit(two_blobs.where("label = 1"))
    with pytest.raises(ValueError, match="two classes"):
        AdaBoost(AB).fit(two_blobs.where("label = 1"))


def test_unknown_tree_knobs_are_refused():
    with pytest.raises(ValueError):
        L.decision_tree(AB, max_depth=60)
    with pytest.raises(ValueError):
        L.random_forest(AB, max_depth=None)
    with pytest.raises(TypeError):
        L.random_forest(AB, min_samples_split=4)


def test_early_stop_keeps_fewer_trees(two_blobs):
    model = Boosted(AB, keyCol="key", rounds=25, maxDepth=2, validation=0.3, tolerance=0.05).fit(two_blobs)
    assert model.rounds()[0] < 25


def test_importances(two_blobs, spark):
    noisy = two_blobs.withColumn("noise", F.hash("key").cast("double"))
    table = L.importances(L.random_forest([*AB, "noise"], trees=5).fit(noisy), [*AB, "noise"], spark).collect()
    assert table[-1]["feature"] == "noise" and math.isclose(sum(r["importance"] for r in table), 1.0)


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 7.0, "B"), (3.0, 7.0, "B"), (5.0, 7.0, "M")], "a double, c double, g string")
    out = Standardize(["a", "c"]).fit(df).transform(df).orderBy("a").collect()
    assert np.allclose([r["a"] for r in out], [-math.sqrt(1.5), 0, math.sqrt(1.5)]) and [r["c"] for r in out] == [0, 0, 0]
    mm = MinMaxBy(["a", "c"], "g", "B").fit(df).transform(df).orderBy("a").collect()
    assert [r["a"] for r in mm] == [0.0, 1.0, 2.0] and mm[0]["c"] is None


def test_components(three_blobs, spark):
    model = R.Pca(ABCD).fit(three_blobs)
    v = model.variance(spark).collect()
    assert math.isclose(v[-1]["cumulative"], 1.0) and all(x["ratio"] >= y["ratio"] for x, y in zip(v, v[1:]))
    w = np.array(model.fitted()["loadings"])
    assert np.allclose(w @ w.T, np.eye(4), atol=1e-9)
    assert all(row[np.abs(row).argmax()] > 0 for row in w)
    x = np.array([[r[c] for c in ABCD] for r in three_blobs.orderBy("key").collect()])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    got = model.transform(three_blobs).orderBy("key").collect()
    assert np.allclose([[r[f"pc{i}"] for i in range(1, 5)] for r in got], z @ w.T)
    need = R.components_for(three_blobs, ABCD, 0.85).first()[0]
    assert v[need - 1]["cumulative"] >= 0.85 and (need == 1 or v[need - 2]["cumulative"] < 0.85)
    assert model.top_loadings(spark, 1, 2).count() == 2


def test_clusters(three_blobs):
    sse = {r["k"]: r["sse"] for r in R.elbow(three_blobs, ABCD, "key", [1, 2, 3], seed=1).collect()}
    x = np.array([[r[c] for c in ABCD] for r in three_blobs.collect()])
    assert math.isclose(sse[1], ((x - x.mean(axis=0)) ** 2).sum()) and sse[2] < 0.5 * sse[1] and sse[3] <= sse[2]
    grouped, centres = R.cluster(three_blobs.repartition(6), ABCD, "key", 2, seed=1)
    assert grouped.count() == 240 and centres.count() == 8
    other, _ = R.cluster(three_blobs.repartition(1), ABCD, "key", 2, seed=1)
    assert sorted(map(tuple, grouped.select("key", "cluster").collect())) == sorted(map(tuple, other.select("key", "cluster").collect()))


def test_polynomial(spark):
    xs = np.linspace(0, 100, 60)
    df = spark.createDataFrame([(float(x), float(3 - 2 * x + 0.01 * x**3)) for x in xs], "x double, y double")
    table = R.polyfit(df, "x", "y", 5).orderBy("power").collect()
    z = (xs - table[0]["x_mean"]) / table[0]["x_std"]
    fit = sum(r["coefficient"] * z ** r["power"] for r in table)
    assert np.allclose(fit, 3 - 2 * xs + 0.01 * xs**3, atol=1e-4)


def test_rbm_does_not_depend_on_partitions(two_blobs):
    est = R.RbmFeatures(AB, units=4, epochs=2, rate=0.5, seed=3)
    a = est.fit(two_blobs.repartition(1)).transform(two_blobs).orderBy("key").collect()
    b = est.fit(two_blobs.repartition(6)).transform(two_blobs).orderBy("key").collect()
    assert np.allclose([r["rbm"] for r in a], [r["rbm"] for r in b])
    assert all(len(r["rbm"]) == 4 and 0 <= min(r["rbm"]) and max(r["rbm"]) <= 1 for r in a)
