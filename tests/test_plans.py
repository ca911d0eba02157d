import math

import pytest
from pyspark.sql import functions as F

from tabforge.models import learner as L
from tabforge.models.bayes import GaussianNB
from tabforge.models.discriminant import Lda, Qda
from tabforge.plans import board, ensemble, tune

AB = ["a", "b"]


def score(model, df):
    return tune.score(model.transform(df), "accuracy")


def test_cross_validation_leaves_the_fold_out(two_blobs):
    scores = tune.cross_val(GaussianNB(AB), two_blobs, "key", "label", 3, seed=2).collect()
    assert sorted(r["fold"] for r in scores) == [0, 1, 2]
    data = tune.folded(two_blobs, "key", "label", 3, 2)
    for r in scores:
        model = GaussianNB(AB).fit(data.where(F.col("_fold") != r["fold"]))
        assert math.isclose(r["score"], score(model, data.where(F.col("_fold") == r["fold"])))


@pytest.mark.parametrize("metric", ["accuracy", "error", "mae", "auc_macro", "auc_micro", "log_loss"])
def test_metrics(two_blobs, metric):
    out = GaussianNB(AB).fit(two_blobs).transform(two_blobs)
    value = tune.score(out, metric, labels=[0, 1])
    assert 0 <= value <= 1 and (value < 0.2) == (metric in tune.SMALLER_IS_BETTER)


def test_grid_search(two_blobs):
    est = L.decision_tree(AB)
    grid = tune.param_grid({est.base.maxDepth: [1, 4], est.base.minInstancesPerNode: [1, 200]})
    found = tune.grid_search(est, grid, two_blobs, "key", "label", 3, seed=1)
    rows = found.table.collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) == 1
    assert found.best_score == max(r["mean_score"] for r in rows)
    assert found.best_params[est.base.minInstancesPerNode] == 1
    assert score(found.best, two_blobs) > 0.9


def test_draws_are_distinct_and_repeatable():
    est = L.decision_tree(AB)
    space = {est.base.maxDepth: [1, 2, 3], est.base.impurity: ["gini", "entropy"]}
    draws = tune.param_draws(space, 4, 7)
    assert draws == tune.param_draws(space, 4, 7) and len({tuple(d.values()) for d in draws}) == 4
    assert len(tune.param_draws(space, 50, 7)) == 6


def test_sweep(two_blobs):
    est = L.decision_tree(AB)
    table = tune.sweep(est, {est.base.maxDepth: [0, 3]}, two_blobs, two_blobs).collect()
    assert [r["param_value"] for r in table] == ["0", "3"]
    assert table[0]["train_accuracy"] < table[1]["train_accuracy"] == table[1]["test_accuracy"]


def test_votes(spark):
    def preds(*labels):
        return spark.createDataFrame(list(enumerate(labels)), "key int, prediction string")

    three = [preds("a", "b", "c"), preds("a", "c", "b"), preds("b", "c", "a")]
    assert dict(ensemble.vote(three, "key").collect()) == {0: "a", 1: "c", 2: "a"}
    assert dict(ensemble.vote(three, "key", weights=[1, 1, 3]).collect()) == {0: "b", 1: "c", 2: "a"}
    wide = spark.createDataFrame([("a", "a", "b"), ("b", "c", "c"), ("c", "b", "a")], "x string, y string, z string")
    assert [r[0] for r in wide.select(ensemble.vote_columns(["x", "y", "z"], ["a", "b", "c"])).collect()] == ["a", "c", "a"]


@pytest.mark.parametrize("proba", [False, True])
def test_blend_and_stack(two_blobs, proba):
    bases = [GaussianNB(AB), L.decision_tree(AB), L.linear_svm(AB, max_iter=10)]
    for est in (
        ensemble.Blend(bases, L.logistic([], C=100.0), "key", use_proba=proba),
        ensemble.Stack(bases, L.logistic([], C=100.0), "key", k=2, use_proba=proba),
    ):
        out = est.fit(two_blobs).transform(two_blobs.drop("label"))
        assert not [c for c in out.columns if c.startswith("_")]
        assert out.join(two_blobs.select("key", "label"), "key").where("label = prediction").count() > 270


def test_parameters_reach_the_parts_of_a_stack(two_blobs):
    tree, meta = L.decision_tree(AB), L.logistic([], C=100.0)
    stack = ensemble.Stack([tree, GaussianNB(AB)], meta, "key", k=2)
    changed = stack.copy({tree.base.maxDepth: 1, meta.base.maxIter: 3})
    assert changed.bases[0].base.getMaxDepth() == 1 and changed.meta.base.getMaxIter() == 3
    assert stack.bases[0].base.getMaxDepth() == 5
    grid = [{tree.base.maxDepth: 1}, {tree.base.maxDepth: 3}]
    assert tune.grid_search(stack, grid, two_blobs, "key", "label", 2).table.count() == 2


def test_out_of_fold_rows_come_from_other_models(two_blobs):
    """A model that knew its rows would repeat a label that is pure noise."""
    noise = two_blobs.withColumn("label", (F.pmod(F.xxhash64("key"), F.lit(2))).cast("int"))
    inner, outer = ensemble.oof(L.decision_tree(AB, max_depth=15), noise, two_blobs, "key", "label", 3)
    assert inner.count() == 300 and outer.count() == 300
    assert inner.agg(F.avg((F.col("_b0") == F.col("label")).cast("double"))).first()[0] < 0.7
    inner, outer = ensemble.oof(GaussianNB(AB), two_blobs, two_blobs, "key", "label", 3, use_proba=True)
    assert all(math.isclose(r["_b0_0"] + r["_b0_1"], 1.0) for r in outer.collect())


def test_models_per_group(two_blobs):
    df = two_blobs.withColumn("g", F.when(F.col("key") < 150, "low").otherwise("high")).withColumn("flat", F.lit(1.0))
    model = ensemble.per_group_fit(Qda, df, "g", ["a", "b", "flat"], min_variance=0.5)
    assert {r["_group"]: r["_used"] for r in model.train.collect()} == dict.fromkeys(["high", "low"], [True, True, False])
    assert model.transform(df).where("label = prediction").count() > 280
    with pytest.raises(ValueError):
        ensemble.per_group_fit(Qda, df, "g", ["flat"], min_variance=0.5)


def test_pseudo_labels(two_blobs):
    train, rest = two_blobs.where("key < 30"), two_blobs.where("key >= 30")
    hold, test = rest.where("key < 100"), rest.where("key >= 100")
    model, history = ensemble.pseudo_label(GaussianNB(AB), train, hold, test, "key", start=0.3, step=0.2, target=1.1, max_rounds=2)
    assert [(r["round"], r["share"]) for r in history.collect()] == [(0, 0.0), (1, 0.3), (2, 0.5)]
    assert score(model, hold) > 0.9
    _, short = ensemble.pseudo_label(GaussianNB(AB), train, hold, test, "key", target=0.5)
    assert short.count() == 1


def test_comparison(two_blobs, spark):
    table = board.compare({"nb": GaussianNB(AB), "lda": Lda(AB)}, two_blobs, two_blobs)
    flags = board.leaderboard_flags(table, min_accuracy=2.0)
    assert {r["classifier"] for r in flags.collect()} == {"nb", "lda"}
    assert flags.where("best_training_time").count() >= 1 and flags.where("low_accuracy").count() == 2
    assert board.top_n(table, "accuracy", 1, ["classifier"]).count() == 1
    a = two_blobs.select("key", "label", F.col("label").alias("prediction"))
    wide = board.predictions_wide({"right": a, "wrong": a.withColumn("prediction", F.lit(5))}, "key", "label")
    assert dict(board.score_wide(wide, ["right", "wrong"]).collect()) == {"right": 1.0, "wrong": 0.0}
