"""Fitted models that are saved, loaded and score as before, alone and inside a pipeline."""

import pytest
from pyspark.ml import Pipeline, PipelineModel

from tabforge.models.bayes import GaussianNB, GaussianNBModel
from tabforge.models.boost import AdaBoost, AdaBoostModel, Boosted, BoostedModel
from tabforge.models.discriminant import Lda
from tabforge.models.knn import KnnClassifier, KnnModel
from tabforge.models.learner import decision_tree
from tabforge.models.scale import Standardize
from tabforge.plans import ensemble

XY = ["a", "b"]
MAKERS = {
    "bayes": (GaussianNBModel, lambda: GaussianNB(XY)),
    "neighbours": (KnnModel, lambda: KnnClassifier(inputCols=XY, keyCol="key", k=3)),
    "boosted": (BoostedModel, lambda: Boosted(XY, "label", "key", rounds=2)),
    "ada": (AdaBoostModel, lambda: AdaBoost(XY, rounds=2)),
    "vote": (ensemble.VotingModel, lambda: ensemble.Voting([GaussianNB(XY), decision_tree(XY, keyCol="key")])),
    "blend": (ensemble.StackedModel, lambda: ensemble.Blend([GaussianNB(XY), Lda(XY)], GaussianNB(smoothing=0.1), "key")),
    "stack": (ensemble.StackedModel, lambda: ensemble.Stack([Lda(XY)], GaussianNB(smoothing=0.1), "key", k=2)),
}


def predictions(model, df):
    return sorted((r["key"], r["prediction"]) for r in model.transform(df).select("key", "prediction").collect())


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_round_trip(two_blobs, tmp_path, name):
    kind, make = MAKERS[name]
    model = make().fit(two_blobs)
    model.save(str(tmp_path / "m"))
    assert predictions(kind.load(str(tmp_path / "m")), two_blobs) == predictions(model, two_blobs)


def test_groups_round_trip(two_blobs, tmp_path):
    df = two_blobs.selectExpr("*", "CAST(key % 2 AS STRING) AS g")
    model = ensemble.per_group_fit(GaussianNB, df, "g", XY)
    model.save(str(tmp_path / "m"))
    assert predictions(type(model).load(str(tmp_path / "m")), df) == predictions(model, df)


@pytest.mark.parametrize("name", ["ada", "neighbours"])
def test_inside_a_pipeline(two_blobs, tmp_path, name):
    model = Pipeline(stages=[Standardize(XY), MAKERS[name][1]()]).fit(two_blobs)
    model.save(str(tmp_path / "p"))
    assert predictions(PipelineModel.load(str(tmp_path / "p")), two_blobs) == predictions(model, two_blobs)
