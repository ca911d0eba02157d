"""Fits do not follow the layout of the rows."""

import numpy as np
import pytest

from tabforge.models import learner as L
from tabforge.models.boost import AdaBoost, Boosted
from tabforge.models.features import extra_trees, rbf_svm

COLS = ["a", "b", "c"]
MAKERS = {
    "tree": lambda: L.decision_tree(COLS, max_depth=8),
    "forest": lambda: L.random_forest(COLS, trees=3, max_depth=6),
    "extra": lambda: extra_trees(COLS, trees=3, max_depth=5),
    "boosted": lambda: Boosted(COLS, rounds=2, maxDepth=3),
    "adaboost": lambda: AdaBoost(COLS, rounds=3, maxDepth=2),
    "logistic": lambda: L.logistic(COLS, C=10.0, max_iter=10),
    "svm": lambda: L.linear_svm(COLS, max_iter=8),
    "rbf": lambda: rbf_svm(COLS, gamma=0.5, size=16, max_iter=8),
    "perceptron": lambda: L.perceptron(COLS, hidden=[5], max_iter=10),
}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12_000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] + 0.5 * rng.normal(size=12_000) > 0.8)
    rows = [(i, *map(float, v), int(k)) for i, (v, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, label int").cache()


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_two_layouts_one_model(table, name):
    asked = table.where("key < 4000")
    one, other = (MAKERS[name]().fit(d).transform(asked).orderBy("key").toPandas()["prediction"] for d in (table.repartition(2), table.orderBy("b").repartition(9, "a")))
    assert (one == other).all()
