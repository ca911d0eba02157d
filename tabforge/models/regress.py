"""Regression trees and forests behind an imputer: the gaps are filled with means that are learned from the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor

FILLED, VECTOR = "_filled_", "_features"


def _behind_imputer(cols: Sequence[str], tree) -> Pipeline:
    filled = [f"{FILLED}{c}" for c in cols]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(cols), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol=VECTOR),
            tree,
        ]
    )


def tree_regression(cols: Sequence[str], label: str = "label", max_depth: int = 5, max_bins: int = 64, seed: int = 0) -> Pipeline:
    """One regression tree on number columns; ``prediction`` is the mean of a leaf."""
    tree = DecisionTreeRegressor(featuresCol=VECTOR, labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return _behind_imputer(cols, tree)


def forest_regression(
    cols: Sequence[str], label: str = "label", trees: int = 20, max_depth: int = 5, max_bins: int = 64,
    max_features="onethird", bootstrap: bool = True, seed: int = 0,
) -> Pipeline:
    """Mean of many such trees."""
    forest = RandomForestRegressor(
        featuresCol=VECTOR, labelCol=label, numTrees=trees, maxDepth=max_depth, maxBins=max_bins,
        featureSubsetStrategy=str(max_features), bootstrap=bootstrap, seed=seed,
    )
    return _behind_imputer(cols, forest)
