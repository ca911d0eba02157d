"""MLlib classifiers over named columns with labels of any type (L1, L2, D1, D2, D6, NN1, Q1).

``Learner`` numbers the labels in ascending order, assembles the features, fits the MLlib estimator and returns
a ``PipelineModel`` that adds ``prediction`` (original label) and ``probability`` (array, labels ascending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.profile import class_sizes
from tabforge.runtime import SMALL_TABLE_ROWS, spread

X, Y, P = "_x", "_y", "_p"
HELPERS = (X, P, "rawPrediction", "_probability")


def label_number(label: str, labels: Sequence) -> Column:
    """Position of the label in the ascending list, as MLlib wants it."""
    return (F.array_position(F.array(*[F.lit(k) for k in labels]), F.col(label)) - 1).cast("double")


class LabelBack(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Class numbers turned back into labels; helper columns dropped."""

    labels = Param(Params._dummy(), "labels", "labels in ascending order", TypeConverters.identity)
    predictionCol = Param(Params._dummy(), "predictionCol", "output column", TypeConverters.toString)

    def __init__(self, labels=None, predictionCol="prediction"):
        super().__init__()
        self._set(predictionCol=predictionCol)
        if labels is not None:
            self._set(labels=list(labels))

    def _transform(self, df: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(k) for k in self.getOrDefault("labels")])
        out = {self.getOrDefault("predictionCol"): F.element_at(names, F.col(P).cast("int") + 1)}
        if "_probability" in df.columns:
            out["probability"] = vector_to_array("_probability")
        return df.withColumns(out).drop(*HELPERS)


class Learner(Estimator, HasInputCols, HasLabelCol):
    """An MLlib classifier with its feature stage.

    base: the classifier. features: stage that makes the vector column ``_x``; plain assembly by default.
    C: total-loss weight as in liblinear; sets regParam = 1 / (C * rows). keyCol: rows are put in a fixed
    order by it first, so that sampling inside the classifier does not depend on how the data lay before.
    balanced: every class gets the same total weight.
    """

    def __init__(
        self,
        base: Estimator,
        inputCols: Sequence[str],
        labelCol: str = "label",
        *,
        features: Estimator | None = None,
        C: float | None = None,
        keyCol: str | None = None,
        balanced: bool = False,
        hidden: Sequence[int] | None = None,
    ):
        super().__init__()
        self.base, self.features, self.C, self.keyCol = base, features, C, keyCol
        self.balanced, self.hidden = balanced, hidden
        self._set(inputCols=list(inputCols), labelCol=labelCol)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.base = self.base.copy(extra)
        that.features = self.features.copy(extra) if self.features is not None else None
        return that

    def _fit(self, df: DataFrame) -> PipelineModel:
        cols, label = self.getOrDefault("inputCols"), self.getOrDefault("labelCol")
        rows = df.where(F.col(label).isNotNull())
        sizes = class_sizes(rows, label)
        labels = list(sizes)
        if len(labels) < 2:
            raise ValueError(f"{label} needs two classes, found {labels}")
        if self.features is None:
            front = VectorAssembler(inputCols=cols, outputCol=X)
        else:
            front = self.features.fit(rows)
        numbered = rows.withColumn(Y, label_number(label, labels))
        keep = [Y] + ([self.keyCol] if self.keyCol and self.keyCol not in cols else [])
        if self.balanced:
            share = {k: sum(sizes.values()) / (len(labels) * n) for k, n in sizes.items()}
            weight = [F.when(F.col(label) == F.lit(k), F.lit(w)) for k, w in share.items()]
            numbered = numbered.withColumn("_w", F.coalesce(*weight))
            keep.append("_w")
        n = sum(sizes.values())
        data = front.transform(spread(numbered.select(*cols, *keep), n, self.keyCol)).select(X, *keep)
        base = self._prepared(n, len(cols), len(labels))
        # MLlib soon keeps a copy of its own; a second one pays for a small table, or for tree learners
        # (which read their input several times before) behind a costly feature stage
        keep_rows = n <= SMALL_TABLE_ROWS or (base.hasParam("maxBins") and self.features is not None)
        data = data.persist() if keep_rows else data
        try:
            model = base.fit(data)
        finally:
            if keep_rows:
                data.unpersist()
        return PipelineModel([front, model, LabelBack(labels)])

    def _prepared(self, n: int, d: int, k: int) -> Estimator:
        base = self.base.copy()
        if isinstance(base, OneVsRest) and k == 2:
            base = base.getClassifier()  # two classes need one model, not two mirrored ones
        base._set(featuresCol=X, labelCol=Y, predictionCol=P)
        if base.hasParam("probabilityCol"):
            base._set(probabilityCol="_probability")
        if self.balanced:
            base._set(weightCol="_w")
        if self.C is not None:
            reg = 1.0 / (self.C * n)
            inner = base.getClassifier() if isinstance(base, OneVsRest) else base
            inner._set(regParam=reg)
        if isinstance(base, MultilayerPerceptronClassifier):
            base._set(layers=[d, *(self.hidden or []), k])
        return base


def logistic(cols, label="label", C: float = 1.0, one_vs_rest: bool = False, max_iter: int = 100, **kw) -> Learner:
    """Logistic regression with the total-loss weight C; one multinomial model or one model per class."""
    base = LogisticRegression(maxIter=max_iter, standardization=False, family="auto")
    return Learner(OneVsRest(classifier=base, parallelism=4) if one_vs_rest else base, cols, label, C=C, **kw)


def linear_svm(cols, label="label", C: float = 0.025, max_iter: int = 100, **kw) -> Learner:
    """Linear support vector machine, one per class."""
    base = LinearSVC(maxIter=max_iter, standardization=False)
    return Learner(OneVsRest(classifier=base, parallelism=4), cols, label, C=C, **kw)


def _tree_params(max_depth, min_leaf, criterion) -> dict:
    if max_depth is None or max_depth > 30:
        raise ValueError("max_depth must be at most 30, the largest depth MLlib grows")
    out = {"maxDepth": max_depth, "impurity": criterion}
    if isinstance(min_leaf, float):
        out["minWeightFractionPerNode"] = min_leaf
    else:
        out["minInstancesPerNode"] = min_leaf
    return out


def decision_tree(cols, label="label", max_depth: int = 5, min_leaf=1, criterion: str = "gini", seed: int = 0, **kw):
    """One tree. ``min_leaf``: rows (int) or share of all rows (float). Other knobs do not exist in MLlib."""
    return Learner(DecisionTreeClassifier(seed=seed, **_tree_params(max_depth, min_leaf, criterion)), cols, label, **kw)


def random_forest(
    cols, label="label", trees: int = 20, max_depth: int = 5, min_leaf=1, criterion: str = "gini",
    max_features="sqrt", bootstrap: bool = True, seed: int = 0, **kw,
) -> Learner:
    """Random forest. ``max_features``: sqrt, log2, all, a count or a share."""
    base = RandomForestClassifier(
        numTrees=trees,
        featureSubsetStrategy=str(max_features),
        bootstrap=bootstrap,
        seed=seed,
        **_tree_params(max_depth, min_leaf, criterion),
    )
    return Learner(base, cols, label, **kw)


def bagging(cols, label="label", trees: int = 20, max_depth: int = 5, seed: int = 0, **kw) -> Learner:
    """Trees on bootstrap samples with all columns at every node."""
    return random_forest(cols, label, trees, max_depth, max_features="all", seed=seed, **kw)


def perceptron(cols, label="label", hidden: Sequence[int] = (50, 50, 50), max_iter: int = 100, seed: int = 0, **kw):
    """Perceptron with sigmoid hidden layers, the only activation MLlib has."""
    base = MultilayerPerceptronClassifier(maxIter=max_iter, seed=seed)
    return Learner(base, cols, label, hidden=list(hidden), **kw)


def importances(model: PipelineModel, cols: Sequence[str], spark) -> DataFrame:
    """Feature importances of a fitted tree model, largest first."""
    trees = [s for s in model.stages if hasattr(s, "featureImportances")]
    values = trees[0].featureImportances.toArray()
    table = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, values)], "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")
