"""Boosting (D4, D5)."""

from __future__ import annotations

import math

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import hashed_below
from tabforge.models.base import ColumnEstimator
from tabforge.models.learner import X, Y, label_number
from tabforge.models.saving import SavedInParts
from tabforge.operators.profile import class_sizes
from tabforge.runtime import cut_lineage, in_parallel, spread

ROUNDS_PER_CUT = 5


class _TreesModel(SavedInParts, Model, HasInputCols, HasPredictionCol):
    """Fitted MLlib models and the labels they vote for."""

    PLAIN, PARTS = ("cols", "labels", "weights"), ("parts",)

    def __init__(self, cols, labels, parts, weights=None):
        super().__init__()
        self._set(inputCols=list(cols), predictionCol="prediction")
        self.cols, self.labels, self.parts, self.weights = list(cols), list(labels), list(parts), weights

    def _assembled(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.getOrDefault("inputCols"), outputCol=X).transform(df)

    def _labelled(self, df: DataFrame) -> DataFrame:
        """From ``_scores``, one number per class that adds up to 1."""
        names = F.array(*[F.lit(k) for k in self.labels])
        best = F.array_position("_scores", F.array_max("_scores"))
        out = {self.getOrDefault("predictionCol"): F.element_at(names, best.cast("int")), "probability": F.col("_scores")}
        return df.withColumns(out).drop("_scores", X)


class BoostedModel(_TreesModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = self._assembled(df)
        for i, part in enumerate(self.parts):
            p = part.copy()
            p._set(featuresCol=X, predictionCol="_pred", rawPredictionCol="_raw", probabilityCol="_prob")
            out = p.transform(out).withColumn(f"_s{i}", vector_to_array("_prob")[1]).drop("_pred", "_raw", "_prob")
        if len(self.parts) == 1:
            scores = F.array(1 - F.col("_s0"), F.col("_s0"))
        else:
            total = sum((F.col(f"_s{i}") for i in range(1, len(self.parts))), F.col("_s0"))
            scores = F.array(*[F.col(f"_s{i}") / total for i in range(len(self.parts))])
        out = out.withColumn("_scores", scores).drop(*[f"_s{i}" for i in range(len(self.parts))])
        return self._labelled(out)

    def rounds(self) -> list[int]:
        """Trees kept per class; fewer than asked for after an early stop."""
        return [p.getNumTrees for p in self.parts]


class Boosted(ColumnEstimator):
    """Gradient boosted trees for any number of classes: one binary model per class against the rest.

    ``validation`` > 0 sets a share of the rows aside (by key hash); a model stops once these no longer get better
    by ``tolerance``. ``balanced`` gives each class the same total weight.
    """

    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees per class", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "step size", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "share of rows per tree", TypeConverters.toFloat)
    validation = Param(Params._dummy(), "validation", "share set aside", TypeConverters.toFloat)
    tolerance = Param(Params._dummy(), "tolerance", "smallest gain", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, inputCols=None, labelCol="label", keyCol=None, rounds=20, rate=0.1, maxDepth=5, subsample=1.0,
                 validation=0.0, tolerance=0.01, seed=0, balanced=False):
        super().__init__()
        self._set(labelCol=labelCol, rounds=rounds, rate=rate, maxDepth=maxDepth, subsample=subsample,
                  validation=validation, tolerance=tolerance, seed=seed)
        self.balanced = balanced
        if inputCols:
            self._set(inputCols=list(inputCols))
        if keyCol:
            self._set(keyCol=keyCol)

    def _fit(self, df: DataFrame) -> BoostedModel:
        cols, label = self.cols(), self.label()
        rows = df.where(F.col(label).isNotNull())
        sizes = class_sizes(rows, label)
        labels = list(sizes)
        if len(labels) < 2:
            raise ValueError(f"{label} needs two classes, found {labels}")
        get = self.getOrDefault
        early = get("validation") > 0
        extra = []
        if early:
            extra.append(hashed_below(get("keyCol"), f"validate{get('seed')}", get("validation")).alias("_held"))
        if self.isDefined("keyCol"):
            extra.append(F.col(get("keyCol")).alias("_key"))
        front = VectorAssembler(inputCols=cols, outputCol=X)
        data = front.transform(rows.withColumn(Y, label_number(label, labels))).select(X, Y, *extra)
        data = spread(data, sum(sizes.values()), "_key" if self.isDefined("keyCol") else None).persist()
        try:
            data.count()
            targets = [1] if len(labels) == 2 else range(len(labels))

            def fit_class(i):
                one = data.withColumn("_is", (F.col(Y) == float(i)).cast("double"))
                gbt = GBTClassifier(featuresCol=X, labelCol="_is", maxIter=get("rounds"), stepSize=get("rate"),
                                    maxDepth=get("maxDepth"), subsamplingRate=get("subsample"), seed=get("seed"))
                if early:
                    gbt = gbt.setValidationIndicatorCol("_held")
                    gbt._set(validationTol=get("tolerance"))
                if self.balanced:
                    n, hit = sum(sizes.values()), sizes[labels[i]]
                    one = one.withColumn("_w", F.when(F.col("_is") == 1, n / (2 * hit)).otherwise(n / (2 * (n - hit))))
                    gbt = gbt.setWeightCol("_w")
                return gbt.fit(one)

            parts = in_parallel(fit_class, targets)
        finally:
            data.unpersist()
        return BoostedModel(cols, labels, parts)


class AdaBoostModel(_TreesModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = self._assembled(df)
        for i, part in enumerate(self.parts):
            p = part.copy()
            p._set(featuresCol=X, predictionCol=f"_v{i}", rawPredictionCol="_raw", probabilityCol="_prob")
            out = p.transform(out).drop("_raw", "_prob")
        total = sum(self.weights)
        scores = []
        for k in range(len(self.labels)):
            s = F.lit(0.0)
            for i, w in enumerate(self.weights):
                s = s + F.when(F.col(f"_v{i}") == k, F.lit(w / total)).otherwise(0.0)
            scores.append(s)
        out = out.withColumn("_scores", F.array(*scores)).drop(*[f"_v{i}" for i in range(len(self.parts))])
        return self._labelled(out)


class AdaBoost(ColumnEstimator):
    """Boosting by reweighting (SAMME, Zhu et al. 2009) of decision trees.

    Stops early when a tree makes no error, or is no better than guessing. Weights are a column of the kept
    rows; the chain of updates is cut by a checkpoint every few rounds.
    """

    rounds = Param(Params._dummy(), "rounds", "most trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "factor on each tree's vote", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, inputCols=None, labelCol="label", rounds=50, rate=1.0, maxDepth=1, seed=0):
        super().__init__()
        self._set(labelCol=labelCol, rounds=rounds, rate=rate, maxDepth=maxDepth, seed=seed)
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        cols, label, get = self.cols(), self.label(), self.getOrDefault
        rows = df.where(F.col(label).isNotNull())
        sizes = class_sizes(rows, label)
        labels = list(sizes)
        k = len(labels)
        if k < 2:
            raise ValueError(f"{label} needs two classes, found {labels}")
        front = VectorAssembler(inputCols=cols, outputCol=X)
        start = front.transform(rows.withColumn(Y, label_number(label, labels))).select(X, Y, F.lit(1.0).alias("_w"))
        data = spread(start, sum(sizes.values())).persist()
        parts, votes = [], []
        for i in range(get("rounds")):
            tree = DecisionTreeClassifier(
                featuresCol=X, labelCol=Y, weightCol="_w", predictionCol="_v", maxDepth=get("maxDepth"), seed=get("seed")
            ).fit(data)
            judged = tree.transform(data).select(X, Y, "_w", (F.col("_v") != F.col(Y)).alias("_miss"))
            sums = judged.agg(F.sum("_w").alias("all"), F.sum(F.when(F.col("_miss"), F.col("_w"))).alias("bad")).first()
            error = (sums["bad"] or 0.0) / sums["all"]
            if error >= 1 - 1 / k:
                if not parts:
                    parts, votes = [tree], [1.0]
                break
            vote = get("rate") * (math.log((1 - error) / max(error, 1e-12)) + math.log(k - 1))
            parts.append(tree)
            votes.append(vote)
            if error == 0:
                break
            # weights relative to their mean, so that they neither vanish nor overflow
            scale = 1 / (1 - error + error * math.exp(vote))
            factor = F.when(F.col("_miss"), F.lit(math.exp(vote) * scale)).otherwise(F.lit(scale))
            update = judged.select(X, Y, (F.col("_w") * factor).alias("_w"))
            update = (cut_lineage(update) if (i + 1) % ROUNDS_PER_CUT == 0 else update).persist()
            update.count()
            data.unpersist()
            data = update
        data.unpersist()
        return AdaBoostModel(cols, labels, parts, votes)
