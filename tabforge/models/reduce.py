"""Principal components, k-means, restricted Boltzmann features (R1-R4, U1-U3), polynomial fit."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.models.base import ColumnEstimator, ColumnModel
from tabforge.models.scale import Standardize
from tabforge.runtime import spread


class PcaModel(ColumnModel):
    """Scores ``pc1``..``pck``: centred (and scaled) columns times the loadings."""

    def _transform(self, df: DataFrame) -> DataFrame:
        st, cols = self.fitted(), self.cols()
        centred = [
            (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, st["mean"], st["std"])
        ]
        if len(cols) * len(st["loadings"]) <= 400:
            out = {}
            for i, load in enumerate(st["loadings"], 1):
                score = F.lit(0.0)
                for x, w in zip(centred, load):
                    score = score + x * F.lit(w)
                out[f"pc{i}"] = score
            return df.withColumns(out)
        wide = df.withColumn("_z", F.array(*centred))
        out = {}
        for i, load in enumerate(st["loadings"], 1):
            terms = F.zip_with("_z", F.lit(list(load)), lambda x, w: x * w)
            out[f"pc{i}"] = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
        return wide.withColumns(out).drop("_z")

    def variance(self, spark) -> DataFrame:
        """Component, share of the variance, running share."""
        rows, total = [], 0.0
        for i, r in enumerate(self.fitted()["ratio"], 1):
            total += r
            rows.append((i, float(r), float(total)))
        return spark.createDataFrame(rows, "component int, ratio double, cumulative double")

    def loadings(self, spark) -> DataFrame:
        rows = [
            (c, i, float(w))
            for i, load in enumerate(self.fitted()["loadings"], 1)
            for c, w in zip(self.cols(), load)
        ]
        return spark.createDataFrame(rows, "feature string, component int, loading double")

    def top_loadings(self, spark, component: int, k: int) -> DataFrame:
        """The k features with the largest absolute weight in a component."""
        one = self.loadings(spark).where(F.col("component") == component)
        return one.orderBy(F.abs("loading").desc(), "feature").limit(k)


class Pca(ColumnEstimator):
    """Principal components of the standardised columns (or only centred ones with ``scale=False``).

    MLlib finds them from the covariance; the projection here subtracts the mean first, which MLlib's does
    not. Each component's largest weight is made positive.
    """

    k = Param(Params._dummy(), "k", "components; all by default", TypeConverters.toInt)

    def __init__(self, inputCols=None, k=None, scale=True):
        super().__init__()
        self.scale = scale
        if inputCols:
            self._set(inputCols=list(inputCols))
        if k:
            self._set(k=k)

    def _fit(self, df: DataFrame) -> PcaModel:
        cols = self.cols()
        stats = Standardize(cols).fit(df).fitted()
        std = [s if s and self.scale else 1.0 for s in stats["std"]]
        z = df.select(
            *[((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(cols, stats["mean"], std)]
        )
        vec = VectorAssembler(inputCols=cols, outputCol="_z").transform(z).select("_z")
        k = self.getOrDefault("k") if self.isDefined("k") else len(cols)
        model = PCA(k=k, inputCol="_z", outputCol="_pc").fit(vec)
        pc = model.pc.toArray().T
        flip = [1.0 if row[np.abs(row).argmax()] >= 0 else -1.0 for row in pc]
        return PcaModel.of(
            self,
            {
                "mean": stats["mean"],
                "std": std,
                "loadings": [[float(w * f) for w in row] for row, f in zip(pc, flip)],
                "ratio": [float(r) for r in model.explainedVariance],
            },
        )


def components_for(df: DataFrame, cols: Sequence[str], share: float = 0.85) -> DataFrame:
    """Fewest components whose running share reaches ``share``."""
    table = Pca(cols).fit(df).variance(df.sparkSession)
    return table.where(F.col("cumulative") >= share - 1e-12).agg(F.min("component").alias("n_components"))


def _vectors(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Vector column in a fixed row order, because k-means draws its first centres from the rows."""
    rows = VectorAssembler(inputCols=list(cols), outputCol="_vec").transform(df.select(key, *cols))
    return spread(rows, df.count(), key).select("_vec")


def cluster(df: DataFrame, cols: Sequence[str], key: str, k: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """k-means: the table with a ``cluster`` column, and the centres (cluster, column, value)."""
    rows = _vectors(df, cols, key).persist()
    try:
        model = KMeans(k=k, seed=seed, featuresCol="_vec", predictionCol="cluster").fit(rows)
    finally:
        rows.unpersist()
    centres = [
        (i, c, float(v)) for i, centre in enumerate(model.clusterCenters()) for c, v in zip(cols, centre)
    ]
    table = df.sparkSession.createDataFrame(centres, "cluster int, col string, value double")
    return model.transform(VectorAssembler(inputCols=list(cols), outputCol="_vec").transform(df)).drop("_vec"), table


def elbow(df: DataFrame, cols: Sequence[str], key: str, ks: Sequence[int], seed: int = 0) -> DataFrame:
    """Sum of squared distances to the nearest centre for each k. The data are read once and kept."""
    rows = _vectors(df, cols, key).persist()
    try:
        out = []
        for k in ks:
            if k == 1:
                mean = Standardize(list(cols)).fit(df).fitted()
                n = rows.count()
                out.append((1, float(sum(s * s for s in mean["std"]) * n)))
                continue
            model = KMeans(k=k, seed=seed, featuresCol="_vec").fit(rows)
            out.append((k, float(model.summary.trainingCost)))
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(out, "k int, sse double")


def polyfit(df: DataFrame, x: str, y: str, degree: int) -> DataFrame:
    """Least-squares polynomial: power and coefficient of the standardised x, with its mean and deviation."""
    scale = Standardize([x]).fit(df).fitted()
    mean, std = scale["mean"][0], scale["std"][0] or 1.0
    z = df.select(((F.col(x).cast("double") - mean) / std).alias("_z"), F.col(y).cast("double").alias("_y"))
    vec = VectorAssembler(inputCols=["_z"], outputCol="_v").transform(z)
    powers = PolynomialExpansion(degree=degree, inputCol="_v", outputCol="_p").transform(vec)
    fit = LinearRegression(featuresCol="_p", labelCol="_y", solver="normal", regParam=0.0).fit(powers)
    rows = [(0, float(fit.intercept))] + [(i, float(c)) for i, c in enumerate(fit.coefficients, 1)]
    table = df.sparkSession.createDataFrame(rows, "power int, coefficient double")
    return table.withColumns({"x_mean": F.lit(mean), "x_std": F.lit(std)})


class RbmModel(ColumnModel):
    """Adds hidden-unit probabilities: an array ``rbm``, or the vector a learner reads."""

    def _transform(self, df: DataFrame) -> DataFrame:
        st, cols = self.fitted(), self.cols()
        w, hidden = np.array(st["w"]), np.array(st["hidden"])
        lo, span = np.array(st["lo"]), np.array(st["span"])

        @F.pandas_udf("array<double>")
        def project(vec: pd.Series) -> pd.Series:
            v = np.clip((np.stack(vec.to_numpy()) - lo) / span, 0.0, 1.0)
            return pd.Series(list(1.0 / (1.0 + np.exp(-(v @ w + hidden)))))

        units = project(F.array(*[F.col(c).cast("double") for c in cols]))
        return df.withColumn("_x", array_to_vector(units)) if st["vector"] else df.withColumn("rbm", units)


class RbmFeatures(ColumnEstimator):
    """Restricted Boltzmann machine: hidden-unit probabilities as features.

    Contrastive divergence with one step, on probabilities instead of samples, so the result does not depend on
    how rows are spread. Each epoch is one pass: every task adds up its rows' gradients, Spark adds up the tasks.
    Columns are brought to [0, 1] first.
    """

    units = Param(Params._dummy(), "units", "hidden units", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "step size", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, inputCols=None, units=100, epochs=10, rate=0.1, seed=0, vector=False):
        super().__init__()
        self._set(units=units, epochs=epochs, rate=rate, seed=seed)
        self.vector = vector
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> RbmModel:
        cols, h = self.cols(), self.getOrDefault("units")
        d = len(cols)
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
            *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)],
        ).first()
        lo = np.array([row[f"a{i}"] for i in range(d)])
        span = np.array([row[f"b{i}"] - row[f"a{i}"] or 1.0 for i in range(d)])
        rng = np.random.default_rng(self.getOrDefault("seed"))
        w, visible, hidden = rng.normal(0.0, 0.01, (d, h)), np.zeros(d), np.zeros(h)
        data = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("vec")).persist()
        try:
            for _ in range(self.getOrDefault("epochs")):
                total = _rbm_epoch(data, w, visible, hidden, lo, span)
                step = self.getOrDefault("rate") / max(total[0], 1.0)
                w = w + step * total[1 : 1 + d * h].reshape(d, h)
                visible = visible + step * total[1 + d * h : 1 + d * h + d]
                hidden = hidden + step * total[1 + d * h + d :]
        finally:
            data.unpersist()
        state = {"w": w, "hidden": hidden, "lo": lo, "span": span}
        return RbmModel.of(self, {"vector": self.vector, **{name: a.tolist() for name, a in state.items()}})


def _rbm_epoch(data: DataFrame, w, visible, hidden, lo, span) -> np.ndarray:
    """Rows and summed gradients of one pass at fixed weights."""

    def sigmoid(x):
        return 1.0 / (1.0 + np.exp(-x))

    def gradients(batches):
        acc = None
        for b in batches:
            if not len(b):
                continue
            v0 = (np.stack(b["vec"].to_numpy()) - lo) / span
            h0 = sigmoid(v0 @ w + hidden)
            v1 = sigmoid(h0 @ w.T + visible)
            h1 = sigmoid(v1 @ w + hidden)
            part = np.concatenate(
                [[len(v0)], (v0.T @ h0 - v1.T @ h1).ravel(), (v0 - v1).sum(axis=0), (h0 - h1).sum(axis=0)]
            )
            acc = part if acc is None else acc + part
        if acc is not None:
            yield pd.DataFrame({"x": [acc]})

    sums = data.mapInPandas(gradients, "x array<double>").agg(Summarizer.sum(array_to_vector("x")).alias("x"))
    return sums.first()["x"].toArray()
