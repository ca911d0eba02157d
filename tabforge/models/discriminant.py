"""Linear and quadratic discriminant analysis.

One pass gives size, mean and cross products per class; a d x d system is solved on the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.models.base import ColumnEstimator, ColumnModel
from tabforge.models.bayes import add_scores
from tabforge.runtime import bounded_rows

PAIR_LIMIT = 12
MAX_FEATURES = 2_000
EXPRESSION_TERMS = 400


def class_moments(df: DataFrame, cols, label: str, max_classes: int = 1_000) -> list[tuple]:
    """Per class, sorted: (label, rows, mean, population covariance), over rows without a missing cell.

    Few columns: Spark's own covariance aggregates. Many: each task adds up cross products of its rows, shifted by
    the overall mean against cancellation, and only the sums are shuffled.
    """
    d = len(cols)
    if d > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")
    df = df.dropna(subset=[label, *cols])
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    if d <= PAIR_LIMIT:
        aggs = [F.covar_pop(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in upper]
        stats = df.groupBy(label).agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)], *aggs
        )
        out = []
        for r in sorted(bounded_rows(stats, max_classes, "classes"), key=lambda r: r[label]):
            cov = np.zeros((d, d))
            for i, j in upper:
                cov[i, j] = cov[j, i] = r[f"c_{i}_{j}"]
            out.append((r[label], r["n"], np.array([r[f"m_{i}"] for i in range(d)]), cov))
        return out

    centre_row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([centre_row[f"m_{i}"] for i in range(d)])
    iu = np.triu_indices(d)

    def sums(batches):
        acc: dict = {}
        for b in batches:
            x = np.stack(b["vec"].to_numpy()) - centre
            y = b["y"].to_numpy()
            for k in pd.unique(y):
                part = x[y == k]
                row = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part)[iu]])
                acc[k] = acc.get(k, 0) + row
        for k, row in acc.items():
            yield pd.DataFrame({"y": [k], "x": [row]})

    rows = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("vec"), F.col(label).alias("y"))
    kind = dict(rows.dtypes)["y"]
    parts = rows.mapInPandas(sums, f"y {kind}, x array<double>").groupBy("y")
    totals = parts.agg(Summarizer.sum(array_to_vector("x")).alias("x"))
    per = {r["y"]: r["x"].toArray() for r in bounded_rows(totals, max_classes, "classes")}
    out = []
    for k in sorted(per):
        v = per[k]
        n, mean = v[0], v[1 : d + 1] / v[0]
        cov = np.zeros((d, d))
        cov[iu] = v[d + 1 :] / n
        cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
        out.append((k, int(n), mean + centre, cov))
    return out


def _vector(cols) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def _numpy_scores(score, cols) -> Column:
    """Scores of all classes from a block of rows at a time."""

    @F.pandas_udf("array<double>")
    def run(vec: pd.Series) -> pd.Series:
        return pd.Series(list(score(np.stack(vec.to_numpy()))))

    return run(_vector(cols))


class LdaModel(ColumnModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        st, cols = self.fitted(), self.cols()
        if len(cols) * len(st["labels"]) > EXPRESSION_TERMS:
            coef, const, mid = np.array(st["coef"]), np.array(st["const"]), np.array(st["centre"])
            wide = df.withColumn("_all", _numpy_scores(lambda x: (x - mid) @ coef.T + const, cols))
            scores = [F.col("_all")[i] for i in range(len(const))]
            return add_scores(wide, scores, st["labels"], self.getOrDefault("predictionCol")).drop("_all")
        scores = []
        for coef, const in zip(st["coef"], st["const"]):
            s = F.lit(const)
            for c, w, m in zip(cols, coef, st["centre"]):
                s = s + F.lit(w) * (F.col(c).cast("double") - F.lit(m))
            scores.append(s)
        return add_scores(df, scores, st["labels"], self.getOrDefault("predictionCol"))


class Lda(ColumnEstimator):
    """Normal classes with one shared covariance, divided by n - K. A singular one gets its pseudo-inverse."""

    def __init__(self, inputCols=None, labelCol="label"):
        super().__init__()
        self._set(labelCol=labelCol)
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> LdaModel:
        return LdaModel.of(self, self.state_of(class_moments(df, self.cols(), self.label())))

    def state_of(self, moments: list[tuple]) -> dict:
        """Fitted numbers from each class's (label, rows, mean, population covariance)."""
        n = sum(m[1] for m in moments)
        centre = sum(m[1] * m[2] for m in moments) / n
        pooled = sum(m[1] * m[3] for m in moments) / max(n - len(moments), 1)
        inv = np.linalg.pinv(pooled, hermitian=True)
        coef = [inv @ (m[2] - centre) for m in moments]
        const = [float(np.log(m[1] / n) - 0.5 * (m[2] - centre) @ w) for m, w in zip(moments, coef)]
        return {
            "labels": [m[0] for m in moments],
            "coef": [[float(x) for x in w] for w in coef],
            "const": const,
            "centre": [float(x) for x in centre],
        }


class QdaModel(ColumnModel):
    def ridged(self) -> list:
        """Classes whose covariance was singular and got a ridge."""
        return self.fitted()["ridged"]

    def _transform(self, df: DataFrame) -> DataFrame:
        st, cols = self.fitted(), self.cols()
        d = len(cols)
        if d * d * len(st["labels"]) > EXPRESSION_TERMS:
            means = [np.array(m) for m in st["mean"]]
            roots = [np.array(r) for r in st["root"]]
            consts = st["const"]

            def score(x):
                return np.stack(
                    [c - 0.5 * (((x - m) @ r.T) ** 2).sum(axis=1) for c, m, r in zip(consts, means, roots)], axis=1
                )

            wide = df.withColumn("_all", _numpy_scores(score, cols))
            scores = [F.col("_all")[i] for i in range(len(consts))]
            return add_scores(wide, scores, st["labels"], self.getOrDefault("predictionCol")).drop("_all")
        scores = []
        for const, mean, root in zip(st["const"], st["mean"], st["root"]):
            dist = F.lit(0.0)
            for row in root:
                z = F.lit(0.0)
                for c, w, m in zip(cols, row, mean):
                    if w:
                        z = z + F.lit(w) * (F.col(c).cast("double") - F.lit(m))
                dist = dist + z * z
            scores.append(F.lit(const) - 0.5 * dist)
        return add_scores(df, scores, st["labels"], self.getOrDefault("predictionCol"))


class Qda(ColumnEstimator):
    """Normal classes with their own covariance, divided by n - 1.

    A class with too few rows for its covariance gets ``ridge`` times the mean variance on the diagonal.
    """

    ridge = Param(Params._dummy(), "ridge", "share of the mean variance", TypeConverters.toFloat)

    def __init__(self, inputCols=None, labelCol="label", ridge=1e-3):
        super().__init__()
        self._set(labelCol=labelCol, ridge=ridge)
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> QdaModel:
        return QdaModel.of(self, self.state_of(class_moments(df, self.cols(), self.label())))

    def state_of(self, moments: list[tuple]) -> dict:
        """Fitted numbers from each class's (label, rows, mean, population covariance)."""
        total, d = sum(m[1] for m in moments), len(moments[0][2])
        state = {"labels": [], "const": [], "mean": [], "root": [], "ridged": []}
        for label, n, mean, cov in moments:
            sigma = cov * n / max(n - 1, 1)
            values, vectors = np.linalg.eigh(sigma)
            if n <= d or values[0] <= 1e-12 * max(values[-1], 1e-300):
                extra = self.getOrDefault("ridge") * max(np.trace(sigma) / d, 1e-12)
                values = np.maximum(values, 0.0) + extra
                state["ridged"].append(label)
            root = (vectors / np.sqrt(values)).T
            state["labels"].append(label)
            state["const"].append(float(np.log(n / total) - 0.5 * np.log(values).sum()))
            state["mean"].append([float(x) for x in mean])
            state["root"].append([[float(x) for x in r] for r in root])
        return state
