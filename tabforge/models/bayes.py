"""Gaussian naive Bayes (B1): class sizes, means and variances in one aggregate; scores as expressions."""

from __future__ import annotations

import math

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.models.base import ColumnEstimator, ColumnModel, argmax_label

WIDE_TERMS = 400


def softmax(scores: list[Column]) -> Column:
    """Probabilities from log scores, shifted by the largest so that nothing overflows."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = F.array(*[F.exp(s - top) for s in scores])
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(parts, lambda x: x / total)


def add_scores(df: DataFrame, scores: list[Column], labels: list, pred: str) -> DataFrame:
    """Score columns first, then label and probabilities from them, so each score is computed once."""
    names = [f"_score{i}" for i in range(len(scores))]
    scored = df.withColumns(dict(zip(names, scores)))
    picked = [F.col(n) for n in names]
    return scored.withColumns({pred: argmax_label(picked, labels), "probability": softmax(picked)}).drop(*names)


class GaussianNBModel(ColumnModel):
    def scores(self) -> list[Column]:
        st, cols = self.fitted(), self.cols()
        out = []
        for prior, mean, var in zip(st["prior"], st["mean"], st["var"]):
            const = math.log(prior) - 0.5 * sum(math.log(2 * math.pi * v) for v in var)
            if len(cols) * len(st["labels"]) <= WIDE_TERMS:
                dist = F.lit(0.0)
                for c, m, v in zip(cols, mean, var):
                    diff = F.col(c).cast("double") - F.lit(m)
                    dist = dist + diff * diff / F.lit(v)
            else:
                xs = F.array(*[F.col(c).cast("double") for c in cols])
                diff = F.zip_with(xs, F.lit(list(mean)), lambda x, m: x - m)
                terms = F.zip_with(diff, F.lit(list(var)), lambda d, v: d * d / v)
                dist = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
            out.append(F.lit(const) - 0.5 * dist)
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_scores(df, self.scores(), self.fitted()["labels"], self.getOrDefault("predictionCol"))


class GaussianNB(ColumnEstimator):
    """Independent normal features per class. Variances get 1e-9 of the largest column variance added."""

    smoothing = Param(Params._dummy(), "smoothing", "share of the largest variance", TypeConverters.toFloat)

    def __init__(self, inputCols=None, labelCol="label", smoothing=1e-9):
        super().__init__()
        self._set(labelCol=labelCol, smoothing=smoothing)
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> GaussianNBModel:
        cols, label = self.cols(), self.label()
        rows = class_statistics(df, cols, [label])
        return GaussianNBModel.of(self, nb_state(rows, cols, label, self.getOrDefault("smoothing")))

    def state_of(self, moments: list[tuple]) -> dict:
        """Fitted numbers from each class's (label, rows, mean, population variances)."""
        rows = [
            {"_label": k, "n": n, **{f"m_{i}": float(m) for i, m in enumerate(mean)}, **{f"v_{i}": float(v) for i, v in enumerate(var)}}
            for k, n, mean, var in moments
        ]
        return nb_state(rows, range(len(moments[0][2])), "_label", self.getOrDefault("smoothing"))


def class_statistics(df: DataFrame, cols, by, max_rows: int = 100_000) -> list:
    """Per group: rows, and per column mean and variance, over rows without a missing cell. Pre-added in each task."""
    from tabforge.runtime import bounded_rows

    stats = df.dropna(subset=[*by, *cols]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
        *[F.var_pop(c).alias(f"v_{i}") for i, c in enumerate(cols)],
    )
    return sorted(bounded_rows(stats, max_rows, "classes"), key=lambda r: tuple(r[b] for b in by))


def nb_state(rows, cols, label: str, smoothing: float) -> dict:
    n = sum(r["n"] for r in rows)
    total_var = []
    for i in range(len(cols)):
        mean = sum(r["n"] * r[f"m_{i}"] for r in rows) / n
        total_var.append(sum(r["n"] * (r[f"v_{i}"] + (r[f"m_{i}"] - mean) ** 2) for r in rows) / n)
    extra = smoothing * max(total_var) or 1e-300
    return {
        "labels": [r[label] for r in rows],
        "prior": [r["n"] / n for r in rows],
        "mean": [[r[f"m_{i}"] for i in range(len(cols))] for r in rows],
        "var": [[r[f"v_{i}"] + extra for i in range(len(cols))] for r in rows],
    }


