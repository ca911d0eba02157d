"""Common ground of the library's own estimators.

They name their input columns, keep their fitted numbers in a parameter (so ``save``/``load`` work as for any
stage) and add ``prediction`` in the original label values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["ColumnEstimator", "ColumnModel", "argmax_label", "keyword_only", "Param", "Params", "TypeConverters"]


class _Columns(HasInputCols, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    def _init_columns(self):
        self._setDefault(labelCol="label", predictionCol="prediction")

    def cols(self) -> list[str]:
        return self.getOrDefault("inputCols")

    def label(self) -> str:
        return self.getOrDefault("labelCol")


class ColumnEstimator(Estimator, _Columns):
    """Estimator over named number columns and a label column."""

    def __init__(self):
        super().__init__()
        self._init_columns()


class ColumnModel(Model, _Columns):
    """Fitted numbers as plain lists in ``state``."""

    state = Param(Params._dummy(), "state", "fitted numbers", TypeConverters.identity)

    def __init__(self):
        super().__init__()
        self._init_columns()

    @classmethod
    def of(cls, parent: ColumnEstimator, state: dict):
        model = cls()
        for p in ("inputCols", "labelCol", "predictionCol"):
            if parent.isDefined(p):
                model._set(**{p: parent.getOrDefault(p)})
        model._set(state=state)
        return model

    def fitted(self) -> dict:
        return self.getOrDefault("state")


def argmax_label(scores: Sequence[Column], labels: Sequence) -> Column:
    """Label of the largest score. Labels are given in ascending order, so the smaller one wins a tie."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return F.coalesce(*[F.when(s == best, F.lit(k)) for s, k in zip(scores, labels)])
