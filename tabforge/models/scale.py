"""Scalers fitted on one table and applied to another."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.models.base import ColumnEstimator, ColumnModel


class StandardizeModel(ColumnModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.fitted()
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
                for c, m, s in zip(self.cols(), st["mean"], st["std"])
                if m is not None
            }
        )


class Standardize(ColumnEstimator):
    """Mean 0 and population deviation 1 per column; a constant column is only centred."""

    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> StandardizeModel:
        cols = self.cols()
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        n = range(len(cols))
        return StandardizeModel.of(self, {"mean": [row[f"m{i}"] for i in n], "std": [row[f"s{i}"] for i in n]})


class MinMaxModel(ColumnModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.fitted()
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo)
                if lo is not None and hi > lo
                else F.lit(None).cast("double")
                for c, lo, hi in zip(self.cols(), st["lo"], st["hi"])
            }
        )


class MinMaxBy(ColumnEstimator):
    """Scale by minimum and maximum of a reference group; a column constant in the group gives null."""

    groupCol = Param(Params._dummy(), "groupCol", "column that names the group", TypeConverters.toString)
    reference = Param(Params._dummy(), "reference", "group that sets the scale", TypeConverters.identity)

    def __init__(self, inputCols=None, groupCol=None, reference=None):
        super().__init__()
        if inputCols:
            self._set(inputCols=list(inputCols))
        if groupCol:
            self._set(groupCol=groupCol, reference=reference)

    def _fit(self, df: DataFrame) -> MinMaxModel:
        cols = self.cols()
        if self.isDefined("groupCol"):
            df = df.where(F.col(self.getOrDefault("groupCol")) == F.lit(self.getOrDefault("reference")))
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
            *[F.max(F.col(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)],
        ).first()
        n = range(len(cols))
        return MinMaxModel.of(self, {"lo": [row[f"a{i}"] for i in n], "hi": [row[f"b{i}"] for i in n]})
