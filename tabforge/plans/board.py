"""Comparison tables."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.metrics import accuracy_of


def top_n(df: DataFrame, score: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The best ``n`` rows of a results table."""
    return df.orderBy(F.col(score).desc(), *ties).limit(n)


def leaderboard_flags(df: DataFrame, min_accuracy: float = 0.9, max_seconds: float = 5.0) -> DataFrame:
    """Marks in a results table (one row per model): best accuracy, best times, weak, slow."""
    whole = Window.partitionBy()
    return df.withColumns(
        {
            "best_accuracy": F.col("accuracy") == F.max("accuracy").over(whole),
            "best_training_time": F.col("training_time") == F.min("training_time").over(whole),
            "best_testing_time": F.col("testing_time") == F.min("testing_time").over(whole),
            "low_accuracy": F.col("accuracy") < min_accuracy,
            "slow": F.col("testing_time") > max_seconds,
        }
    )


def predictions_wide(scored: Mapping[str, DataFrame], key: str, label: str, pred: str = "prediction") -> DataFrame:
    """One column of predictions per model, joined by key, next to the true class."""
    parts = [df.select(key, *([label] if i == 0 else []), F.col(pred).alias(name)) for i, (name, df) in enumerate(scored.items())]
    return reduce(lambda a, b: a.join(b, key), parts)


def score_wide(df: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    """Accuracy of each prediction column, all in one pass."""
    cells = [F.struct(F.lit(m).alias("model"), accuracy_of(label, m).alias("accuracy")) for m in models]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def compare(models: Mapping[str, Estimator], train: DataFrame, val: DataFrame, label: str = "label") -> DataFrame:
    """Train and test time and accuracy per model, best first.

    Times are taken around the fit and around the scoring job, because ``transform`` alone does no work.
    """
    spark = train.sparkSession
    train, val = train.persist(), val.persist()
    try:
        train.count(), val.count()
        rows = []
        for name, est in models.items():
            start = time.perf_counter()
            model = est.fit(train)
            fitted = time.perf_counter()
            score = model.transform(val).agg(accuracy_of(label, "prediction").alias("a")).first()["a"]
            rows.append((name, score, fitted - start, time.perf_counter() - fitted))
    finally:
        train.unpersist()
        val.unpersist()
    schema = "classifier string, accuracy double, training_time double, testing_time double"
    return spark.createDataFrame(rows, schema).orderBy(F.col("accuracy").desc(), "classifier")
