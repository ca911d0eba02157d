"""Scores of predictions (V1-V9).

Class metrics start from one table of counts per (true, predicted) pair, which Spark pre-aggregates in
each task; everything after works on that small table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.runtime import bounded_rows


def accuracy_of(label: str, pred: str) -> Column:
    """Share of right predictions among rows with a label; a missing prediction is wrong."""
    right = F.coalesce(F.col(label) == F.col(pred), F.lit(False)).cast("double")
    return F.avg(F.when(F.col(label).isNotNull(), right))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Share of right predictions and of wrong ones."""
    return df.agg(accuracy_of(label, pred).alias("accuracy")).withColumn("error", 1 - F.col("accuracy"))


def pair_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", max_classes: int = 1_000) -> DataFrame:
    """Rows per (true, predicted) pair, also for pairs that never occur. The scored table is read once.

    Rows without label or prediction are in no cell. More than ``max_classes`` classes are an error.
    """
    pairs = pair_counts(df, label, pred)
    n = {(r["label"], r["prediction"]): r["n"] for r in bounded_rows(pairs, max_classes**2, "pairs of classes")}
    classes = sorted({c for pair in n for c in pair if c is not None})
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    cells = [(a, b, n.get((a, b), 0)) for a in classes for b in classes]
    return df.sparkSession.createDataFrame(cells, pairs.schema)


def class_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class: rows that have it, rows predicted as it, rows where both agree."""
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), zero.alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero).alias("hits")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("support"), F.col("n").alias("predicted"),
                 zero.alias("hits")),
    )
    return (
        pair_counts(df, label, pred)
        .select(F.inline(sides))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Precision, recall, f1 and support per class, with plain and support-weighted averages."""

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    per = class_counts(df, label, pred).select(
        F.col("cls").cast("string").alias("cls"),
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    # each class also counts towards both averages: once with weight 1, once with its support
    one = F.lit(1.0)
    rows = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("cls").alias("name"), one.alias("w")),
        F.struct(F.lit(1).alias("kind"), F.lit("macro avg").alias("name"), one.alias("w")),
        F.struct(F.lit(2).alias("kind"), F.lit("weighted avg").alias("name"), F.col("support").cast("double").alias("w")),
    )
    names = ("precision", "recall", "f1")
    spread = per.select(*names, "support", F.inline(rows))
    return (
        spread.groupBy("kind", F.col("name").alias("cls"))
        .agg(*[ratio(F.sum(F.col(c) * F.col("w")), F.sum("w")).alias(c) for c in names], F.sum("support").alias("support"))
        .drop("kind")
    )


def mae(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Mean absolute error on class numbers; rows without a prediction have no error and are left out."""
    return df.agg(F.avg(F.abs(F.col(label) - F.col(pred))).alias("mae"))


def mape_accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """100 minus the mean absolute percentage error. Rows with true value 0 have none; they are counted."""
    y = F.col(label).cast("double")
    err = F.abs(F.try_divide(y - F.col(pred), F.nullif(y, F.lit(0.0))))
    return df.agg((100 - 100 * F.avg(err)).alias("mape_accuracy"), F.count_if(y == 0).alias("n_zero"))


def auc_hard(df: DataFrame, average: str = "macro", label: str = "label", pred: str = "prediction") -> DataFrame:
    """Area under the ROC curve of hard class predictions, one class against the rest.

    A hard prediction has one point on the curve, so the area of a class is (TPR + TNR) / 2. ``macro`` takes
    the mean over the true classes; ``micro`` pools all their cells. With two classes both are the same.
    """
    if average not in ("macro", "micro"):
        raise ValueError("average must be macro or micro")
    per = class_counts(df, label, pred).withColumn("n", F.sum("support").over(Window.partitionBy()))
    per = per.where(F.col("support") > 0).withColumn("false_pos", F.col("predicted") - F.col("hits"))
    tpr = F.try_divide(F.col("hits"), F.col("support"))
    tnr = 1 - F.try_divide(F.col("false_pos"), F.col("n") - F.col("support"))
    macro = F.avg((tpr + tnr) / 2)
    if average == "macro":
        return per.agg(macro.alias("auc"))
    n, k = F.max("n"), F.count(F.lit(1))
    pooled = (F.try_divide(F.sum("hits"), n) + 1 - F.try_divide(F.sum("false_pos"), n * (k - 1))) / 2
    return per.agg(F.when(k > 2, pooled).otherwise(macro).alias("auc"))


def log_loss(df: DataFrame, probs: Mapping, label: str = "label") -> DataFrame:
    """Mean negative logarithm of the probability given to the true class; ``probs`` maps class to column."""
    p = F.coalesce(*[F.when(F.col(label) == F.lit(k), F.col(c)) for k, c in probs.items()])
    return df.agg((-F.avg(F.ln(F.greatest(p, F.lit(1e-15))))).alias("log_loss"))


def cv_summary(scores: DataFrame, score: str = "score", by=()) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return scores.groupBy(*by).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))
