"""Encoders that need a pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.operators.profile import per_column
from tabforge.runtime import broadcast_if_small, cut_lineage

SMALL_CODE_TABLE = 100_000


def code_table(df: DataFrame, col: str, max_small: int = SMALL_CODE_TABLE) -> DataFrame:
    """Distinct values and their codes 0..K-1 in sorted order.

    Up to ``max_small`` values are numbered in one window. More are sorted across all tasks, written once,
    and numbered by the sizes of the parts before them, so no task sees the whole list.
    """
    values = df.select(F.col(col).alias("value")).where(F.col(col).isNotNull()).distinct()
    if values.limit(max_small + 1).count() <= max_small:
        small = Window.partitionBy().orderBy("value")
        return values.withColumn("code", (F.row_number().over(small) - 1).cast("int"))
    parts = cut_lineage(values.orderBy("value").withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").count()
    before = F.sum("count").over(Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    return parts.withColumn("_place", place).join(F.broadcast(starts), "_part").select(
        "value", (F.col("_start") + F.col("_place")).cast("int").alias("code")
    )


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Code 0..K-1 of each value in sorted order; -1 where the value is missing."""
    codes = code_table(df, col).withColumnsRenamed({"value": col, "code": out})
    joined = df.join(broadcast_if_small(codes, SMALL_CODE_TABLE), col, "left")
    return joined.select(*df.columns, F.coalesce(F.col(out), F.lit(-1)).alias(out))


def onehot_counts(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Set flags per column, train and test side by side."""

    def ones(df, name):
        return per_column(df, cols, {name: lambda c: F.count_if(c == 1)})

    return ones(train, "n_train").join(ones(test, "n_test"), "col")


def vocabulary(df: DataFrame, phrases: str) -> DataFrame:
    """Distinct phrases of an array column.

    The outer form of explode keeps Spark from making the array a second time for a filter on its size.
    """
    return df.select(F.explode_outer(phrases).alias("phrase")).where(F.col("phrase").isNotNull()).distinct()


def phrase_pairs(df: DataFrame, key: str, phrases: str) -> DataFrame:
    """Long form of the phrase matrix: one row per key and phrase that occurs. Fits any vocabulary."""
    pairs = df.select(key, F.explode_outer(F.array_distinct(phrases)).alias("phrase"))
    return pairs.where(F.col("phrase").isNotNull())
