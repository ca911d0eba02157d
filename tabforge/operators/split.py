"""Splits, folds, shuffles and samples (T1-T7), all repeatable from md5(key, seed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import hashed_below, row_hash
from tabforge.operators.ranking import ROWS_PER_BUCKET, hashed_position, ordered_position


def hash_split(df: DataFrame, key, frac: float, seed: int = 0, out: str = "split") -> DataFrame:
    """``test`` for a share ``frac`` of the keys, else ``train``. A projection: no shuffle, no count."""
    return df.withColumn(out, F.when(hashed_below(key, seed, frac), "test").otherwise("train"))


def train_test(df: DataFrame, key, frac: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    below = hashed_below(key, seed, frac)
    return df.where(~below), df.where(below)


def hash_sample(df: DataFrame, key, frac: float, seed: int = 0) -> DataFrame:
    """A share of the rows. A larger share with the same seed holds the smaller one."""
    return df.where(hashed_below(key, seed, frac))


def stratified_split(
    df: DataFrame, key, label: str, frac: float, seed: int = 0, exact: bool = True, out: str = "split"
) -> DataFrame:
    """Split that keeps the class shares.

    exact: each class gives round(frac * rows) test rows; this shuffles the table once. Without it the
    hash threshold is used, which keeps the shares in expectation and moves no row.
    """
    if not exact:
        return hash_split(df, key, frac, seed, out)
    placed = hashed_position(df, key, seed, by=label, out="_pos", size="_rows")
    cut = F.floor(F.col("_rows") * F.lit(float(frac)) + F.lit(0.5))
    return placed.withColumn(out, F.when(F.col("_pos") < cut, "test").otherwise("train")).drop("_pos", "_rows")


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and share per split and class."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.groupBy(split).agg(F.sum("n_rows").alias("_all"))
    return counts.join(totals, split).withColumn("share", F.col("n_rows") / F.col("_all")).drop("_all")


def kfold(df: DataFrame, key, k: int, how: str = "hash", seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1.

    ``blocks``: consecutive keys in order, the first folds one row longer when it does not divide evenly.
    ``hash``: the next best thing without any shuffle, folds equal in expectation.
    """
    if k < 2:
        raise ValueError("at least two folds")
    if how == "hash":
        part = F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("long")
        return df.withColumn(out, F.pmod(part, F.lit(k)).cast("int"))
    if how != "blocks":
        raise ValueError("how must be hash or blocks")
    placed = ordered_position(df, key, out="_pos", size="_rows")
    small = F.floor(F.col("_rows") / F.lit(k))
    extra = F.pmod(F.col("_rows"), F.lit(k))
    long_part = extra * (small + 1)
    fold = F.when(F.col("_pos") < long_part, F.floor(F.col("_pos") / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(F.col("_pos") - long_part, small))
    )
    return placed.withColumn(out, fold.cast("int")).drop("_pos", "_rows")


def stratified_kfold(df: DataFrame, key, label: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 with the rows of each class dealt out in turn, in hash order."""
    placed = hashed_position(df, key, seed, by=label, out="_pos")
    return placed.withColumn(out, F.pmod(F.col("_pos"), F.lit(k)).cast("int")).drop("_pos")


def shuffle(df: DataFrame, key, seed: int = 0, out: str = "pos") -> DataFrame:
    """A random but repeatable position per row."""
    return hashed_position(df, key, seed, out=out)


def cap_rows(df: DataFrame, key, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows, the first in hash order.

    Counts per hash prefix (three more digits per round, so 4,096 numbers at most) say which prefixes fit
    completely: those rows pass by a plain filter, and only the small prefix on the edge is sorted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    h = row_hash(keys, seed)
    if df.count() <= n:
        return df
    edge, left = "", n
    while True:
        inside = df.where(F.startswith(h, F.lit(edge)))
        counts = inside.groupBy(F.substring(h, 1, len(edge) + 3).alias("p")).count().collect()
        for r in sorted(counts, key=lambda r: r["p"]):
            if r["count"] > left:
                edge, rows = r["p"], r["count"]
                break
            left -= r["count"]
        if rows <= ROWS_PER_BUCKET or len(edge) >= 9:
            break
    prefix = F.substring(h, 1, len(edge))
    rest = df.where(prefix == F.lit(edge)).orderBy(h, *keys).limit(left)
    return df.where(prefix < F.lit(edge)).unionAll(rest)
