"""Joins (J1-J6): enrichment from the left, lookups, ranges, glue by key.

Spark picks broadcast or sort-merge from measured sizes (adaptive execution included); nothing is
broadcast by hint here except tables whose rows were counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.runtime import broadcast_if_small
from tabforge.sources.io import require_key

NULL_PLACES = 10_000


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on,
    *,
    null_keys_match: bool = False,
    check_unique: bool = True,
    salts: int = 1,
) -> DataFrame:
    """Left join that keeps every row of ``df`` once.

    A key that occurs twice in ``dim`` would multiply rows, so it is an error unless the check is off. Rows whose key is
    null match nothing; they are dealt out to all tasks.
    ``salts`` > 1 spreads a hot key of ``df`` over that many tasks and repeats each row of ``dim`` as often;
    the salt is a hash of the row, so a task that is run again sends its rows the same way.
    """
    on = [on] if isinstance(on, str) else list(on)
    if check_unique:
        require_key(dim.select(*on).dropna(how="any"), on)
    keys = list(on)
    if salts > 1:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    elif not null_keys_match:
        missing = reduce(or_, [F.col(k).isNull() for k in on])
        anywhere = F.pmod(F.xxhash64(*df.columns), F.lit(NULL_PLACES)) + 1
        df = df.withColumn("_salt", F.when(missing, anywhere).otherwise(0))
        dim = dim.withColumn("_salt", F.lit(0).cast("long"))
        keys.append("_salt")
    if not null_keys_match:
        return df.join(dim, keys, "left").drop("_salt")
    right = dim.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return df.join(right, cond, "left").drop("_salt", *[f"_r_{k}" for k in keys])


def heavy_keys(df: DataFrame, on: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows: 1 / ``share`` at most.

    Two narrow passes without a shuffle of keys: a sketch of bounded size names all candidates, then they are counted.
    """
    hashed = df.dropna(subset=list(on)).select(F.xxhash64(*on).alias("_key"))
    found = hashed.stat.freqItems(["_key"], share).first()[0]
    if not found:
        return []
    counts = [F.count_if(F.col("_key") == F.lit(k)).alias(f"n{i}") for i, k in enumerate(found)]
    row = hashed.agg(F.count(F.lit(1)).alias("n"), *counts).first()
    return sorted(k for i, k in enumerate(found) if row[f"n{i}"] > share * row["n"])


def enrich_hot(df: DataFrame, dim: DataFrame, on, *, share: float = 0.01, salts: int = 16, check_unique: bool = True) -> DataFrame:
    """``enrich`` for facts with a few very frequent keys: only these are salted, and only their rows of ``dim`` copied.

    A key with more than ``share`` of the facts goes to ``salts`` tasks. All other rows join as they are, and rows whose key is
    null match nothing and are dealt out to all tasks. One join, whatever the keys.
    """
    on = [on] if isinstance(on, str) else list(on)
    if check_unique:
        require_key(dim.select(*on).dropna(how="any"), on)
    hot = F.xxhash64(*on).isin(heavy_keys(df, on, share))
    row = F.xxhash64(*df.columns)
    missing = reduce(or_, [F.col(k).isNull() for k in on])
    salt = F.when(missing, F.pmod(row, F.lit(NULL_PLACES)) + salts).when(hot, F.pmod(row, F.lit(salts))).otherwise(0)
    first = F.lit(0).cast("long")
    copies = F.when(hot, F.sequence(first, F.lit(salts - 1).cast("long"))).otherwise(F.array(first))
    right = dim.withColumn("_salt", F.explode(copies))
    return df.withColumn("_salt", salt.cast("long")).join(right, [*on, "_salt"], "left").drop("_salt")


def lookup_join(df: DataFrame, table: DataFrame, code) -> DataFrame:
    """Attributes of a code from a small table; an unknown code gets nulls. The table is counted first."""
    return df.join(broadcast_if_small(require_key(table, code)), code, "left")


def range_join(df: DataFrame, col: str, ranges: DataFrame, lo: str = "lo", hi: str = "hi", bins: int | None = None) -> DataFrame:
    """Pairs of a row and a range with lo <= value < hi; ranges may overlap.

    Both sides get a bin number, so it is an equality join with a filter instead of a comparison of all
    pairs. A range is repeated once per bin it touches. By default there are four bins for each range, or fewer if the
    ranges are so wide that they would be repeated more than about ten times on average.
    """
    ranges = ranges.where(F.col(lo) < F.col(hi))
    lengths = F.sum(F.col(hi).cast("double") - F.col(lo).cast("double"))
    ends = ranges.agg(
        F.min(lo).cast("double").alias("a"), F.max(hi).cast("double").alias("b"), F.count(F.lit(1)).alias("n"), lengths.alias("w")
    ).first()
    a, b = (0.0, 1.0) if ends["a"] is None else (ends["a"], ends["b"])
    if not math.isfinite(a) or not math.isfinite(b):
        raise ValueError("range ends must be finite")
    if bins is None:
        n = max(1, ends["n"])
        bins = int(max(1, min(4 * n, 8 * n * (b - a) / ends["w"] if ends["w"] else 4 * n)))
    width = (b - a) / bins

    def bin_of(c):
        return F.floor((c.cast("double") - F.lit(a)) / F.lit(width)).cast("long")

    touched = ranges.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(lo)), bin_of(F.col(hi)))))
    inside = df.where((F.col(col) >= a) & (F.col(col) < b)).withColumn("_bin", bin_of(F.col(col)))
    hit = inside.join(broadcast_if_small(touched), "_bin")
    return hit.where((F.col(col) >= F.col(lo)) & (F.col(col) < F.col(hi))).drop("_bin")


def glue(dfs: Sequence[DataFrame], key: str, check: bool = True) -> DataFrame:
    """Column blocks of the same rows put side by side by key. A key that some block has not, or has twice, is an error.

    The check counts keys only; the blocks are joined once.
    """
    if check:
        keys = reduce(DataFrame.unionAll, [d.select(F.col(key).alias("_k"), F.lit(i).alias("_i")) for i, d in enumerate(dfs)])
        per = keys.groupBy("_k").agg(*[F.count_if(F.col("_i") == i).alias(f"n{i}") for i in range(len(dfs))])
        odd = per.where(reduce(or_, [F.col(f"n{i}") != 1 for i in range(len(dfs))]) | F.col("_k").isNull()).take(3)
        if odd:
            raise ValueError(f"the blocks hold different keys: {[r.asDict() for r in odd]}")
    return reduce(lambda x, y: x.join(y, key), dfs)
