"""Profiles that add up: one small row per part and column, stored and merged without reading the data again.

Counts, means, deviations, least and largest values merge exactly. Distinct values (HyperLogLog, 2^12 registers), quantiles (KLL)
and frequent values are sketches with the errors stated below; ``describe``, ``nunique_by`` and ``mode_frequency`` are the exact
forms. A merge of merged profiles is a profile again, so days can be kept and months made from them.

Nulls are counted and left out of everything else, NaN counts as null. A part of nulls only has count 0 and no values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)  # relative, three standard errors
KLL_SIZE = 400
RANK_ERROR = 0.02  # of all rows; wider than the library's 99 % bound for this size
TOP_TRACKED = 1_000  # counts are exact up to this many values less a quarter, beyond it too small by rows * 3.5 / 1000 at most

SUMS = ("n", "nulls", "mean", "m2", "least", "largest")


def _columns(df: DataFrame, cols: Sequence[str]) -> list[tuple[str, Column, Column, bool]]:
    """Name, number, text, whether it is a number."""
    out = []
    for c in cols:
        number = isinstance(df.schema[c].dataType, T.NumericType)
        x = F.nanvl(F.col(c).cast("double"), F.lit(None)) if number else F.lit(None).cast("double")
        text = F.when(x.isNotNull(), F.col(c).cast("string")) if number else F.col(c).cast("string")
        out.append((c, x, text, number))
    return out


def profile_parts(df: DataFrame, cols: Sequence[str], part: Column | None = None) -> DataFrame:
    """One row per part and column, in one pass. ``part``: by default the file that a row was read from."""
    part = F.input_file_name() if part is None else part
    prepared, cells = [part.alias("part")], []
    for i, (_, x, text, _) in enumerate(_columns(df, cols)):
        prepared += [x.alias(f"_x{i}"), text.alias(f"_t{i}")]
    for i, c in enumerate(cols):
        x, text = F.col(f"_x{i}"), F.col(f"_t{i}")
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(text).alias("n"),
                (F.count(F.lit(1)) - F.count(text)).alias("nulls"),
                F.avg(x).alias("mean"),
                (F.var_pop(x) * F.count(x)).alias("m2"),
                F.min(x).alias("least"),
                F.max(x).alias("largest"),
                F.hll_sketch_agg(text, DISTINCT_BITS).alias("distinct"),
                F.kll_sketch_agg_double(x, KLL_SIZE).alias("ranks"),
                F.expr(f"approx_top_k_accumulate(_t{i}, {TOP_TRACKED})").alias("top"),
            )
        )
    wide = df.select(*prepared).groupBy("part").agg(*[c.alias(f"_c{i}") for i, c in enumerate(cells)])
    return wide.select("part", F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(cells))])))


def merge_profiles(parts: DataFrame, part: Column | None = None) -> DataFrame:
    """Profiles put together: all of a column, or those that ``part`` maps to one name. The same columns again."""
    named = parts.withColumn("part", F.lit("all") if part is None else part)
    counted = F.nullif(F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))), F.lit(0))
    means = named.groupBy("part", "column").agg((F.sum(F.col("n") * F.col("mean")) / counted).alias("_mean"))
    shifted = named.join(means, ["part", "column"])
    return shifted.groupBy("part", "column").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), 2)).alias("m2"),
        F.min("least").alias("least"),
        F.max("largest").alias("largest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks", KLL_SIZE).alias("ranks"),
        F.expr(f"approx_top_k_combine(top, {TOP_TRACKED})").alias("top"),
    )


def read_profile(parts: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 1) -> DataFrame:
    """Numbers of a profile: exact ones, ``distinct``, ``q<percent>`` of number columns, and the ``top`` values with their counts."""
    counted = F.col("mean").isNotNull()
    values = {f"q{round(100 * q)}": F.when(counted, F.kll_sketch_get_quantile_double("ranks", F.lit(float(q)))) for q in quantiles}
    return parts.select(
        "part",
        "column",
        "n",
        "nulls",
        "mean",
        F.sqrt(F.try_divide("m2", F.col("n") - 1)).alias("std"),
        "least",
        "largest",
        F.hll_sketch_estimate("distinct").alias("distinct"),
        *[v.alias(n) for n, v in values.items()],
        F.expr(f"approx_top_k_estimate(top, {int(top)})").alias("top"),
    )
