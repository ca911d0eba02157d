"""Profiles, correlations and distributions."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.operators.cols import numeric_cols
from tabforge.operators.ranking import exact_quantiles
from tabforge.runtime import bounded_rows, broadcast_if_small

PAIRWISE_LIMIT = 16


def per_column(df: DataFrame, cols: Sequence[str], measures: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per column with the given aggregates, all taken in a single pass over the table."""
    cells = [
        F.struct(F.lit(c).alias("col"), *[make(F.col(f"`{c}`")).alias(name) for name, make in measures.items()])
        for c in cols
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def table_shape(df: DataFrame) -> DataFrame:
    """Column name, type and the table's row count."""
    types = dict(df.dtypes)
    cells = [F.struct(F.lit(c).alias("col"), F.lit(types[c]).alias("type")) for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*cells)), "n_rows")


def preview(df: DataFrame, key: str, n: int = 5, last: bool = False) -> DataFrame:
    """First or last rows by key."""
    return df.orderBy(F.col(key).desc() if last else F.col(key)).limit(n)


def nunique_by(df: DataFrame, by: str, col: str, approx: bool = False) -> DataFrame:
    """Distinct values of ``col`` per group; rows without a group do not count."""
    count = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(count.alias("n"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, then by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), col)


def group_min_max(df: DataFrame, by: str, col: str) -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def group_count(df: DataFrame, by: str, col: str) -> DataFrame:
    """Cells of ``col`` that are present, per group."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(col).alias("n"))


def distinct_classes(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def null_counts(df: DataFrame) -> DataFrame:
    return per_column(df, df.columns, {"n_null": lambda c: F.count_if(c.isNull())})


def zero_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_column(df, cols, {"n_zero": lambda c: F.count_if(c == 0)})


def cols_with_negative(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns and whether they hold a value below 0."""
    picked = numeric_cols(df) if cols is None else cols
    return per_column(df, picked, {"has_negative": lambda c: F.coalesce(F.bool_or(c < 0), F.lit(False))})


def mode_frequency(df: DataFrame) -> DataFrame:
    """Share of the most frequent value per column in percent of all rows; nulls are no value.

    All columns are counted in one shuffle. Equal values of a task are added up before they move.
    """
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    counts = df.select(text).unpivot([], list(df.columns), "col", "_value").groupBy("col", "_value").count()
    top = F.max(F.when(F.col("_value").isNotNull(), F.col("count")))
    return counts.groupBy("col").agg((100.0 * F.coalesce(top, F.lit(0)) / F.sum("count")).alias("mode_pct"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column.

    ``exact=False`` takes approximate quartiles in the same single pass.
    """
    cols = list(numeric_cols(df) if cols is None else cols)
    probs = [0.25, 0.5, 0.75]
    measures = {
        "n": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "lo": lambda c: F.min(c).cast("double"),
        "hi": lambda c: F.max(c).cast("double"),
    }
    names = ("q25", "q50", "q75")
    if not exact:
        for name, p in zip(names, probs):
            measures[name] = lambda c, p=p: F.percentile_approx(c.cast("double"), p)
        return per_column(df, cols, measures)
    found = exact_quantiles(df, cols, probs)
    table = df.sparkSession.createDataFrame(
        [(c, *found[c]) for c in cols], "col string, q25 double, q50 double, q75 double"
    )
    return per_column(df, cols, measures).join(F.broadcast(table), "col")


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns as rows (a, b, r).

    Each pair is taken over the rows where both are present, however many columns there are. A column that is constant
    there has no correlation (null). Few columns: Spark's covariances in one pass, and a second one only if cells are
    missing. Many: matrix products of each task's rows, of which only the sums are shuffled.
    """
    cols = list(cols)
    spark, schema = df.sparkSession, "a string, b string, r double"
    if len(cols) <= PAIRWISE_LIMIT:
        pairs = list(combinations(range(len(cols)), 2))
        one = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
            *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)],
            *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs],
        ).first()
        if all(one[f"n{i}"] == one["n"] for i in range(len(cols))):
            r = {(i, j): one[f"c{i}_{j}"] for i, j in pairs}
            scale = [math.sqrt(one[f"v{i}"] or 0.0) for i in range(len(cols))]
            r = {(i, j): x / (scale[i] * scale[j]) if scale[i] and scale[j] else None for (i, j), x in r.items()}
        else:
            row = df.agg(*[_complete_corr(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
            r = {(i, j): row[f"c{i}_{j}"] for i, j in pairs}
        own = [(c, c, 1.0 if one[f"v{i}"] else None) for i, c in enumerate(cols)]
        both = [(cols[i], cols[j], x) for (i, j), x in r.items()] + [(cols[j], cols[i], x) for (i, j), x in r.items()]
        return spark.createDataFrame(own + both, schema)
    m = _pairwise_matrix(df, cols)
    rows = [(a, b, None if np.isnan(m[i, j]) else float(m[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return spark.createDataFrame(rows, schema)


def _pairwise_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Correlations over pairwise present rows; NaN where there is none."""
    d = len(cols)
    number = [F.col(f"`{c}`").cast("double") for c in cols]
    ends = df.agg(*[F.max(x).alias(f"h{i}") for i, x in enumerate(number)], *[F.min(x).alias(f"l{i}") for i, x in enumerate(number)]).first()
    centre = np.array([((ends[f"h{i}"] or 0.0) + (ends[f"l{i}"] or 0.0)) / 2 for i in range(d)])

    def sums(batches):
        total = np.zeros((4, d, d))
        for b in batches:
            x = np.array(b["vec"].to_list(), dtype=float).reshape(len(b), d) - centre
            here = ~np.isnan(x)
            x, here = np.where(here, x, 0.0), here.astype(float)
            total += [here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x]
        yield pd.DataFrame({"x": [total.ravel()]})

    parts = df.select(F.array(*number).alias("vec")).mapInPandas(sums, "x array<double>")
    total = parts.groupBy(F.lit("all")).agg(Summarizer.sum(array_to_vector("x")).alias("x")).first()
    if total is None:
        return np.full((d, d), np.nan)
    n, first, second, cross = total["x"].toArray().reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = second - first * first / n  # of the row's column, over the rows where the other is present too
        spread = np.where(spread > 1e-12 * second, spread, np.nan)
        r = (cross - first * first.T / n) / np.sqrt(spread * spread.T)
    np.fill_diagonal(r, np.where(np.isnan(np.diag(spread)), np.nan, 1.0))
    return r


def _complete_corr(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; null (no error) where one does not vary."""
    sa = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a)))
    sb = F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
    return F.try_divide(F.covar_pop(a, b), sa * sb)


def _position(c: str, cols: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in cols]), F.col(c))


def top_corr_pairs(df: DataFrame, cols: Sequence[str], thr: float = 0.95) -> DataFrame:
    """Pairs (each once) whose absolute correlation exceeds ``thr``, strongest first."""
    upper = corr_long(df, cols).where(_position("a", cols) < _position("b", cols))
    strong = upper.withColumn("abs_r", F.abs("r")).where(F.col("abs_r") > thr)
    return strong.select("a", "b", "abs_r").orderBy(F.col("abs_r").desc(), "a", "b")


def corr_lower_triangle(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The part of the matrix below its diagonal."""
    return corr_long(df, cols).where(_position("a", cols) > _position("b", cols))


def entity_profile(
    df: DataFrame, key: str, entity, group: str, reference, features: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """One entity against a reference group, on the group's min-max scale.

    ``features`` maps block -> feature -> column. Result: block, feature, group_mean, entity; a column that
    is constant in the group has no scale and gives nulls. One pass over the table, no join.
    """
    in_group = F.col(group) == F.lit(reference)
    is_entity = F.col(key) == F.lit(entity)
    cells = []
    for block, named in features.items():
        for feature, c in named.items():
            inside = F.when(in_group, F.col(c))
            lo, hi, mean = F.min(inside), F.max(inside), F.avg(inside)
            span = F.nullif(hi - lo, F.lit(0.0))
            cells.append(
                F.struct(
                    F.lit(block).alias("block"),
                    F.lit(feature).alias("feature"),
                    ((mean - lo) / span).alias("group_mean"),
                    ((F.max(F.when(is_entity, F.col(c))) - lo) / span).alias("entity"),
                )
            )
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def above_group_mean(df: DataFrame, key: str, entity, group: str, reference, cols: Sequence[str]) -> DataFrame:
    """Per feature: the entity's value, the mean of a group, and whether the value is above it."""
    own = F.col(key) == F.lit(entity)
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.max(F.when(own, F.col(c))).cast("double").alias("entity"),
            F.avg(F.when(F.col(group) == F.lit(reference), F.col(c))).alias("group_mean"),
        )
        for c in cols
    ]
    rows = df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))
    return rows.withColumn("above", F.col("entity") > F.col("group_mean"))


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum, empty bins included.

    The maximum falls into the last bin. With ``by`` all classes share the same bins. Only bins x classes
    rows leave the tasks.
    """
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    names = ["bin"] if by is None else [by, "bin"]
    if lo is None:
        none = [F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("bin_lo")]
        return df.limit(0).select(*([by] if by else []), *none)
    width = (hi - lo) / bins
    number = F.lit(0) if width == 0 else F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    present = df.where(x.isNotNull()).select(*([by] if by else []), number.alias("bin"))
    if by:
        present = present.where(F.col(by).isNotNull())
    counts = present.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    classes = counts.select(by).distinct() if by else df.sparkSession.range(1)
    grid = classes.select(*([by] if by else []), every)
    full = grid.join(counts, names, "left").fillna(0, ["n"])
    return full.withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width))


def kde(df: DataFrame, col: str, by: str, grid: Sequence[float], max_groups: int = 10_000) -> DataFrame:
    """Density per group on given points: Gaussian kernel, width = deviation * n^(-1/5) (Scott's rule).

    Every grid point is one sum over the rows, so the tasks add up their own rows and only
    groups x points numbers move. Exact. A group without spread has no density.
    """
    x = F.col(col).cast("double")
    rows = df.where(F.col(by).isNotNull() & x.isNotNull())
    stats = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp(x).alias("_s"))
    width = stats.where(F.col("_s") > 0).select(by, "_n", (F.col("_s") * F.pow("_n", F.lit(-0.2))).alias("_h"))
    width = broadcast_if_small(width, max_groups)
    joined = rows.select(by, x.alias("_x")).join(width, by)
    points = [float(g) for g in grid]
    sums = joined.groupBy(by, "_n", "_h").agg(
        *[F.sum(F.exp(-0.5 * F.pow((F.lit(g) - F.col("_x")) / F.col("_h"), F.lit(2.0)))).alias(f"_g{i}") for i, g in enumerate(points)]
    )
    norm = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    cells = [F.struct(F.lit(g).alias("x"), (F.col(f"_g{i}") / norm).alias("density")) for i, g in enumerate(points)]
    return sums.select(by, F.inline(F.array(*cells)))


def cov_ellipse(df: DataFrame, x: str, y: str, by: str, nstd: float = 3.0) -> DataFrame:
    """Covariance ellipse per class: centre, full width and height of ``nstd`` deviations, angle in degrees.

    The 2x2 eigen system has a closed form. The angle of the long axis lies in (-90, 90], because an axis
    has no direction. A class of one row has no covariance and gives nulls.
    """
    m = df.groupBy(by).agg(
        F.avg(x).alias("centre_x"),
        F.avg(y).alias("centre_y"),
        F.var_samp(x).alias("_a"),
        F.covar_samp(x, y).alias("_b"),
        F.var_samp(y).alias("_c"),
        F.count(F.lit(1)).alias("_n"),
    )
    half = (F.col("_a") + F.col("_c")) / 2
    root = F.hypot((F.col("_a") - F.col("_c")) / 2, F.col("_b"))
    enough = F.col("_n") > 1
    angle = F.degrees(0.5 * F.atan2(2 * F.col("_b"), F.col("_a") - F.col("_c")))
    return m.select(
        by,
        "centre_x",
        "centre_y",
        F.when(enough, 2 * nstd * F.sqrt(half + root)).alias("width"),
        F.when(enough, 2 * nstd * F.sqrt(F.greatest(half - root, F.lit(0.0)))).alias("height"),
        F.when(enough, angle).alias("angle"),
    )


def range_scale_by(df: DataFrame, cols: Sequence[str], by: str, max_groups: int = 10_000) -> DataFrame:
    """Columns divided by max - min of the row's class; a class without spread gives null."""
    spans = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        *[F.nullif(F.max(c) - F.min(c), F.lit(0)).alias(f"_span_{c}") for c in cols]
    )
    joined = df.join(broadcast_if_small(spans, max_groups), by, "left")
    return joined.select(
        *[(F.col(c) / F.col(f"_span_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def class_sizes(df: DataFrame, col: str, max_classes: int = 1_000) -> dict:
    """Rows per class, classes ascending; a column with more than ``max_classes`` is not a class column."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    rows = bounded_rows(counts, max_classes, f"classes of {col}")
    return {r[col]: r["_n"] for r in sorted(rows, key=lambda r: r[col])}


def classes_of(df: DataFrame, col: str, max_classes: int = 1_000) -> list:
    """Sorted class values."""
    return list(class_sizes(df, col, max_classes))
