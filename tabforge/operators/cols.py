"""Choosing, checking and repairing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.ranking import ordered_position


def cols_pos(df: DataFrame, start: int | None = None, end: int | None = None) -> list[str]:
    """Names at positions start..end-1, counted like a Python slice."""
    return df.columns[slice(start, end)]


def cols_range(df: DataFrame, first: str | None = None, last: str | None = None) -> list[str]:
    """Names from ``first`` to ``last``, both included."""
    names = df.columns
    i = 0 if first is None else names.index(first)
    j = len(names) - 1 if last is None else names.index(last)
    return names[i : j + 1]


def cols_like(df: DataFrame, suffix: str | None = None, contains: str | None = None) -> list[str]:
    """Names that end with ``suffix`` and hold ``contains``."""
    return [c for c in df.columns if (suffix is None or c.endswith(suffix)) and (contains is None or contains in c)]


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Names without the suffix; a clash of two names is an error."""
    names = [c.removesuffix(suffix) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("two columns would get the same name")
    return df.toDF(*names)


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def reorder(df: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """Columns in the order of the groups; every column must occur once."""
    names = [c for g in groups for c in g]
    if sorted(names) != sorted(df.columns):
        raise ValueError("the groups must hold every column once")
    return df.select(*names)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like`` in their order. A missing one is an error."""
    missing = [c for c in like.columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*like.columns)


def extra_columns(df: DataFrame, like: DataFrame) -> list[str]:
    """Columns that ``align`` would leave out."""
    return [c for c in df.columns if c not in like.columns]


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The row with the given key."""
    return df.where(F.col(key) == F.lit(value))


TOP_ROWS = 100_000


def lookup_position(df: DataFrame, key: str, position: int) -> DataFrame:
    """Row number ``position`` (from 0) when sorted by ``key``.

    Near the top it is a top-k; further down, positions are counted by ranges, so no task holds all rows before it.
    """
    if position < TOP_ROWS:
        return df.orderBy(key).limit(position + 1).orderBy(F.col(key).desc()).limit(1)
    return ordered_position(df, key, out="_pos").where(F.col("_pos") == position).drop("_pos")


def semi_join_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(keys, on, "left_semi")


# Value ranges of the integer types.
_INT_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))


def downcast(df: DataFrame, cols: Sequence[str], floats: bool = False) -> DataFrame:
    """Integer columns get the smallest type that holds all values; doubles become floats on request."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ints = [c for c in cols if isinstance(kinds[c], T.IntegralType)]
    casts = {c: F.col(c).cast("float") for c in cols if floats and isinstance(kinds[c], T.DoubleType)}
    if ints:
        row = df.agg(*[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(ints) for f in (F.min, F.max)]).first()
        for i, c in enumerate(ints):
            lo, hi = row[f"min_{i}"], row[f"max_{i}"]
            fits = [t for t, bound in _INT_TYPES if lo is not None and -bound <= lo and hi < bound]
            if fits:
                casts[c] = F.col(c).cast(fits[0])
    return df.withColumns(casts)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all. One aggregate over the table."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[f"`{c}`" for i, c in enumerate(df.columns) if counts[f"n{i}"] > 0])


def near_constant_cols(df: DataFrame, pct: float = 99.0, cols: Sequence[str] | None = None) -> list[str]:
    """Columns in which one value fills more than ``pct`` percent of the rows; nulls are no value.

    A value that fills more than 60 % of the rows is also the median, so for numbers one pass finds the only
    candidate of each column and a second pass counts it exactly: no value is shuffled. Smaller limits
    and other types are counted per value.
    """
    from tabforge.operators.profile import mode_frequency

    cols = list(df.columns if cols is None else cols)
    numbers = [c for c in numeric_cols(df) if c in cols] if pct >= 60.0 else []
    others = [c for c in cols if c not in numbers]
    found = []
    if numbers:
        mids = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.percentile_approx(F.col(c), 0.5, 1000).alias(f"m{i}") for i, c in enumerate(numbers)],
        ).first()
        if mids["n"]:
            hits = df.agg(
                *[F.count_if(F.col(c) == F.lit(mids[f"m{i}"])).alias(f"h{i}") for i, c in enumerate(numbers)]
            ).first()
            found += [c for i, c in enumerate(numbers) if 100.0 * (hits[f"h{i}"] or 0) / mids["n"] > pct]
    if others:
        freq = mode_frequency(df.select(*others)).where(F.col("mode_pct") > pct).collect()
        found += [r["col"] for r in freq]
    return [c for c in cols if c in found]


def drop_near_constant(df: DataFrame, pct: float = 99.0, cols: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*near_constant_cols(df, pct, cols))


def low_variance_cols(df: DataFrame, cols: Sequence[str], thr: float) -> list[str]:
    """Columns whose population variance is at most ``thr``."""
    row = df.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"v{i}"] is None or row[f"v{i}"] <= thr]


def drop_low_variance(df: DataFrame, cols: Sequence[str], thr: float = 1.5) -> DataFrame:
    return df.drop(*low_variance_cols(df, cols, thr))


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Nulls and NaN replaced by the column's mean, median or mode."""
    fill = Imputer(strategy=strategy, inputCols=list(cols), outputCols=[f"_{c}_filled" for c in cols])
    out = fill.fit(df).transform(df)
    return out.select(*[F.col(f"_{c}_filled").alias(c) if c in cols else F.col(c) for c in df.columns])


def finite_or(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Plus and minus infinity replaced."""
    inf = float("inf")
    return df.withColumns({c: F.when(F.abs(c) == inf, F.lit(value)).otherwise(F.col(c)) for c in cols})


def shift_label(df: DataFrame, col: str, by: int = -1) -> DataFrame:
    """Class numbers moved by a constant, as integers."""
    return df.withColumn(col, (F.col(col) + F.lit(by)).cast("int"))
