"""Row-wise features as column expressions (M1-M12, A1, J4 flags, J6).

Each function returns a Column, so one ``select``/``withColumns`` holds many features and Spark compiles
them into one projection. Missing cells are null: means and sums skip them, other formulas give null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(parts: Sequence[Column]) -> Column:
    return reduce(add, parts)


def row_norm(cols: Sequence) -> Column:
    """Euclidean length of the row over ``cols``."""
    return F.sqrt(_total([_c(c).cast("double") * _c(c).cast("double") for c in cols]))


def row_sum(cols: Sequence) -> Column:
    """Sum over the cells that are present; 0 when none is."""
    return _total([F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])


def row_mean(cols: Sequence) -> Column:
    """Mean over the cells that are present; null when none is."""
    present = _total([F.when(_c(c).isNotNull(), 1).otherwise(0) for c in cols])
    return F.when(present > 0, row_sum(cols) / F.nullif(present, F.lit(0)))


def pair_diff(a, b) -> Column:
    return _c(a) - _c(b)


def pair_sum(a, b) -> Column:
    return _c(a) + _c(b)


def half_sum(a, b) -> Column:
    return (_c(a) + _c(b)) / F.lit(2.0)


def half_diff(a, b) -> Column:
    return (_c(a) - _c(b)) / F.lit(2.0)


def pair_ops(pairs: Sequence[tuple[str, str]], ops: Mapping[str, object]) -> dict[str, Column]:
    """One column per pair and operation, named ``<op>_<a>_<b>``; ``ops`` maps a name to a function."""
    return {f"{name}_{a}_{b}": op(a, b) for a, b in pairs for name, op in ops.items()}


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of columns times their own weights; absent cells count as 0."""
    return _total([F.coalesce(_c(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()])


def cos_deg(c, offset: float = 0.0) -> Column:
    """Cosine of an angle in degrees; with an offset, of (offset - angle)."""
    angle = _c(c) if offset == 0.0 else F.lit(float(offset)) - _c(c)
    return F.cos(F.radians(angle))


def sin_deg(c) -> Column:
    return F.sin(F.radians(_c(c)))


def bin_floor(c, width: float) -> Column:
    """Number of the fixed-width bin; values below 0 go down, not towards 0."""
    if width <= 0:
        raise ValueError("bin width must be positive")
    return F.floor(_c(c).cast("double") / F.lit(float(width))).cast("long")


def safe_ratio(a, b) -> Column:
    """a / (b + 1), null where the divisor is 0."""
    return _c(a).cast("double") / F.nullif(_c(b).cast("double") + F.lit(1.0), F.lit(0.0))


def interact(a, b) -> Column:
    return _c(a) * _c(b)


def log_or_null(c) -> Column:
    """Natural logarithm; null for 0 and below."""
    return F.when(_c(c) > 0, F.ln(_c(c).cast("double")))


def row_max(cols: Sequence) -> Column:
    """Largest cell that is present."""
    return F.greatest(*[_c(c) for c in cols]) if len(cols) > 1 else _c(cols[0])


def row_min(cols: Sequence) -> Column:
    return F.least(*[_c(c) for c in cols]) if len(cols) > 1 else _c(cols[0])


def array_affine(c, a: float, b: float) -> Column:
    """Every element x of an array becomes a*x + b."""
    return F.transform(_c(c), lambda x: x.cast("double") * F.lit(float(a)) + F.lit(float(b)))


def flatten_array(c) -> Column:
    """Nested arrays laid out one after the other."""
    return F.flatten(_c(c))


def range_flags(c, ranges: Mapping[str, tuple[float, float]]) -> dict[str, Column]:
    """0/1 per named range: low <= value < high."""
    return {
        name: F.when((_c(c) >= F.lit(lo)) & (_c(c) < F.lit(hi)), 1).otherwise(0)
        for name, (lo, hi) in ranges.items()
    }


def row_shares(cols: Sequence[str]) -> dict[str, Column]:
    """Each cell divided by the row sum; null when the sum is 0."""
    total = F.nullif(row_sum(cols), F.lit(0.0))
    return {c: F.col(c).cast("double") / total for c in cols}


def row_normalize(cols: Sequence[str]) -> dict[str, Column]:
    """Cells divided by the row's Euclidean length; a row of zeros stays as it is."""
    length = row_norm(cols)
    return {c: F.when(length == 0.0, F.lit(0.0)).otherwise(F.try_divide(F.col(c).cast("double"), length)) for c in cols}


def weight_columns(cols: Sequence[str], weights: Mapping[str, float], groups: Mapping[str, float] | None = None):
    """Columns times constant weights.

    ``weights`` names single columns. ``groups`` gives one weight to all columns whose name contains the
    text. A column that matches neither keeps weight 1; its own weight wins over a group's.
    """
    unknown = [c for c in weights if c not in cols]
    if unknown:
        raise ValueError(f"weights for unknown columns: {unknown}")
    out = {}
    for c in cols:
        shared = [w for text, w in (groups or {}).items() if text in c]
        w = weights.get(c, shared[-1] if shared else 1.0)
        out[c] = F.col(c).cast("double") * F.lit(float(w))
    return out
