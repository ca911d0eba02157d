"""Repeatable randomness: every random choice comes from md5(key, seed), never from row order.

``rand``, ``sample`` and ``randomSplit`` depend on the partitioning; a hash of the row key does not,
and it stays the same after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_DIGITS = 8


def row_hash(key, seed) -> Column:
    """md5 over the key columns (one name or a list) and the seed, as hexadecimal text."""
    names = [key] if isinstance(key, (str, Column)) else list(key)
    return F.md5(F.concat_ws(":", *[F.col(n) if isinstance(n, str) else n for n in names], F.lit(str(seed))))


def threshold(frac: float) -> str:
    """Hexadecimal prefix below which a share ``frac`` of all hashes lies."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("share must lie in [0, 1]")
    return format(round(frac * 16**PREFIX_DIGITS), f"0{PREFIX_DIGITS}x")


def hashed_below(key, seed, frac: float) -> Column:
    """True for a share ``frac`` of the keys. Fixed-width hexadecimal text sorts like the number."""
    if frac == 1.0:
        return F.lit(True)
    return F.substring(row_hash(key, seed), 1, PREFIX_DIGITS) < F.lit(threshold(frac))
