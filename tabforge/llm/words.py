"""Words as the contracts have them: runs of characters other than space and U+0009 to U+000D."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def one_space(text: str) -> Column:
    """Text with each run of blanks replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, " ")
