"""Codes for categories and phrases as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

PHRASE_BREAKS = r"[.,\-\p{Nd}]+"
LINE_BREAKS = r"[\n\r\x0B\x0C\x1C-\x1E\u0085\u2028\u2029]"
BLANKS = "".join(filter(str.isspace, map(chr, range(0x3001))))  # all white space and separators of Unicode


def onehot_to_index(cols: Sequence[str]) -> Column:
    """1-based number of the set flag; 0 when none is set."""
    return reduce(add, [F.col(c).cast("long") * F.lit(i) for i, c in enumerate(cols, 1)])


def exactly_one(cols: Sequence[str]) -> Column:
    """True where exactly one flag of the block is 1 and the rest 0."""
    ones = reduce(add, [F.when(F.col(c) == 1, 1).otherwise(0) for c in cols])
    zeros = reduce(add, [F.when(F.col(c) == 0, 1).otherwise(0) for c in cols])
    return (ones == 1) & (zeros == len(cols) - 1)


def onehot_to_bitmask(cols: Sequence[str]) -> Column:
    """Flags read as binary digits, the first column being the highest."""
    n = len(cols)
    if n > 62:
        raise ValueError("a long holds at most 62 flags")
    return reduce(add, [F.col(c).cast("long") * F.lit(2 ** (n - 1 - i)).cast("long") for i, c in enumerate(cols)])


def row_argmax(cols: Sequence[str]) -> Column:
    """0-based position of the largest cell, the first one on ties."""
    cells = F.array(*[F.col(c).cast("double") for c in cols])
    return (F.array_position(cells, F.array_max(cells)) - 1).cast("int")


def one_hot(c: str, classes: Sequence, prefix: str | None = None) -> dict[str, Column]:
    """0/1 column per class, named ``<prefix>_<class>``."""
    stem = c if prefix is None else prefix
    return {f"{stem}_{k}": F.when(F.col(c) == F.lit(k), 1).otherwise(0) for k in classes}


def split_phrases(c, breaks: str = PHRASE_BREAKS) -> Column:
    """Phrases of a text: cut at line ends, then at ``breaks``; trimmed, empty ones dropped."""
    text = F.col(c) if isinstance(c, str) else c
    parts = F.split(text, f"{LINE_BREAKS}|{breaks}")
    trimmed = F.transform(parts, lambda p: F.btrim(p, F.lit(BLANKS)))
    return F.filter(trimmed, lambda p: p != "")


def phrase_matrix(phrases, vocab: Sequence[str], prefix: str = "has_") -> dict[str, Column]:
    """0/1 column per phrase of a given vocabulary. Made in the row itself, so nothing is shuffled."""
    arr = F.col(phrases) if isinstance(phrases, str) else phrases
    return {f"{prefix}{v}": F.array_contains(arr, v).cast("int") for v in vocab}


def keyword_flags(phrases, keywords: Mapping[str, str]) -> dict[str, Column]:
    """0/1 per group: does any phrase contain the text?"""
    arr = F.col(phrases) if isinstance(phrases, str) else phrases

    def any_with(text: str) -> Column:
        return F.exists(arr, lambda p: F.contains(p, F.lit(text))).cast("int")

    return {name: any_with(text) for name, text in keywords.items()}
