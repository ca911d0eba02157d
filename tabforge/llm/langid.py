"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased letter by letter, everything else becomes one space, and runs of 1 to 3 characters are hashed to
buckets. Fitting counts n-grams per language in all training rows; each task adds up its rows before the shuffle. The
matrix of log probabilities has languages x buckets numbers, a size that is checked before it is broadcast.

Cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned; rows
without a language are not learned from; long texts are counted piece by piece; equal scores go to the language first in
code-point order; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.runtime import bounded_rows

BUCKET_BITS = 14
ORDERS = (1, 2, 3)
PIECE = 1 << 20  # characters hashed together
BLOCK_GRAMS = 1 << 18  # n-grams scored together
MAX_LANGUAGES = 500  # times the buckets: 64 MB of probabilities
UNKNOWN = "und"
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@cache
def folding() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_pieces(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams that hold a letter, piece by piece; pieces overlap, so that no n-gram is lost or made up."""
    tail = np.array([32], np.uint64)  # the last letters and spaces before the piece; a space before the text
    for at in range(0, len(text), PIECE):
        codes = folding()[np.frombuffer(text[at : at + PIECE].encode("utf-32-le"), np.uint32)].astype(np.uint64)
        codes = np.concatenate([tail, codes, [np.uint64(32)] if at + PIECE >= len(text) else []]).astype(np.uint64)
        blank = codes == 32
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
        found, mixed = [], np.zeros(len(codes), np.uint64)
        for n in ORDERS:
            new = max(0, len(tail) - n + 1)  # the first n-gram that ends in this piece
            mixed = (mixed[: max(0, len(codes) - n + 1)] + codes[n - 1 :]) * FACTORS[n % 3]
            mixed = mixed ^ (mixed >> np.uint64(29))
            grams = mixed[new:] if n > 1 else mixed[new:][codes[new:] != 32]
            found.append((grams * FACTORS[0]) >> np.uint64(64 - BUCKET_BITS))
        yield np.concatenate(found).astype(np.int64)
        tail = codes[-(max(ORDERS) - 1) :]


def gram_buckets(text: str) -> np.ndarray:
    """Buckets of all n-grams of a text that hold a letter. Empty if it has none."""
    return np.concatenate([np.empty(0, np.int64), *gram_pieces(text)])


def gram_blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and buckets of many n-grams at a time, of short texts together and of long ones piece by piece."""
    held, size = [], 0
    for i, value in enumerate(texts):
        for buckets in gram_pieces(value.as_py() or ""):
            held.append((np.full(len(buckets), i), buckets))
            size += len(buckets)
            if size >= BLOCK_GRAMS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``bucket``, ``n`` over all rows with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch.column(0), batch.column(1).to_pylist()):
                total = sums.setdefault(language, np.zeros(1 << BUCKET_BITS, np.int64))
                for buckets in gram_pieces(value.as_py() or ""):
                    total += np.bincount(buckets, minlength=len(total))
        for language, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"]
            )

    rows = df.where(F.col(lang).isNotNull()).select(f"`{text}`", F.col(lang).cast("string"))
    parts = rows.mapInArrow(count, "lang string, bucket long, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in code-point order, and log probabilities as a matrix buckets x languages (add-one smoothing)."""
    rows = df.where(F.col(lang).isNotNull())
    found = bounded_rows(rows.select(F.col(lang).cast("string").alias("lang")).distinct(), MAX_LANGUAGES, "languages")
    languages = sorted((r["lang"] for r in found), key=str.encode)
    counts = np.ones((1 << BUCKET_BITS, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    for r in gram_counts(rows, text, lang).toArrow().to_batches():  # languages x buckets rows at most
        at = [place[x] for x in r.column(0).to_pylist()]
        counts[r.column(1).to_numpy(), at] += r.column(2).to_numpy()
    return languages, np.log(counts) - np.log(counts.sum(0))


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """``df`` without the text, with ``lang_pred`` and ``score``, the posterior at equal priors per n-gram."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in df.schema.fields if f.name not in (text, "lang_pred", "score")]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs = shared.value
        columns = np.ascontiguousarray(logs.T)
        for batch in batches:
            n = batch.num_rows
            total, grams = np.zeros((n, len(languages))), np.zeros(n, np.int64)
            for at, buckets in gram_blocks(batch.column(0)):
                grams += np.bincount(at, minlength=n)
                for j, column in enumerate(columns):  # a sparse row of counts for each text, times the matrix
                    total[:, j] += np.bincount(at, column[buckets], n)
            known = (grams > 0) & (len(languages) > 0)
            best = total.argmax(axis=1) if len(languages) else np.zeros(n, np.int64)
            names = [languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            top = total[np.arange(n), best][:, None] if len(languages) else total
            scores = np.where(known, 1 / np.maximum(np.exp(total - top).sum(axis=1), 1e-300), 0.0)
            arrays = [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.select(f"`{text}`", *[f"`{f.name}`" for f in keep]).mapInArrow(score, schema)


def held_out(key: str) -> Column:
    """True for a quarter of the keys, by crc32 of the key as text."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
