"""Importance resampling towards a target: documents are drawn by how much likelier their n-grams are in the target.

An untrained regex split of the tokenizers library over ASCII-lowered text gives words with their places. Windows of one
to three words, joined by one space, fall into buckets by the CRC-32 of their bytes. A bucket's gain is the logarithm of
its share in the target over its share in the documents, a document's weight the sum of gains over its windows, and
Gumbel noise from a hash of its key makes the highest scores a draw without replacement.

Two scans of the texts: histograms first, one sparse row per bucket and task, then weights. Only the gains, one number a
bucket, reach the driver and the tasks. Ranks come from a range sort of narrow rows and the row counts of its parts.

Cases: a null or empty text has no windows and weight 0; it is never drawn, as any text below the least number of words;
ties of score go to the smaller key, null last; a null key draws as the empty string; rows that repeat a key are rows of
their own; an empty target or table is a histogram of zeros. Very long texts are split piece by piece between words.
Other columns pass through; those named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from tabforge.runtime import bounded_rows, broadcast_if_small, cut_lineage

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what the split removes: all of ASCII but digits and a-z
BUCKETS = 10_000
LONGEST = 3  # words in a window
PIECE_CHARS = 1 << 18
KNOWN_STRETCHES = 1 << 20  # remembered by a task
SHORT = 64  # bytes; windows that end in a longer word are hashed one by one
RESULT = ("n_features", "weight", "score", "rank")


def _append_zero_bytes() -> np.ndarray:
    """Tables that turn a CRC into that of the text with ``n`` zero bytes after it, less the CRC of ``n`` zero bytes alone."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    step ^= step[0]
    tables = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for byte in range(4):
        tables[0, byte] = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
    for n in range(1, SHORT + 1):
        tables[n] = (tables[n - 1] >> np.uint32(8)) ^ step[tables[n - 1] & np.uint32(255)]
    return tables


class Windows:
    """Buckets of all windows of a text.

    Texts are cut at spaces; each new stretch is split into words once, those of a piece in one call, and the words'
    offsets tell which stretch they came from. A word is hashed once; windows combine the hashes of their words.
    """

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST):
        self.buckets, self.longest = buckets, longest
        self.split = Split(Regex(NOT_WORD), "removed")
        self.between = re.compile(NOT_WORD)
        self.tables = _append_zero_bytes().ravel()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # numbers of stretches
        self.spans = np.zeros((2, 1024), np.int64)  # a stretch's first word and number of words
        self.words: list[bytes] = []
        self.hashes = np.zeros((2, 1024), np.uint32)  # of the word, and of a space and the word
        self.sizes = np.zeros(1024, np.int64)  # of the latter

    def _learn(self, stretches: list[str]) -> None:
        ends = np.cumsum([len(s) + 1 for s in stretches])
        found = self.split.pre_tokenize_str(" ".join(stretches))
        owners = np.searchsorted(ends, [start for _, (start, _) in found], side="right")
        counts = np.bincount(owners.astype(np.int64), minlength=len(stretches))
        spans = np.stack([len(self.words) + np.cumsum(counts) - counts, counts])
        words = [w.encode() for w, _ in found]
        hashes = np.array([[zlib.crc32(w) for w in words], [zlib.crc32(b" " + w) for w in words]], np.uint32)
        self.spans = _with(self.spans, len(self.known), spans)
        self.hashes = _with(self.hashes, len(self.words), hashes)
        self.sizes = _with(self.sizes, len(self.words), np.array([len(w) + 1 for w in words], np.int64))
        self.words += words
        self.known.update(zip(stretches, range(len(self.known), len(self.known) + len(stretches))))

    def pieces(self, text: str) -> Iterator[tuple[str, int]]:
        """The text cut between words into pieces of about PIECE_CHARS characters; each but the first begins with the
        last words of the one before, whose number goes with it."""
        at, tail = 0, []
        while at < len(text) or not at:
            cut = self.between.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
            end = cut.end() if cut else len(text)
            piece = " ".join([*tail, text[at:end]])
            yield piece, len(tail)
            tail = [w for w in self.between.split(piece) if w][1 - self.longest :] if cut and self.longest > 1 else []
            at = max(end, 1)

    def _numbers(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words, and how many each stretch has."""
        try:
            at = np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))
        except KeyError:
            self._learn([s for s in dict.fromkeys(stretches) if s not in self.known])
            at = np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))
        first, count = self.spans[:, at]
        ends = np.cumsum(count)
        return np.repeat(first - (ends - count), count) + np.arange(ends[-1]), count

    def _after(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """CRC of what ``before`` stands for, a space and the word."""
        sizes = self.sizes[ids]
        at, out = np.minimum(sizes, SHORT) << 10, self.hashes[1, ids]
        for byte in range(4):
            out ^= self.tables.take(at + (256 * byte + ((before >> np.uint32(8 * byte)) & np.uint32(255))))
        for i in np.flatnonzero(sizes > SHORT):
            out[i] = zlib.crc32(b" " + self.words[ids[i]], int(before[i]))
        return out

    def of(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some pieces at a time: the text that each word is from, and text and bucket of each window."""
        held, size = [], 0
        for i, text in enumerate(texts):
            for piece, again in self.pieces((text or "").encode().lower().decode()):
                held.append((i, piece.split(" "), again))
                size += len(piece)
                if size >= PIECE_CHARS:
                    yield self._windows(held)
                    held, size = [], 0
        if held:
            yield self._windows(held)

    def _windows(self, held: list[tuple[int, list[str], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.known) > KNOWN_STRETCHES:
            self._forget()
        owners, stretches, again = zip(*held)
        ids, count = self._numbers(list(chain.from_iterable(stretches)))
        piece = np.repeat(np.repeat(np.arange(len(held)), list(map(len, stretches))), count)
        words = np.bincount(piece, minlength=len(held))
        place = np.arange(len(ids)) - np.repeat(np.cumsum(words) - words, words)
        owner, new = np.array(owners)[piece], place >= np.array(again)[piece]
        run, texts, buckets = self.hashes[0, ids], [], []
        for n in range(1, self.longest + 1):
            if n > 1:
                run = self._after(run[:-1], ids[n - 1 :])
            whole = (new & (place >= n - 1))[n - 1 :]
            texts.append(owner[n - 1 :][whole])
            buckets.append(run[whole] % np.uint32(self.buckets))
        return owner[new], np.concatenate(texts), np.concatenate(buckets)


def _with(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` after its first ``used`` entries; its room at least doubles when it is full."""
    need = used + more.shape[-1]
    if need > array.shape[-1]:
        room = np.zeros((*array.shape[:-1], max(need, 2 * array.shape[-1])), array.dtype)
        room[..., :used] = array[..., :used]
        array = room
    array[..., used:need] = more
    return array


def histogram(df: DataFrame, text: str, buckets: int, longest: int) -> np.ndarray:
    """Windows in each bucket, over all rows; tasks add up their rows, so at most one row per bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, counts = Windows(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found in windows.of(batch.column(0).to_pylist()):
                counts += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    parts = df.select(f"`{text}`").mapInArrow(run, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in bounded_rows(parts.groupBy("bucket").agg(F.sum("n").alias("n")), buckets, "buckets"):
        total[row.bucket] = row.n
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, with one added to every count."""
    buckets, every, wanted = len(documents), int(documents.sum()), int(target.sum())
    ratios = [
        (int(t) + 1) * (every + buckets) / ((int(s) + 1) * (wanted + buckets)) for s, t in zip(documents, target)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _weighed(df: DataFrame, text: str, gain: np.ndarray, longest: int) -> DataFrame:
    """The columns of ``df`` but the text, with ``_words``, ``n_features`` and ``weight``."""
    keep = [f for f in df.schema.fields if f.name != text]
    added = [T.StructField(n, T.LongType()) for n in ("_words", "n_features", "weight")]
    schema = T.StructType([*keep, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(len(gain), longest)
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((3, n), np.int64)
            for words, texts, found in windows.of(batch.column(0).to_pylist()):
                for i, (at, weight) in enumerate([(words, None), (texts, None), (texts, gain[found])]):
                    sums[i] += np.bincount(at, weight, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, sums)], names=schema.names)

    return df.select(f"`{text}`", *[f"`{f.name}`" for f in keep]).mapInArrow(run, schema)


def gumbel(key: str, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform)))


def _ranked(rows: DataFrame, key: str, drawn: int) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the order of score, highest first, for the first ``drawn``; null for all others.

    Rows are sorted by ranges of about equal size, whatever scores repeat, and written once, so that the counts of the
    parts and the places in them belong to the same ranges.
    """
    order = [F.col("score").desc(), F.col(key).asc_nulls_last()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted((r["_part"], r["_n"]) for r in placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect())
    starts, seen = [], 0
    for at, n in sizes:  # one row per part of the sort
        starts.append((at, seen))
        seen += n
    table = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    rank = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.withColumn("_part", part).join(broadcast_if_small(table), "_part")
    return joined.withColumn("rank", F.when(rank <= drawn, rank)).drop("_at", "_part", "_start")


def resample(
    df: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
) -> DataFrame:
    """Each row of ``df`` without its text: ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn).

    ``target`` has a column of the same name ``text``. Of the N rows with ``least_words`` words or more,
    floor(percent * N / 100) are drawn.
    """
    gain = gains(histogram(df, text, buckets, longest), histogram(target, text, buckets, longest))
    weighed = _weighed(df.drop(*[c for c in RESULT if c not in (key, text)]), text, gain, longest)
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + gumbel(key, seed)))
    enough = scored.where(F.col("_words") >= least_words)
    ranked = _ranked(enough, key, percent * enough.count() // 100)
    rest = scored.where(F.col("_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("_words")


def drawn_documents(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents drawn, with their texts and their ``rank``. Rows are told by their keys, which must be unique."""
    ranks = resample(df.select(key, text), target, key, text, **options).where("rank IS NOT NULL")
    return df.drop("rank").join(ranks.select(F.col(key).alias("_key"), "rank"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
