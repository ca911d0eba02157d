"""Audit of filters that act one after the other: what each removes alone, first, again, and on average over all orders.

Every text is read once, for the filters that look at one text and for its SHA-256. Copies are found by a counting Bloom
prepass: tasks count the digests into sketches of two-bit counters, which are merged block by block; a text with a
counter of one is certainly unique and is cleared. Only the digests of possible repeats are shuffled, for the exact
smallest key of each text. The failures of a document are then one mask, and all figures are sums over the counts of
masks, which are additive over any parts of the data.

Digests are dealt into slices of bounded size by their own bits, one sketch for each slice, so that a sketch fits in memory
however many documents there are and the whole work stays in proportion to them.

Cases: null texts count as empty ones, and are copies of each other; a row whose key is null is never later than another and
never makes another a copy; rows that repeat key and text are copies of smaller keys only, not of each other; a null part is
the empty string; a document without labels is neither good nor toxic, and of repeated labels the largest counts; an
empty table has no parts and no rows. Columns other than those named are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.runtime import cut_lineage, in_parallel, new_path

FILTERS = "ABCDE"  # bit i of a mask is the i-th filter
UPPER = bytes(range(65, 91))
SYMBOLS = re.compile(rb"[#$%&*|]")
SLICE_ROWS = 1 << 22  # digests that share one sketch, at most on average
COUNTERS = 8  # for each digest, at least
BLOCK = 1 << 14  # counters of one row of a sketch
HASHES = 3
MERGE_WAYS = 16


def text_failures(text: str) -> int:
    """Mask of the failed filters A to D."""
    data = text.encode()
    words = data.split()  # bytes.split() cuts at space and U+0009 to U+000D
    failed = len(words) < 200
    failed |= (100 * len(set(words)) < 50 * len(words)) << 1
    failed |= (100 * (len(data) - len(data.translate(None, UPPER))) > 3 * len(text)) << 2
    return failed | (SYMBOLS.search(data) is not None) << 3


def _scanned(df: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``_key``, ``part``, ``mask`` of A to D and ``digest`` of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(0)]
            masks = pa.array([text_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], masks, digests], names=["_key", "part", "mask", "digest"])

    named = df.select(F.col(text), F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    return named.mapInArrow(run, f"_key {kind}, part string, mask int, digest binary")


def _places(digests: pa.Array, counters: int) -> np.ndarray:
    """Counters of each digest, HASHES columns, from bits 64 onward; bits before them chose the slice."""
    data = np.frombuffer(b"".join(digests.to_pylist()), ">u4").reshape(-1, 8)
    return data[:, 2 : 2 + HASHES].astype(np.int64) % counters


def sketch_of(digests: DataFrame, counters: int) -> dict[int, bytes]:
    """Counters by block, two bits each, over all tasks: 0, 1, or 2 for two and more.

    A task sends its counters once, only blocks in use; blocks are merged in two steps, so that no group has more rows
    than a share of the tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.uint8)
        for batch in batches:
            for places in _places(batch.column(0), counters).T:
                at, n = np.unique(places, return_counts=True)
                counts[at] = np.minimum(counts[at] + np.minimum(n, 2), 2)
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        way = TaskContext.get().partitionId() % MERGE_WAYS
        for at in np.array_split(used, max(1, len(used) // 64)):
            packed = pa.array([_pack(blocks[b]) for b in at], pa.binary())
            ways = pa.array(np.full(len(at), way))
            yield pa.RecordBatch.from_arrays([ways, pa.array(at), packed], names=["way", "block", "counters"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.uint8)
        for packed in table["counters"]:
            total = np.minimum(total + _unpack(packed.as_py()), 2)
        return pa.table({"way": table["way"][:1], "block": table["block"][:1], "counters": pa.array([_pack(total)], pa.binary())})

    schema = "way long, block long, counters binary"
    parts = digests.select("digest").mapInArrow(count, schema)
    for by in (["way", "block"], ["block"]):
        parts = parts.groupBy(*by).applyInArrow(merge, schema)
    rows = parts.select("block", "counters").toArrow()  # a quarter of a byte for each counter
    return dict(zip(rows["block"].to_pylist(), rows["counters"].to_pylist()))


def _pack(counters: np.ndarray) -> bytes:
    quads = counters.reshape(-1, 4)
    return (quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).astype(np.uint8).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    data = np.frombuffer(packed, np.uint8)
    return np.stack([data >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


def _slice(stored: DataFrame, number: int, counters: int) -> DataFrame:
    """The rows of one slice with ``_maybe``: their digest may occur twice. All that do are among them."""
    rows = stored.where(F.col("_slice") == number).drop("_slice")
    sketch = rows.sparkSession.sparkContext.broadcast(sketch_of(rows, counters))
    at = rows.columns.index("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((counters // BLOCK, BLOCK), np.uint8)
        for block, packed in sketch.value.items():
            counts[block] = _unpack(packed)
        flat = counts.ravel()
        for batch in batches:
            maybe = (flat[_places(batch.column(at), counters)] > 1).all(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=[*batch.schema.names, "_maybe"])

    return rows.mapInArrow(run, rows.withColumn("_maybe", F.lit(True)).schema)


def possible_repeats(digests: DataFrame, rows: int) -> DataFrame:
    """``digests``, about as many as ``rows``, with ``_maybe``: false for those certain to occur once.

    Rows are written in folders by slice, so that each slice's sketch reads its own folder only, and once more when marked.
    """
    spark = digests.sparkSession
    slices = max(1, -(-rows // SLICE_ROWS))
    counters = max(BLOCK, 1 << (COUNTERS * -(-rows // slices) - 1).bit_length())
    number = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(slices))
    dealt, marked = new_path(spark, "audit-slices"), new_path(spark, "audit-marked")
    numbered = digests.withColumn("_slice", number)
    numbered.write.partitionBy("_slice").parquet(dealt)
    stored = spark.read.schema(numbered.schema).parquet(dealt)
    in_parallel(lambda i: _slice(stored, i, counters).write.parquet(f"{marked}/_of={i}"), range(slices))
    return spark.read.schema(digests.withColumn("_maybe", F.lit(True)).schema).parquet(marked)


def failures(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per row of ``df``: ``_key``, ``part`` and the ``mask`` of all failed filters, E (bit 4) included.

    Cleared rows stay where they are. The others are reduced to one row per digest in each task before the shuffle, and
    meet the smallest keys in a join that Spark splits when one digest is much more frequent than others.
    """
    rows = possible_repeats(_scanned(df, key, text, part), df.count())
    cleared = rows.where(~F.col("_maybe") | F.col("_key").isNull())
    repeats = rows.where(F.col("_maybe") & F.col("_key").isNotNull())
    least = cut_lineage(repeats.groupBy("digest").agg(F.min("_key").alias("_least")))
    later = (F.col("_key") > F.col("_least")).cast("int") * (1 << FILTERS.index("E"))
    copies = repeats.join(least, "digest").withColumn("mask", F.col("mask").bitwiseOR(later))
    return cleared.select("_key", "part", "mask").unionByName(copies.select("_key", "part", "mask"))


def mask_counts(failed: DataFrame, labels: DataFrame, label_key: str = "doc_id") -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and ``n``, the number of documents of that kind.

    Rows are counted per key before they meet the labels, so a key of any frequency is one row per task.
    """
    once = labels.groupBy(F.col(label_key).alias("_label")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    counted = failed.groupBy("_key", "part", "mask").agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(once, F.col("_key") == F.col("_label"), "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    return joined.select("part", "mask", *zero, "_n").groupBy("part", "mask", "good", "toxic").agg(F.sum("_n").alias("n"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of masks.

    ``kept``, ``removed``, ``redundant`` (failing, removed earlier), ``unique_fails``, ``good_lost``, ``toxic_lost``, and
    ``shapley``, the filter's removals summed over all orders: the first failed filter of an order removes a document, and
    each of its ``f`` failed filters comes first in an ``f``-th of the orders.
    """
    orders = list(permutations(range(len(filters))))
    steps = [
        F.struct(
            F.lit("".join(filters[i] for i in order)).alias("filter_order"),
            F.lit(step + 1).alias("step"),
            F.lit(sum(1 << i for i in order[:step])).alias("before"),
            F.lit(1 << order[step]).alias("bit"),
        )
        for order in orders
        for step in range(len(order))
    ]
    counts = cut_lineage(counts)  # few rows: masks of each part
    rows = counts.select("*", F.inline(F.array(*steps)))
    n, mask, bit = F.col("n"), F.col("mask"), F.col("bit")
    early, fails = mask.bitwiseAND(F.col("before")) != 0, mask.bitwiseAND(bit) != 0

    def total(where, what=n):
        return F.sum(F.when(where, what).otherwise(F.lit(0))).cast("long")

    share = F.floor(F.lit(len(orders)) / F.greatest(F.bit_count(mask), F.lit(1))) * n
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~early & ~fails).alias("kept"),
        total(~early & fails).alias("removed"),
        total(early & fails).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(~early & fails & (F.col("good") == 1)).alias("good_lost"),
        total(~early & fails & (F.col("toxic") == 1)).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The interactions of filters A to E over all documents, for each value of ``part``."""
    return interactions(mask_counts(failures(df, key, text, part), labels, key))
