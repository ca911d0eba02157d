"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint of 64 bits is cut into segments of two bits (or one); the counts of set bits in its segments are a point in
a grid. The Manhattan distance of two points is a lower bound of the number of differing bits. Points within distance d
agree exactly on at least k of any k + d groups of segments, so for each choice of k groups a unit grid over these
coordinates puts every such pair into one cell. Cells are joined by equality, pairs are kept if the Manhattan distance
allows them and the differing bits confirm them.

Counts are written in unary, two bits a segment, so that the Manhattan distance is a count of differing bits too.
Segments of one bit make the bound exact and the cells finer, which pays for wide distances.

No group is ever paired with itself in full: equal fingerprints count once; neighbours in the order of each cell are
linked first and contracted; the join then returns pairs between different contracted groups only.

Cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer words than a
shingle are one shingle; repeated keys are rows of their own; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.components import connected
from tabforge.runtime import cut_lineage

HASH_SEED = 42
PIECE_BYTES = 1 << 20  # longer texts are hashed piece by piece
LOW_BITS = 0x5555555555555555
#: Set bits of a byte, spread over the eight bytes of a number, so that 255 of them add up without a carry.
SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def word_pieces(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Words in pieces of bounded size; each piece begins with the last ``overlap`` words of the one before."""
    at, tail = 0, []
    while at < len(data) or not at:
        cut = data.find(b" ", at + PIECE_BYTES) if len(data) - at > PIECE_BYTES else -1
        end = len(data) if cut < 0 else cut
        words = tail + data[at:end].split()  # bytes.split() cuts at space and U+0009 to U+000D
        yield words
        tail = words[len(words) - min(overlap, len(words)) :] if overlap else []
        at = end + 1


def shingle_digests(words: list[bytes], shingle: int) -> bytes:
    """Hashes of all runs of ``shingle`` words, one after the other, eight bytes each."""
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *[e + 1 for e in ends[: len(ends) - shingle]]]
    pieces = map(joined.__getitem__, map(slice, starts, ends[shingle - 1 :]))
    return b"".join(map(xxhash.xxh64_digest, pieces, repeat(HASH_SEED)))


def _bit_counts(words: list[bytes], shingle: int) -> tuple[int, np.ndarray]:
    hashes = shingle_digests(words, shingle)
    spread = SPREAD[np.frombuffer(hashes, np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)
    return len(spread), sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; bit set if set in over half of the hashes."""
    data = (text or "").encode().lower()  # A-Z only
    total, counts, words = 0, np.zeros(64, np.int64), []
    for words in word_pieces(data, shingle - 1):
        if len(words) >= shingle:
            n, found = _bit_counts(words, shingle)
            total, counts = total + n, counts + found
    if not total:
        if not words:
            return 0
        total, counts = _bit_counts(words, len(words))
    bits = np.packbits((2 * counts > total).astype(np.uint8), bitorder="little")
    return int.from_bytes(bits.tobytes(), "big")  # digests are big-endian


def with_fingerprints(df: DataFrame, text: str, shingle: int, out: str = "fingerprint") -> DataFrame:
    """Columns of ``df`` but the text, and the fingerprint as a signed long."""
    keep = [f for f in df.schema.fields if f.name not in (text, out)]
    schema = T.StructType([*keep, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(0)]
            prints = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], prints], names=schema.names)

    return df.select(f"`{text}`", *[f"`{f.name}`" for f in keep]).mapInArrow(run, schema)


def unary_counts(fp: Column, width: int) -> Column:
    """Set bits of each segment, in unary: 00, 01 or 11 for two bits, the bit itself for one."""
    if width == 1:
        return fp
    low = fp.bitwiseAND(F.lit(LOW_BITS))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def grid_masks(matched: int, distance: int, width: int) -> list[int]:
    """One mask for each choice of ``matched`` out of ``matched + distance`` groups of segments, as signed numbers."""
    groups, segments = matched + distance, 64 // width
    edges = [round(i * segments / groups) * width for i in range(groups + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(masks, matched))]


def matched_groups(prints: int, distance: int, width: int) -> int:
    """How many groups must agree, so that copies of rows and chance meetings together cost least.

    A segment agrees by chance in 1 of 2 cases (one bit) or 3 of 8 (counts of two bits); a row written to a cell costs as
    much as some hundred comparisons. Answers do not depend on the choice.
    """
    by_chance = {1: 1 / 2, 2: 3 / 8}[width]

    def cost(matched: int) -> float:
        grids = math.comb(matched + distance, matched)
        return grids * (100 + prints * by_chance ** (64 // width * matched / (matched + distance)))

    return min(range(2, 64 // width - distance + 1), key=cost)


def _cells(prints: DataFrame, masks: list[int], width: int) -> DataFrame:
    exploded = prints.select("*", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("_grid", "_mask"))
    return exploded.withColumn("_cell", unary_counts(F.col("fp"), width).bitwiseAND(F.col("_mask"))).drop("_mask")


def _neighbour_links(cells: DataFrame, distance: int) -> DataFrame:
    """Links between fingerprints next to each other in a cell. The order is dealt out by ranges, so any cell may be cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            if last is not None:
                cols = [np.concatenate([[x], c]) for x, c in zip(last, cols)]
            if not len(cols[0]):
                continue
            last = [c[-1] for c in cols]
            grid, cell, fp = cols
            near = np.bitwise_count((fp[1:] ^ fp[:-1]).view(np.uint64)) <= distance
            near &= (grid[1:] == grid[:-1]) & (cell[1:] == cell[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(fp[:-1][near]), pa.array(fp[1:][near])], names=["a", "b"])

    order = ["_grid", "_cell", "fp"]
    dealt = cells.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "a long, b long")


def _range_join(cells: DataFrame, distance: int, width: int) -> DataFrame:
    """Links between different contracted groups: equal cells, then the lower bound, then the differing bits."""
    left = cells.select("_grid", "_cell", F.col("fp").alias("a"), F.col("root").alias("ra"))
    right = cells.select("_grid", "_cell", F.col("fp").alias("b"), F.col("root").alias("rb"))
    bound = F.bit_count(unary_counts(F.col("a"), width).bitwiseXOR(unary_counts(F.col("b"), width))) <= distance
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    on = (left["_grid"] == right["_grid"]) & (left["_cell"] == right["_cell"])
    pairs = left.join(right, on & (F.col("ra") < F.col("rb")) & bound & exact)
    return pairs.select(F.col("ra").alias("a"), F.col("rb").alias("b"))


def classes(prints: DataFrame, distance: int, width: int = 2) -> DataFrame:
    """``fp`` and ``root`` for every distinct fingerprint ``fp``: equal roots for those joined by links."""
    prints = cut_lineage(prints.select("fp").distinct())
    masks = grid_masks(matched_groups(prints.count(), distance, width), distance, width)
    rooted = prints.withColumn("root", F.col("fp"))
    rooted = _with_roots(rooted, _neighbour_links(_cells(rooted, masks, width), distance))
    return _with_roots(rooted, _range_join(_cells(rooted, masks, width), distance, width))


def _with_roots(rooted: DataFrame, links: DataFrame) -> DataFrame:
    found = connected(links)
    if found is None:
        return rooted
    joined = rooted.join(found.withColumnRenamed("root", "_root"), F.col("root") == F.col("node"), "left")
    return cut_lineage(joined.select("fp", F.coalesce("_root", "root").alias("root")))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, distance: int = 4, width: int = 2
) -> DataFrame:
    """Each row's columns but the text, its ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Two rows are linked if their fingerprints differ in ``distance`` bits at most; ``component_id`` is the smallest key
    that links lead to, the row's own included (null only if all of these are null).
    """
    rows = cut_lineage(with_fingerprints(df.drop("fingerprint", "component_id"), text, shingle, "_fp"))
    firsts = cut_lineage(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min(key).alias("_first")))
    rooted = classes(firsts, distance, width).join(firsts, "fp")
    least = cut_lineage(rooted.groupBy("root").agg(F.min("_first").alias("component_id")))
    members = rooted.select("fp", F.col("root").alias("_root")).join(least, F.col("_root") == F.col("root"))
    members = cut_lineage(members.select("fp", "component_id"))
    named = rows.join(members, F.col("_fp") == F.col("fp"))
    columns = [f"`{c}`" for c in rows.columns if c != "_fp"]
    return named.select(*columns, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay: of each component the row with the smallest key.

    Rows are told by their keys: those that repeat a key stay or go together, and those without a key stay.
    """
    found = near_duplicates(df.select(key, text), key, text, **options)
    gone = found.where(F.col("component_id") < F.col(key)).select(F.col(key).alias("_gone")).distinct()
    return df.join(gone, F.col(key) == F.col("_gone"), "left_anti")
