"""Exact top-k by inner product through a bit-sliced index.

Components become integers floor(scale * x). A block of rows holds one bitmap for each bit of each dimension. For a
query, the slices are added with bitmap arithmetic: carry-save adders take three bitmaps of one weight and give a sum of
that weight and a carry of the next, until each weight has one bitmap left. The rows of the k highest sums are chosen
from the most significant slice downward; rows that tie at the boundary are resolved exactly, the smaller key first.

Cases: vectors that are null or hold null or non-finite components take no part; vectors of different length are not
compared; a query meets every row with another key; an empty vector scores 0; keys that repeat with one vector are one
query; null keys take no part; an empty table gives an empty result. Columns other than key and vector are not passed on. Sums are
64-bit: dimensions times the square of the largest scaled component must stay below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384  # rows of a bit-sliced block
QUERY_ROWS = 1_024  # queries that meet a block together


def quantised(vector: str, scale: float) -> Column:
    """Integer components, null for a vector that takes no part."""
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    bad = F.exists(F.col(vector), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)), x)


class SlicedBlock:
    """Bitmaps of up to BLOCK_ROWS integer vectors, rows in the order of their keys."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.vectors = keys[order], vectors[order]
        n, dims = self.vectors.shape
        self.words = -(-n // 64)
        low = self.vectors.min(0) if n and dims else np.zeros(dims, np.int64)
        self.low = low
        above = (self.vectors - low).astype(np.uint64)  # not negative, so slices have no sign
        self.bits = int(above.max()).bit_length() if above.size else 0
        self.slices = np.zeros((2, dims, self.bits, self.words), np.uint64)  # as they are, and complemented
        for b in range(self.bits):
            plane = ((above >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T
            self.slices[0, :, b] = self._pack(plane)
            self.slices[1, :, b] = self._pack(1 - plane)

    def _pack(self, plane: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(plane), self.words * 64), np.uint8)
        padded[:, : plane.shape[1]] = plane
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the sums over all dimensions, least significant first, up to a constant of the query.

        A negative weight takes the complemented slices of its dimension, so all addends are positive.
        """
        weights = np.abs(query)
        flat = self.slices.reshape(-1, self.words)
        dims = len(query)
        base = ((query < 0) * dims + np.arange(dims)) * self.bits
        levels: list[list[np.ndarray]] = []
        for w in range(int(weights.max()).bit_length() if dims else 0):
            rows = base[(weights >> w) & 1 == 1]
            for b in range(self.bits):
                while len(levels) <= w + b:
                    levels.append([])
                if len(rows):
                    levels[w + b].append(rows + b)
        out, carried = [], []
        at = 0
        while at < len(levels) or carried:
            own = [flat[np.concatenate(levels[at])]] if at < len(levels) and levels[at] else []
            stack = np.concatenate(own + carried) if own or carried else np.zeros((1, self.words), np.uint64)
            carried = []
            while len(stack) > 1:
                third = max(1, len(stack) // 3)
                a, b = stack[:third], stack[third : 2 * third]
                if len(stack) == 2:
                    carried.append(a & b)
                    stack = a ^ b
                    break
                c, rest = stack[2 * third : 3 * third], stack[3 * third :]
                half = a ^ b
                carried.append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, rest])
            out.append(stack[0])
            at += 1
        return out

    def best(self, key: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the k best rows with another key."""
        n = len(self.keys)
        allowed = np.zeros(self.words * 64, np.uint8)
        allowed[:n] = self.keys != key
        tied = np.packbits(allowed, bitorder="little").view(np.uint64)
        sure = np.zeros_like(tied)
        have = 0
        for plane in reversed(self.score_slices(query)):
            upper = tied & plane
            count = int(np.bitwise_count(upper).sum())
            if have + count > k:
                tied = upper
            else:
                sure, have = sure | upper, have + count
                tied &= ~plane
            if have == k:
                break
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if have < k:  # rows in the order of their keys, so the first ties are those of the smallest keys
            ties = np.flatnonzero(np.unpackbits(tied.view(np.uint8), bitorder="little"))
            rows = np.concatenate([rows, ties[: k - have]])
        return self.keys[rows], self.vectors[rows] @ query


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def top_k(df: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0):
    """``query_id``, ``rank`` from 1, the candidate's key and ``score``: the k best rows for each row that ``queries`` picks.

    Rows are dealt to blocks and queries to groups by hash; each pair of a block and a group is one task's work and
    returns k rows a query. Best rows are cut to k in each task before they are merged.
    """
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("_key"), quantised(vector, scale).alias("_vector"), queries.alias("_asks")
    )
    rows = rows.where("_vector IS NOT NULL").withColumn("_dims", F.size("_vector"))
    asked = rows.where("_asks").select("_dims", "_key", "_vector").distinct()
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    groups = max(1, -(-asked.count() // QUERY_ROWS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = ["_dims", "_block", "_group"]
    left = rows.select("_dims", dealt(blocks).alias("_block"), every(groups).alias("_group"), "_key", "_vector")
    right = asked.select("_dims", every(blocks).alias("_block"), dealt(groups).alias("_group"), "_key", "_vector")

    def search(index: pa.Table, ask: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(index) and len(ask):
            dims = index.column("_dims")[0].as_py()
            vectors = _matrix(index.column("_vector").combine_chunks(), dims) if dims else np.zeros((len(index), 0), np.int64)
            weights = _matrix(ask.column("_vector").combine_chunks(), dims) if dims else np.zeros((len(ask), 0), np.int64)
            block = SlicedBlock(index.column("_key").to_numpy(), vectors)
            for query, weight in zip(ask.column("_key").to_pylist(), weights):
                ids, scores = block.best(query, weight, k)
                found.append((np.full(len(ids), query), ids, scores))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(p, pa.int64()) for p in parts], names=["query_id", key, "score"])

    pairs = left.groupBy(*place).cogroup(right.groupBy(*place))
    partial = pairs.applyInArrow(search, f"query_id long, `{key}` long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")
