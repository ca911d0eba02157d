"""Connected components by contraction: every node moves to the neighbour with the smallest hash of the round.

Each round at least the moved nodes vanish and edges inside a contracted node are dropped, so the number of rounds grows
with the logarithm of the longest path. Once the remaining edges fit into one task, a bounded number, that task finishes
them by union-find. A node with a third of all edges is reduced to one row per task before the
shuffle, and relabelling joins written tables, which Spark splits when one node is much more frequent than others.

Cases: edges that repeat or lead from a node to itself change nothing; edges with a null end must be left out before; a table
without edges between different nodes gives None. Only the two columns of the edges are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.runtime import cut_lineage

MAX_ROUNDS = 64
LOCAL_EDGES = 500_000  # so many edges are finished by one task


def connected(edges: DataFrame) -> DataFrame | None:
    """``node`` and ``root`` for every node of ``edges`` (columns ``a`` and ``b``, any order, repeats allowed).

    Nodes have the same root exactly if a path joins them. Null for no edges.
    """
    edges = _tidy(edges)
    moves: list[DataFrame] = []
    while (left := edges.count()) > LOCAL_EDGES:
        if len(moves) == MAX_ROUNDS:
            raise RuntimeError("components did not settle")
        moves.append(_moves(edges, len(moves)))
        edges = _relabelled(edges, moves[-1])
    if left:
        moves.append(cut_lineage(edges.coalesce(1).mapInArrow(_union_find, "node long, to long")))
    if not moves:
        return None
    found = moves.pop().select("node", F.col("to").alias("root"))
    for move in reversed(moves):
        later = found.select(F.col("node").alias("_n"), "root")
        joined = move.join(later, F.col("to") == F.col("_n"), "left")
        found = joined.select("node", F.coalesce("root", "to").alias("root"))
    return found


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest node of its component for each node of LOCAL_EDGES edges at most."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(find, nodes), pa.int64())], ["node", "to"])


def _tidy(edges: DataFrame) -> DataFrame:
    ends = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return cut_lineage(ends.distinct())


def _moves(edges: DataFrame, round_: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = lambda c: F.struct(F.xxhash64(F.lit(round_), c), F.col(c))
    nearest = both.groupBy("a").agg(F.min(rank("b")).alias("_least"))
    to = F.when(F.col("_least") < rank("a"), F.col("_least").getField("b")).otherwise(F.col("a"))
    return cut_lineage(nearest.select(F.col("a").alias("node"), to.alias("to")))


def _relabelled(edges: DataFrame, moves: DataFrame) -> DataFrame:
    first = moves.select(F.col("node").alias("_n"), F.col("to").alias("_a"))
    second = moves.select(F.col("node").alias("_m"), F.col("to").alias("_b"))
    moved = edges.join(first, F.col("a") == F.col("_n")).select("_a", "b")
    moved = moved.join(second, F.col("b") == F.col("_m")).select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    return _tidy(moved)
