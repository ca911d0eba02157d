"""Decision trees grown level by level from histograms, for classes, numbers and gradients alike.

Columns are cut into at most 255 bins once. For each level every task adds up its rows into histograms of the open nodes;
these are summed and judged per (tree, node), in groups or, if they are few, on the driver; one split for each of them
grows the tree. Rows are kept in blocks, their bins column by column. Nodes that fit a task's memory leave the levels: their
rows are gathered by node and finished there, level by level, to any depth. With a limit on leaves, nodes open best first.

All statistics are whole numbers (numbers and gradients in fixed point) and all draws are hashes of the row, so a tree does
not depend on how the rows lie, nor on the cores. Ties go to the first column, then to the lowest cut.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.ranking import exact_quantiles

MAX_BINS = 255  # bin numbers are bytes
SMALL_NODE = 1 << 20  # rows; such nodes are finished in one group each
HISTOGRAM_BYTES = 1 << 27  # of one task in one pass
DRIVER_BYTES = 1 << 25  # histograms of all tasks that are summed on the driver
FINISH_BYTES = 1 << 25  # histograms at a time where a node is finished
PACKED = 1 << 26  # two sums below this fit one float
ROWS_A_PART = 500_000
TREES_AT_ONCE = 16
MASK = (1 << 64) - 1


# ---------------------------------------------------------------- draws


def mix(*parts: int) -> int:
    """A 64-bit hash of whole numbers (the finaliser of splitmix64 after each)."""
    h = 0
    for part in parts:
        h = (h + (part & MASK) + 0x9E3779B97F4A7C15) & MASK
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & MASK
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
        h ^= h >> 31
    return h


def mix_rows(seed: int, rows: np.ndarray) -> np.ndarray:
    """``mix`` with the last part taken from each row; numbers in [0, 1)."""
    h = rows.view(np.uint64) + np.uint64((seed + 0x9E3779B97F4A7C15) & MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def uniform(*parts: int) -> float:
    return (mix(*parts) >> 11) / float(1 << 53)


POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def bootstrap_weights(seed: int, rows: np.ndarray) -> np.ndarray:
    """How often each row is in the sample: Poisson with mean 1."""
    return np.searchsorted(POISSON, mix_rows(seed, rows), side="right").astype(np.int64)


# ---------------------------------------------------------------- bins


@dataclass(frozen=True)
class Bins:
    """Upper ends of each column's bins. ``exact``: every bin is one value."""

    uppers: list[list[float]]
    exact: list[bool]

    @property
    def widest(self) -> int:
        return max(map(len, self.uppers))

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bin numbers, a row for each row (laid out by column). Values above the last end fall in the last bin."""
        out = np.empty((len(columns), len(columns[0])), np.uint8)
        for j, (x, ends) in enumerate(zip(columns, self.uppers)):
            out[j] = np.minimum(np.searchsorted(ends, x), len(ends) - 1)
        return out.T

    def threshold(self, column: int, cut: int, after: int) -> float:
        """The value that parts bin ``cut`` from ``after``, the next one with rows in the node."""
        ends = self.uppers[column]
        return (ends[cut] + ends[after]) / 2 if self.exact[column] else ends[cut]


def find_bins(df: DataFrame, cols: Sequence[str], bins: int = MAX_BINS) -> Bins:
    """Bins of number columns without gaps: every value if there are at most ``bins``, else exact quantiles.

    Tasks stop noting a column's values beyond ``bins``, so little is shuffled.
    """
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"bins must be 2 to {MAX_BINS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set] = [set() for _ in cols]
        for batch in batches:
            for values, column in zip(seen, batch.columns):
                if len(values) <= bins:
                    values.update(np.unique(column.to_numpy(zero_copy_only=False))[: bins + 1].tolist())
        at = [j for j, values in enumerate(seen) for _ in values]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([v for s in seen for v in s], pa.float64())], names=["at", "value"])

    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist()
    try:
        values = numbers.mapInArrow(run, "at int, value double").groupBy("at").agg(F.collect_set("value").alias("values"))
        found = {r["at"]: sorted(r["values"]) for r in values.withColumn("values", F.slice("values", 1, bins + 1)).collect()}
        many = [c for j, c in enumerate(cols) if len(found.get(j, ())) > bins]
        cuts = exact_quantiles(numbers, many, [i / bins for i in range(1, bins + 1)]) if many else {}
    finally:
        numbers.unpersist()
    uppers = [sorted(set(cuts[c])) if c in cuts else found.get(j, [0.0]) for j, c in enumerate(cols)]
    return Bins(uppers, [c not in cuts for c in cols])


#: Columns of a block, by name: the bins of all columns (a row for each), and what was kept beside them.
Block = dict[str, np.ndarray]


def with_bins(df: DataFrame, cols: Sequence[str], bins: Bins, keep: Sequence[str]) -> DataFrame:
    """Blocks of rows: a row holds ``_bins``, one byte a value, column after column, and the whole numbers of ``keep``, as bytes."""
    schema = T.StructType([T.StructField(n, T.BinaryType()) for n in ("_bins", *keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                kept = [x.astype(np.int64).tobytes() for x in numbers[len(cols) :]]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (bins.codes(numbers[: len(cols)]).T.tobytes(), *kept)], names=schema.names)

    return df.select(*[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(cols)], *keep).mapInArrow(run, schema)


def laid_out(blocks: DataFrame, rows: int) -> DataFrame:
    """Blocks in parts of bounded size, kept; at least a part for each core."""
    parts, cores = blocks.rdd.getNumPartitions(), blocks.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, -(-rows // ROWS_A_PART))
    return (blocks.repartition(wanted) if parts < wanted else blocks).persist()


def blocks_of(batch: pa.RecordBatch, d: int) -> Iterator[Block]:
    """The blocks of a batch; ``_bins`` has a row for each of ``d`` columns, ``_f`` holds floats."""
    for i in range(batch.num_rows):
        block = {n: np.frombuffer(batch.column(n)[i].as_buffer(), np.uint8 if n == "_bins" else float if n == "_f" else np.int64) for n in batch.schema.names}
        block["_bins"] = block["_bins"].reshape(d, -1)
        yield block


# ---------------------------------------------------------------- what a split is worth


@dataclass(frozen=True)
class Counts:
    """Classes. Statistics: weight of each class, rows. Worth: weight times purity (Gini or entropy)."""

    classes: int
    entropy: bool = False

    @property
    def width(self) -> int:
        return self.classes + 1

    def worth(self, s: np.ndarray) -> np.ndarray:
        c = s[..., :-1].astype(float)
        n = np.maximum(c.sum(-1), 1.0)
        if self.entropy:
            return (c * np.log2(np.maximum(c, 1.0))).sum(-1) - n * np.log2(n)
        return (c * c).sum(-1) / n

    def weight(self, s: np.ndarray) -> np.ndarray:
        return s[..., :-1].sum(-1)

    def done(self, s: np.ndarray) -> bool:
        return np.count_nonzero(s[:-1]) < 2

    def value(self, s: np.ndarray) -> list[float]:
        return (s[:-1] / max(int(s[:-1].sum()), 1)).tolist()

    def accepts(self, gain: float) -> bool:
        return gain > -1e-9  # a split that helps only further down is a split


@dataclass(frozen=True)
class Sums:
    """Numbers in fixed point. Statistics: weight, weighted sum, rows. Worth: what the mean explains of the squares."""

    unit: float

    width = 3

    def worth(self, s: np.ndarray) -> np.ndarray:
        total = s[..., 1] * self.unit
        return total * total / np.maximum(s[..., 0], 1)

    def weight(self, s: np.ndarray) -> np.ndarray:
        return s[..., 0]

    def done(self, s: np.ndarray) -> bool:
        return False

    def value(self, s: np.ndarray) -> list[float]:
        return [float(s[1] * self.unit / max(int(s[0]), 1))]

    def accepts(self, gain: float) -> bool:
        return gain > 0


@dataclass(frozen=True)
class Slopes:
    """Gradients and curvatures in fixed point, and rows. Worth: the loss that the best step takes away, doubled."""

    unit: float
    ridge: float = 1.0
    least_gain: float = 0.0

    width = 3

    def worth(self, s: np.ndarray) -> np.ndarray:
        g = s[..., 0] * self.unit
        return g * g / (s[..., 1] * self.unit + self.ridge)

    def weight(self, s: np.ndarray) -> np.ndarray:
        return s[..., 1] * self.unit

    def done(self, s: np.ndarray) -> bool:
        return False

    def value(self, s: np.ndarray) -> list[float]:
        return [float(-(s[0] * self.unit) / (s[1] * self.unit + self.ridge))]

    def accepts(self, gain: float) -> bool:
        return gain > max(self.least_gain, 1e-6)


def fixed_point(largest: float, rows: int) -> float:
    """A power of two: in this unit, the sum of so many numbers up to ``largest`` fits 62 bits."""
    bits = 60 - max(rows, 1).bit_length() - math.frexp(max(largest, 1e-300))[1]
    return 2.0 ** -min(bits, 1000)


@dataclass(frozen=True)
class Rules:
    """When a node is split, and how. Shares are of all rows or all weight."""

    max_depth: int | None = None
    min_split: int | float = 2
    min_leaf: int | float = 1
    min_weight: float = 0.0  # of a side, absolute
    min_weight_share: float = 0.0
    max_leaves: int | None = None
    min_gain: float = 0.0  # impurity taken away, per unit of all weight
    features: int | None = None  # columns tried at a node; all if None
    random_cuts: bool = False  # one cut a column, between the node's smallest and largest value

    def settled(self, rows: int, weight: float) -> Rules:
        """Shares turned into numbers."""

        def count(x, least):
            return max(least, math.ceil(x * rows)) if isinstance(x, float) else max(least, x)

        return replace(
            self,
            min_split=count(self.min_split, 2),
            min_leaf=count(self.min_leaf, 1),
            min_weight=max(self.min_weight, self.min_weight_share * weight),
            min_gain=self.min_gain * weight,
        )


def feature_count(given, cols: int) -> int | None:
    """sqrt, log2, onethird, all, a count or a share, as a number of columns."""
    if given in (None, "all", "auto"):
        return None
    named = {"sqrt": math.sqrt(cols), "log2": math.log2(cols), "onethird": cols / 3}
    n = named[given] if given in named else given * cols if isinstance(given, float) else given
    return max(1, min(cols, int(n)))


@dataclass(frozen=True)
class Grower:
    """All that tasks need to judge nodes."""

    bins: Bins
    objective: Counts | Sums | Slopes
    rules: Rules

    def candidates(self, hist: np.ndarray, columns: Sequence[int], seeds: Sequence[int]) -> list[np.ndarray]:
        """Best cut of each column: score, cut, next bin with rows, statistics left of it, whether there are two values.

        ``hist`` has a row for each of ``columns``, then bins, then statistics; ``seeds`` are those of the rows' nodes.
        """
        rows = hist[..., -1]
        held = rows > 0
        left = hist.cumsum(axis=1)
        right = left[:, -1:] - left
        ok = held & (right[..., -1] > 0)
        at = np.arange(hist.shape[1])
        if self.rules.random_cuts:
            ok &= at == self._drawn(held, columns, seeds)[:, None]
        for side in (left, right):
            ok &= (side[..., -1] >= self.rules.min_leaf) & (self.objective.weight(side) >= self.rules.min_weight)
        score = np.where(ok, self.objective.worth(left) + self.objective.worth(right), -np.inf)
        cut = score.argmax(axis=1)
        after = (held & (at > cut[:, None])).argmax(axis=1)
        pick = np.arange(len(hist))
        return [score[pick, cut], cut, after, left[pick, cut], held.sum(axis=1) > 1]

    def _drawn(self, held: np.ndarray, columns: Sequence[int], seeds: Sequence[int]) -> np.ndarray:
        out, uppers = np.zeros(len(held), np.int64), [np.array(x) for x in self.bins.uppers]
        for i, (column, seed) in enumerate(zip(columns, seeds)):
            at = np.flatnonzero(held[i])
            if len(at) > 1:
                ends = uppers[column][at]
                value = ends[0] + uniform(seed, column, 1) * (ends[-1] - ends[0])
                out[i] = at[min(np.searchsorted(ends, value, side="right"), len(at) - 1) - 1]
        return out

    def chosen(self, hists: np.ndarray, columns: Sequence[int], seeds: Sequence[int], totals: np.ndarray) -> list[tuple | None]:
        """``choose`` for several nodes; ``hists`` has a row for each node, then one for each of ``columns``."""
        nodes, d = hists.shape[:2]
        flat = hists.reshape(nodes * d, *hists.shape[2:])
        score, cut, after, left, varies = self.candidates(flat, list(columns) * nodes, [s for s in seeds for _ in range(d)])
        out = []
        for i, (seed, total) in enumerate(zip(seeds, totals)):
            own = range(i * d, (i + 1) * d)
            out.append(self.choose([(c, score[r], cut[r], after[r], left[r], varies[r]) for c, r in zip(columns, own)], total, seed))
        return out

    def choose(self, found: list[tuple], total: np.ndarray, seed: int) -> tuple | None:
        """(gain, column, cut, threshold, left) of the node, or None. ``found`` has (column, score, cut, next, left, varies).

        The cut is the last bin below the threshold, so that rows the node has not seen go by bin where they go by value.
        """
        tried = [f for f in found if f[5]]
        if self.rules.features and len(tried) > self.rules.features:
            tried = sorted(tried, key=lambda f: mix(seed, f[0], 2))[: self.rules.features]
        best = max(tried, key=lambda f: (f[1], -f[0]), default=None)
        if best is None or best[1] == -np.inf:
            return None
        gain = float(best[1] - self.objective.worth(total))
        if not self.objective.accepts(gain) or gain < self.rules.min_gain - 1e-9:
            return None
        threshold = self.bins.threshold(best[0], int(best[2]), int(best[3]))
        cut = int(np.searchsorted(self.bins.uppers[best[0]], threshold, side="right")) - 1
        return gain, best[0], cut, threshold, best[4]

    def final(self, total: np.ndarray, depth: int) -> bool:
        """Whether a node is a leaf whatever its rows look like."""
        deep = self.rules.max_depth is not None and depth >= self.rules.max_depth
        return deep or total[-1] < max(self.rules.min_split, 2 * self.rules.min_leaf) or self.objective.done(total)


@dataclass
class Tree:
    """Nodes in the order they were made. ``feature`` is -1 at leaves."""

    seed: int
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    seeds: list[int] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)

    def add(self, stats: np.ndarray, depth: int, seed: int) -> int:
        for name, value in (("feature", -1), ("cut", 0), ("threshold", 0.0), ("left", 0), ("right", 0), ("gain", 0.0)):
            getattr(self, name).append(value)
        self.depth.append(depth)
        self.seeds.append(seed)
        self.stats.append(stats)
        return len(self.feature) - 1

    def split(self, node: int, chosen: tuple) -> tuple[int, int]:
        self.gain[node], self.feature[node], self.cut[node], self.threshold[node], left = chosen
        for side, stats in ((0, left), (1, self.stats[node] - left)):
            child = self.add(stats, self.depth[node] + 1, mix(self.seeds[node], side))
            (self.right if side else self.left)[node] = child
        return self.left[node], self.right[node]

    def graft(self, node: int, other: Tree) -> None:
        """Put a tree grown elsewhere in place of a leaf."""
        shift = len(self.feature) - 1
        for i in range(len(other.feature)):
            to = node if i == 0 else self.add(other.stats[i], self.depth[node] + other.depth[i], other.seeds[i])
            for name in ("feature", "cut", "threshold", "gain"):
                getattr(self, name)[to] = getattr(other, name)[i]
            if other.feature[i] >= 0:
                self.left[to], self.right[to] = other.left[i] + shift, other.right[i] + shift

    def router(self) -> Router:
        return Router(*(np.array(x, np.int32) for x in (self.feature, self.cut, self.left, self.right)))


@dataclass
class Router:
    """What tells where a row ends. With up to 64 leaves, a table for each column has the leaves that a bin leaves open, as bits
    from left to right; the first bit in all of a row's entries is its leaf (Lucchese et al. 2015)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    tables: list[tuple[int, np.ndarray]] | None = None
    leaves: np.ndarray | None = None

    def __post_init__(self):
        inner, leaves, below = [], [], {}
        todo = [(0, False)]
        while todo and len(leaves) <= 64:
            node, closed = todo.pop()
            if self.feature[node] < 0:
                below[node] = 1 << len(leaves)
                leaves.append(node)
            elif closed:
                below[node] = below[self.left[node]] | below[self.right[node]]
                inner.append(node)
            else:
                todo += [(node, True), (int(self.right[node]), False), (int(self.left[node]), False)]
        if len(leaves) <= 64:
            tables: dict[int, np.ndarray] = {}
            for node in inner:
                table = tables.setdefault(int(self.feature[node]), np.full(256, MASK, np.uint64))
                table[self.cut[node] + 1 :] &= np.uint64(MASK ^ below[self.left[node]])
            self.tables, self.leaves = sorted(tables.items()), np.array(leaves, np.int32)

    def __len__(self) -> int:
        return len(self.feature)


def routed(router: Router, codes: np.ndarray) -> np.ndarray:
    """The node where each row ends. ``codes`` has a row for each column."""
    n = codes.shape[1]
    if router.tables is not None:
        open_ = None
        for column, table in router.tables:
            own = table.take(codes[column])
            open_ = own if open_ is None else np.bitwise_and(open_, own, out=open_)
        if open_ is None:
            return np.full(n, router.leaves[0])
        open_ &= ~open_ + np.uint64(1)
        return router.leaves.take(np.frexp(open_.astype(float))[1] - 1)
    feature, cut, left, right = router.feature, router.cut, router.left, router.right
    flat = np.ascontiguousarray(codes).reshape(-1)
    node = np.zeros(n, np.int32)
    moving = np.arange(n)
    while len(moving):
        at = node[moving]
        column = feature[at]
        inner = column >= 0
        if not inner.all():
            moving, at, column = moving[inner], at[inner], column[inner]
        node[moving] = np.where(flat[column.astype(np.int64) * n + moving] <= cut[at], left[at], right[at])
    return node


def _summands(stats: np.ndarray) -> list[tuple[np.ndarray, list[tuple[int, int]]]] | None:
    """Weights whose sums as floats are exact, and for each the statistics it holds with their factors. None if there are none.

    Two small sums share a weight, a large one is cut in two.
    """
    n, small, out = len(stats), [], []
    for s in range(stats.shape[1]):
        column = stats[:, s]
        lo, hi = (int(column.min()), int(column.max())) if n else (0, 0)
        most = max(-lo, hi) * n
        if lo >= 0 and most < PACKED:
            small.append(s)
        elif most < 1 << 53:
            out.append((column.astype(float), [(s, 1)]))
        elif most >> 26 < 1 << 52 and n < PACKED:
            out += [((column >> 26).astype(float), [(s, PACKED)]), ((column & (PACKED - 1)).astype(float), [(s, 1)])]
        else:
            return None
    for pair in (small[i : i + 2] for i in range(0, len(small), 2)):
        out.append((sum(stats[:, s].astype(float) * f for s, f in zip(pair, (1, PACKED))), [(s, 0) for s in pair]))
    return out


def histograms(codes: np.ndarray, slots: np.ndarray, stats: np.ndarray, slot_count: int, bins: int) -> np.ndarray:
    """Sums of the statistics by slot, column, bin. ``codes`` has a row for each column."""
    out, size = np.zeros((slot_count, len(codes), bins, stats.shape[1]), np.int64), slot_count * bins
    parts, base = _summands(stats), slots * bins
    for j in range(len(codes)):
        at = base + codes[j]
        if parts is None:
            for s in range(stats.shape[1]):
                sums = np.zeros(size, np.int64)
                np.add.at(sums, at, stats[:, s])
                out[:, j, :, s] = sums.reshape(slot_count, bins)
            continue
        for weight, held in parts:
            sums = np.bincount(at, weight, size).astype(np.int64).reshape(slot_count, bins)
            if held[0][1]:
                out[:, j, :, held[0][0]] += sums * held[0][1]
            else:
                out[:, j, :, held[0][0]] = sums & (PACKED - 1)
                if len(held) > 1:
                    out[:, j, :, held[1][0]] = sums >> 26
    return out


def grow_here(grower: Grower, codes: np.ndarray, stats: np.ndarray, depth: int, seed: int) -> Tree:
    """A whole tree from rows in memory, level by level; rows of finished nodes are dropped."""
    tree, d, width = Tree(seed), len(codes), grower.bins.widest
    open_ = [tree.add(stats.sum(axis=0), depth, seed)]
    open_ = [n for n in open_ if not grower.final(tree.stats[n], depth)]
    slots, each = np.zeros(len(stats), np.int64), max(1, FINISH_BYTES // (8 * d * width * stats.shape[1]))
    while open_:
        feature, cut, to = np.zeros(len(open_), np.int64), np.zeros(len(open_), np.int64), np.full((len(open_), 2), -1, np.int64)
        after: list[int] = []
        for start in range(0, len(open_), each):
            nodes = open_[start : start + each]
            if len(open_) > each:
                here = np.flatnonzero((slots >= start) & (slots < start + each))
                hists = histograms(codes[:, here], slots[here] - start, stats[here], len(nodes), width)
            else:
                hists = histograms(codes, slots, stats, len(nodes), width)
            splits = grower.chosen(hists, range(d), [tree.seeds[n] for n in nodes], [tree.stats[n] for n in nodes])
            for i, (node, split) in enumerate(zip(nodes, splits), start):
                if split is not None:
                    feature[i], cut[i] = split[1], split[2]
                    for side, child in enumerate(tree.split(node, split)):
                        if not grower.final(tree.stats[child], tree.depth[child]):
                            to[i, side] = len(after)
                            after.append(child)
        values = codes.reshape(-1)[feature[slots] * codes.shape[1] + np.arange(codes.shape[1])]
        slots = to.reshape(-1)[2 * slots + (values > cut[slots])]
        stay = np.flatnonzero(slots >= 0)
        codes, stats, slots, open_ = np.ascontiguousarray(codes[:, stay]), stats[stay], slots[stay], after
    tree.depth = [x - depth for x in tree.depth]
    return tree


# ---------------------------------------------------------------- growing over all rows

#: From a block and the number of a tree: which rows the tree sees (None: all), and their statistics.
Weigh = Callable[[Block, int], tuple[np.ndarray | None, np.ndarray]]


def _judged(rows: DataFrame, grower: Grower, weigh: Weigh, open_: dict[int, tuple], d: int, parts: int) -> dict:
    """Total and split (or None) of each open node of each tree, from one pass over the rows.

    ``open_`` has (router, nodes, seeds, depths, columns) by tree number.
    """
    bins, width = grower.bins.widest, grower.objective.width
    schema = "tree int, slot int, hist binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((len(nodes), len(use), bins, width), np.int64) for t, (_, nodes, _, _, use) in open_.items()}
        for batch in batches:
            for block in blocks_of(batch, d):
                for t, (router, nodes, _, _, use) in open_.items():
                    codes = block["_bins"]
                    seen, stats = weigh(block, t)
                    if seen is not None:
                        codes = codes[:, seen]
                    slots = np.zeros(len(stats), np.int64)
                    if len(router) > 1:
                        slot_of = np.full(len(router), -1, np.int64)
                        slot_of[nodes] = np.arange(len(nodes))
                        slots = slot_of[routed(router, codes)]
                        here = np.flatnonzero(slots >= 0)
                        if len(here) < len(slots):
                            codes, slots, stats = codes[:, here], slots[here], stats[here]
                    sums[t] += histograms(codes if len(use) == d else codes[use], slots, stats, len(nodes), bins)
        for t, hist in sums.items():
            for slot in np.flatnonzero(hist[:, 0, :, -1].any(axis=1)):
                row = [pa.array([t], pa.int32()), pa.array([slot], pa.int32()), pa.array([hist[slot].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, names=["tree", "slot", "hist"])

    def judge(t: int, slot: int, hists: Sequence[bytes]) -> tuple[np.ndarray, tuple | None]:
        _, _, seeds, depths, use = open_[t]
        hist = sum(np.frombuffer(h, np.int64) for h in hists).reshape(1, len(use), bins, width)
        total = hist[0, 0].sum(axis=0)
        return total, None if grower.final(total, depths[slot]) else grower.chosen(hist, use, [seeds[slot]], [total])[0]

    counted = rows.mapInArrow(count, schema)
    size = sum(8 * len(nodes) * len(use) * bins * width for _, nodes, _, _, use in open_.values())
    if size * parts <= DRIVER_BYTES:
        hists: dict = {}
        for r in counted.collect():
            hists.setdefault((r["tree"], r["slot"]), []).append(r["hist"])
        return {(t, int(open_[t][1][slot])): judge(t, slot, h) for (t, slot), h in hists.items()}

    def judge_group(table: pa.Table) -> pa.Table:
        t, slot = table["tree"][0].as_py(), table["slot"][0].as_py()
        total, split = judge(t, slot, [h.as_buffer() for h in table["hist"]])
        gain, column, cut, threshold, left = split or (0.0, -1, 0, 0.0, total)
        values = [t, slot, total.tobytes(), float(gain), int(column), int(cut), float(threshold), left.tobytes()]
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds)})

    out = "tree int, slot int, total binary, gain double, column int, cut int, threshold double, lower binary"
    names = [f.split()[0] for f in out.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
    found = {}
    for r in counted.groupBy("tree", "slot").applyInArrow(judge_group, out).collect():
        split = (r["gain"], r["column"], r["cut"], r["threshold"], np.frombuffer(r["lower"], np.int64)) if r["column"] >= 0 else None
        found[r["tree"], int(open_[r["tree"]][1][r["slot"]])] = (np.frombuffer(r["total"], np.int64), split)
    return found


def _evaluate(
    rows: DataFrame, grower: Grower, weigh: Weigh, trees: dict[int, Tree], wanted: list[tuple[int, int]], d: int, columns: dict | None, parts: int
) -> None:
    """Split the wanted nodes (tree, node) where that is allowed, in as many passes as memory asks for."""
    each = max(1, HISTOGRAM_BYTES // (8 * d * grower.bins.widest * grower.objective.width))
    for at in range(0, len(wanted), each):
        open_ = {}
        for t in sorted({t for t, _ in wanted[at : at + each]}):
            nodes = np.array([n for u, n in wanted[at : at + each] if u == t], np.int64)
            use = list(range(d)) if columns is None else sorted(columns[t])
            open_[t] = (trees[t].router(), nodes, [trees[t].seeds[n] for n in nodes], [trees[t].depth[n] for n in nodes], use)
        for (t, node), (total, split) in sorted(_judged(rows, grower, weigh, open_, d, parts).items(), key=lambda x: x[0]):
            trees[t].stats[node] = total
            if split is not None:
                trees[t].split(node, split)


def _smallest(column: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as hold them."""
    return column.astype(next(k for k in ("i1", "i2", "i4", "i8") if not len(column) or np.iinfo(k).min <= column.min() and column.max() <= np.iinfo(k).max))


def _unshrunk(data: bytes, n: int, width: int) -> np.ndarray:
    """Statistics from columns that each begin with the bytes of a number."""
    stats, at = np.empty((n, width), np.int64), 0
    for s in range(width):
        size = int(data[at : at + 1])
        stats[:, s] = np.frombuffer(data, f"i{size}", n, at + 1)
        at += 1 + size * n
    return stats


def _finish_small(rows: DataFrame, grower: Grower, weigh: Weigh, trees: dict[int, Tree], small: dict[int, list[int]], d: int) -> None:
    """Gather the rows of each small node in a group and grow its subtree there."""
    width = grower.objective.width
    starts = {t: (trees[t].router(), np.array(nodes, np.int64)) for t, nodes in small.items()}
    about = {(t, n): (trees[t].depth[n], trees[t].seeds[n]) for t, nodes in small.items() for n in nodes}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch, d):
                for t, (router, nodes) in starts.items():
                    codes = block["_bins"]
                    seen, stats = weigh(block, t)
                    if seen is not None:
                        codes = codes[:, seen]
                    # Numbers of 16 bits are sorted without comparisons.
                    slot_of = np.full(len(router), len(nodes), np.int16 if len(nodes) < 1 << 15 else np.int64)
                    slot_of[nodes] = np.arange(len(nodes))
                    slots = slot_of[routed(router, codes)]
                    ends = np.bincount(slots, minlength=len(nodes) + 1)[:-1].cumsum()
                    order = np.argsort(slots, kind="stable")[: ends[-1]]
                    own, columns = codes[:, order], [_smallest(stats[order, s]) for s in range(width)]
                    heads = [str(c.itemsize).encode() for c in columns]
                    made = [(int(n), int(a), int(b)) for n, a, b in zip(nodes, np.r_[0, ends], ends) if b > a]
                    if made:
                        packed = [b"".join(x for h, c in zip(heads, columns) for x in (h, c[a:b].tobytes())) for _, a, b in made]
                        fields = [[t] * len(made), [n for n, _, _ in made], [own[:, a:b].tobytes() for _, a, b in made], packed]
                        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(fields, kinds)], names=["tree", "node", "codes", "stats"])

    def finish(table: pa.Table) -> pa.Table:
        t, node = table["tree"][0].as_py(), table["node"][0].as_py()
        codes = [np.frombuffer(c.as_buffer(), np.uint8).reshape(d, -1) for c in table["codes"]]
        stats = [_unshrunk(s.as_py(), c.shape[1], width) for s, c in zip(table["stats"], codes)]
        tree = grow_here(grower, np.concatenate(codes, axis=1), np.concatenate(stats), *about[t, node])
        numbers = np.array([tree.feature, tree.cut, tree.left, tree.right, tree.depth], np.int32)
        fields = [numbers.tobytes(), np.array([tree.gain, tree.threshold]).tobytes(), np.array(tree.stats, np.int64).tobytes()]
        packed = {n: pa.array([v], pa.binary()) for n, v in zip(("numbers", "gains", "stats"), fields)}
        return pa.table({"tree": table["tree"][:1], "node": table["node"][:1], **packed})

    # Groups are few and long: some parts for each core, whatever their bytes.
    parts = min(len(about) * 2, 16 * rows.sparkSession.sparkContext.defaultParallelism)
    moved = rows.mapInArrow(gather, "tree int, node long, codes binary, stats binary").repartition(max(1, parts), "tree", "node")
    subtrees = moved.groupBy("tree", "node").applyInArrow(finish, "tree int, node long, numbers binary, gains binary, stats binary")
    for r in sorted(subtrees.collect(), key=lambda r: (r["tree"], r["node"])):
        feature, cut, left, right, depth = np.frombuffer(r["numbers"], np.int32).reshape(5, -1).tolist()
        stats = list(np.frombuffer(r["stats"], np.int64).reshape(-1, width))
        gains, thresholds = np.frombuffer(r["gains"]).reshape(2, -1).tolist()
        sub = Tree(0, feature, cut, thresholds, left, right, gains, depth, [0] * len(feature), stats)
        trees[r["tree"]].graft(r["node"], sub)


def _best_first(tree: Tree, leaves: int, asked: set[int]) -> tuple[set[int], list[int]]:
    """Which nodes a tree of so many leaves splits, best gain first, and which nodes must be judged before that is known."""
    heap, split = [], set()

    def push(node: int) -> None:
        if tree.feature[node] >= 0:
            heapq.heappush(heap, (-tree.gain[node], node))

    if 0 not in asked:
        return split, [0]
    push(0)
    while heap and len(split) + 1 < leaves:
        node = heapq.heappop(heap)[1]
        split.add(node)
        pair = (tree.left[node], tree.right[node])
        missing = [c for c in pair if c not in asked]
        if missing and len(split) + 1 < leaves:
            # Others that may be next are judged in the same pass.
            near = [n for _, n in heapq.nsmallest(leaves - len(split), heap)]
            return split, missing + [c for n in near for c in (tree.left[n], tree.right[n]) if c not in asked]
        for child in pair:
            if child in asked:
                push(child)
    return split, []


def _prune(tree: Tree, split: set[int]) -> None:
    for node in range(len(tree.feature)):
        if node not in split:
            tree.feature[node] = -1


def grow(
    rows: DataFrame, grower: Grower, weigh: Weigh, seeds: dict[int, int], d: int, columns: dict[int, set[int]] | None = None
) -> dict[int, Tree]:
    """One tree for each number in ``seeds``. ``rows`` are blocks as of ``with_bins``; keep them persisted.

    ``columns`` names the columns each tree may use; such trees are grown by levels to the end.
    """
    trees = {t: Tree(s) for t, s in seeds.items()}
    for t, tree in trees.items():
        tree.add(np.zeros(grower.objective.width, np.int64), 0, seeds[t])
    rules, parts = grower.rules, rows.rdd.getNumPartitions()
    if rules.max_leaves is not None:
        asked: dict[int, set[int]] = {t: set() for t in trees}
        while True:
            wanted = []
            for t, tree in trees.items():
                missing = _best_first(tree, rules.max_leaves, asked[t])[1]
                for n in missing:
                    asked[t].add(n)
                    if n == 0 or not grower.final(tree.stats[n], tree.depth[n]):
                        wanted.append((t, n))
            if not wanted and not any(_best_first(tree, rules.max_leaves, asked[t])[1] for t, tree in trees.items()):
                break
            _evaluate(rows, grower, weigh, trees, wanted, d, columns, parts)
        for t, tree in trees.items():
            _prune(tree, _best_first(tree, rules.max_leaves, asked[t])[0])
        return trees
    open_ = [(t, 0) for t in trees]
    small: dict[int, list[int]] = {}
    while open_:
        _evaluate(rows, grower, weigh, trees, open_, d, columns, parts)
        after = [(t, c) for t, n in open_ if trees[t].feature[n] >= 0 for c in (trees[t].left[n], trees[t].right[n])]
        after = [(t, c) for t, c in after if not grower.final(trees[t].stats[c], trees[t].depth[c])]
        least = SMALL_NODE if columns is None else 0
        open_ = [(t, c) for t, c in after if trees[t].stats[c][-1] > least]
        for t, c in after:
            if trees[t].stats[c][-1] <= least:
                small.setdefault(t, []).append(c)
    if small:
        _finish_small(rows, grower, weigh, trees, small, d)
    return trees


# ---------------------------------------------------------------- fitted trees


def compact(tree: Tree, grower: Grower) -> dict:
    """A tree as plain lists, for a model's state: only nodes that a row can reach, thresholds instead of bins."""
    order, at = [0], 0
    while at < len(order):
        if tree.feature[order[at]] >= 0:
            order += [tree.left[order[at]], tree.right[order[at]]]
        at += 1
    number = {n: i for i, n in enumerate(order)}
    inner = [tree.feature[n] >= 0 for n in order]
    return {
        "feature": [tree.feature[n] for n in order],
        "threshold": [tree.threshold[n] if i else 0.0 for n, i in zip(order, inner)],
        "left": [number[tree.left[n]] if i else 0 for n, i in zip(order, inner)],
        "right": [number[tree.right[n]] if i else 0 for n, i in zip(order, inner)],
        "gain": [tree.gain[n] if i else 0.0 for n, i in zip(order, inner)],
        "value": [[] if i else grower.objective.value(tree.stats[n]) for n, i in zip(order, inner)],
    }


class Walker:
    """Values of fitted trees for rows of numbers."""

    def __init__(self, trees: Sequence[dict]):
        width = max((len(v) for t in trees for v in t["value"]), default=1)
        self.trees = []
        for t in trees:
            value = np.array([v or [0.0] * width for v in t["value"]])
            arrays = [np.array(t[n], k) for n, k in (("feature", np.int32), ("threshold", float), ("left", np.int32), ("right", np.int32))]
            self.trees.append((*arrays, value))

    def values(self, tree: int, x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right, value = self.trees[tree]
        node, moving = np.zeros(len(x), np.int32), np.arange(len(x))
        while len(moving):
            at = node[moving]
            inner = feature[at] >= 0
            moving, at = moving[inner], at[inner]
            node[moving] = np.where(x[moving, feature[at]] <= threshold[at], left[at], right[at])
        return value[node]

    def mean(self, x: np.ndarray) -> np.ndarray:
        return sum(self.values(i, x) for i in range(len(self.trees))) / len(self.trees)


def importances(trees: Sequence[dict], cols: Sequence[str]) -> dict[str, float]:
    """Share of each column in all gains; per tree first, then the mean, as forests have it."""
    total = np.zeros(len(cols))
    for t in trees:
        own = np.zeros(len(cols))
        for f, g in zip(t["feature"], t["gain"]):
            if f >= 0:
                own[f] += g
        total += own / own.sum() if own.sum() > 0 else own
    total = total / total.sum() if total.sum() > 0 else total
    return dict(zip(cols, total.tolist()))
