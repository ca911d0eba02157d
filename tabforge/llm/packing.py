"""Best-fit packing of documents into sequences of fixed length, by a configuration linear program.

Documents are tokenised, closed with an end id, and cut if longer than a sequence. Only the histogram of piece lengths
(as many numbers as a sequence has tokens) reaches the driver. There a configuration, a multiset of lengths that fit into
one sequence, is priced by knapsack dynamic programming. Multiplicative weights seek the prices that prove the highest
number of sequences; every length has a price, however few pieces it has. Whole uses of the dearest configurations are
taken until none is left, prices are found anew for what remains, and the last pieces are filled best fit first. The plan
has about as many rows as a sequence has tokens. Pieces then get exact positions among their equals, in small buckets, and
look their place up in the plan.

Cases: a null text counts as empty and is one piece, the end id; rows that repeat a key are packed as rows of their own;
an empty table gives an empty result. Long texts are tokenised whole and cut by tokens; pieces of one length are placed in
the order of a hash of key and piece. Columns other than key and text are not passed on.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.llm.vocab import TokenIds
from tabforge.operators.ranking import hashed_position
from tabforge.runtime import cut_lineage

END_ID = 0
ROUNDS = 20  # of multiplicative weights
STEP = 0.3  # largest part of a length's demand that a round covers
SHIFT = 0.3  # by how much prices of what is covered fall in the first round
NEAR = 0.02  # configurations this close to the dearest are used in a round
TOLERANCES = (1e-9, 1e-9, 0.001, 0.004, 0.016)  # for whole uses, one after the other
LEAST = 1e-9  # of a length's count, for sums of floats

_IDS: dict[str, TokenIds] = {}


def _encoder(path: str, ranks: str) -> TokenIds:
    """One per worker process, so that pieces seen in one task are known in the next."""
    if path not in _IDS:
        _IDS[path] = TokenIds(path, ranks)
    return _IDS[path]


def piece_bounds(tokens: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter than the capacity if it is cut."""
    start, length = 0, tokens % capacity or capacity
    while start < tokens:
        yield start, length
        start, length = start + length, capacity


def cut_pieces(
    df: DataFrame, vocabulary: str, ranks: str, capacity: int, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, ``ids`` (little-endian 32-bit) of each piece."""
    kind = df.schema[key].dataType
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    fields += [("ids", T.BinaryType())] if with_ids else []
    schema = T.StructType([T.StructField(key, kind), *[T.StructField(n, t) for n, t in fields]])
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, ranks)
        for batch in batches:
            rows: list[int] = []
            found: list[tuple] = []
            for i, ids in enumerate(encoder.ids([t or "" for t in batch.column(1).to_pylist()])):
                view = memoryview(ids + end)
                for n, (start, length) in enumerate(piece_bounds(len(view) // 4, capacity)):
                    part = view[4 * start : 4 * (start + length)]
                    found.append((n, start, length, zlib.crc32(part), *([bytes(part)] if with_ids else [])))
                    rows.append(i)
            columns = list(zip(*found)) if found else [[]] * len(fields)
            arrays = [pa.array(c, f) for c, f in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays], names=schema.names)

    return df.select(f"`{key}`", f"`{text}`").mapInArrow(cut, schema)


def best_values(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Price of the dearest multiset that fits into each size; ``prices[l]`` is the price of length l.

    Knapsack by dynamic programming over the filled size; one step weighs all lengths at once.
    """
    value = np.zeros(capacity + 1)
    for size in range(1, capacity + 1):
        value[size] = max(value[size - 1], (prices[1 : size + 1] + value[size - 1 :: -1]).max())
    return value


def filled(config: list[int], prices: np.ndarray, value: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """``config`` with the dearest lengths that still fit, none more often than its limit; of equally dear ones the longest.

    ``prices`` are minus infinity where there is nothing left; they are changed for a while.
    """
    config, room, used, gone = list(config), len(value) - 1 - sum(config), {}, []
    new = list(config)
    while True:
        for length in new:
            used[length] = used.get(length, 0) + 1
            if used[length] >= limits[length]:
                gone.append((length, prices[length]))
                prices[length] = -np.inf
        if room == 0:
            break
        total = prices[1 : room + 1] + value[room - 1 :: -1]
        length = room - int(total[::-1].argmax())
        if total[length - 1] == -np.inf:
            break
        config.append(length)
        room, new = room - length, [length]
    for length, price in reversed(gone):
        prices[length] = price
    return np.array(config, np.int64)


def best_configuration(prices: np.ndarray, capacity: int) -> np.ndarray:
    """Lengths (repeats allowed) of the dearest multiset that fits."""
    usable = np.where(prices > 0, prices, -np.inf)
    return filled([], usable, best_values(prices, capacity), np.full(capacity + 1, np.inf))


def tight_configurations(
    prices: np.ndarray, value: np.ndarray, counts: np.ndarray, part: float, tolerance: float, whole: bool
) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
    """Configurations of a price within ``tolerance`` of the dearest, and what they cover: at most ``part`` of each count.

    The longest length comes first, with the dearest configuration that holds it, used as often as its lengths allow.
    ``whole`` uses only; else a length gets one configuration, and parts of uses count.
    """
    allowed = part * counts
    limits = allowed if whole else counts
    usable, found = np.where(allowed > 0, prices, -np.inf), []
    usable[0] = -np.inf
    for length in np.flatnonzero(allowed)[::-1]:
        if prices[length] + value[-1 - length] < (1 - tolerance) * value[-1]:
            continue
        while usable[length] > -np.inf:
            config = filled([int(length)], usable, value, limits)
            if prices[config].sum() < (1 - tolerance) * value[-1]:
                break
            kinds, times = np.unique(config, return_counts=True)
            often = int((allowed[kinds] // times).min()) if whole else (allowed[kinds] / times).min()
            allowed[kinds] -= often * times
            usable[kinds[allowed[kinds] <= LEAST * counts[kinds]]] = -np.inf
            found.append((config, often))
            if not whole:
                break
    return found, part * counts - allowed


def starting_prices(capacity: int) -> Iterator[np.ndarray]:
    """Prices known to price no configuration above one: by size, by how many fit, by steps, and with the longest at one."""
    lengths = np.arange(capacity + 1)
    yield lengths / capacity
    yield np.append(0.0, 1 / (capacity // lengths[1:]))
    for k in range(1, 17):
        scaled = (k + 1) * lengths
        yield np.where(scaled % capacity == 0, lengths / capacity, scaled // capacity / k)
    for least in sorted({capacity * i // 16 for i in range(1, 9)} - {0}):
        yield np.where(lengths > capacity - least, 1.0, np.where(lengths < least, 0.0, lengths / capacity))


def cover_bound(prices: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Fewest sequences that the prices prove by duality, the prices with the dearest configuration at one, its values."""
    prices = np.where(counts > 0, prices, 0.0)
    value = best_values(prices, capacity)
    if value[-1] == 0:
        return 0.0, prices, value
    return float((prices * counts).sum() / value[-1]), prices / value[-1], value / value[-1]


def cover_prices(counts: np.ndarray, capacity: int, enough: int) -> tuple[float, np.ndarray]:
    """Bound and prices of the linear program of configurations that cover every length's count, rare ones too.

    Multiplicative weights: a round uses all configurations near the dearest, each length up to STEP of its count, and what
    they cover gets cheaper, by less from round to round. The rounds begin at the best of the starting prices; of all
    rounds' prices and their mean, those with the highest bound are given. A bound of ``enough`` ends the rounds.
    """
    best = max((cover_bound(p, counts, capacity) for p in starting_prices(capacity)), key=lambda b: b[0])
    prices = np.where(counts > 0, np.maximum(best[1], 1e-3 * np.arange(capacity + 1) / capacity), 0.0)
    mean = np.zeros(capacity + 1)
    for turn in range(ROUNDS):
        if math.ceil(best[0] - 1e-6) >= enough:
            break
        _, now, value = bound = cover_bound(prices, counts, capacity)
        mean += now / bound[0]
        best = max(best, bound, key=lambda b: b[0])
        _, covered = tight_configurations(now, value, counts, STEP, NEAR, whole=False)
        prices = now * np.exp(-SHIFT / (turn + 1) * covered / np.maximum(counts, 1))
    else:
        best = max(best, cover_bound(mean, counts, capacity), key=lambda b: b[0])
    return best[:2]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations for whole demands: the longest piece first, then always the longest that still fits.

    Each is used as often as its lengths allow, so there are about as many as there are lengths.
    """
    rest, plan = counts.copy(), []
    while rest.any():
        room, config, left = capacity, [], rest.copy()
        while len(fitting := np.flatnonzero(left[: room + 1])):
            length = int(fitting[-1])
            config.append(length)
            left[length] -= 1
            room -= length
        kinds, times = np.unique(config, return_counts=True)
        often = int((rest[kinds] // times).min())
        rest[kinds] -= often * times
        plan.append((np.array(config, np.int64), often))
    return plan


def cover(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole uses of configurations that the linear program prices highest, and best-fit ones for the rest.

    Prices are those of what is left, found anew for each tolerance; tight configurations are used until there are none.
    What best fit adds is known after each step: of all steps the plan with the fewest sequences is given, of equally short
    ones the latest. A plan as short as the bound ends the search.
    """
    left, placed, used = counts.copy(), [], 0
    rest = best_fit(left, capacity)
    fewest, plan, least = sum(n for _, n in rest), rest, 0
    for tolerance in TOLERANCES:
        bound, prices = cover_prices(left, capacity, sum(n for _, n in rest))
        least = least or math.ceil(bound - 1e-6)
        while left.any():
            _, now, value = cover_bound(prices, left, capacity)
            found, covered = tight_configurations(now, value, left, 1, tolerance, whole=True)
            if not found or value[-1] == 0:
                break
            left = left - covered
            placed, used = placed + found, used + sum(n for _, n in found)
            rest = best_fit(left, capacity)
            total = used + sum(n for _, n in rest)
            if total <= fewest:
                fewest, plan = total, placed + rest
        if fewest == least and plan is not rest or not left.any():
            break
    return plan


def plan_sequences(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """For each run of equal pieces: ``length``, first ``rank``, ``often``, first ``sequence`` and ``offset``.

    The piece of a length with rank r in the run that begins at rank s lies in sequence ``sequence + (r - s) % often`` at
    ``offset + (r - s) // often * length``.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = cover(counts, capacity)
    runs, placed, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for config, often in plan:
        offset = 0
        for length, times in zip(*np.unique(config, return_counts=True)):
            runs.append((length, placed[length], often, sequence, offset))
            placed[length] += times * often
            offset += times * length
        sequence += often
    names = ("length", "rank", "often", "sequence", "offset")
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return dict(zip(names, table.T))


def place_pieces(pieces: DataFrame, capacity: int, key: str = "doc_id", piece: str = "piece") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Any table with keys and a ``length`` of 1 to ``capacity`` will do.

    The plan is broadcast: at most a few runs for each length up to the capacity.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_sequences(histogram, capacity))
    ranked = hashed_position(pieces, [key, piece], 0, by=["length"], out="_rank")
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType([pieces.schema[c] for c in columns])
    schema = schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        starts = runs["length"] * (1 << 48) + runs["rank"]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "_rank"))
            at = np.searchsorted(starts, length * (1 << 48) + rank, "right") - 1
            nth = rank - runs["rank"][at]
            sequence = runs["sequence"][at] + nth % runs["often"][at]
            offset = runs["offset"][at] + nth // runs["often"][at] * length
            arrays = [*[batch.column(c) for c in columns], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ranked.select(*[f"`{c}`" for c in columns], F.col("_rank").cast("long")).mapInArrow(place, schema)


def pack(df: DataFrame, vocabulary: str, ranks: str, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with their places. Tokens are made once; the narrow table of pieces is written."""
    pieces = cut_lineage(cut_pieces(df, vocabulary, ranks, capacity, key, text))
    return place_pieces(pieces, capacity, key)
