"""Exact positions of rows without a window over a large group.

``row_number`` over a class sends the whole class to one task. Here rows fall into many small buckets
that follow the wanted order; a row's position is the count of all earlier buckets plus its place in its own.
Buckets depend only on the row itself, so a task that is run again gives the same answer.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.hashing import row_hash
from tabforge.runtime import broadcast_if_small, cut_lineage, in_parallel

ROWS_PER_BUCKET = 100_000
COUNTED_DIGITS = 3  # of the hash, in the first counting pass
MAX_SORTED = 1_000_000  # different values that one task sorts


def hash_digits(n: int) -> int:
    """Hexadecimal digits that make buckets of at most about ROWS_PER_BUCKET rows; 16 buckets at least."""
    return max(1, min(6, math.ceil(math.log(max(n / ROWS_PER_BUCKET, 1), 16))))


def _bucket_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))


def _from_buckets(df: DataFrame, by: list[str], order: list, out: str, size: str | None, counts: DataFrame) -> DataFrame:
    w = Window.partitionBy(*by)
    before = F.sum("_n").over(w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        *by,
        "_bucket",
        F.coalesce(before, F.lit(0)).alias("_start"),
        F.sum("_n").over(w).alias("_size"),
    )
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    res = df.join(broadcast_if_small(starts), [*by, "_bucket"]).withColumn(out, F.col("_start") + place - 1)
    if size:
        res = res.withColumn(size, F.col("_size"))
    return res.drop("_bucket", "_start", "_size", "_h")


def hashed_position(df: DataFrame, key, seed, by=(), out: str = "pos", size: str | None = None) -> DataFrame:
    """0-based position of each row within ``by`` in the order of md5(key, seed).

    Rows whose group is null are left out. ``size`` names a column for the number of rows in the group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = [by] if isinstance(by, str) else list(by)
    df = df.dropna(subset=by) if by else df
    hashed = df.withColumn("_h", row_hash(keys, seed))
    # One pass counts fine buckets; their sum tells how many digits are wanted, and their sums are the coarser counts.
    fine = cut_lineage(_bucket_counts(hashed.withColumn("_bucket", F.substring("_h", 1, COUNTED_DIGITS)), by))
    digits = hash_digits(fine.agg(F.sum("_n")).first()[0] or 0)
    spread = hashed.withColumn("_bucket", F.substring("_h", 1, digits))
    if digits > COUNTED_DIGITS:
        counts = _bucket_counts(spread, by)
    else:
        counts = fine.groupBy(*by, F.substring("_bucket", 1, digits).alias("_bucket")).agg(F.sum("_n").alias("_n"))
    return _from_buckets(spread, by, ["_h", *keys], out, size, counts)


def ordered_position(df: DataFrame, col: str, ties=(), out: str = "pos", size: str | None = None) -> DataFrame:
    """0-based position of each row in the order of a column with few repeats, such as a key; nulls come first.

    Works for any type that can be ordered: rows are dealt out by ranges and written once, so that counting and placing
    see the same ranges. The number of ranges grows with the rows.
    """
    parts = max(8, df.count() // ROWS_PER_BUCKET)
    dealt = df.repartitionByRange(parts, col, *ties).withColumn("_bucket", F.spark_partition_id())
    written = cut_lineage(dealt)
    return _from_buckets(written, [], [col, *ties], out, size, _bucket_counts(written, []))


def value_bounds(df: DataFrame, cols, buckets: int) -> dict[str, list[float]]:
    """Values that cut each column into about equal parts. At most ``buckets`` numbers per column."""
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10 * buckets).alias(c) for c in cols]).first()
    return {c: sorted({x for x in row[c] or [] if math.isfinite(x)}) for c in cols}


def _splits(bounds: list[float]) -> list[float]:
    return [float("-inf"), *(bounds or [0.0]), float("inf")]


def exact_quantiles(df: DataFrame, cols, probs) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, exact, as plain numbers.

    One pass counts the rows of every column's buckets, in each task before the shuffle. A second one counts the values of
    all buckets that hold a wanted rank, whatever their number; a bucket with too many rows is looked at by itself and cut further.
    """
    cols, probs = list(cols), list(probs)
    bounds = value_bounds(df, cols, max(8, min(4096, df.count() // ROWS_PER_BUCKET)))
    names = [f"_x{i}" for i in range(len(cols))]
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(n) for c, n in zip(cols, names)])
    marks = [f"_b{i}" for i in range(len(cols))]
    cut = Bucketizer(
        splitsArray=[_splits(bounds[c]) for c in cols], inputCols=names, outputCols=marks, handleInvalid="keep"
    ).transform(numbers)

    def long(*fields: str) -> DataFrame:
        cells = [F.struct(F.lit(i).alias("c"), F.when(F.col(n).isNotNull(), F.col(b)).alias("b"), F.col(n).alias("_value")) for i, (n, b) in enumerate(zip(names, marks))]
        return cut.select(F.inline(F.array(*cells))).where("b IS NOT NULL").select("c", "b", *fields)

    sizes: list[dict] = [{} for _ in cols]
    for r in long().groupBy("c", "b").count().collect():
        sizes[r["c"]][r["b"]] = r["count"]
    ranks, asked, large, at = [], [], [], [{} for _ in cols]
    for i, counts in enumerate(sizes):
        total = sum(counts.values())
        ranks.append([(math.floor(p * (total - 1)), math.ceil(p * (total - 1)), p * (total - 1)) for p in probs] if total else [])
        wanted = sorted({rank for lo, hi, _ in ranks[i] for rank in (lo, hi)})
        start = 0
        for b in sorted(counts):
            inside = [r - start for r in wanted if start <= r < start + counts[b]]
            if inside:
                (asked if counts[b] <= MAX_SORTED else large).append((i, b, start, inside))
            start += counts[b]
    if asked:
        buckets = F.broadcast(df.sparkSession.createDataFrame(asked, "c int, b double, start long, ranks array<long>"))
        counted = long("_value").join(buckets.select("c", "b"), ["c", "b"]).groupBy("c", "b", "_value").agg(F.count(F.lit(1)).alias("_n"))
        run = F.sum("_n").over(Window.partitionBy("c", "b").orderBy("_value"))  # MAX_SORTED rows at most
        hits = F.filter("ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))
        placed = counted.withColumn("_end", run).join(buckets, ["c", "b"])
        for r in placed.select("c", "start", "_value", F.explode(hits).alias("rank")).collect():
            at[r["c"]][r["start"] + r["rank"]] = r["_value"]

    def one(task: tuple) -> None:
        i, b, start, inside = task
        found = _values_at(numbers.select(F.col(names[i]).alias("_value")), _splits(bounds[cols[i]]), b, inside)
        at[i].update({r + start: v for r, v in found.items()})

    in_parallel(one, large)
    return {c: [own[lo] + (own[hi] - own[lo]) * (exact - lo) for lo, hi, exact in r] or [None for _ in probs] for c, r, own in zip(cols, ranks, at)}


def _values_at(values: DataFrame, splits: list[float], bucket: float, ranks: list[int]) -> dict[int, float]:
    """Value at each rank within one bucket between ``splits``."""
    low, high = splits[int(bucket)], splits[int(bucket) + 1]
    value = F.col("_value")
    rows = values.where((value >= low) & ((value <= high) if high == math.inf else (value < high)))
    return _ranked(rows.groupBy("_value").agg(F.count(F.lit(1)).alias("_n")), ranks)


def _ranked(counted: DataFrame, ranks: list[int]) -> dict[int, float]:
    """Value at each rank of a table of values and their numbers."""
    counted = counted.persist()
    try:
        distinct = counted.count()
        if distinct > MAX_SORTED:
            splits = _splits(value_bounds(counted, ["_value"], 256)["_value"])
            cut = Bucketizer(splits=splits, inputCol="_value", outputCol="_bucket").transform(counted)
            sizes = {r["_bucket"]: r["n"] for r in cut.groupBy("_bucket").agg(F.sum("_n").alias("n")).collect()}
            out, start = {}, 0
            for b in sorted(sizes):
                inside = [r - start for r in ranks if start <= r < start + sizes[b]]
                if inside:
                    part = cut.where(F.col("_bucket") == b).select("_value", "_n")
                    out |= {r + start: v for r, v in _ranked(part, inside).items()}
                start += sizes[b]
            return out
        run = F.sum("_n").over(Window.orderBy("_value"))  # MAX_SORTED rows at most
        hits = F.filter(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))
        found = counted.withColumn("_end", run).select("_value", F.explode(hits).alias("rank")).collect()
        return {r["rank"]: r["_value"] for r in found}
    finally:
        counted.unpersist()
