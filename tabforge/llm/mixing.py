"""Mix sources to target weights: repeat each document floor(rate) times, plus one copy drawn by its hash.

The rate of a source is its target over its size. ``plan_mix`` says how often each document is taken and moves no text;
``mix`` writes the copies out. Draws are md5 of key and seed, so reruns and lost executors give the same mix.

Cases: a null text has size 0; a null source is a source of its own (last in order); a source without words has target
0 and takes no copy; rows that repeat a key are drawn alike; an empty table gives an empty plan. Columns of the input
pass through; one named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.words import word_count
from tabforge.runtime import broadcast_if_small, cut_lineage

DRAW_DIGITS = 13  # 52 bits, exact in a double


def uniform(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("double") / F.lit(float(16**DRAW_DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: float) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the size of all. No target is above
    ``max_repeat`` times its source's size. The excess is shared again by weight: in the order of cap over weight, a
    source is capped exactly if the level that it and all later ones could share reaches its cap, so running sums over
    the small table of sources replace repeated rounds.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    shares = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn("_weight", F.element_at(shares, F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    ratio = F.col("_cap") / F.col("_weight")
    before = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    levels = ranked.withColumn("_ratio", ratio).withColumn("_level", left / weight_left)
    capped = F.col("_ratio") <= F.col("_level")
    # Sources that are not capped share one level: that of the first of them.
    level = F.min(F.when(~capped, F.struct("_ratio", "_level"))).over(every).getField("_level")
    return levels.withColumn("target", F.when(capped, F.col("_cap")).otherwise(F.col("_weight") * level)).select(
        "source", "source_size", "target"
    )


def _with_copies(rows: DataFrame, sums: DataFrame, key, source, weights, max_repeat, seed) -> DataFrame:
    targets = source_targets(sums, weights, max_repeat).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = F.floor("rate") + F.when(uniform(key, seed) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    joined = rows.join(broadcast_if_small(targets), F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
    return joined.withColumn("rate", rate).withColumn("copies", F.least(drawn, F.lit(max_repeat)).cast("int"))


def _sums(sized: DataFrame, source: str) -> DataFrame:
    return sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))


def plan_mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    seed: int = 42,
) -> DataFrame:
    """Every document of ``df`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``; texts stay behind.

    Texts are read once: the sizes go to the shared folder as a narrow table. They are summed per source before the
    shuffle, so a source with a third of all rows is one row per task. The summary has one row per source; it is
    broadcast after its rows were counted, and beyond that limit it joins by shuffle.
    """
    made = {"size", "source_size", "target", "rate", "copies"}
    rest = [f"`{c}`" for c in df.columns if c not in made and c != text]
    sized = cut_lineage(df.withColumn("size", word_count(text)).select(*rest, "size"))
    return _with_copies(sized, _sums(sized, source), key, source, weights, max_repeat, seed)


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    seed: int = 42,
    copy: str | None = None,
) -> DataFrame:
    """The documents themselves, each as often as it is taken; ``copy`` names a column for the copy's number from 0.

    Texts are read twice, for the sizes and for the copies, and are not shuffled.
    """
    columns = [f"`{c}`" for c in df.columns]
    sums = _sums(df.select(F.col(source), word_count(text).alias("size")), source)
    rows = df.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_from"))
    drawn = _with_copies(rows, sums, "_key", "_from", weights, max_repeat, seed)
    rows = drawn.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("_copy"))
    return rows.select("_row.*", F.col("_copy").alias(copy)) if copy else rows.select("_row.*")
