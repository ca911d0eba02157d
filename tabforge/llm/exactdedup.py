"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

Texts are equal when identical after each run of blanks became one space; null counts as empty. Only rows whose length
and prefix occur more than once get the full hash, and only they are shuffled by it. All steps are DataFrame functions.

Cases: empty and null texts form one group; of equal texts the row with the smallest key stays, null keys last; of rows
that repeat both key and text exactly one stays; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.words import one_space
from tabforge.runtime import cut_lineage

PREFIX_CHARS = 64
#: Groups of equal (length, prefix) are named to the second reading by bucket numbers, so what is broadcast is at most
#: this many integers whatever the input. Full buckets only mean that more rows get the full hash.
BUCKETS = 1 << 20


def _prefix_keys(norm: Column) -> list[Column]:
    return [F.octet_length(norm).alias("_len"), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("_prefix")]


def _bucket(length, prefix) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(BUCKETS)).cast("int")


def _suspects(df: DataFrame, text: str) -> DataFrame:
    """Buckets that hold a (length, prefix) of more than one row. At most BUCKETS rows.

    Equal rows are counted in each task before the shuffle. A length that occurs once is dropped before prefixes are
    compared.
    """
    counts = df.select(*_prefix_keys(one_space(text))).groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    lengths = counts.groupBy("_len").agg(F.sum("_n").alias("_rows")).where("_rows > 1").select("_len")
    shared = counts.where("_n > 1").join(lengths, "_len", "left_semi")
    return shared.select(_bucket(F.col("_len"), F.col("_prefix")).alias("_bucket")).distinct()


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_full``: the full hash of rows whose length and prefix recur, null for all others."""
    norm = one_space(text)
    length, prefix = _prefix_keys(norm)
    found = F.broadcast(_suspects(df, text).withColumn("_hit", F.lit(True)))
    marked = df.withColumn("_bucket", _bucket(length, prefix)).join(found, "_bucket", "left")
    return marked.withColumn("_full", F.when(F.col("_hit"), F.sha2(norm, 256))).drop("_bucket", "_hit")


def mark_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """A row for each row of ``df``: key, the carried columns, ``keep_id``, ``group_size`` and ``kept``.

    ``carry`` names columns to keep beside the key, none by default. What is carried is written once to the shared
    folder and then joined by full hash to the groups, so carry digests and not texts. Rows without a full hash spread
    over all tasks by a hash of their own, and a group of copies of any size is one row per task before the shuffle;
    its rows meet the summary in a join that Spark splits when one hash is much more frequent than others.
    """
    carry = [c for c in (carry or []) if c not in (key, "keep_id", "group_size", "kept")]
    columns = [f"`{c}`" for c in (key, *carry)]
    rows = cut_lineage(_hashed(df, text).select(*columns, "_full").withColumn("_row", F.monotonically_increasing_id()))
    # Smallest key, null last; among equal keys the first written row.
    order = F.struct(F.col(key).isNull(), F.col(key).alias("_key"), F.col("_row"))
    groups = rows.where("_full IS NOT NULL").groupBy("_full").agg(F.min(order).alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = cut_lineage(groups.withColumnRenamed("_full", "_group"))
    alone = F.concat(F.lit("row "), F.col("_row"))
    joined = rows.withColumn("_at", F.coalesce("_full", alone)).join(groups, F.col("_at") == F.col("_group"), "left")
    known = F.col("_group").isNotNull()
    return joined.select(
        *columns,
        F.when(known, F.col("_keep._key")).otherwise(F.col(key)).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (~known | (F.col("_keep._row") == F.col("_row"))).alias("kept"),
    )


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Rows whose length and prefix occur once stay where they are. The others are reduced to one row per full hash, in
    each task before the shuffle, so no group is ever gathered.
    """
    rows = F.struct(*[f"`{c}`" for c in df.columns]).alias("_all")
    hashed = _hashed(df.select(rows, F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    order = F.struct(F.col("_key").isNull(), F.col("_key"), F.xxhash64("_all"))
    kept = hashed.where("_full IS NOT NULL").groupBy("_full").agg(F.min_by("_all", order).alias("_all"))
    return hashed.where("_full IS NULL").select("_all.*").unionByName(kept.select("_all.*"))
