"""Helpers about the running session: shared folder, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a new temporary folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="tabforge-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Loops call this once in a while, so that a lost executor replays one round and not all of them.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_parallel(fn: Callable, items: Sequence, threads: int = 4) -> list:
    """Results of ``fn`` for each item, in order. Each call starts its own Spark jobs; a few run at a time."""
    items = list(items)
    spark = SparkSession.getActiveSession()
    run = inheritable_thread_target(spark)(fn) if spark else fn
    with ThreadPoolExecutor(max(1, min(threads, len(items)))) as pool:
        return list(pool.map(run, items))


SMALL_TABLE_ROWS = 5_000_000
MAX_SMALL_PARTS = 24


def spread(df: DataFrame, rows: int, key: str | None = None) -> DataFrame:
    """Lay out training rows for an algorithm that passes over them many times.

    The number of parts follows from the rows alone, the place of a row from its key, without one from a hash of all its
    values (equal rows are alike). So a fit sees the same parts in the same order whatever the files and cores were.
    """
    parts = min(MAX_SMALL_PARTS, -(-rows // 5_000)) if rows <= SMALL_TABLE_ROWS else max(MAX_SMALL_PARTS, rows // 200_000)
    if key:
        return df.repartition(max(1, parts), key).sortWithinPartitions(key)
    marked = df.withColumn("_place", F.xxhash64(*df.columns))
    return marked.repartition(max(1, parts), "_place").sortWithinPartitions("_place").drop("_place")


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list:
    """Rows of a summary table that must be small; more than ``max_rows`` is an error, never a cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a per-group summary after counting it; a larger one stays a plain join side.

    The summary is read once, so the join sees a literal table and its size is known, not guessed.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
