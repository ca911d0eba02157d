"""Where query functions and their SQL twins are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The provided tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(key: str, sql: str | None = None):
    """Register a function of the tables under ``key``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def r6(c):
    """Rounded for comparison, because sums in another order differ in the last bits."""
    return F.round(c, 6)


# Unique text key of a line item; order and line number alone repeat.
LINE_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT))"
)

# Class to predict: band of the net price.
BAND = (
    "CASE WHEN l_extendedprice * (1 - l_discount) < 30000 THEN 0 "
    "WHEN l_extendedprice * (1 - l_discount) < 65000 THEN 1 ELSE 2 END"
)

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(t: Tables) -> DataFrame:
    """Line items with their key, four numbers and the class ``label``."""
    return t.lineitem.select(
        F.expr(LINE_ID).alias("line_id"), *LINE_FEATURES, F.expr(BAND).cast("int").alias("label")
    )


LINES_SQL = f"""lines AS (
  SELECT {LINE_ID} AS line_id, l_quantity, l_extendedprice, l_discount, l_tax,
         CAST({BAND} AS INTEGER) AS label
  FROM lineitem)"""


def part_sql(key: str, seed, frac_hex: str) -> str:
    """SQL condition of ``hashed_below``."""
    return f"substr(md5(concat_ws(':', {key}, '{seed}')), 1, 8) < '{frac_hex}'"
