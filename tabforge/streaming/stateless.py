"""Row-wise operators and fitted models applied to files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabforge.runtime import new_path


def score_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    apply: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Read new files of ``source``, apply a projection such as ``model.transform``, append to ``target``.

    Works off what is there and ends; started again with the same checkpoint it takes only new files, and
    each row is written exactly once.
    """
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    return (
        apply(rows)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint or new_path(spark, "stream"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
