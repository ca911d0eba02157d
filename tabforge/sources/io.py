"""Typed CSV scans, key checks, time parsing, Parquet cache, prediction sink (IO1-IO9)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_ROW = "_bad_row"


def read_csv(
    spark: SparkSession,
    path,
    schema,
    *,
    header: bool = True,
    on_bad: str = "null",
    ts_format: str | None = None,
) -> DataFrame:
    """Scan CSV files with a given schema.

    on_bad: ``null`` keeps a malformed row with null cells and its text in ``_bad_row``; ``drop`` leaves
    such rows out; ``fail`` stops the job. A row is malformed if any of its cells is, whichever columns are asked for
    later. With a header, each file's names must be the schema's, in order; other names stop the job.
    """
    if on_bad not in ("null", "drop", "fail"):
        raise ValueError("on_bad must be one of ['drop', 'fail', 'null']")
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("header", header).option("enforceSchema", not header).option("mode", "PERMISSIVE")
    if ts_format:
        reader = reader.option("timestampFormat", ts_format)
    reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    marked = reader.schema(T.StructType(st.fields + [T.StructField(BAD_ROW, T.StringType())])).csv(path)
    if on_bad == "null":
        return marked
    # A cell is only parsed if its column is asked for; a condition on all of them, which always holds, asks for them.
    every = F.xxhash64(*[f"`{f.name}`" for f in st.fields]) >= F.lit(-(2**63))
    whole = every & F.col(BAD_ROW).isNull()
    if on_bad == "fail":
        whole = whole | F.raise_error(F.concat(F.lit("malformed row: "), F.col(BAD_ROW))).cast("boolean")
    return marked.where(whole).drop(BAD_ROW)


def read_csv_named(spark: SparkSession, path, types: dict[str, str], **options) -> DataFrame:
    """Scan CSV files with types for some columns, found by their header; the others are text."""
    names = spark.read.csv(path, header=True).columns
    missing = [c for c in types if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {missing}")
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in names)
    return read_csv(spark, path, schema, **options)


def infer_csv_schema(spark: SparkSession, path, sampling: float = 1.0) -> T.StructType:
    """Schema of CSV files, found by reading a share of the rows. Fix it in code afterwards."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling).schema


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness or hold a null, with their row count."""
    key = [key] if isinstance(key, str) else list(key)
    has_null = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | has_null)
    )


def require_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` itself when ``key`` is unique and never null, else an error that shows examples."""
    bad = key_report(df, key).take(5)
    if bad:
        raise ValueError(f"{key} is not a key: {[r.asDict() for r in bad]}")
    return df


def parse_ts(c, formats: Sequence[str]) -> Column:
    """Timestamp from text by the first format that fits; null when none does."""
    text = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes null in the float columns, so that later aggregates skip it."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    picked = floats if cols is None else [c for c in cols if c in floats]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in picked})


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def inputs_fingerprint(spark: SparkSession, paths: Sequence[str], *params) -> str:
    """Digest of the input files' names, sizes and times and of the parameters used."""
    parts = []
    for p in paths:
        fs, jp = _fs(spark, p)
        for st in fs.globStatus(jp) or []:
            files = fs.listFiles(st.getPath(), True)  # folders below folders too
            while files.hasNext():
                f = files.next()
                parts.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.md5(repr((sorted(parts), params)).encode()).hexdigest()


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], fingerprint: str) -> DataFrame:
    """Table kept as Parquet below ``path``, built only when its inputs changed.

    The fingerprint is part of the folder name, and a folder counts only once its job was committed.
    """
    target = f"{path.rstrip('/')}/{fingerprint}"
    fs, done = _fs(spark, f"{target}/_SUCCESS")
    if not fs.exists(done):
        build().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_predictions(df: DataFrame, path: str, key: str, pred: str) -> None:
    """CSV files with header: the key and the predicted class as an integer."""
    df.select(key, F.col(pred).cast("int").alias(pred)).write.mode("errorifexists").csv(path, header=True)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Small table written in code. Its size is the length of ``rows``."""
    return spark.createDataFrame(list(rows), schema)


def soil_table(spark: SparkSession) -> DataFrame:
    """The 40 soil classes: code and description."""
    from tabforge.functions.fixed import SOIL_DESCRIPTIONS

    rows = [(int(code), text) for code, text in (s.split(" ", 1) for s in SOIL_DESCRIPTIONS.splitlines())]
    return literal_table(spark, rows, "code int, description string")


def cached_weights(spark: SparkSession, path: str, build: Callable[[], Mapping[str, float]], fingerprint: str) -> dict[str, float]:
    """Fitted weights by name, kept as a one-row table; built only when their inputs changed. Nulls come back as None."""

    def table() -> DataFrame:
        weights = {name: None if w is None else float(w) for name, w in build().items()}
        if not weights:
            raise ValueError("no weights to keep")
        return spark.createDataFrame([tuple(weights.values())], ", ".join(f"`{name}` double" for name in weights))

    return cached(spark, path, table, fingerprint).first().asDict()
