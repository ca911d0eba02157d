"""Token counts of whole texts: batches of about equal bytes, encoded in Arrow functions that return lengths only.

Cases: a null text counts as empty, 0 bytes and 0 tokens; long texts are cut at spaces, where no token crosses; rows
repeat as given; an empty table gives an empty result. Only the key is passed on beside the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from tabforge.llm.vocab import TokenCounter

_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str) -> TokenCounter:
    """One per worker process, so that pieces seen in one task are known in the next."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(df: DataFrame, vocabulary: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row. ``vocabulary`` is a path on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            n = counter.counts([t or "" for t in texts.to_pylist()])
            arrays = [batch.column(0), sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(f"`{key}`", f"`{text}`").mapInArrow(
        count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
