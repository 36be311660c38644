"""Shared helpers of the operators: table reading, staging and model broadcast."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from segmint.session import Stager

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation. The files
    go when the driver's Python process ends.
    """
    return Stager(df.sparkSession).stage(df, name)


class Memo(dict):
    """A memo of ``compute`` that holds at most two generations of ``limit`` entries.

    When the young generation is full it becomes the old one, and old entries that are asked
    for come back, so frequent keys stay. ``memo[key]`` computes what it does not hold.
    """

    def __init__(self, compute: Callable, limit: int):
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        return self.put(key, value)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


_FORGET: dict[str, Callable[[], None]] = {}


def only_memo(name: str, forget: Callable[[], None]) -> None:
    """Called where a task starts to use a process-wide memo: the memos of other operators in
    this (reused) worker process are dropped, so that only one of them takes memory."""
    for other, drop in _FORGET.items():
        if other != name:
            drop()
    _FORGET[name] = forget


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def list_array(parts: list[np.ndarray], value_type: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=value_type))


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` per slice (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(float)
        cuts = np.floor(np.cumsum(lengths) / max_bytes).astype(int)
        starts = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)
