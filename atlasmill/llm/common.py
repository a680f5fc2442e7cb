"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Bytes of text after which a Python worker gives back memory that it no longer uses.
TRIM_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower (never raise) the rows of an Arrow batch, as texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return freed memory of this process to the system: allocators keep it, and idle workers would hold it for all later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has one
    if trim:
        trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut Arrow batches into runs of rows with about ``limit`` bytes in ``column``; gives the texts as UTF-8 bytes.

    Freed memory is given back after every ``TRIM_BYTES`` of text and at the end.
    """
    since = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if since > TRIM_BYTES:
            give_back()
            since = 0
        raw = batch.column(column).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at), raw.slice(at, to - at).to_pylist()
            at = to
        since += int(ends[-1])
    give_back()


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns whose names an operator is about to use for its own results."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def text_key(col: str = "text"):
    """Hash of a text; null and empty texts have keys of their own."""
    return F.xxhash64(F.col(col), F.col(col).isNull())
