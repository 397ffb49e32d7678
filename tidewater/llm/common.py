"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.session import materialise, shared_path

__all__ = ["materialise", "shared_path", "held", "small_batches", "columns", "type_of", "arrow_type", "chunks", "id_column"]

#: Text (in bytes) a worker turns into strings, words or numbers at once.  (Spark
#: itself hands a worker at most 64 MB or 10,000 rows at once, one row at least.)
CHUNK_BYTES = 2 << 20


_HELD: dict = {"key": None, "value": None}


def held(key, make):
    """What ``make()`` gives for ``key``, kept for the next batches.  A worker process
    serves one operator after the other and keeps the tables of one at a time."""
    if _HELD["key"] != key:
        _HELD.update(key=None, value=None)
        _HELD.update(value=make(), key=key)
    return _HELD["value"]


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand Python workers at most ``rows`` rows at once from now on (a session setting,
    read when a query starts): less memory on both sides for a little more overhead."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the named input columns, under fixed names, so that further columns
    of the input, whatever they are called, never clash with an operator's own."""
    return df.select(*(F.col(f"`{src}`").alias(dst) for dst, src in named.items()))


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return to_arrow_type(df.schema[name].dataType)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut record batches into pieces of about ``size`` bytes of text each (at least
    one row); yields the piece and its texts as Python strings."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, before + size, side="right")), start + 1)
            yield batch.slice(start, stop - start), column.slice(start, stop - start).to_pylist()
            start, before = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()  # the worker lives on for other tasks


def id_column(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
