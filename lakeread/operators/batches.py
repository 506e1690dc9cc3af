"""Handing rows over as Arrow batches of a fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _filled(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in batches of just that size, but for the last; Spark's own may be smaller or larger."""
    held, rows = [], 0
    for batch in batches:
        while rows + batch.num_rows >= size:
            held.append(batch.slice(0, size - rows))
            batch, rows = batch.slice(size - rows), 0
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _each_batch(df: DataFrame, fetch_size: int, made: Callable[[pa.RecordBatch], object], schema: str) -> DataFrame:
    """One row of one column for each batch of each partition."""
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    name = schema.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (pa.RecordBatch.from_struct_array(b.column(0)) for b in batches if b.num_rows)
        for batch in _filled(rows, fetch_size):
            yield pa.RecordBatch.from_arrays([pa.array([made(batch)])], [name])

    return packed.mapInArrow(run, schema)


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def serialized(df: DataFrame, fetch_size: int = 4096) -> DataFrame:
    """(stream): the rows as Arrow streams of one batch each, made where the partitions are."""
    return _each_batch(df, fetch_size, _stream, "stream binary")


def arrow_batches(df: DataFrame, fetch_size: int = 4096) -> Iterator[pa.RecordBatch]:
    """All rows as record batches of fetch_size (the last of a partition may hold fewer), one partition at a time."""
    for row in serialized(df, fetch_size).toLocalIterator():
        yield from pa.ipc.open_stream(row["stream"])


def batch_sizes(df: DataFrame, fetch_size: int = 4096) -> DataFrame:
    """(rows long): for each batch that arrow_batches() gives, how many rows it holds; counted where the partitions are."""
    return _each_batch(df, fetch_size, lambda batch: batch.num_rows, "rows long")
