"""Reading the corpus tables, storing intermediate tables, and blocks of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import prepare, scratch


BATCH_BYTES = str(8 << 20)  # what a Python worker is sent at a time, unless one row is larger


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a corpus table; further columns are never read."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    This cuts the lineage: what is read later does not depend on any executor's memory or disk.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose ``column`` holds about ``most_bytes`` at most.

    A single longer text makes a run of its own; no text is ever cut.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.diff(offsets(values))
        ends, start, total = [], 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > start and total + size > most_bytes:
                ends.append((start, row))
                start, total = row, 0
            total += size
        ends.append((start, batch.num_rows))
        for begin, end in ends:
            yield batch.slice(begin, end - begin)


def offsets(values: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array, by row."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    width = np.dtype("int64" if wide else "int32")
    raw = np.frombuffer(values.buffers()[1], width, count=values.offset + len(values) + 1)
    return raw[values.offset :].astype("int64")


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an array, end to end, and where each text starts and ends.

    A null counts as an empty text.
    """
    bounds = offsets(values)
    data = values.buffers()[2]
    if data is None:
        return np.zeros(0, "uint8"), bounds - bounds[0]
    whole = np.frombuffer(data, "uint8")[bounds[0] : bounds[-1]]
    return whole, bounds - bounds[0]
