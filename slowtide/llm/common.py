"""Shared helpers: exact column picking, UTF-8 views of Arrow columns, bounded chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with columns in0__, in1__, .. and where each old name went.

    Names that differ only in case, or that an operator adds itself, can then not clash.
    """
    names = [f"in{i}__" for i in range(len(df.columns))]
    return df.toDF(*names), dict(reversed(list(zip(df.columns, names, strict=True))))


def pick(df: DataFrame, *wanted: str) -> DataFrame:
    """Only these columns, matched by exact name (the first one wins); all others are ignored."""
    plain, at = numbered(df)
    return plain.select(*[plain[at[name]].alias(name) for name in wanted])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and its n + 1 offsets. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, ends, content = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]] if content is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer row is a chunk of its own."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(n, max(start + 1, stop))
        yield start, stop
        start = stop


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` between consecutive offsets; integers stay exact."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def table(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of `schema` from arrays or lists by name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in columns.items()], schema=schema
    )
