"""Whole-number vectors for the embedding operators: cleaned in DataFrame functions, packed for numpy."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) of every component."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def _within(vector: Column, limit: float) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < limit, F.lit(False)))


def dimension_of(rows: DataFrame, vector: str) -> int:
    """The length of the longest vector without null or non-finite components, 0 without any."""
    return rows.filter(_within(F.col(vector), float("inf"))).agg(F.max(F.size(vector))).first()[0] or 0


def usable(vector: Column, dimension: int, scale: int = SCALE) -> Column:
    """Whether a vector is there, and all its components are finite and small enough.

    Small enough means that inner products and squares of `dimension` scaled components fit a long.
    """
    return _within(vector, float(isqrt(2**61 // max(1, dimension))) / scale)


def pack(rows: DataFrame, vector: str, dimension: int) -> DataFrame:
    """The vector column of whole numbers as bytes of 32-bit numbers, shorter vectors filled up with zeros."""
    others = [f for f in rows.schema.fields if f.name != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(others))
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            out = np.zeros((batch.num_rows, dimension), "<i4")
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out[np.repeat(np.arange(batch.num_rows), sizes), at] = lists.flatten().to_numpy()
            packed = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], [*[f.name for f in others], vector])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], f"`{vector}` binary"])
    return rows.select(*[f"`{f.name}`" for f in others], vector).mapInArrow(run, schema)


def unpack(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """The rows of a packed column as 64-bit whole numbers."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<i4").reshape(len(column), dimension).astype(np.int64)
