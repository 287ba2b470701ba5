"""Vectors of a table as rows of integers, and the length that counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import binary, saved

LARGEST = 2**15  # components beyond count as this, so that sums of squares of scaled ones fit in 64 bits


def finite(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix of doubles) of the vectors that are not null and hold only finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    length = at[1:] - at[:-1]
    good = column.is_valid().to_numpy(zero_copy_only=False) & (length > 0) & (bad[at[1:]] == bad[at[:-1]])
    for dim in np.unique(length[good]).tolist():
        rows = np.flatnonzero(good & (length == dim))
        yield dim, rows, values[at[rows][:, None] + np.arange(dim)]


def integers(matrix: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * component) as 32-bit integers; components beyond LARGEST count as LARGEST."""
    return np.floor(np.clip(matrix, -LARGEST, LARGEST) * scale).astype("<i4")


def integer_rows(embeddings: DataFrame, scale: int, columns: Sequence[str]) -> DataFrame:
    """The given columns, ``dim`` and ``vector`` (32-bit integers) of the usable vectors, written."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, matrix in finite(batch.column("embedding")):
                own = batch.select(list(columns)).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(len(rows), dim), pa.int32()),
                     binary([v.tobytes() for v in integers(matrix, scale)])], [*columns, "dim", "vector"])

    rows = embeddings.select(*columns, "embedding").withColumns({
        "vec_id": F.col("vec_id").cast("long"), "embedding": F.col("embedding").cast("array<double>")})
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return saved(rows.mapInArrow(convert, f"{kinds}, dim int, vector binary"), "integers")


def as_matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of 64-bit integers."""
    return np.stack([np.frombuffer(v.as_buffer(), "<i4") for v in column]).astype(np.int64)


def commonest_length(rows: DataFrame) -> int | None:
    """The most frequent ``dim``, of equally frequent ones the largest; None without rows."""
    top = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    return top[0]["dim"] if top else None
