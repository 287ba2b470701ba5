"""Helpers that the operators share: tables, intermediate tables, Arrow columns."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def code_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it (a path they share, or a local session)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    code_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return "file://" + os.path.abspath(tempfile.mkdtemp(prefix="llm-"))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only in a local session without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it outlives executors, and its plan is a scan.

    Only one attempt of a task is committed, so rows that depend on the layout of a run are fixed by it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


HEAVY = 1024


def joined_to_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows with the values of their group, from a table with one row per key and its number of rows ``n``.

    Keys with more than one in HEAVY of all rows, so fewer than HEAVY keys, are broadcast; only rows of the others are
    shuffled. A null key is a key. Both tables are read twice.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    named = groups.withColumnRenamed(key, "__key")
    heavy = named.filter(F.col("n") * HEAVY > total)
    same = F.col(key).eqNullSafe(F.col("__key"))
    common = rows.join(F.broadcast(heavy), same)
    others = rows.join(F.broadcast(heavy.select("__key")), same, "left_anti").join(
        named.filter(F.col("n") * HEAVY <= total), same)
    return common.unionByName(others).drop("__key", "n")


def frequent_values(df: DataFrame, column: str, most: int = 256, counters: int = 8192) -> DataFrame:
    """The frequent values of a column of whole numbers, at most ``most`` rows, written: from a sketch of fixed size.

    A value in more than about one in 1,200 rows is among them.
    """
    top = df.select(F.expr(f"approx_top_k(`{column}`, {most}, {counters})").alias("top"))
    return saved(top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(column)), "frequent")


def text_bytes(column: pa.Array) -> Iterator[memoryview | None]:
    """UTF-8 bytes of a string or binary column, without decoding or copying; None where null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    valid, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    view = memoryview(data) if data is not None else memoryview(b"")
    nulls = column.is_null().to_pylist() if column.null_count else None
    at = starts.tolist() if len(column) else []
    for i in range(len(column)):
        yield None if nulls and nulls[i] else view[at[i] : at[i + 1]]


def texts(column: pa.Array) -> Iterator[str]:
    """Texts of a column; a null is the empty text, and bytes that are no UTF-8 become U+FFFD."""
    for b in text_bytes(column):
        yield "" if b is None else str(b, "utf-8", "replace")


def binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())
