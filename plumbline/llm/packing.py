"""Packing: documents are concatenated and cut into windows of fixed length.

Two passes over written partitions. The first encodes each text once and writes, in the order of the input
partition, its ids and the tokens before it in that partition. The totals of the partitions, one number
each, give every partition its global offset by a prefix sum. The second pass adds the offset, cuts each
document at the window boundaries and returns its pieces. Nothing is sorted or shuffled, a task holds one
batch of documents, and only the last window may stay short.

Defined cases: a null or empty text is the end id alone; null ids and repeated rows are packed like any other
row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import binary, saved, table, texts
from plumbline.llm.tokens import encoder

WINDOW = 2048
END_ID = 1

_TOKENS = "doc_id long, part int, before long, n int, ids binary"
_PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,
    opens_window boolean, ends_document boolean"""


def encoded(documents: DataFrame, vocabulary: str, split: str | None, end_id: int) -> DataFrame:
    """First pass, written: ids of each document as unsigned 32-bit integers and the tokens before it in its part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, before = encoder(vocabulary, split), TaskContext.get().partitionId(), 0
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            ids = [own.encode(t) + end for t in texts(batch.column(1))]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + np.cumsum(n) - n),
                 pa.array(n.astype(np.int32)), binary(ids)], ["doc_id", "part", "before", "n", "ids"])
            before += int(n.sum())

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(rows.mapInArrow(encode, _TOKENS), "tokens")


def part_offsets(tokens: DataFrame) -> DataFrame:
    """Global offset of each part: prefix sums over one total per input partition."""
    spark = tokens.sparkSession
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total")).orderBy("part").collect()
    starts = accumulate((r["total"] for r in totals), initial=0)
    return spark.createDataFrame([(r["part"], s) for r, s in zip(totals, starts)], "part int, part_offset long")


def cut(tokens: DataFrame, window: int) -> DataFrame:
    """Second pass: the pieces of each document, and where each lies."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, first, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = ids.as_buffer()
                n, at = ids.size // 4, 0
                while at < n:
                    offset = (first + at) % window
                    length = min(n - at, window - offset)
                    crc = zlib.crc32(memoryview(ids)[4 * at : 4 * (at + length)])
                    out.append((doc, at, length, crc, n, (first + at) // window, offset, offset == 0, at + length == n))
                    at += length
            columns = list(zip(*out)) if out else [[] for _ in range(9)]
            kinds = [pa.int64()] * 7 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "opens_window",
                "ends_document"])

    offsets = F.broadcast(part_offsets(tokens))  # one row per input partition
    placed = tokens.join(offsets, "part").select("doc_id", (F.col("part_offset") + F.col("before")).alias("first"), "ids")
    return placed.mapInArrow(pieces, _PIECES)


def pack(
    documents: DataFrame, vocabulary: str, split: str | None, end_id: int = END_ID, window: int = WINDOW
) -> DataFrame:
    """Pieces of all documents. ``opens_window`` marks the boundary record of each window: the piece at its offset 0."""
    return cut(encoded(documents, vocabulary, split, end_id), window)


def windows(pieces: DataFrame) -> DataFrame:
    """Where each window begins: its first document, the position in that document, and the tokens it holds."""
    opening = F.when(F.col("opens_window"), F.struct("doc_id", "start"))
    return (
        pieces.groupBy("sequence_id")
        .agg(F.max(opening).alias("opening"), F.sum("length").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"))
        .select("sequence_id", "opening.doc_id", "opening.start", "n_tokens", "n_pieces")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), vocabulary, "words")
