"""Token-ID files: patched frame-of-reference blocks with an index of block starts.

A shard file holds the ids of neighbouring documents in ascending id order:

    header   8 bytes "PFORIDS1", then five unsigned 64-bit integers: shard number, documents, ids, ids per
             block, bytes of all blocks
    blocks   each: minimum (uint32), width in bits (uint8), number of exceptions (uint16); the low ``width``
             bits of each id minus the minimum, packed from the lowest bit of 64-bit words; the positions of
             the exceptions (uint16 each), their high parts (uint32 each)
    index    byte offset of each block after the header (uint64 each)
    documents  document id (int64 each), then the position of its first id in the shard (uint64 each)
    one line feed, which the writer adds

The width of a block is the bit length of a percentile of its values, so a few large ids do not widen the
rest. All integers are little-endian. Files are written through the task committer of Spark's text writer,
one row per file: a lost executor leaves no half file, and any file system Spark knows will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.llm.common import binary, new_path, table, texts
from plumbline.llm.tokens import encoder

MAGIC = b"PFORIDS1"
BLOCK = 1024  # ids per block, a multiple of 64
PERCENTILE = 0.95  # share of a block's ids that fit its width
SHARD_IDS = 1_000_000  # a shard ends with the document that reaches this many ids
END_ID = 2

_HEADER = "<8s5Q"
_BLOCK = "<IBH"
_HEADER_SIZE, _BLOCK_SIZE = struct.calcsize(_HEADER), struct.calcsize(_BLOCK)


# ---------------------------------------------------------------- one shard


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, packed into 64-bit words; all 64 values of a group take ``width`` words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T)
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return words.T.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int, block: int) -> np.ndarray:
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    values = np.empty((64, lanes.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        v = lanes[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (lanes[word + 1] << np.uint64(64 - shift))
        values[j] = v & mask
    return values.T.reshape(len(words), block)


def encode_shard(number: int, doc_ids: list[int], lengths: list[int], ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The file of one shard, without the line feed at its end."""
    n = len(ids)
    padded = np.empty(-(-n // block) * block, np.uint32)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0  # a copy of the last id never widens a block
    rows = padded.reshape(-1, block)
    low = rows.min(axis=1) if n else np.zeros(0, np.uint32)
    values = (rows - low[:, None]).astype(np.uint64)
    at = min(block - 1, int(PERCENTILE * block))
    typical = np.partition(values, at, axis=1)[:, at] if n else np.zeros(0, np.uint64)
    widths = np.frexp(typical.astype(np.float64))[1].astype(np.int64)  # bit length; 0 where all are the minimum
    parts: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        which = np.flatnonzero(widths == width)
        own = values[which]
        packed = _pack(own & np.uint64((1 << width) - 1), width) if width else None
        high = (own >> np.uint64(width)).astype(np.uint32)
        for k, b in enumerate(which.tolist()):
            where = np.flatnonzero(high[k])
            parts[b] = b"".join([
                struct.pack(_BLOCK, int(low[b]), width, len(where)), packed[k].tobytes() if width else b"",
                where.astype("<u2").tobytes(), high[k][where].astype("<u4").tobytes()])
    sizes = np.array([len(p) for p in parts], np.uint64)
    firsts = np.cumsum([0, *lengths[:-1]]) if lengths else []
    return b"".join([
        struct.pack(_HEADER, MAGIC, number, len(doc_ids), n, block, int(sizes.sum())), *parts,
        (np.cumsum(sizes) - sizes).astype("<u8").tobytes(), np.array(doc_ids, "<i8").tobytes(),
        np.array(firsts, "<u8").tobytes()])


class Shard:
    """A file read back. Any range of ids decodes only the blocks that hold it."""

    def __init__(self, content):
        self._content = memoryview(content)
        magic, self.number, self.n_docs, self.n_ids, self.block, size = struct.unpack_from(_HEADER, self._content)
        if magic != MAGIC:
            raise ValueError("not a token-ID file")
        at, n_blocks = _HEADER_SIZE + size, -(-self.n_ids // self.block)
        self.block_starts = np.frombuffer(self._content, "<u8", n_blocks, at)
        self.doc_ids = np.frombuffer(self._content, "<i8", self.n_docs, at + 8 * n_blocks)
        self.firsts = np.frombuffer(self._content, "<u8", self.n_docs, at + 8 * (n_blocks + self.n_docs))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids at positions start..stop of the shard."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block + 1
        heads = [struct.unpack_from(_BLOCK, self._content, _HEADER_SIZE + int(s)) for s in self.block_starts[first:last]]
        out = np.empty((last - first, self.block), np.uint32)
        widths = np.array([w for _, w, _ in heads])
        for width in np.unique(widths).tolist():
            which = np.flatnonzero(widths == width)
            words = self.block // 64 * width
            at = [_HEADER_SIZE + int(self.block_starts[first + k]) + _BLOCK_SIZE for k in which]
            packed = np.stack([np.frombuffer(self._content, "<u8", words, a) for a in at])
            values = _unpack(packed, width, self.block) if width else np.zeros((len(which), self.block), np.uint64)
            for k, a, v in zip(which.tolist(), at, values):
                low, _, n = heads[k]
                if n:
                    where = np.frombuffer(self._content, "<u2", n, a + 8 * words)
                    v[where] |= np.frombuffer(self._content, "<u4", n, a + 8 * words + 2 * n).astype(np.uint64) << np.uint64(width)
                out[k] = (v + np.uint64(low)).astype(np.uint32)
        return out.reshape(-1)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        stop = int(self.firsts[k + 1]) if k + 1 < self.n_docs else self.n_ids
        return self.ids(int(self.firsts[k]), stop)


# ---------------------------------------------------------------- whole tables


def ranges(ids: DataFrame) -> tuple[int, Column]:
    """Number of ranges of about equal numbers of ids, and the range of a row, from a pass over the ids alone.

    Spark's own range partitioning would read all texts once more for its sample.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("cuts")).first()["cuts"] if shares else None
    if not cuts:
        return 1, F.lit(0)
    above = F.filter(F.expr(f"array({', '.join(f'{c}L' for c in cuts)})"), lambda c: c < F.col("doc_id"))
    return parts, F.size(above)


def write(
    documents: DataFrame, path: str, vocabulary: str, split: str | None, end_id: int = END_ID, block: int = BLOCK,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode texts and write shard files in ascending document order; folder names sort in that order."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(vocabulary, split), np.uint32(end_id).tobytes()
        part, count = TaskContext.get().partitionId(), 0
        docs: list[int] = []
        found: list[bytes] = []
        size = 0

        def file() -> pa.RecordBatch:
            number = (part << 32) | count
            ids = np.frombuffer(b"".join(found), "<u4")
            content = encode_shard(number, docs, [len(x) // 4 for x in found], ids, block)
            return pa.RecordBatch.from_arrays([pa.array([f"{number:016x}"]), binary([content])], ["shard", "value"])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), own.encode_all(texts(batch.column(1)))):
                docs.append(doc)
                found.append(ids + end)
                size += len(found[-1]) // 4
                if size >= shard_ids:
                    yield file()
                    docs, found, size, count = [], [], 0, count + 1
        if docs:
            yield file()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("doc_id IS NOT NULL")
    parts, place = ranges(rows.select("doc_id"))
    ordered = rows.repartitionById(parts, place).sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(shards, "shard string, value binary")
    files.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, ids before it, number of ids, checksum of its ids."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_buffer())
                ids = np.ascontiguousarray(shard.ids(), "<u4")
                bounds = [*shard.firsts.tolist(), shard.n_ids]
                data = memoryview(ids).cast("B")
                crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(shard.n_docs, shard.number, np.int64)), pa.array(shard.doc_ids),
                     pa.array(shard.firsts.astype(np.int64)), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.array(crcs, pa.int64())], ["shard", "doc_id", "first", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    heads = files.select(F.substring("content", 1, _HEADER_SIZE).alias("head")).collect()  # one row per file
    sizes = sorted((number, n) for _, number, _, n, _, _ in (struct.unpack(_HEADER, r["head"]) for r in heads))
    starts = accumulate((n for _, n in sizes), initial=0)
    offsets = spark.createDataFrame([(number, s) for (number, _), s in zip(sizes, starts)], "shard long, shard_start long")
    found = files.mapInArrow(documents, "shard long, doc_id long, first long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_files(
    documents: DataFrame, path: str, vocabulary: str, split: str | None, end_id: int = END_ID, block: int = BLOCK
) -> DataFrame:
    """Encode, write the files below ``path`` and read them back.

    Defined cases: a null or empty text is the end id alone; rows without a document id have no place in the
    order and are left out; rows with the same id are ordered by their texts; an empty table gives no file.
    """
    write(documents, path, vocabulary, split, end_id, block)
    return read(documents.sparkSession, path)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(table(spark, sf_dir, "documents"), new_path(spark, "token-files"), vocabulary, "byte_level")
