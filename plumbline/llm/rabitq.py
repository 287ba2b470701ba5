"""Near-duplicate embeddings by randomised-rotation binary codes with stored correction factors.

Equal vectors of a label are one class. A class's vector of unit length is rotated at random; the signs are its
code, and the inner product of code and vector is the correction factor that makes the estimate of an inner
product from a code unbiased. Stretches of the codes of a few rotations are bucket keys, enough of them that a
pair at the threshold misses all with a probability of at most MISS. Within a bucket every pair gets an
estimate from one code and the other vector in four bits (population counts); pairs whose confidence bound
stays below the threshold are dropped, all others are recomputed in double precision. A pair belongs to the
first bucket its members share, so it counts once.

A bucket above BLOCK members is dealt out in blocks and every two blocks meet in one group, so no task holds
more than two blocks. Groups give back sums of links and a spanning forest, never the pairs.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, a null label or a null
id links with nothing; vectors of different lengths do not link; rows that share an id count as separate
vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import binary, saved, table
from plumbline.llm.components import components

THRESHOLD = 0.98
MISS = 1e-6
BLOCK = 1024
SURE = 4.0  # confidence bounds in the error's scale: beyond it one pair in many thousands errs
PLANES = 4  # bits of the other vector in an estimate


# ---------------------------------------------------------------- codes


@functools.cache
def rotation(dim: int, number: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the first rotation (rows of 64-bit words) and the correction factors."""
    turned = unit @ rotation(unit.shape[1], 0)
    return _words(turned > 0), np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def estimates(codes: np.ndarray, factors: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of all inner products of coded rows with vectors, and the bound of their errors."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, 0)
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-30)
    levels = np.rint((turned - low) / step).astype(np.uint8)
    weighted = np.zeros((len(codes), len(unit)), np.int64)
    for j in range(PLANES):
        plane = _words((levels >> j) & 1)
        for w in range(codes.shape[1]):
            weighted += np.bitwise_count(codes[:, None, w] & plane[None, :, w]).astype(np.int64) << j
    ones = np.bitwise_count(codes).sum(axis=1).astype(np.int64)[:, None]
    product = (2 * (low.T * ones + step.T * weighted) - turned.sum(axis=1)[None, :]) / math.sqrt(dim)
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / math.sqrt(dim - 1) if dim > 1 else np.full(len(codes), np.inf)
    bound = SURE * (spread[:, None] + step.T / math.sqrt(12)) / factors[:, None]
    return product / factors[:, None], bound


def band_plan(largest: int, dim: int) -> tuple[int, int]:
    """Bits and number of bands: buckets of some tens in the largest label, misses below MISS at the threshold."""
    bits = int(np.clip(math.ceil(math.log2(max(largest, 1) / 32)), 4, 60))
    hit = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - hit))


def band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """One 64-bit number per band: its stretch of the sign bits of the rotations, one after the other."""
    dim = unit.shape[1]
    signs = np.hstack([unit @ rotation(dim, t) > 0 for t in range(-(-bits * bands // dim))])[:, : bits * bands]
    weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    values = (signs.reshape(len(unit), bands, bits) * weights).sum(axis=2, dtype=np.uint64)
    return values.astype(np.int64)


# ---------------------------------------------------------------- on tables


def vectors(embeddings: DataFrame) -> DataFrame:
    """Per row, written: id, label, fingerprint and doubles of a vector that can link, else nulls."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, data, dims = [], [], []
            for vec_id, label, v in zip(batch.column(0), batch.column(1), batch.column(2)):
                x = None
                if vec_id.is_valid and label.is_valid and v.is_valid and v.values.null_count == 0 and len(v.values):
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zero
                    if not (np.isfinite(x).all() and x.any()):
                        x = None
                data.append(None if x is None else x.tobytes())
                prints.append(None if x is None else hashlib.blake2b(data[-1], digest_size=16).digest())
                dims.append(None if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), binary(prints), pa.array(dims, pa.int32()), binary(data)],
                ["vec_id", "label", "print", "dim", "vector"])

    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return saved(
        rows.mapInArrow(check, "vec_id long, label string, print binary, dim int, vector binary"), "vectors")


def _units(column: pa.Array) -> np.ndarray:
    x = np.stack([np.frombuffer(v.as_buffer()) for v in column])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def coded(classes: DataFrame, plan: dict[int, tuple[int, int]]) -> DataFrame:
    """Per class, written: code, correction factor, and bucket keys of its label and length."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                unit = _units(rows.column("vector"))
                codes, factors = encode(unit)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in ("node", "n", "label", "dim", "vector")],
                     binary([c.tobytes() for c in codes]), pa.array(factors),
                     pa.array(list(band_keys(unit, *plan[dim])), pa.list_(pa.int64()))],
                    ["node", "n", "label", "dim", "vector", "code", "factor", "bands"])

    return saved(classes.mapInArrow(
        code, "node long, n long, label string, dim int, vector binary, code binary, factor double, bands array<long>"), "codes")


def _links_of(ids: np.ndarray, n: np.ndarray, vector: pa.Array, codes, factors, bands, band: int, blocks, one: bool):
    """Links of one group: (node, links added, smallest node of its tree in this group)."""
    unit = _units(vector)
    first = np.flatnonzero(blocks == blocks.min()) if not one else np.arange(len(ids))
    second = np.flatnonzero(blocks != blocks.min()) if not one else first
    if not len(second):
        return []
    estimate, bound = estimates(codes[first], factors[first], unit[second])
    i, j = np.nonzero(estimate + bound >= THRESHOLD)
    a, b = first[i], second[j]
    if one:
        a, b = a[a < b], b[a < b]
    linked = np.zeros(len(a), bool)
    for at in range(0, len(a), 65_536):  # exact products and owners of the pairs that are left, in pieces
        x, y = a[at : at + 65_536], b[at : at + 65_536]
        exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= THRESHOLD
        owner = (bands[x] == bands[y]).argmax(axis=1) == band
        linked[at : at + 65_536] = exact & owner
    a, b = a[linked], b[linked]
    if not len(a):
        return []
    links = np.bincount(a, n[b], len(ids)) + np.bincount(b, n[a], len(ids))
    tree = ids.copy()
    while True:
        low = np.minimum(tree[a], tree[b])
        before = tree.copy()
        np.minimum.at(tree, a, low)
        np.minimum.at(tree, b, low)
        if (tree == before).all():
            break
    hit = links > 0
    return zip(ids[hit].tolist(), links[hit].astype(np.int64).tolist(), tree[hit].tolist())


def linked(codes: DataFrame) -> DataFrame:
    """(node, links, tree), written: links found in each group, and a node of the same component."""
    narrow = codes.select(
        "node", F.posexplode("bands").alias("band", "bits"), "label", "dim").select(
        "node", "band", F.struct("label", "dim", "band", "bits").alias("bucket"))
    crowded = narrow.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        narrow.join(crowded, "bucket").withColumn("block", own).withColumn("other", meets)
        .select("node", "band", "bucket", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            group = held.column("group").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            if len(edges) > 1:
                yield _compared(held.slice(0, edges[-1]), edges[:-1].tolist() + [int(edges[-1])])
                held = held.slice(edges[-1])
        if held is not None and len(held):
            yield _compared(held, [0, len(held)])

    rows = dealt.join(codes.select("node", "n", "vector", "code", "factor", "bands"), "node").withColumn(
        "group", F.xxhash64("bucket", "p", "q"))
    ordered = rows.repartition("group").sortWithinPartitions("group", "bucket", "p", "q").select(
        "group", "node", "n", "vector", "code", "factor", "bands", "band", "block", "p", "q",
        F.col("bucket.bits").alias("bits"), F.col("bucket.label").alias("label"), F.col("bucket.dim").alias("dim"))
    return saved(ordered.mapInArrow(compare, "node long, links long, tree long"), "links")


def _compared(rows: pa.Table, edges: list[int]) -> pa.RecordBatch:
    """Compare each stretch of rows between two edges; rows of one group number but another bucket stay apart."""
    rows = rows.combine_chunks()
    column = {c: rows.column(c).chunk(0) if len(rows) else rows.column(c) for c in rows.column_names}
    out: list[tuple] = []
    plain = {c: column[c].to_numpy() for c in ("node", "n", "factor", "band", "block", "p", "q", "dim", "bits")}
    labels = np.array(column["label"].to_pylist(), object)
    for start, end in zip(edges, edges[1:]):
        members = np.arange(start, end)
        keys = list(zip(plain["band"][members], plain["bits"][members], plain["dim"][members], labels[members], plain["p"][members], plain["q"][members]))
        for key in dict.fromkeys(keys):  # one, but for colliding group numbers
            at = members if keys.count(key) == len(keys) else members[[k == key for k in keys]]
            if len(at) < 2:
                continue
            take = pa.array(at)
            codes = np.stack([np.frombuffer(c.as_buffer(), np.uint64) for c in column["code"].take(take)])
            bands = np.stack([b.values.to_numpy() for b in column["bands"].take(take)])
            out += _links_of(
                plain["node"][at], plain["n"][at], column["vector"].take(take), codes, plain["factor"][at], bands,
                int(key[0]), plain["block"][at], bool(key[4] == key[5]))
    columns = list(zip(*out)) if out else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "tree"])


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    rows = vectors(embeddings)
    classes = saved(
        rows.filter("print IS NOT NULL").groupBy("label", "dim", "print")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector")), "classes")
    # One row per label and length comes together by partial sums; the driver gets one row per length.
    sizes = classes.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("largest")).collect()
    plan = {r["dim"]: band_plan(r["largest"], r["dim"]) for r in sizes}
    found = linked(coded(classes, plan))
    tree = components(found.select(F.col("node").alias("a"), F.col("tree").alias("b")))
    told = (
        classes.select("label", "dim", "print", "node", "n")
        .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(tree, "node", "left")
        .select("label", "dim", "print", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("class_links"),
                F.coalesce("component", "node").alias("component")))
    return (
        rows.select("vec_id", "label", "dim", "print").join(told, ["label", "dim", "print"], "left")
        .select("vec_id", F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op8_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP8_SQL = f"""
WITH RECURSIVE fine AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_sum(list_transform(embedding, lambda x: CAST(coalesce(isfinite(x), FALSE) AS INTEGER))) = len(embedding)
    AND list_sum(list_transform(embedding, lambda x: CAST(x <> 0 AS INTEGER))) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), told AS (
  SELECT a, min(b) AS c FROM reach GROUP BY a
), degrees AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id,
  coalesce(vec_id = least(vec_id, coalesce(c, vec_id)), TRUE) AS kept
FROM embeddings LEFT JOIN told ON told.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id
"""
