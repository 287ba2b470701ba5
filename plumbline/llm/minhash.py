"""Near-duplicate documents by min-max hashing of their word shingles.

1. Each text becomes a set of shingle hashes. Documents with equal sets are one class (a grouped minimum).
2. Each of the class's permutations gives two signature values, the smallest and the largest hash, so half
   as many permutations are evaluated. Bands of four values (two permutations) are the bucket keys.
3. Every member of a bucket is compared with the bucket's smallest member only: a group of copies costs one
   comparison for each member, however large.
4. Where a bucket then still holds several components, its members are joined exactly: shingles are ordered from
   rare to common, and two sets at the threshold must share one among the first few of each (a ninth of the
   shorter, a fifth of the longer set), at places that leave enough behind. Documents that only share a long
   passage have their own shingles first and do not meet. Members of one component are not compared.
5. Links are confirmed on the full sets, recomputed from the texts of the documents that need it; components
   follow by contraction.

A pair of large sets at the threshold 0.8 shares no band with a probability of (1 - 0.8**4)**24 = 3e-6. In small sets
the smallest and the largest value depend on each other: sets of 4 and 5 shingles share both with 0.6 and not
0.8**2, and no band with (1 - 0.6**2)**24 = 2.2e-5.

Defined cases: texts without words (null, empty, blank) have no shingle and are linked with nothing; rows
without a document id are linked with nothing and kept; repeated rows of one id give one row each, and several
texts under one id count as one document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from plumbline.llm.common import binary, saved, table, text_bytes
from plumbline.llm.components import components
from plumbline.llm.shingles import Shingler, fingerprint, overlap

BANDS = 24
PERMUTATIONS = 2 * BANDS  # two values each
PERCENT = 80  # least similarity of a link
WORDS = 5
_GROUP = 200  # most pairs of one document that one group of a task compares


def _multipliers() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: its number and the smallest and largest values of two permutations."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 4096):  # long texts in pieces
        values = multipliers[:, None] * shingles[None, at : at + 4096]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    odd = np.uint64(0xBF58476D1CE4E5B9)
    for value in (low[::2], high[::2], low[1::2], high[1::2]):
        keys = (keys ^ value) * odd
        keys ^= keys >> np.uint64(29)
    return keys.astype(np.int64)


def signatures(documents: DataFrame, words: int) -> DataFrame:
    """Per row, written: id, size and fingerprint of its set (null for an empty set), band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, multipliers = Shingler(words), _multipliers()
        for batch in batches:
            sizes, prints, bands = [], [], []
            for text in text_bytes(batch.column(1)):
                found = shingler(text or b"")
                sizes.append(len(found))
                prints.append(fingerprint(found) if len(found) else None)
                bands.append(band_keys(found, multipliers) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), binary(prints), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "print", "bands"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(rows.mapInArrow(sign, "doc_id long, n_shingles long, print binary, bands array<long>"), "signatures")


def _sets(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Full shingle sets of the documents in ``ids`` (doc_id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            found = [shingler(t or b"").tobytes() for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), binary(found)], ["doc_id", "shingles"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(ids, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, shingles binary")


def similarities(pairs: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """(a, b, both, either), written: sizes of intersection and union of the full sets of each pair.

    The pairs of a document are dealt out in groups of about _GROUP; the document's set goes to each of its
    groups once, so a task holds one set and one batch.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _GROUP).cast("int").alias("groups"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = saved(_sets(documents, ids, words), "sets")
    dealt = pairs.join(groups, "a").withColumn("group", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int"))
    partners = dealt.join(sets, F.col("b") == F.col("doc_id")).select("a", "group", "b", "shingles")
    own = (
        groups.join(sets, F.col("a") == F.col("doc_id"))
        .select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(None).cast("long").alias("b"), "shingles")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own_sets = None, []
        for batch in batches:
            out = []
            a, group, b, column = (batch.column(i) for i in range(4))
            for x, g, y, s in zip(a.to_pylist(), group.to_pylist(), b.to_pylist(), column):
                shingles = np.frombuffer(s.as_buffer(), np.uint64)
                if y is None:
                    own_sets = [*own_sets, shingles] if key == (x, g) else [shingles]
                    key = (x, g)
                    continue
                for mine in own_sets:  # several only where several texts have one id
                    both = overlap(mine, shingles)
                    out.append((x, y, both, len(mine) + len(shingles) - both))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "both", "either"])

    ordered = partners.unionByName(own).repartition("a", "group").sortWithinPartitions("a", "group", F.col("b").asc_nulls_first())
    return saved(ordered.mapInArrow(compare, "a long, b long, both long, either long"), "similarities")


def _linked() -> F.Column:
    return 100 * F.col("both") >= PERCENT * F.col("either")


def _may_link(a: str, b: str) -> F.Column:
    """The sizes of two sets allow a link: the smaller one may lie in the larger."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def across_components(documents: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) of nodes (node, component) of different components that may link: a superset of those that do.

    With t the threshold, x the shorter set of a pair that links and y the longer, the first shingle they share, in
    any order common to all, is among the first |x| - ceil(2t/(1+t) |x|) + 1 of x and the first |y| - ceil(t |y|) + 1
    of y, and at least t/(1+t) (|x| + |y|) shingles of either set are left from there on. Shingles that no other
    set has come first and need not be written out. The component that holds a shingle most often is not joined
    with itself.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            found = [shingler(t or b"") for t in text_bytes(batch.column(1))]
            versions = [int.from_bytes(fingerprint(x)[:8], "little", signed=True) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array(versions, pa.int64()),
                 pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["node", "n", "version", "shingles"])

    rows = documents.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    own = saved(rows.join(nodes.select("node"), "node", "left_semi").mapInArrow(
        sets, "node long, n long, version long, shingles array<long>"), "open-sets")
    # ``version`` tells the texts of an id that has several apart.
    grams = own.select("node", "n", "version", F.explode("shingles").alias("shingle"))
    shared = grams.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    n = F.col("n")
    probed = n - F.ceil(n * PERCENT / 100) + 1
    indexed = n - F.ceil(n * (2 * PERCENT) / (100 + PERCENT)) + 1
    first = (
        grams.join(shared, "shingle")
        .groupBy("node", "n", "version").agg(F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("shared"))
        .withColumn("alone", n - F.size("shared"))  # so many shingles come before the shared ones
        .withColumn("shared", F.slice("shared", 1, F.greatest(probed - F.col("alone"), F.lit(0)).cast("int")))
        .select("node", "n", "alone", F.posexplode("shared").alias("at", "gram"))
        .select("node", "n", (F.col("alone") + F.col("at")).alias("place"), "gram.shingle")
        .withColumn("indexed", F.col("place") < indexed).join(nodes, "node"))
    first = saved(first, "prefixes")
    most = (
        first.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("rows")).groupBy("shingle")
        .agg(F.max_by("component", "rows").alias("most"), F.count(F.lit(1)).alias("components"))
        .filter("components > 1").select("shingle", "most"))
    told = saved(first.join(most, "shingle").withColumn("main", F.col("component") == F.col("most")).drop("most"), "prefixes")
    x, y = (told.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "place", "component", "main", "indexed")]) for s in "xy")
    left = F.ceil((F.col("n_x") + F.col("n_y")) * PERCENT / (100 + PERCENT))
    meets = (
        (F.col("n_x") <= F.col("n_y")) & _may_link("n_x", "n_y") & (F.col("component_x") != F.col("component_y"))
        & (F.col("n_x") - F.col("place_x") >= left) & (F.col("n_y") - F.col("place_y") >= left))
    x = x.filter("indexed_x")
    pairs = x.join(y.filter("NOT main_y"), "shingle").filter(meets).unionByName(
        x.filter("NOT main_x").join(y.filter("main_y"), "shingle").filter(meets))
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_duplicates(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    signed = signatures(documents, words)
    classes = (
        signed.filter("print IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("print").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    members = classes.select("node", "n", F.explode("bands").alias("key"))
    smallest = members.groupBy("key").agg(
        F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last")).filter("first.node <> last")
    buckets = saved(
        members.join(smallest.select("key", F.col("first.node").alias("center"), F.col("first.n").alias("center_n")), "key"),
        "buckets")

    star = buckets.filter((F.col("node") != F.col("center")) & _may_link("n", "center_n"))
    near = similarities(star.select(F.col("center").alias("a"), F.col("node").alias("b")).distinct(), documents, words)
    links = near.filter(_linked()).select("a", "b")
    found = components(links)

    # Members of buckets that still hold several components.
    placed = buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c <> d").select("key")
    open_nodes = saved(placed.join(mixed, "key").select("node", "component").distinct(), "open")
    more = similarities(across_components(documents, open_nodes, words), documents, words).filter(_linked())
    if not more.isEmpty():
        joined = links.unionByName(more.select("a", "b"))
        found = components(joined)
    nodes = classes.select("print", "node").join(found, "node", "left").select(
        "print", F.coalesce("component", "node").alias("class_component"))
    unlinked = F.col("print").isNull() | F.col("doc_id").isNull()
    return (
        signed.select("doc_id", "n_shingles", "print").join(nodes, "print", "left")
        .withColumn("component_id", F.when(unlinked, F.col("doc_id")).otherwise(F.col("class_component")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def deduplicated(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each group, with all its columns; of rows that share an id, one stays."""
    out = near_duplicates(documents, words)
    gone = out.filter(~F.col("kept")).select("doc_id")
    repeated = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    rest = documents.join(gone, "doc_id", "left_anti").join(repeated, "doc_id", "left_anti")
    one = W.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`") for c in documents.columns])
    again = documents.join(gone, "doc_id", "left_anti").join(repeated, "doc_id", "left_semi").withColumn(
        "__row", F.row_number().over(one)).filter("__row = 1").drop("__row")
    return rest.unionByName(again).select(*[F.col(f"`{c}`") for c in documents.columns])


def op10_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP10_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words
), grams AS MATERIALIZED (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets WHERE doc_id IS NOT NULL
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_of AS (
  SELECT a, min(b) AS c FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id,
  coalesce(doc_id = least(doc_id, coalesce(c, doc_id)), TRUE) AS kept
FROM sets LEFT JOIN least_of ON a = doc_id
"""
