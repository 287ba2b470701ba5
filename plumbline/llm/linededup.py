"""Line deduplication with keep bitmaps, in built-in functions only.

A line's key is the line stripped of blanks at both ends with A-Z lower-cased; a key of at least SHORTEST code points
that is found in at least DOCUMENTS documents loses all its lines but those of the document that comes first, which
is the one with the largest id. Keys are two 64-bit hashes. One table of (hash, document, position) is written; it is
range-partitioned by hash and sorted by document and position within each hash, and a window streams over each hash:
its first document, and whether a third one follows. Only positions of lines to drop leave that step. They become one
sparse bitmap per document, 64 lines a word, where words that keep every line are left out. Texts take no part in
any of this; ``deduplicated`` joins them to the bitmaps at the end.

A sketch of bounded size counts the hashes first. The most frequent ones, at most HOT_KEYS, do not go through the range
partitions: their documents are counted by partial sums, and the few verdicts are broadcast to their lines.

Defined cases: a null text is the empty text, which is one empty line; rows that share an id count as one document (so
do all rows without an id, which come last in the order), but every row keeps a bitmap of its own text; repeated rows
get the same result; an empty table gives no rows; other columns are kept and never looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plumbline.llm.common import saved, table

SHORTEST = 20  # code points of a key
DOCUMENTS = 3
BLANKS = " \t\n\x0b\x0c\r"
HOT_KEYS = 256  # at most so many hashes go the way of the frequent ones
COUNTERS = 8192  # of the sketch; a hash in more than about one in 1,200 lines is among its frequent ones
WORD = 64  # lines in a word of a bitmap


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(BLANKS))
    # Only A-Z change; where all characters are ASCII the faster function does the same.
    lower = F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(stripped) == F.octet_length(stripped), F.lower(stripped)).otherwise(lower)


def lines(documents: DataFrame) -> DataFrame:
    """(doc_id, version, position, h1, h2) of every line with a key of sufficient length, written."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    cut = rows.select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    keyed = cut.select("doc_id", "version", "position", line_key(F.col("line")).alias("key"))
    return saved(
        keyed.filter(F.length("key") >= SHORTEST)
        .select("doc_id", "version", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")),
        "lines")


def frequent(hashes: DataFrame) -> DataFrame:
    """The frequent values of ``h1``: at most HOT_KEYS rows, from a sketch of fixed size."""
    top = hashes.select(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {COUNTERS})").alias("top"))
    return saved(top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("h1")), "frequent")


def _repeats_of_others(rest: DataFrame) -> DataFrame:
    """Positions to drop among hashes that are not frequent: one range shuffle, one sort, one streaming pass."""
    group = W.partitionBy("h1", "h2")
    newest = F.col("doc_id").desc_nulls_last()
    streamed = rest.repartitionByRange("h1").select(
        "doc_id", "version", "position", "h1", "h2",
        F.row_number().over(group.orderBy(newest, "version", "position")).alias("place"),
        F.dense_rank().over(group.orderBy(newest)).alias("document"))
    whole = streamed.withColumn("documents", F.max("document").over(group))
    return whole.filter((F.col("documents") >= DOCUMENTS) & (F.col("document") > 1)).select("doc_id", "version", "position")


def _repeats_of_frequent(hot: DataFrame) -> DataFrame:
    """Positions to drop among the frequent hashes: one verdict each, broadcast."""
    without_id = F.max(F.col("doc_id").isNull().cast("int"))
    verdicts = hot.groupBy("h1", "h2").agg(
        (F.count_distinct("doc_id") + without_id).alias("documents"), F.max("doc_id").alias("first"))
    kept = F.broadcast(verdicts.filter(F.col("documents") >= DOCUMENTS).select("h1", "h2", "first"))  # HOT_KEYS rows
    return hot.join(kept, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first"))).select(
        "doc_id", "version", "position")


def keep_bitmaps(documents: DataFrame) -> DataFrame:
    """(doc_id, version, n_dropped, keep) of the documents that lose lines.

    ``keep`` holds (word, bits) in order: bit i of word w is line 64 w + i, set if the line stays. Words that are not
    there keep all their lines. ``version`` is a hash of the text, for rows that share an id.
    """
    keyed = lines(documents)
    hot = F.broadcast(frequent(keyed))
    dropped = _repeats_of_others(keyed.join(hot, "h1", "left_anti")).unionByName(
        _repeats_of_frequent(keyed.join(hot, "h1", "left_semi")))
    bit = F.expr(f"shiftleft(1L, position % {WORD})")
    words = dropped.groupBy("doc_id", "version", F.floor(F.col("position") / WORD).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("gone"))
    return words.groupBy("doc_id", "version").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))


def _mask() -> Column:
    """One boolean per line up to the end of the last word of ``keep``."""

    def expanded(entry: Column, i: Column) -> Column:
        before = F.when(i == 0, -1).otherwise(F.get(F.col("keep"), i - 1)["word"])
        bits = F.transform(
            F.sequence(F.lit(0), F.lit(WORD - 1)),
            lambda b: F.call_function("shiftrightunsigned", entry["bits"], b).bitwiseAND(F.lit(1)) == 1)
        return F.concat(F.array_repeat(F.lit(True), (entry["word"] - before - 1) * WORD), bits)

    return F.flatten(F.transform("keep", expanded))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents with the kept lines as ``text``, ``n_lines`` (before) and ``n_dropped``; other columns stay."""
    bitmaps = keep_bitmaps(documents).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("n_dropped").alias("__dropped"), "keep")
    rows = documents.select(F.struct(*[f"`{c}`" for c in documents.columns]).alias("row"))
    text, own_id = F.coalesce(F.col("row.text").cast("string"), F.lit("")), F.col("row.doc_id").cast("long")
    joined = rows.join(bitmaps, own_id.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__version")), "left")
    zipped = F.arrays_zip(F.split(text, "\n", -1).alias("line"), _mask().alias("stays"))
    stays = F.filter(zipped, lambda z: z["line"].isNotNull() & F.coalesce(z["stays"], F.lit(True)))
    kept = F.when(F.col("keep").isNull(), text).otherwise(F.array_join(F.transform(stays, lambda z: z["line"]), "\n"))
    feeds = F.length(text) - F.length(F.replace(text, F.lit("\n")))
    done = joined.select(
        "row", kept.alias("text"), (feeds + 1).cast("long").alias("n_lines"),
        F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"))
    others = [F.col(f"row.`{c}`") for c in documents.columns if c not in ("text", "n_lines", "n_dropped")]
    return done.select(*others, "text", "n_lines", "n_dropped")


def op11_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = f"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position FROM documents
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM cut
), repeated AS (
  SELECT key, max(doc_id) AS first FROM keyed WHERE length(key) >= {SHORTEST} GROUP BY key HAVING count(DISTINCT doc_id) >= {DOCUMENTS}
), told AS (
  SELECT doc_id, line, position, first IS NULL OR doc_id = first AS stays FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (stays), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
