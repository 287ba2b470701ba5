"""Substring deduplication by sliding runs of sentences.

A text is cut into parts: at . ! ? and line ends, and within these sentences before the word with the smallest
hash of any WINDOW neighbouring words. A word of more than MAX_CHARS characters (text without blanks) is first cut
in the same way by its characters, and its pieces are words. So cuts depend on the words around them alone, any
WINDOW words hold one, and the words of a passage are cut alike in every document but for WINDOW - 1 at either end.
From every part on, and up to every part, the shortest run of at least RUN parts and MIN_WORDS words is hashed.
Hashes are counted over all documents with the smallest document that has each; runs of any other document, and
later runs of the same document, are repeats, and the parts they cover are removed. Any 50 words that two documents
share hold a run wherever they begin (the first cut comes within 2 * WINDOW - 2 words, the run ends within
MIN_WORDS + WINDOW - 1 more, and WINDOW words are left). Since runs start and end at every part, a repeated
passage goes whole but for the words at its ends, and only its first occurrence stays.

Runs are written once and move once: a window over equal hashes finds the first document of each. The few most
frequent hashes, found by a sketch of fixed size, do not move; their first documents come from partial sums and are
broadcast. So a passage in a third of all documents is no single task. Only the runs of one document are ever
gathered together.

Defined cases: a null text stays null and has no part; a text with fewer parts or words than one run stays as
it is; rows without an id are neither compared nor changed; rows with the same id count as one document, each with
the repeats of its own text; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from plumbline.llm.common import frequent_values, saved, table, text_bytes
from plumbline.llm.shingles import _mixed, _powers

RUN = 3
MIN_WORDS = 20
WINDOW = 8
MAX_CHARS = 48
SPAN = 256

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*\s*|[.!?\n]+\s*")
_WORD = re.compile(r"(\S+)(\s*)")
_ODD = 0x9E3779B97F4A7C15
_EVEN = pow(_ODD, -1, 1 << 64)


def _smallest(hashes: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Places of the smallest of any WINDOW neighbouring hashes (of one group)."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64)
    places = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW).argmin(axis=1) + np.arange(len(hashes) - WINDOW + 1)
    if group is not None:
        places = places[group[: 1 - WINDOW] == group[WINDOW - 1 :]]
    return places[np.diff(places, prepend=-1) != 0]


def _pieces(word: str) -> list[str]:
    """A word of more than MAX_CHARS characters in pieces, any other as it is."""
    if len(word) <= MAX_CHARS:
        return [word]
    lower = word.lower()
    lower = lower if len(lower) == len(word) else word
    letters = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    cuts = [0, *_smallest(_mixed(letters * np.uint64(_ODD))).tolist(), len(word)]
    return [word[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


def _lower_words(sentence: str) -> list[str]:
    words = sentence.lower().split()
    if words and len(max(words, key=len)) > MAX_CHARS:
        return [p.lower() for w in sentence.split() for p in _pieces(w)]
    return words


def cut(text: str) -> tuple[list[str], np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Sentences and their numbers of words, words in lower case with their hashes, and the first word of each part
    and the number of words."""
    found = _SENTENCE.findall(text)
    own = [_lower_words(s) for s in found]
    words = [w for o in own for w in o]
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    sizes = np.array([len(o) for o in own], np.int64)
    ends = np.cumsum(sizes)
    places = np.zeros(len(words), bool)
    places[_smallest(hashes, np.repeat(np.arange(len(own)), sizes))] = True
    firsts = ends - sizes
    places[firsts[sizes > 0]] = False
    bounds = np.sort(np.concatenate([firsts, np.flatnonzero(places), [len(words)]]))
    return found, sizes, words, hashes, bounds


def sentences(text: str) -> tuple[list[str], list[list[str]]]:
    """Parts that together are the text, and the words of each in lower case."""
    found, sizes, words, _, bounds = cut(text)
    edges = bounds.tolist()
    parts, k, at = [], 0, 0
    for sentence, n in zip(found, sizes.tolist()):
        if edges[k + 1] >= at + n:  # not cut any further
            parts.append(sentence)
            k += 1
        else:
            tokens = []
            for m in _WORD.finditer(sentence):
                tokens += _pieces(m[1])
                tokens[-1] += m[2]
            tokens[0] = sentence[: len(sentence) - len(sentence.lstrip())] + tokens[0]
            while edges[k] < at + n:
                parts.append("".join(tokens[edges[k] - at : edges[k + 1] - at]))
                k += 1
        at += n
    return parts, [words[a:b] for a, b in zip(edges, edges[1:])]


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial of the values from each start to its end: the same for equal values wherever they stand."""
    up, down = _powers(_ODD, len(values) + 1), _powers(_EVEN, len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return (sums[ends] - sums[starts]) * down[starts]


def runs(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first part, part behind the last) of every run, from the hashes of words and the bounds of parts."""
    n = len(counts) - 1
    if n < RUN or counts[-1] < MIN_WORDS:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(n)
    end = np.maximum(at + RUN, np.searchsorted(counts, counts[:-1] + MIN_WORDS))
    start = np.minimum(at + 1 - RUN, np.searchsorted(counts, counts[1:] - MIN_WORDS, side="right") - 1)
    forward, backward = end <= n, start >= 0
    pairs = np.unique(np.concatenate([at[forward] << 32 | end[forward], start[backward] << 32 | at[backward] + 1]))
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    parts = _mixed(_sums(hashes, counts[:-1], counts[1:]) + np.diff(counts).astype(np.uint64))
    return _sums(parts, a, b).view(np.int64), a, b


def versioned(documents: DataFrame) -> DataFrame:
    """doc_id, text and version, which tells the texts of an id apart: a hash of the text, 0 where no id has several rows.

    A hash in every row of the shuffles takes a third of their space, so it is there only if it is needed.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    repeated = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return rows.withColumn("version", F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64("text"))


def hashed_runs(documents: DataFrame) -> DataFrame:
    """Written: run, doc_id, version, span (first part times SPAN plus the number of parts), and whether the text had the run before.

    A run has few parts, as each but an empty one at the start of a text has a word.
    """

    def hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, versions, columns = [], [], [[], [], []]
            for doc, text, version in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                *_, hashes, bounds = cut(str(text or b"", "utf-8", "replace"))
                found, a, b = runs(hashes, bounds)
                if len(found):
                    again = np.ones(len(found), bool)
                    again[np.unique(found, return_index=True)[1]] = False
                    docs.append(np.full(len(found), doc, np.int64))
                    versions.append(np.full(len(found), version, np.int64))
                    for column, values in zip(columns, (found, a * SPAN + b - a, again)):
                        column.append(values)
            if docs:
                found, span, again = map(np.concatenate, columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(np.concatenate(docs)), pa.array(np.concatenate(versions)), pa.array(span), pa.array(again)],
                    ["run", "doc_id", "version", "span", "again"])

    rows = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return saved(rows.mapInArrow(hash_runs, "run long, doc_id long, version long, span long, again boolean"), "runs")


def repeats(found: DataFrame) -> DataFrame:
    """(doc_id, version, spans): the runs of a text that are not the first of their kind.

    Each run moves once: a window over equal runs finds the first document. The few most frequent runs do not move at
    all: their first documents are found by partial sums and broadcast.
    """
    own = found.filter(~F.col("again"))
    hot = F.broadcast(frequent_values(own, "run"))
    first = F.min("doc_id").over(W.partitionBy("run"))
    rest = own.join(hot, "run", "left_anti").select("run", "doc_id", "version", "span").withColumn("first_doc", first)
    common = own.join(hot, "run", "left_semi")
    firsts = F.broadcast(common.groupBy("run").agg(F.min("doc_id").alias("first_doc")))
    later = rest.unionByName(common.join(firsts, "run").select(rest.columns)).filter("doc_id > first_doc")
    within = found.filter("again").select("doc_id", "version", "span")
    spans = later.select("doc_id", "version", "span").unionByName(within)
    return spans.groupBy("doc_id", "version").agg(F.collect_list("span").alias("spans"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, n_removed, and the text without repeats."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, out = [], [], []
            spans = batch.column(2)
            for i, text in enumerate(text_bytes(batch.column(1))):
                if text is None:
                    totals.append(0)
                    removed.append(0)
                    out.append(None)
                    continue
                whole = str(text, "utf-8", "replace")
                if not spans[i].is_valid:  # only its number of parts is asked for
                    totals.append(len(cut(whole)[-1]) - 1)
                    removed.append(0)
                    out.append(whole)
                    continue
                parts = sentences(whole)[0]
                totals.append(len(parts))
                own = spans[i].values.to_numpy()
                covered = np.zeros(len(parts) + 1, np.int64)
                np.add.at(covered, own // SPAN, 1)
                np.add.at(covered, own // SPAN + own % SPAN, -1)
                gone = np.cumsum(covered[:-1]) > 0
                removed.append(int(gone.sum()))
                out.append("".join(p for p, g in zip(parts, gone) if not g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                ["doc_id", "n_sentences", "n_removed", "text"])

    rows = versioned(documents)
    marked = rows.join(repeats(hashed_runs(rows)), ["doc_id", "version"], "left")
    return marked.select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id long, n_sentences long, n_removed long, text string")


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
