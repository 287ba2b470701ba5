"""Toxicity by a weighted lexicon that an Aho-Corasick automaton finds in the folded text.

Folding: compatibility forms and look-alike letters of other scripts become Latin letters, digits and signs that
stand for letters inside a word become those letters, case goes, all else becomes a blank. Patterns are whole
words and beginnings of words; where several match at one place the heaviest counts. A pattern inside one of
the exception phrases does not count.

Lexicon, weights and phrases come from labelled documents outside the held-out fold: patterns that at least
MIN_SUPPORT toxic documents hold and that are much more frequent there, weighted by the logarithm of the
ratio; phrases are pairs of words that hold a pattern but occur in clean documents only. A logistic curve in
the sum of weights and in the sum per word (the length normalisation) gives the score. Sums over labels are
counted in Spark; the sample is bounded by MAX_SAMPLE documents, the lexicon by MAX_PATTERNS.

Defined cases: null and empty texts hold nothing and get the lowest score; null ids are scored and never learned
from; several labels of one document count as toxic if any is; without labels of both kinds every score is 0;
repeated rows give one row each; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import saved, table, texts
from plumbline.llm.quality import held_out

MAX_SAMPLE = 20_000  # about so many labelled documents are learned from
MAX_PATTERNS = 5_000
MAX_PHRASES = 5_000
MIN_SUPPORT = 3  # toxic documents that hold a pattern
MIN_WEIGHT = 2.0
PREFIXES = (4, 5, 6)  # lengths of the beginnings of words that may become patterns
PREDICT = 0.3

# Letters of other scripts by the Latin letter they look like, and characters used for letters.
LOOK_ALIKES = {
    "a": "аαɑ", "b": "Ьв", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ",
    "l": "ӏ", "m": "м", "n": "п", "o": "оο", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υ", "v": "ν", "w": "ԝω",
    "x": "хχ", "y": "уγ",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}


class _Fold(dict):
    """Translation table, filled as characters are met: one letter or a blank for each."""

    def __init__(self):
        super().__init__({ord(c): latin for latin, others in LOOK_ALIKES.items() for c in others})
        self.update({ord(c): latin for c, latin in SUBSTITUTES.items()})

    def __missing__(self, code: int) -> str:
        c = unicodedata.normalize("NFKC", chr(code)).lower()
        if len(c) == 1 and ord(c) != code:
            c = self[ord(c)]
        elif len(c) != 1 or not c.isalpha():
            c = " "
        self[code] = c
        return c


_FOLD = _Fold()


def folded(text: str) -> str:
    """Words of letters between single or several blanks; a blank at both ends."""
    if "$" in text or "@" in text:  # at the end of a word they are marks, not letters
        text = " ".join(w.rstrip("$@.,;:!?") for w in text.split())
    return f" {text.translate(_FOLD)} "


class Lexicon:
    """Weights by pattern (" word " or " beginning"), phrases that excuse, and the curve of the score."""

    def __init__(self, weights: dict[str, float], phrases: list[str], curve: tuple[float, float, float] | None):
        self.weights, self.phrases, self.curve = weights, phrases, curve
        self._automaton = None

    def __reduce__(self):
        return Lexicon, (self.weights, self.phrases, self.curve)

    def _build(self):
        import ahocorasick

        self._automaton = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            self._automaton.add_word(pattern, (len(pattern), weight))
        for phrase in self.phrases:
            self._automaton.add_word(phrase, (len(phrase), None))
        if self.weights or self.phrases:
            self._automaton.make_automaton()
        return self._automaton

    def sums(self, text: str) -> tuple[float, int]:
        """Sum of the weights found, and number of words."""
        plain = folded(text)
        automaton = self._automaton or self._build()
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if len(automaton):
            for last, (size, weight) in automaton.iter(plain):
                start = last - size + 1
                if weight is None:
                    excused.append((start, last))
                elif weight > found.get(start, 0.0):
                    found[start] = weight
        if excused:
            found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in excused)}
        return sum(found.values()), len(plain.split()) if found else 0

    def design(self, sums: list[tuple[float, int]]) -> np.ndarray:
        total, words = (np.array(x, float) for x in zip(*sums)) if sums else (np.zeros(0), np.zeros(0))
        return np.column_stack([np.log1p(total), 10 * total / (words + 20), np.ones(len(total))])

    def score(self, sums: list[tuple[float, int]]) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(sums))
        return 1 / (1 + np.exp(-np.clip(self.design(sums) @ np.array(self.curve), -30, 30)))


# ---------------------------------------------------------------- learning


def _patterns(text: str) -> set[str]:
    words = set(folded(text).split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n}


def _pairs(text: str, weights: dict[str, float]) -> set[str]:
    """Pairs of neighbouring words of which one is a pattern or begins with one."""
    words = folded(text).split()
    hit = [f" {w} " in weights or any(f" {w[:n]}" in weights for n in PREFIXES) for w in words]
    return {f" {a} {b} " for a, b, x, y in zip(words, words[1:], hit, hit[1:]) if x or y}


def _counted(sample: DataFrame, of, name: str) -> DataFrame:
    """Documents that hold each of the strings ``of`` finds in a text, by label; added up in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts(batch.column("text"))):
                counts.update((x, toxic) for x in of(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], [name, "toxic", "n"])

    rows = sample.select("toxic", "text").mapInArrow(count, f"{name} string, toxic int, n long")
    return rows.groupBy(name).agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"))


def _curve(lexicon: Lexicon, sums: list[tuple[float, int]], toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small decay."""
    x, w = lexicon.design(sums), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + 0.05 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w = w - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return tuple(float(v) for v in w)


def learn(documents: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Lexicon:
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max_sample / max(1, sum(n.values()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = saved(
        documents.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id"), "toxicity-sample")  # about max_sample ids are broadcast
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_bad, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_clean:
        return Lexicon({}, [], None)
    candidates = {
        r["pattern"] for r in _counted(sample.filter("toxic = 1"), _patterns, "pattern")
        .filter(F.col("bad") >= MIN_SUPPORT).orderBy(F.desc("bad"), "pattern").limit(20 * MAX_PATTERNS).collect()}
    weight = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    heavy = (
        _counted(sample, lambda t: _patterns(t) & candidates, "pattern")
        .withColumn("weight", weight).filter((F.col("bad") >= MIN_SUPPORT) & (F.col("weight") >= MIN_WEIGHT))
        .orderBy(F.desc(F.col("weight") * F.col("bad")), "pattern").limit(MAX_PATTERNS).collect())
    weights = {r["pattern"]: r["weight"] for r in heavy}
    phrases = [
        r["phrase"] for r in _counted(sample, lambda t: _pairs(t, weights), "phrase")
        .filter("clean >= 2 AND bad = 0").orderBy(F.desc("clean"), "phrase").limit(MAX_PHRASES).collect()]
    lexicon = Lexicon(weights, phrases, None)
    rows = _sums(sample.select("toxic", "text"), lexicon, "toxic", "int").toPandas()
    pairs = sorted(zip(rows["total"], rows["words"], rows["toxic"]))
    lexicon.curve = _curve(lexicon, [p[:2] for p in pairs], np.array([p[2] for p in pairs], float))
    return lexicon


def _sums(rows: DataFrame, lexicon: Lexicon, keep: str, kind: str) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [lexicon.sums(t) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(keep), pa.array([s[0] for s in sums], pa.float64()), pa.array([s[1] for s in sums], pa.int64())],
                [keep, "total", "words"])

    return rows.mapInArrow(compute, f"{keep} {kind}, total double, words long")


def scored(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = lexicon.score([lexicon.sums(t) for t in texts(batch.column(2))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= PREDICT).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return scored(documents, learn(documents, table(spark, sf_dir, "labels")))
