"""Document quality by positive-unlabelled learning.

Trusted positives are the documents labelled good; all other text is unlabelled, whatever its label. The share
of good text among the unlabelled (the class prior) is estimated from a positive-against-unlabelled
classifier: at its best bin, the share of unlabelled above a cut over the share of held-back positives
above it. The scorer then minimises the non-negative unbiased risk with that prior: positives as good,
unlabelled as bad less the part that the positives account for, and never below zero.

The model is logistic in a few statistics of the text and their squares. It is fitted by full gradients on
samples of at most about MAX_SAMPLE positives and as many unlabelled documents, chosen by a hash of the id, so
the same rows are chosen at every run. Every whole text is scored in one pass without a shuffle.

Defined cases: null and empty texts have the statistics of an empty text and are scored like any other; null
ids are scored and never learned from; several labels of one document count as good only if all are;
without positives every score is DEFAULT_PRIOR; repeated rows give one row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.llm.common import table, text_bytes

MAX_SAMPLE = 20_000  # bound on the positives, and on the unlabelled, that the model is fitted on
DEFAULT_PRIOR = 0.85
ACCEPT = 0.7  # least score of an accepted document
HELD_OUT = 2  # remainder of crc32(doc_id) mod 4 whose labels are never read

FEATURES = [
    "log_words", "distinct_words", "upper_case", "symbols", "marks", "digits", "bytes_per_word", "repeated_words",
    "lines", "distinct_pairs",
]


def features(text) -> list[float]:
    """Statistics of a whole text, each independent of its language."""
    data = bytes(text)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, pairs = max(1, len(words)), max(1, len(words) - 1)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    marks = int(counts[44] + counts[46])
    symbols = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) - marks
    return [
        float(np.log1p(len(words))), len(set(words)) / n, upper / max(1, upper + lower), symbols / n, marks / n,
        int(counts[48:58].sum()) / max(1, len(data)), len(data) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, int(counts[10]) / n, len(set(zip(words, words[1:]))) / pairs,
    ]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


# ---------------------------------------------------------------- the model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Logistic in standardised statistics and their squares; ``weights`` is None for a constant score."""

    def __init__(self, mean, scale, weights, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return _sigmoid(self.design(x) @ self.weights)


def _descend(gradient, size: int, steps: int = 1500, rate: float = 0.03) -> np.ndarray:
    """Adam on full gradients."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: best bin of a classifier fitted on the even rows, read on the odd."""
    p, u = positive[::2], unlabelled[::2]

    def gradient(w):
        return -(p * (1 - _sigmoid(p @ w))[:, None]).mean(0) + (u * _sigmoid(u @ w)[:, None]).mean(0) + 1e-3 * w

    w = _descend(gradient, p.shape[1], steps=500)
    sp, su = np.sort(positive[1::2] @ w)[::-1], np.sort(unlabelled[1::2] @ w)[::-1]
    if not len(sp) or not len(su):
        return DEFAULT_PRIOR
    in_p = np.arange(1, len(sp) + 1) / len(sp)
    in_u = np.searchsorted(-su, -sp, side="right") / len(su)
    slack = np.sqrt(np.log(40) / 2 / len(su)) + np.sqrt(np.log(40) / 2 / len(sp))
    best = np.argmin((in_u + slack) / in_p)
    return float(np.clip(in_u[best] / in_p[best], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, decay: float = 1e-4) -> Model:
    """Non-negative unbiased risk with the logistic loss."""
    if not len(positive) or not len(unlabelled):
        return Model(None, None, None, DEFAULT_PRIOR)
    model = Model(positive.mean(0), positive.std(0) + 1e-3, None, DEFAULT_PRIOR)
    p, u = model.design(positive), model.design(unlabelled)
    prior = model.prior = class_prior(p, u)

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        good = -(p * (1 - sp)[:, None]).mean(0)  # positives as good
        p_bad, u_bad = (p * sp[:, None]).mean(0), (u * su[:, None]).mean(0)
        bad_risk = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
        if bad_risk < 0:  # the estimate of a risk went negative: step back from it
            return -(u_bad - prior * p_bad) + decay * w
        return prior * good + u_bad - prior * p_bad + decay * w

    model.weights = _descend(gradient, p.shape[1])
    return model


# ---------------------------------------------------------------- on tables


def _below(share: float) -> Column:
    """Chooses about a share of the documents by a hash of the id."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30))


def _features_of(documents: DataFrame, keep: list[str], schema: str) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or b"") for t in text_bytes(batch.column("text"))]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], [*keep, "x"])

    return documents.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(compute, f"{schema}, x array<double>")


def train(documents: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Model:
    """Fit on bounded samples; held-out documents are in neither."""
    good = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id"))
    n_good, n_docs = good.count(), documents.count()
    positives = good.filter(_below(max_sample / max(1, n_good)))  # about max_sample ids
    others = _below(max_sample / max(1, n_docs)) & ~held_out() & F.col("doc_id").isNotNull()
    chosen = (
        documents.select("doc_id", "text", others.alias("u"))
        .join(F.broadcast(positives.withColumn("p", F.lit(True))), "doc_id", "left")
        .withColumn("p", F.coalesce("p", F.lit(False))).filter("p OR u"))
    rows = _features_of(chosen, ["doc_id", "p", "u"], "doc_id long, p boolean, u boolean").toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x[rows["p"].to_numpy(bool)], x[rows["u"].to_numpy(bool)])


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or b"") for t in text_bytes(batch.column(2))], float).reshape(-1, len(FEATURES))
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= ACCEPT).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with a score of ACCEPT or more, unchanged."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or b"") for t in text_bytes(batch.column("text"))], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= ACCEPT))

    return documents.mapInArrow(keep, documents.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return scored(documents, train(documents, table(spark, sf_dir, "labels")))
