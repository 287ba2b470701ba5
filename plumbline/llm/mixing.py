"""Mixing sources to target shares by iterative proportional fitting.

Tokens are summed by source, language and topic. Categories without a target of their own share the target of
OTHER, so there are at most (sources + 1) * (languages + 1) * (topics + 1) sums, a bound set by the targets and not
by the data; only these reach the driver. A budget of tokens is chosen, as large as the scarcest category
allows but at least LEAST of all tokens; a category too scarce for that is taken whole and the rest of its share
goes to the others in proportion. Raking then scales the drawing probabilities of the cells, never above 1, to one
margin after the other until all margins hold. Documents are drawn by a hash of their id: the expected tokens
have the target shares, and a repeated or lost task draws the same documents.

Defined cases: a null source or language belongs to OTHER; a null or empty text has no token and the topic of plain
text; a document without an id is drawn by a hash of its text; targets of categories without tokens are spread over
the others; repeated rows are drawn alike; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.llm.common import saved, table

OTHER = "*"
TARGETS = {
    "source": {f"src{i}": 0.05 for i in range(20)} | {OTHER: 0.02},
    "lang": {"en": 0.54, "de": 0.16, "fr": 0.16, "es": 0.12, OTHER: 0.02},
    "topic": {"prose": 0.88, "contact": 0.04, "legal": 0.03, "listing": 0.025, "credentials": 0.025},
}
SEED = 6

LEAST = 0.5  # share of all tokens that is kept at least


def _holds(text: str, *parts: str) -> Column:
    return functools.reduce(Column.__or__, [F.col(text).contains(p) for p in parts])


def topic(text: str = "text") -> Column:
    """Topic of a text by the kind of passage it holds, the first that fits; a plain search comes before a pattern."""
    named = _holds(text, "token", "TOKEN", "secret", "SECRET", "passw", "PASSW", "api", "API")
    return (
        F.when(_holds(text, "icense", "icence", "ICENSE", "ICENCE"), "legal")
        .when(named & F.col(text).rlike(r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]"), "credentials")
        .when(_holds(text, "@") & F.col(text).rlike(r"[\w.+-]+@[\w-]+\.\w"), "contact")
        .when(_holds(text, "(") & F.col(text).rlike(r"\(\d{3}\) ?\d{3}-\d{4}"), "contact")
        .when(_holds(text, " | "), "listing")
        .otherwise("prose")
    )


def tokens(text: str = "text") -> Column:
    """About the number of words: blanks and line feeds and one more; none in an empty text."""
    blanks = F.length(text) - F.length(F.replace(F.replace(F.col(text), F.lit(" ")), F.lit("\n")))
    return F.when(F.length(text) > 0, blanks + 1).otherwise(0).cast("long")


def _category(column: str, targets: dict[str, float]) -> Column:
    return F.when(F.col(column).isin(list(targets)), F.col(column)).otherwise(OTHER)


def _other_axes(sums: np.ndarray, axis: int) -> tuple[int, ...]:
    return tuple(i for i in range(sums.ndim) if i != axis)


def feasible(sums: np.ndarray, margins: list[np.ndarray], budget: float | None = None) -> tuple[float, list[np.ndarray]]:
    """The token budget, and margins (tokens by category) that no category exceeds."""
    total = sums.sum()
    there = [sums.sum(axis=_other_axes(sums, axis)) for axis in range(sums.ndim)]
    goals = [np.where(have > 0, goal, 0.0) for have, goal in zip(there, margins)]
    goals = [g / g.sum() if g.sum() else np.where(have > 0, 1.0, 0.0) / max(1, (have > 0).sum()) for have, g in zip(there, goals)]
    scarcest = min((have[g > 0] / g[g > 0]).min(initial=total) for have, g in zip(there, goals))
    tokens = min(total, max(LEAST * total, scarcest)) if budget is None else min(total, budget)
    out = []
    for have, goal in zip(there, goals):
        want = tokens * goal
        for _ in range(len(goal)):  # each round at least one more category is taken whole
            short = want > have
            if not short.any():
                break
            open_share = np.where(want < have, goal, 0.0)
            spare = tokens - np.minimum(want, have).sum()
            if not open_share.sum():  # nothing with a target is left: the rest comes from what is there
                open_share = have - np.minimum(want, have)
            if not open_share.sum():
                break
            want = np.minimum(want, have) + spare * open_share / open_share.sum()
        out.append(np.minimum(want, have))
    return tokens, out


def rake(sums: np.ndarray, goals: list[np.ndarray], start: float, rounds: int = 2000, close: float = 1e-9) -> np.ndarray:
    """Probabilities of the cells, at most 1, whose expected tokens come to the goals along each axis."""
    chance = np.full(sums.shape, start)
    for _ in range(rounds):
        worst = 0.0
        for axis, goal in enumerate(goals):
            now = (sums * chance).sum(axis=_other_axes(sums, axis))
            ratio = np.divide(goal, now, out=np.ones_like(goal), where=now > 0)
            chance = np.minimum(1.0, chance * ratio.reshape([-1 if i == axis else 1 for i in range(sums.ndim)]))
            worst = max(worst, np.abs(now - goal).max(initial=0.0))
        if worst <= close * sums.sum():
            break
    return chance


def described(documents: DataFrame, targets: dict[str, dict[str, float]]) -> DataFrame:
    """The documents with ``__topic``, ``__tokens`` and the category of each margin."""
    rows = documents.withColumn("text", F.col("text").cast("string"))
    named = rows.withColumn("__topic", topic()).withColumn("__tokens", tokens())
    return named.withColumns({
        "__source": _category("source", targets["source"]), "__lang": _category("lang", targets["lang"]),
        "__kind": _category("__topic", targets["topic"])})


def probabilities(cells: DataFrame, targets: dict[str, dict[str, float]], budget: float | None = None) -> DataFrame:
    """(source, lang, topic) cells with the probability of their documents and the factor against the average."""
    spark = cells.sparkSession
    names = [list(dict.fromkeys([*t, OTHER])) for t in (targets["source"], targets["lang"], targets["topic"])]
    sums = np.zeros([len(n) for n in names])
    for r in cells.collect():  # at most one row per combination of target categories
        sums[tuple(n.index(r[c]) for n, c in zip(names, ("__source", "__lang", "__kind")))] = r["total"]
    margins = [np.array([targets[k].get(c, 0.0) for c in n]) for k, n in zip(("source", "lang", "topic"), names)]
    total = sums.sum()
    used, goals = feasible(sums, margins, budget)
    average = float(used / total) if total else 1.0
    # Cells without tokens hold only documents without words: these are drawn like the average document.
    chance = np.where(sums > 0, rake(sums, goals, average), average)
    rows = [
        (names[0][i], names[1][j], names[2][k], float(chance[i, j, k] / average) if average else 0.0, float(chance[i, j, k]))
        for i, j, k in np.ndindex(*sums.shape)]
    return spark.createDataFrame(rows, "__source string, __lang string, __kind string, __weight double, __probability double")


def drawn() -> Column:
    """Whether a document is drawn with its probability."""
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id"), F.lit(SEED))).otherwise(
        F.xxhash64(F.col("text"), F.lit(SEED)))
    return F.shiftrightunsigned(key, 11) < F.col("__probability") * float(1 << 53)


def mixed(documents: DataFrame, targets: dict[str, dict[str, float]] = TARGETS, budget: float | None = None) -> DataFrame:
    """The documents with ``__topic``, ``__tokens``, ``__weight``, ``__probability`` and ``__drawn``."""
    rows = described(documents, targets)
    cells = saved(rows.groupBy("__source", "__lang", "__kind").agg(F.sum("__tokens").alias("total")), "cells")
    chances = F.broadcast(probabilities(cells, targets, budget))  # as many rows as target categories combine
    return rows.join(chances, ["__source", "__lang", "__kind"]).withColumn("__drawn", drawn())


def op6_target_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.col("__weight").alias("weight"), F.col("__probability").alias("probability"), F.col("__drawn").alias("sampled"))
