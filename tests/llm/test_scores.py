"""Quality and toxicity by held-out accuracy, mixture and code search against brute force, the pipeline."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import mixing, multiindex, quality, toxicity
from plumbline.llm.common import DOCUMENT_COLUMNS, table
from tests.llm.conftest import SF

LARGER = "/root/testdata/sf0.1"


def with_labels(scored, spark):
    return scored.join(table(spark, LARGER, "labels"), "doc_id").filter("held_out").toPandas()


def test_quality_on_held_out_documents(spark):
    rows = with_labels(quality.op1_quality(spark, LARGER), spark)
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    assert (rows.predicted == rows.quality).mean() > 0.98
    assert rows[rows.quality == 1].predicted.mean() > 0.99 and rows[rows.quality == 0].predicted.mean() < 0.1


def test_toxicity_on_held_out_documents(spark):
    rows = with_labels(toxicity.op9_toxicity(spark, LARGER), spark)
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    assert rows[rows.toxic == 1].predicted.mean() > 0.9 and rows[rows.toxic == 0].predicted.mean() < 0.02


def test_held_out_rows(spark):
    rows = spark.range(-3, 50).select(F.col("id").alias("doc_id"), quality.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumns({c: F.when(quality.held_out(), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    assert (quality.train(docs, labels).weights == quality.train(docs, turned).weights).all()
    assert toxicity.learn(docs, labels).weights == toxicity.learn(docs, turned).weights


def test_class_prior():
    rng = np.random.default_rng(1)
    one = np.ones((4000, 1))
    good, bad = rng.normal(0, 1, (4000, 1)), rng.normal(6, 1, (4000, 1))
    mixed = np.vstack([good[:2800], bad[:1200]])
    rng.shuffle(mixed)
    prior = quality.class_prior(np.hstack([rng.normal(0, 1, (4000, 1)), one]), np.hstack([mixed, one]))
    assert abs(prior - 0.7) < 0.06


@pytest.mark.parametrize("name", ["odd_documents", "no_documents"])
@pytest.mark.parametrize("known", [True, False])
def test_odd_documents_are_scored(request, spark, name, known):
    docs = request.getfixturevalue(name)
    labels = spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(1, 18)] + [(1, 0, None), (None, 1, 1), (3, None, 0)] if known else [],
        "doc_id long, quality int, toxic int")
    for scored in (quality.scored(docs, quality.train(docs, labels)), toxicity.scored(docs, toxicity.learn(docs, labels))):
        rows = scored.toPandas()
        assert len(rows) == docs.count() and rows.score.between(0, 1).all()


def test_folding():
    assert toxicity.folded("1D10T! ѕtuріd ＭＯＲＯＮ l0$er $$$").split() == ["idiot", "stupid", "moron", "loser"]
    assert toxicity.folded("") .split() == [] and toxicity.folded("naïve été").split() == ["naïve", "été"]


def test_exceptions_and_weights():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " trash": 1.0, " scum ": 3.0}, [" trash can "], None)
    assert lexicon.sums("trash Trash, tr4sh") == (6.0, 3)
    assert lexicon.sums("the trash can is full")[0] == 0.0
    assert lexicon.sums("trashy scum")[0] == 4.0


def margins_of(cells):
    return [cells.sum(axis=tuple(i for i in range(cells.ndim) if i != axis)) for axis in range(cells.ndim)]


def test_raking_reaches_the_margins():
    sums = np.random.default_rng(2).integers(1, 100, (4, 3, 2)).astype(float)
    sums[0, 0] = 0
    shares = [np.array([0.3, 0.3, 0.2, 0.2]), np.array([0.4, 0.3, 0.3]), np.array([0.6, 0.4])]
    used, goals = mixing.feasible(sums, shares)
    chance = mixing.rake(sums, goals, used / sums.sum())
    assert used >= mixing.LEAST * sums.sum() and chance.max() <= 1
    for now, goal, share in zip(margins_of(sums * chance), goals, shares):
        assert np.allclose(now, goal, rtol=1e-6) and np.allclose(goal, used * share)


def test_a_scarce_category_is_taken_whole_and_empties_nothing_else():
    sums = np.array([[[1e6, 2e6], [1e6, 1e6]], [[3e6, 1e6], [1e6, 1e6]], [[5.0, 0.0], [0.0, 0.0]]])
    shares = [np.array([0.49, 0.49, 0.02]), np.array([0.5, 0.5]), np.array([0.5, 0.5])]
    used, goals = mixing.feasible(sums, shares)
    chance = mixing.rake(sums, goals, used / sums.sum())
    assert used >= mixing.LEAST * sums.sum() and goals[0][2] == 5.0
    assert (sums * chance).sum() == pytest.approx(used, rel=1e-3)
    for now, goal in zip(margins_of(sums * chance)[1:], goals[1:]):
        assert np.allclose(now, goal, rtol=1e-3)


def test_mixture(spark):
    rows = mixing.op6_target_mixture(spark, LARGER).toPandas()
    assert rows.probability.between(0, 1).all() and len(rows) == 10_000
    drawn = (rows.tokens * rows.probability).sum()
    assert drawn >= 0.99 * mixing.LEAST * rows.tokens.sum()
    for column, targets in mixing.TARGETS.items():
        expected = (rows.tokens * rows.probability).groupby(rows[column]).sum()
        there = rows.tokens.groupby(rows[column]).sum()
        goal = {c: t / sum(t for k, t in targets.items() if k in there) for c, t in targets.items() if c in there}
        for c, t in goal.items():  # at its target, or whole where that is too much
            assert expected[c] / drawn == pytest.approx(t, rel=0.05) or expected[c] >= 0.95 * there[c]
    assert rows.sampled.mean() == pytest.approx(rows.probability.mean(), abs=0.02)


@pytest.mark.parametrize("name", ["odd_documents", "no_documents"])
def test_mixture_of_odd_documents(request, name):
    docs = request.getfixturevalue(name)
    rows = mixing.mixed(docs).toPandas()
    assert len(rows) == docs.count() and rows["__probability"].between(0, 1).all()
    half = mixing.mixed(docs, budget=10.0).toPandas()
    assert (half["__tokens"] * half["__probability"]).sum() <= 10.0 + 1e-6


def brute_search(rows, k):
    rows = sorted({(i, c) for i, c in rows if i is not None and c is not None})
    out = []
    for q, code in rows:
        if q % 20 == 0:
            near = sorted((bin((code ^ c) & (2**64 - 1)).count("1"), i) for i, c in rows)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 10])
def test_code_search(spark, k):
    rng = np.random.default_rng(5)
    codes = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 150)]
    rows = [(i, codes[0] if i < 60 else codes[i % 150] ^ (1 << (i % 64) if i % 64 < 63 else 0)) for i in range(400)]
    rows += [(None, codes[1]), (400, None), (3, codes[0]), (20, codes[9])]
    items = spark.createDataFrame(rows, "id long, code long")
    got = sorted(tuple(r) for r in multiindex.search(items, items.filter("id % 20 = 0"), k).collect())
    assert got == brute_search(rows, k)
    assert multiindex.search(items.limit(0), items.limit(0), k).count() == 0


def test_code_search_with_many_ties(spark):
    """Copies and codes one or two bits apart: rows of several codes alternate by id at one distance."""
    rng = np.random.default_rng(8)
    center = int(rng.integers(-2**62, 2**62))
    rows = [(i, center ^ (1 << int(rng.integers(0, 6))) ^ (1 << int(rng.integers(0, 6)))) for i in range(300)]
    items = spark.createDataFrame(rows, "id long, code long")
    for k in (3, 10):
        got = sorted(tuple(r) for r in multiindex.search(items, items.filter("id % 20 = 0"), k).collect())
        assert got == brute_search(rows, k)


def test_code_search_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cur = con.execute(entry.oracle_sql()["op3_code_search"])
    names = [d[0] for d in cur.description]
    assert sorted(map(tuple, multiindex.op3_code_search(spark, SF).select(*names).collect())) == sorted(cur.fetchall())


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    want = {r.doc_id for r in quality.op1_quality(spark, SF).collect() if r.predicted == 1}
    kept = corpus_pipeline.good_quality(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == DOCUMENT_COLUMNS
    stages = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = corpus_pipeline.saved(stage(spark, stages, SF), "stage")
        assert stages.columns == DOCUMENT_COLUMNS
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in stages.collect()}
    assert (pieces.groupby("sequence_id").length.sum().iloc[:-1] == 2048).all()


def test_pipeline_of_odd_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, SF), "stage")


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names


def test_codes_of_vectors_of_any_length(spark, tmp_path):
    """All components count: 72, 100 and 200 of them, few, none, nulls among them; in Spark, by hand and in SQL."""
    rng = random.Random(9)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(n)]) for i, n in enumerate([64, 72, 100, 200, 3, 1, 128] * 12)]
    one = [1.0] * 64
    rows += [(100, one + [-9.0] * 8), (101, one + [9.0] * 8), (120, []), (121, None), (140, [None] * 70 + [1.0]), (None, one)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")
    frame.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))

    def by_hand(v):
        v = np.array([np.nan if c is None else c for c in v], np.float32).astype(np.float64)
        v = np.where(np.isnan(v), 0, v)
        return sum(1 << b for b in range(64) if sum(v[b::64].tolist()) > 0)

    got = {r.vec_id: r.code for r in frame.select("vec_id", multiindex.sign_code("embedding").alias("code")).collect()}
    assert got[121] is None and got[100] != got[101]
    assert all(got[i] & (2**64 - 1) == by_hand(v) for i, v in rows if i is not None and v is not None)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    names = ["query_id", "rank", "vec_id", "distance"]
    found = multiindex.op3_code_search(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(multiindex.OP3_SQL).fetchall())
