"""Line deduplication against brute force and SQL."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, duck
from plumbline.llm import linededup
from tests.llm.conftest import SCHEMA, SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept text) of each row."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(float("-inf") if r.doc_id is None else r.doc_id)
    out = []
    for r in rows:
        all_lines, own = (r.text or "").split("\n"), float("-inf") if r.doc_id is None else r.doc_id
        stays = [x for x in all_lines if len(holders[key(x)]) < 3 or own == max(holders[key(x)])]
        out.append((r.doc_id, len(all_lines), len(all_lines) - len(stays), "\n".join(stays)))
    return sorted(out, key=str)


def result(docs):
    return sorted(
        ((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in linededup.deduplicated(docs).collect()), key=str)


@pytest.fixture(scope="module")
def shared_lines(spark):
    """A line in a third of all rows, lines in two and three documents, blanks, case, long documents, shared ids."""
    rng = random.Random(7)
    common = [f"a line that several documents hold, number {i}" for i in range(300)]
    rows = []
    for i in range(400):
        own = [f"only in document {i} and in no other, line {j}" for j in range(rng.randrange(6))]
        own += rng.sample(common, rng.randrange(8))
        own += ["  \tCOMMON Footer of a third of all documents\r"] * (i % 3 == 0) + ["short"] * rng.randrange(3)
        own += ["Ünïcode footer, À LA LIGNE, STRASSE ß"] * (i % 5 == 0) + ["twice in one place, but kept or dropped"] * 2 * (i % 50 == 0)
        rng.shuffle(own)
        rows.append((None if i % 20 == 7 else i // 2 if i % 10 == 3 else i, "\n".join(own) if i % 30 else None))
    rows.append((1000, "\n".join([*common, *[f"long document, line {j} of so many" for j in range(3000)]] * 2)))
    rows.append((999, "\n".join([f"long document, line {j} of so many" for j in range(0, 3000, 7)])))
    rows.append((998, "\n".join([f"long document, line {j} of so many" for j in range(3000)])))
    rows += rows[:40]
    return spark.createDataFrame([(*r, "en", "s", 1, 0.1, 1, "p") for r in rows], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents", "shared_lines"])
def test_kept_lines(request, name):
    docs = request.getfixturevalue(name)
    want = brute(docs.collect())
    assert result(docs) == want
    assert name == "no_documents" or any(r[2] for r in want)


def test_frequent_hashes_take_the_other_way(shared_lines, monkeypatch):
    """The sketch decides how a hash is dealt, never what comes out."""
    keyed = linededup.lines(shared_lines)
    footer = keyed.groupBy("h1").agg(F.count_distinct("doc_id").alias("n")).orderBy(F.desc("n")).first()
    assert footer.h1 in {r.h1 for r in linededup.frequent(keyed).collect()}
    want = result(shared_lines)
    for keys, counters in ((1, 64), (5, 1024)):
        monkeypatch.setattr(linededup, "HOT_KEYS", keys)
        monkeypatch.setattr(linededup, "COUNTERS", counters)
        assert linededup.frequent(keyed).count() <= keys
        assert result(shared_lines) == want


def test_bitmaps_are_sparse_and_cover_each_row(shared_lines):
    found = linededup.keep_bitmaps(shared_lines)
    rows = {(r.doc_id, r.version): r for r in found.collect()}
    assert len(rows) == found.count()
    for r in rows.values():
        words = [w.word for w in r.keep]
        assert words == sorted(set(words)) and all(w.bits != -1 for w in r.keep)
        assert r.n_dropped == sum(64 - (w.bits & (2**64 - 1)).bit_count() for w in r.keep)


def test_one_range_exchange_and_no_python(shared_lines):
    keyed = linededup.lines(shared_lines)
    plan = linededup._repeats_of_others(keyed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(h1" in plan
    whole = linededup.deduplicated(shared_lines)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in whole and "Arrow" not in whole


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "x\ny", 5, 6, "w", 1)], "doc_id int, text string, n_lines int, keep int, `a.b` string, version int")
    r = linededup.deduplicated(docs).first()
    assert (r.n_lines, r.n_dropped, r.keep, r["a.b"], r.version, r.text) == (2, 0, 6, "w", 1, "x\ny")


def test_long_text_in_linear_time(spark):
    """Some 4 MB of lines in one text, half of them dropped."""
    many = [f"line {i} of a very long document" for i in range(120_000)]
    rows = [(9, "\n".join(many)), (1, "\n".join(many[::2])), (2, "\n".join(many[::2]))]
    docs = spark.createDataFrame([(*r, "en", "s", 1, 0.1, 1, "p") for r in rows], SCHEMA)
    assert result(docs) == brute(docs.collect())


def test_query_against_sql(spark):
    assert compare(spark, duck(SF), SF, linededup.op11_line_bitmaps, linededup.OP11_SQL) is None
    row = linededup.op11_line_bitmaps(spark, SF).orderBy("doc_id").first()
    assert len(row.kept_sha256) == len(hashlib.sha256(b"").hexdigest())
