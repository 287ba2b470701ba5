"""Vector codes and whitening against brute force and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, duck
from plumbline.llm import dualtree, whitening
from plumbline.llm.common import joined_to_groups, table
from tests.llm.conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int, code string, n long, dim string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "x", 1, "d") for i, v, label in rows], VECTORS).repartition(parts)


def random_rows(seed, n, dim, copies=3):
    """Clustered vectors with a third of equal ones, ties on a coarse grid, labels with nulls."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    x = np.round((centres[rng.integers(20, size=n)] + 0.2 * rng.normal(size=(n, dim))) * 16) / 16
    x[: n // copies] = x[0]
    x = x[rng.permutation(n)].astype(np.float32)
    return [(int(i), v.tolist(), None if i % 7 == 0 else int(i % 3)) for i, v in enumerate(x)]


ODD = [
    (1, None, 1), (2, [], 1), (3, [1.0, None, 0.0, 0.0], 1), (4, [float("nan")] * 4, 1), (5, [float("inf"), 0.0, 0.0, 0.0], 2),
    (6, [1.0, 2.0, 3.0, 4.0], None), (6, [1.0, 2.0, 3.0, 4.0], None), (7, [-1e30, 1e30, 0.5, -0.25], 2), (None, [0.0] * 4, 2),
    (6, [1.0, -2.0, 3.0, 4.0], 3), (9, [0.1, 0.2], 1), (10, [0.5, 0.5, -0.5, 0.0], 1), (11, [0.0] * 4, 1), (12, [1.0] * 5, 1),
    (13, [-0.0001] * 4, 3),
]


def brute_codes(rows, parts=4, entries=256, rounds=4):
    usable = [(i, v, g) for i, v, g in rows if v and all(c is not None and np.isfinite(c) for c in v) and len(v) % parts == 0]
    if not usable:
        return {}, None
    lengths = [len(v) for _, v, _ in usable]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    usable = [r for r in usable if len(r[1]) == dim]
    x = np.floor(np.clip(np.array([np.float32(v) for _, v, _ in usable], np.float64), -(2**15), 2**15) * 1024).astype(np.int64)
    ids = [i for i, _, _ in usable]
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, x[k].astype("<i4").tobytes()))
    books = np.stack(np.split(x[order[:entries]], parts, axis=1))
    cut = np.split(x, parts, axis=1)

    def nearest():
        d = [((c[:, None] - b[None]) ** 2).sum(axis=2) for c, b in zip(cut, books)]
        return np.stack([a.argmin(axis=1) for a in d], axis=1), sum(a.min(axis=1) for a in d)

    for _ in range(rounds):
        codes, _ = nearest()
        for p in range(parts):
            for e in set(codes[:, p].tolist()):
                own = cut[p][codes[:, p] == e]
                books[p, e] = [int(s) // len(own) for s in own.sum(axis=0)]
    codes, error = nearest()
    found = sorted(
        ((i, "".join(f"{e:02x}" for e in c), int(d), g) for (i, _, g), c, d in zip(usable, codes.tolist(), error)), key=str)
    return found, dualtree.digest(books)


def codes_of(frame_):
    rows, books = dualtree.coded(frame_)
    return sorted(((r.vec_id, r.code, r.error, r.label) for r in rows.collect()), key=str), dualtree.digest(books)


@pytest.mark.parametrize("seed,n,dim,block,leaf", [(1, 900, 16, 64, 4), (2, 700, 8, 4096, 32), (3, 100, 32, 16, 1)])
def test_codes(spark, monkeypatch, seed, n, dim, block, leaf):
    monkeypatch.setattr(dualtree, "BLOCK", block)
    monkeypatch.setattr(dualtree, "LEAF", leaf)
    rows = random_rows(seed, n, dim)
    assert codes_of(frame(spark, rows)) == brute_codes(rows)


def test_codes_of_odd_rows(spark):
    assert codes_of(frame(spark, ODD)) == brute_codes(ODD)
    none = frame(spark, [])
    assert dualtree.coded(none)[0].count() == 0
    assert dualtree.coded(frame(spark, ODD[:5]))[0].count() == 0


def test_walk_decides_whole_nodes(spark):
    """Far groups are assigned by their nodes' sums, and never to an entry that is not the nearest."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-(10**6), 10**6, (40, 16))
    x = centres[rng.integers(40, size=3000)] + rng.integers(-50, 50, (3000, 16))
    order, counts, levels = dualtree.grown(x, 16)
    block = dualtree.Block(x, order, counts, *dualtree.node_values(x, order, counts, levels))
    tree = dualtree.EntryTree(np.concatenate([centres, centres[:5]]))  # equal entries
    nodes, _, places, _ = block.decided(tree)
    assert block.n[nodes].sum() > 2000 and (nodes < block.leaves - 1).any() and len(places) < 1000
    want = ((x[:, None] - tree.book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (block.labels(tree) == want).all()
    total = np.zeros((45, 17), np.int64)
    block.add_to(total, tree)
    assert (total[:, 0] == np.bincount(want, minlength=45)).all()
    assert (total[7, 1:] == x[want == 7].sum(axis=0)).all()


def test_large_components_stay_exact():
    rng = np.random.default_rng(6)
    x, y = rng.integers(-(2**25), 2**25, (50, 64)), rng.integers(-(2**25), 2**25, (20, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in y] for u in x]
    assert dualtree.squared_distances(x, y).tolist() == want


def test_heavy_groups_join_without_a_shuffle(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 1500).alias("label"), "id")
    groups = rows.groupBy("label").agg(F.sum("id").alias("total"), F.count(F.lit(1)).alias("n"))
    got = {(r.id, r.label, r.total) for r in joined_to_groups(rows, groups, "label").collect()}
    sums = {r.label: r.total for r in groups.collect()}
    assert got == {(r.id, r.label, sums[r.label]) for r in rows.collect()}


def test_codes_query_against_sql(spark):
    assert compare(spark, duck(SF), SF, dualtree.op12_dual_tree_codes, dualtree.OP12_SQL) is None


# ---------------------------------------------------------------- whitening


def brute_whitening(rows, most=32):
    usable = [(i, v) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in usable]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    usable = [(i, v) for i, v in usable if len(v) == dim]
    x = np.floor(np.clip(np.array([np.float32(v) for _, v in usable], np.float64), -(2**15), 2**15) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    centred = (x - x.min(axis=0)) - (s - n * x.min(axis=0)) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:most]
    return usable, n, deviation, centred, values[order], vectors[:, order], np.trace(covariance)


@pytest.mark.parametrize("seed,n,dim", [(11, 600, 40), (12, 300, 8)])
def test_whitening(spark, seed, n, dim):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) @ np.diag(np.linspace(3, 0.5, dim)) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + ODD[:5]
    usable, count, deviation, centred, values, vectors, trace = brute_whitening(rows)
    found = whitening.whitened(frame(spark, rows)).collect()
    k = min(32, dim)
    assert len(found) == len(usable) * k
    by = {(r.vec_id, r.component): r for r in found}
    want = centred @ vectors / np.sqrt(values)
    got = np.array([[by[i, c + 1].whitened for c in range(k)] for i, _ in usable])
    sign = np.sign((want * got).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-8
    first = by[usable[0][0], 1]
    assert first.n == count and max(r.identity_error for r in found) < 1e-12
    assert [int(by[i, 1].deviation) for i, _ in usable] == deviation
    for c in range(k):
        assert by[usable[0][0], c + 1].explained == pytest.approx(values[c] / trace, rel=1e-12)


def test_whitening_of_odd_rows(spark):
    found = whitening.whitened(frame(spark, ODD)).collect()
    usable, count, deviation, *_ = brute_whitening(ODD)
    assert len(found) == 4 * len(usable) and {r.n for r in found} == {count}
    assert sorted(int(r.deviation) for r in found if r.component == 1) == sorted(deviation)
    assert whitening.whitened(frame(spark, [])).count() == 0
    alone = whitening.whitened(frame(spark, [(1, [0.5, 1.0], 1)])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in alone] == [
        (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]


def test_components_without_variance(spark):
    rows = [(i, [float(i % 5), float(i % 3), 2.0, float(i % 5)], 1) for i in range(60)]  # rank 2 of 4
    found = whitening.whitened(frame(spark, rows)).collect()
    assert {r.whitened for r in found if r.component > 2} == {0.0}
    assert max(r.identity_error for r in found) < 1e-12


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 48), np.r_[1 + np.arange(24) * 1e-9, np.linspace(2, 50, 24)], np.r_[np.ones(20), np.full(8, 1 + 1e-6), np.arange(2, 22)],
    10.0 ** -np.arange(0, 12, 0.25), np.r_[np.zeros(10), np.ones(38)],
])
def test_refined_eigenvectors(values):
    """Residual and orthogonality at the precision of doubles, whatever the gaps."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(48, 48)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(48) - q.T @ q) / 2)
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.eigenvectors(a)
    xl = x.astype(np.longdouble)
    assert np.abs(got - np.sort(values)[::-1]).max() < 1e-15 * values.max() * 4
    assert np.abs(xl.T @ xl - np.eye(48)).max() < 1e-15
    assert np.abs(a @ xl - xl * got).max() < 1e-15 * values.max() * 4
    exact = q[:, np.argsort(-values, kind="stable")]
    sorted_values = np.sort(values)[::-1]
    for k in range(48):  # every eigenvector whose eigenvalue is a simple one, by its gap
        gap = min([abs(sorted_values[k] - v) for i, v in enumerate(sorted_values) if i != k])
        if gap > 1e-7 * values.max():
            error = 3e-16 + 2e-19 * values.max() / gap  # what the rounding of the matrix itself may do
            assert min(np.abs(x[:, k] - exact[:, k]).max(), np.abs(x[:, k] + exact[:, k]).max()) < error


def test_whitening_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    usable, count, deviation, centred, values, vectors, trace = brute_whitening(rows)
    found = whitening.op13_whitening(spark, SF)
    assert dict(found.dtypes)["deviation"] == "bigint"
    by = {(r.vec_id, r.component): r for r in found.collect()}
    assert len(by) == 32 * len(usable)
    want = centred @ vectors / np.sqrt(values)
    got = np.array([[by[i, c + 1].whitened for c in range(32)] for i, _ in usable])
    assert np.abs(got - want * np.sign((want * got).sum(axis=0))).max() < 1e-8
    assert [by[i, 32].deviation for i, _ in usable] == deviation
    assert max(r.identity_error for r in by.values()) < 1e-12
    assert all(abs(by[usable[0][0], c + 1].explained - values[c] / trace) < 1e-12 for c in range(32))
