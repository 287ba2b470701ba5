"""Near-duplicates, sentence spans, embeddings and components against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import minhash, rabitq, sentencespans
from plumbline.llm.components import components
from plumbline.llm.common import table
from tests.llm.conftest import SF, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, k) for k in range(2, 50)]
    links = [*chain, *star, (70, 70), (49, 300), (300, 20), (80, 81), (81, 80)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == smallest_reachable({x for p in links for x in p}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_sets(rows, size):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        words = WORD.findall((r.text or "").translate(lower))
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return sets


@pytest.mark.parametrize("size", [2, 5])
@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_near_duplicates(request, name, size):
    docs = request.getfixturevalue(name)
    rows = docs.collect()
    sets = brute_sets(rows, size)
    ids = [r.doc_id for r in rows]
    links = [
        (ids[i], ids[j]) for i in range(len(rows)) for j in range(i)
        if ids[i] is not None and ids[j] is not None and sets[i] and sets[j]
        and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = smallest_reachable({i for i in ids if i is not None}, links)
    want = sorted(str((i, len(s), root.get(i), i is None or root[i] == i)) for i, s in zip(ids, sets))
    assert sorted(str(tuple(r)) for r in minhash.near_duplicates(docs, size).collect()) == want


def test_link_through_a_member_that_is_not_the_smallest(spark):
    """A chain of changes: the ends are unlike, so comparing with the smallest member alone would break it."""
    words = prose(5, 400).split()
    texts = []
    for step in range(12):
        changed = list(words)
        for k in range(step * 9):
            changed[(k * 7) % 400] = f"new{k}"
        texts.append((100 - step if step % 2 else step + 1, " ".join(changed)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = docs.collect()
    sets = brute_sets(rows, 2)
    links = [(rows[i].doc_id, rows[j].doc_id) for i in range(12) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = smallest_reachable([r.doc_id for r in rows], links)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2).collect()} == root


def test_one_of_each_group_stays(odd_documents):
    kept = minhash.deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 1 in ids and 2 not in ids and 7 in ids and 8 not in ids and 9 not in ids


def brute_spans(rows):
    seen, out = set(), {}
    for r in sorted((r for r in rows if r.doc_id is not None), key=lambda r: r.doc_id):
        words = sentencespans.sentences(r.text or "")[1] if r.text is not None else []
        n, covered, own = len(words), set(), set()
        runs = set()
        for i in range(n):
            ends = [j for j in range(i + sentencespans.RUN, n + 1) if sum(map(len, words[i:j])) >= sentencespans.MIN_WORDS][:1]
            runs |= {(i, j) for j in ends}
        for j in range(1, n + 1):
            starts = [i for i in range(j - sentencespans.RUN, -1, -1) if sum(map(len, words[i:j])) >= sentencespans.MIN_WORDS][:1]
            runs |= {(i, j) for i in starts}
        for i, j in sorted(runs):
            key = tuple(map(tuple, words[i:j]))
            if key in seen or key in own:
                covered |= set(range(i, j))
            own.add(key)
        seen |= own
        out[r.doc_id] = (n, len(covered), covered)
    return out


def test_sentence_spans(documents):
    want = brute_spans(documents.collect())
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in sentencespans.deduplicated(documents).collect():
        n, gone, covered = want[r.doc_id]
        parts = sentencespans.sentences(texts[r.doc_id])[0]
        assert "".join(parts) == texts[r.doc_id]
        assert (r.n_sentences, r.n_removed) == (n, gone)
        assert r.text == "".join(p for k, p in enumerate(parts) if k not in covered)


def test_sentence_spans_of_odd_documents(spark, odd_documents, no_documents):
    rows = sentencespans.deduplicated(odd_documents).collect()
    assert len(rows) == odd_documents.count() and sentencespans.deduplicated(no_documents).count() == 0
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    base = prose(1, 60)
    assert by_id[1][0].text == base and {r.text for r in by_id[2]} == {""}  # the copies go, both rows of id 2
    assert by_id[16][0].text == prose(3, 80) + "\n"  # the passage that document 1 has goes, the rest stays
    assert by_id[4][0].text is None and by_id[5][0].text == "" and base in {r.text for r in by_id[None]}


@pytest.mark.parametrize("marks", [0, 0.04, 0.08, 0.15])
def test_any_shared_window_is_found(spark, marks):
    """Windows of 50 words from every offset of a text, between words of their own: each loses words, nothing else does."""
    rng = random.Random(marks)

    def fresh(name, n):
        return [f"{name}{k}" + ("." if rng.random() < marks else "") for k in range(n)]

    source = fresh("w", 300)
    rows, around = [(0, " ".join(fresh("z", 7) + source))], {}
    for at in range(251):
        before, after = " ".join(fresh(f"a{at}x", rng.randint(0, 40))), " ".join(fresh(f"b{at}x", rng.randint(0, 40)))
        around[at + 1] = before, after
        rows.append((at + 1, " ".join(filter(None, [before, *source[at : at + 50], after]))))
    texts = dict(rows)
    for r in sentencespans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.doc_id == 0:
            assert r.text == texts[0]
            continue
        before, after = around[r.doc_id]
        assert r.text.startswith(before) and r.text.endswith(after) and len(r.text.split()) <= len(texts[r.doc_id].split()) - 20


def test_shared_text_without_blanks(spark):
    rng = random.Random(3)
    fresh = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))
    source = fresh(1500)
    rows = [(0, fresh(11) + source)] + [(at + 1, fresh(rng.randint(0, 99)) + source[at : at + 450] + fresh(60)) for at in range(0, 1050, 13)]
    for r in sentencespans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = dict(rows)[r.doc_id]
        assert r.text == text if r.doc_id == 0 else len(r.text) <= len(text) - 20 and r.text.endswith(text[-60:])


def test_two_texts_under_one_id(spark):
    base, own, short = prose(1, 60), prose(8, 90), "Short."
    rows = [(1, base), (2, f"{own}\n{base}"), (2, prose(9, 200)), (2, short)]
    got = sentencespans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(1, base), (2, f"{own}\n"), (2, prose(9, 200)), (2, short)}


def brute_links(rows):
    ids = list(range(len(rows)))
    links = set()
    unit = []
    for r in rows:
        x = None if r.embedding is None or any(v is None for v in r.embedding) else np.array(r.embedding, float)
        fine = x is not None and len(x) and np.isfinite(x).all() and x.any() and r.label is not None and r.vec_id is not None
        unit.append(x / np.abs(x).max() / np.sqrt(((x / np.abs(x).max()) ** 2).sum()) if fine else None)
    for i in ids:
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i].label == rows[j].label and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= rabitq.THRESHOLD:
                    links |= {(i, j), (j, i)}
    return links


def cluster(rng, center, n, noise):
    return [(center + rng.normal(0, noise, len(center))).tolist() for _ in range(n)]


def near_vectors(seed=4):
    """Tight and loose groups, copies, chains; no pair so near the threshold that rounding decides."""
    rng = np.random.default_rng(seed)
    vectors = []
    for noise in (0.01, 0.017, 0.02):
        vectors += cluster(rng, rng.normal(0, 1, 64) / 8, 60, noise)
    vectors += [vectors[0]] * 20
    vectors += rng.normal(0, 1, (60, 64)).tolist()
    return [(i, v, i % 3 if i < 60 else 1) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("block", [16, 1024])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(rabitq, "BLOCK", block)
    rows = near_vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = brute_links(frame.collect())
    root = smallest_reachable(range(len(rows)), links)
    degree = np.bincount([a for a, _ in links], minlength=len(rows))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rabitq.near_duplicates(frame).collect()}
    assert got == {i: (degree[i], root[i], root[i] == i) for i in range(len(rows))}


def test_odd_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0, 5), (2, [2.0, 0.0], 0, 5), (3, [1.0, 0.0], 1, 5), (4, [1.0, 0.0], None, 5), (5, None, 0, 5),
        (6, [0.0, 0.0], 0, 5), (7, [nan, 1.0], 0, 5), (8, [inf, 1.0], 0, 5), (9, [None, 1.0], 0, 5), (10, [], 0, 5),
        (11, [1.0], 0, 5), (12, [3.0], 0, 5), (13, [1.0, 0.0, 0.0], 0, 5), (None, [1.0, 0.0], 0, 5), (14, [1e200, 0.0], 0, 5),
        (15, [1e-200, 0.0], 0, 5), (16, [1.0, 0.0], 0, 5), (16, [1.0, 0.0], 0, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int")
    got = sorted((tuple(r) for r in rabitq.near_duplicates(frame).collect()), key=str)
    same = {1, 2, 14, 15, 16}
    want = [(i, 5 if i in same else 1 if i in (11, 12) else 0, 1 if i in same else 11 if i == 12 else i) for i, *_ in rows]
    assert got == sorted(((i, n, c, i is None or i == c) for i, n, c in want), key=str)
    assert rabitq.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    unit = rng.normal(0, 1, (400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes, factors = rabitq.encode(unit)
    estimate, bound = rabitq.estimates(codes, factors, unit)
    error = estimate - unit @ unit.T
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 2e-3 and (np.abs(error) <= bound)[off].mean() > 0.9995


def test_embedding_table(spark):
    frame = table(spark, SF, "embeddings")
    links = brute_links(rows := frame.collect())
    got = {r.vec_id: r.n_links for r in rabitq.near_duplicates(frame).collect()}
    degree = np.bincount([a for a, _ in links], minlength=len(rows)) if links else np.zeros(len(rows))
    assert got == {r.vec_id: int(degree[i]) for i, r in enumerate(rows)}
