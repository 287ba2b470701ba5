import hashlib
import random
import re

import pytest

from plumbline.llm import secretscan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
RULES = tuple(secretscan.RULES)


def base(text):
    return sorted(
        [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        + [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
        + [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32])


def test_spans_equal_the_regexes():
    rng = random.Random(3)
    parts = [
        "token", "secret", "password", "PassWd", "api_key", "API_KEY", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH1234", "é",
        "0123456789abcdef", "0123456789abcdef", "日", "secret: token: abcdefgh12", "abcd", "\n", "-", "ghp_", "K", "aa"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in secretscan.spans(text.encode(), RULES) if s[1] < 3] == base(text), text


def test_more_kinds():
    def kinds(text):
        return {secretscan.RULES[k].kind for _, k, _ in secretscan.spans(text.encode(), RULES)}

    assert "github" in kinds("x ghp_" + "aB3" * 12)
    assert "pem" in kinds("-----BEGIN RSA PRIVATE KEY-----") and "pem" in kinds("-----BEGIN PRIVATE KEY-----")
    assert kinds("AIza short, xoxb-1, sk_live_1, ghp_1") == set()


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_scan(request, name):
    docs = request.getfixturevalue(name)
    rows = secretscan.scan(docs).collect()
    assert len(rows) == docs.count()
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    want = []
    for doc, text in texts:
        found = base(text)
        told = ",".join(f"{secretscan.RULES[k].kind}:{a}:{b}" for a, k, b in found)
        want.append((doc, *[sum(k == x for _, k, _ in found) for x in range(3)], hashlib.sha256(told.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:5] for r in rows))) == sorted(map(str, want))


def test_redacted(odd_documents):
    rows = {r.doc_id: r for r in secretscan.redacted(odd_documents).collect()}
    assert rows[17].text == "[SECRET] token: short" and rows[17].n_chars == len(rows[17].text)
    assert rows[4].text is None and rows[1].text == next(r.text for r in odd_documents.collect() if r.doc_id == 1)
    assert secretscan.redacted(odd_documents).columns == odd_documents.columns
