"""Packing and token-ID files against the tokenizer library on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from plumbline.llm import packing, pfor, tokens
from plumbline.llm.common import new_path
from plumbline.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {"words": Encoder(WORD, "words"), "byte_level": Encoder(BYTE, "byte_level")}


@pytest.mark.parametrize("split", ["words", "byte_level"])
@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t.,;'!aABzéÉİıſﬁ1239$<|>\x1c\x85\xa0́日")), st.characters(codec="utf-8")), max_size=60))
def test_parts_give_the_ids_of_the_text(split, text):
    own = ENCODERS[split]
    assert own.encode(text) == own.whole(text)


@pytest.mark.parametrize("split", ["words", "byte_level"])
@settings(max_examples=200, deadline=None)
@given(found=st.lists(st.text(alphabet=st.sampled_from(list("  \n'strevmldSTRE.,!*$%-_09aé\x00\x7f\t\u0301(«")), max_size=40), max_size=8),
       together=st.sampled_from([1, 30, 8_000_000]))
def test_texts_together_give_the_ids_of_each(split, found, together):
    own = ENCODERS[split]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "TOGETHER", together)
        assert list(own.encode_all(found)) == [own.whole(t) for t in found]


def test_a_very_long_text_is_encoded_alone(monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER", 50)
    own, seen = Encoder(BYTE, "byte_level"), []
    by_parts = Encoder._by_different_parts
    monkeypatch.setattr(Encoder, "_by_different_parts", lambda self, found: seen.append(sum(map(len, found))) or by_parts(self, found))
    found = ["one two\nthree"] * 6 + ["long text\n of words" * 40, "long text\nof words" * 40] + ["a b"] * 3
    assert list(own.encode_all(found)) == [own.whole(t) for t in found]
    assert seen and max(seen) <= 100


@pytest.mark.parametrize("split,path", [("words", WORD), ("byte_level", BYTE)])
def test_a_full_memory_keeps_its_newer_half_and_the_ids(monkeypatch, split, path):
    monkeypatch.setattr(tokens, "MAX_REMEMBERED", 40)
    own = Encoder(path, split)
    rows = [f"the word{k % 7} one{'abcdefghij'[k % 10]} heat{'*' * (k % 5)},\nand x{k} the" for k in range(60)]
    for some in ([t] for t in rows):
        assert list(own.encode_all(some)) == [own.whole(t) for t in some]
        assert own.encode(some[0]) == own.whole(some[0])
    kept = [own._words, own._later, own._words._older, own._later._older]
    assert sum(map(len, kept)) < 100 and "x0" not in {w for k in kept for w in k}


@pytest.mark.parametrize("split,path", [("words", WORD), ("byte_level", BYTE)])
def test_the_library_is_asked_once_for_marks_and_not_for_words(monkeypatch, split, path):
    own, asked = Encoder(path, split), []
    library = tokens._Words._library
    monkeypatch.setattr(tokens._Words, "_library", lambda self, part: asked.append(part) or library(self, part))
    text = "heat*** more$$$ don't heat%%% l'eau one,two"
    assert list(own.encode_all([text] * 50)) == [own.whole(text)] * 50
    assert set(asked) <= {"***", "$$$", "%%%", "'t", "'", ","} and len(asked) == len(set(asked))


@pytest.mark.parametrize("split,path", [("words", WORD), ("byte_level", BYTE)])
def test_strings_of_special_tokens_give_what_the_untouched_library_gives(split, path):
    from tokenizers import Tokenizer

    untouched = Tokenizer.from_file(path)
    for mark in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof text|>"):
        for text in (mark, f"one{mark}two", f"one {mark} two.\n{mark}{mark}", f"{mark}\x1c x", f" a\n\n{mark}", f"{mark[:-1]} {mark}"):
            ids = untouched.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ENCODERS[split].encode(text), "<u4").tolist() == ids


def ids_of(rows, path, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [(r.doc_id, np.array([*t.encode(r.text or "", add_special_tokens=False).ids, end], "<u4")) for r in rows]


@pytest.mark.parametrize("window", [16, 2048])
@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_packing(request, name, window):
    docs = request.getfixturevalue(name)
    by_place = packing.pack(docs, WORD, "words", window=window).orderBy("sequence_id", "offset").collect()
    at = 0
    for p in by_place:
        assert (p.sequence_id, p.offset) == divmod(at, window) and p.opens_window == (p.offset == 0)
        at += p.length
    want = []
    for doc, ids in ids_of(docs.collect(), WORD, packing.END_ID):
        want.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    got, n = [], 0
    for p in by_place:  # the pieces of a document follow each other
        if p.start == 0:
            n = 0
        assert p.start == n and p.length > 0
        n += p.length
        if p.start == 0 and p.ends_document:
            got.append((p.doc_id, n, p.ids_crc32))
        elif p.ends_document:
            got.append((p.doc_id, n, None))
    shown = lambda rows: sorted((str(d), n) for d, n, _ in rows)
    assert shown(got) == shown(want)
    crcs = {(str(d), n, c) for d, n, c in want}
    assert all((str(d), n, c) in crcs for d, n, c in got if c is not None)


def test_pieces_hold_their_ids(documents):
    pieces = packing.pack(documents, WORD, "words", window=100).toPandas()
    ids = dict(ids_of(documents.collect(), WORD, packing.END_ID))
    for p in pieces.itertuples():
        assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32


def test_windows(documents):
    pieces = packing.pack(documents, WORD, "words")
    rows = packing.windows(pieces).orderBy("sequence_id").collect()
    assert [r.sequence_id for r in rows] == list(range(len(rows)))
    assert all(r.n_tokens == packing.WINDOW for r in rows[:-1]) and rows[0].start == 0


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_token_files(request, spark, name):
    docs = request.getfixturevalue(name)
    path = new_path(spark, "test")
    got = sorted(map(tuple, pfor.token_files(docs, path, BYTE, "byte_level", block=64).collect()))
    rows = sorted(docs.filter("doc_id IS NOT NULL").collect(), key=lambda r: (r.doc_id, r.text or ""))
    start, want = 0, []
    for doc, ids in ids_of(rows, BYTE, pfor.END_ID):
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)


def test_the_files_go_to_python_once(spark, documents, monkeypatch):
    path = new_path(spark, "test")
    pfor.write(documents, path, BYTE, "byte_level", shard_ids=200)
    calls = []
    frame = type(documents)
    whole = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: calls.append(a) or whole(self, *a, **k))
    got = pfor.read(spark, path).orderBy("start").collect()
    assert len(calls) == 1
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in documents.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 300)), max_size=200), min_size=1, max_size=6),
       st.sampled_from([64, 128, 1024]))
def test_shard_round_trip(docs, block):
    ids = np.array([x for d in docs for x in d], np.uint32)
    shard = pfor.Shard(pfor.encode_shard(7, list(range(len(docs))), [len(d) for d in docs], ids, block) + b"\n")
    assert shard.number == 7 and (shard.ids() == ids).all() and shard.doc_ids.tolist() == list(range(len(docs)))
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d
    if len(ids) > 3:
        assert (shard.ids(2, len(ids) - 1) == ids[2:-1]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1024, dtype=np.uint32) % 16
    plain = len(pfor.encode_shard(0, [0], [1024], ids))
    ids[5] = 4_000_000_000
    assert len(pfor.encode_shard(0, [0], [1024], ids)) - plain <= 6
