"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from netscope.llm import byte_bpe as B

PATH = P.path(B.VOCABULARY)
ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
    base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))})


def same(texts):
    ids, offsets = B.encode_batch(texts, PATH)
    data, bounds = B.decode_batch(ids, offsets, PATH)
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == ENCODING.encode_ordinary(t or ""), repr(t)
        assert data[bounds[i]:bounds[i + 1]] == (t or "").encode()


def test_random_mixtures():
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "re", "'", "'s", "'ll", "'ve", " ", "  ", "\n", "\t", "1", "23", "!", "é", "ß", "中",
             " ", "　", "\0", "🙂", "\x1c", "ñ", "'d", "m", " '", "ª", "²", "\r\n", "\x85", "\xa0"]
    same(["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [
        "", None, "a" * 3000, "ab" * 2000, " " * 300, "'" * 50, "\0\0a\0", "\n" * 70 + "x"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=6))
def test_any_text(texts):
    if texts:
        same(texts)


def test_all_planes():
    """Every code point beside a letter, a digit, white space and a sign; and letters newer than Python's tables."""
    rng = random.Random(7)
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(["".join(chr(c) + rng.choice("한1 !\n") for c in every[i:i + 8000]) for i in range(0, len(every), 8000)])
    same([chr(c) + "한" for c in (0x105CC, 0x1396C, 0x13A00, 0x14110)])
    astral = [c for c in every if 0x10000 <= c < 0x32000]
    same(["".join(chr(rng.choice(astral)) for _ in range(rng.randint(1, 12))) for _ in range(3000)])


def test_scan_is_associative():
    """Blocked composition equals stepping through the automaton."""
    own, compose, at_fresh, _ = B._monoid()
    cls = np.random.default_rng(0).integers(0, 9, 5000)
    state, want = B.FRESH, []
    for c in cls.tolist():
        state = B._step(state, c)[0]
        want.append(state)
    for block in (2, 7, 64, 9000):
        assert at_fresh[B._scan(own[cls], block)].tolist() == want


def test_operator(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    encoded = B.encode(docs, PATH)
    rows = encoded.collect()
    texts = sorted(((i is None, i or 0, t or "") for i, t in edge_rows))
    assert len(rows) == len(texts)
    data = B.decode(encoded, PATH).collect()
    assert sorted(bytes(r["data"]) for r in data) == sorted((t or "").encode() for _, t in edge_rows)
    for r in rows:
        assert len(r["ids"]) == len(r["byte_starts"]) and list(r["byte_starts"]) == sorted(r["byte_starts"])
    found = {(r["doc_id"], r["ids_sha256"]) for r in B.digests(docs, PATH).collect()}
    for i, t in edge_rows:
        ids = np.array(ENCODING.encode_ordinary(t or ""), "<u4")
        assert (i, hashlib.sha256(ids.tobytes()).hexdigest()) in found
    assert B.digests(make_docs([]), PATH).count() == 0
