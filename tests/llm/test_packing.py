"""Packing: ids as the tokenizer gives them, every id once, gapless sequences, no padding."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from netscope.llm import packing as K

PATH = public_tokenizers.path(K.VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [K.END_ID], "<u4")


def test_ids_equal_the_tokenizer():
    rng = random.Random(2)
    parts = ["a", "B", "s", "'s", "'LL", " ", "  ", "\n", "\t", "1", "23", "!", "é", "É", "ß", "中", "\x0b", "\x1c",
             "\xa0", "\x85", "Σ", "İ", "é", "́", ",", ".", "word", "Word,", "<|endoftext|>", "²", " "]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert K.token_ids(text, PATH) == ids_of(text).tobytes(), repr(text)


def check(rows, pieces, limit=2048):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    want = collections.defaultdict(list)
    for i, t in rows:
        want[i].append(ids_of(t))
    for i, texts in want.items():
        assert sum(p["length"] for p in by_doc[i]) == sum(map(len, texts))
        for p in by_doc[i]:
            fits = [t for t in texts if len(t) == p["doc_tokens"]]
            assert any(zlib.crc32(t[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for t in fits)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limit and at & (at - 1) == 0  # a power of two needs no padding
    return by_seq


@pytest.mark.parametrize("block", [300, 2_000_000])
def test_pieces_cover_everything(make_docs, edge_rows, block):
    rng = random.Random(3)
    rows = [*edge_rows, *[(100 + i, "word and more text " * rng.randint(0, 700)) for i in range(40)]]
    pieces = K.pack(make_docs(rows), PATH, block_tokens=block).collect()
    check(rows, pieces)
    steps = collections.defaultdict(dict)
    for p in pieces:
        steps[p["step_id"]].setdefault(p["sequence_id"], p["tier"])
    for seqs in steps.values():
        assert len(set(seqs.values())) == 1 and sum(seqs.values()) <= K.STEP_TOKENS


def test_tiers_and_gap_filling():
    packer = K.Packer((16, 8, 4))
    done = [w for i, n in enumerate([40, 13, 3, 6, 2, 7, 1]) for w in packer.add(i, n)]
    assert [t for t, _ in done] == [16, 16]  # whole long windows of the first document
    done += list(packer.close())
    assert sum(p[2] for _, w in done for p in w) == 72
    assert all(sum(p[2] for p in w) == t for t, w in done)
    thirteen = next(w for _, w in done if any(p[0] == 1 and p[1] == 0 for p in w))
    assert sum(p[2] for p in thirteen) == 16 and len(thirteen) > 1  # its gap was filled from shorter tiers


def test_empty_table(make_docs):
    assert K.pack(make_docs([]), PATH).count() == 0
