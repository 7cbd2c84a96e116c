"""Lattice scores: base against plain Python, lattice against enumeration, marginal sums."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from netscope.llm import lattice_lm as L

PATH = public_tokenizers.path(L.VOCABULARY)


def brute_base(rows, train):
    c = collections.Counter()
    for i, t in rows:
        if train(i):
            c.update([*(t or "").encode().lower().split(), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        out.append((i, len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def agree(rows, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key)):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)


@pytest.mark.parametrize("heavy", [100_000, 5])
def test_edge_cases(make_docs, edge_rows, monkeypatch, heavy):
    """The same results whether words are broadcast or travel as messages to parts with copies."""
    monkeypatch.setattr(L, "HEAVY", heavy)
    monkeypatch.setattr(L, "PART_WORDS", 100)
    monkeypatch.setattr(L, "PART_MESSAGES", 1_000)
    train = F.col("doc_id") % 2 == 0
    rows = L.score_texts(make_docs(edge_rows), train, PATH).collect()
    agree(rows, brute_base(edge_rows, lambda i: i is not None and i % 2 == 0))


def test_query(spark):
    rows = L.query(spark, SF_SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    agree(rows, brute_base(docs, lambda i: zlib.crc32(str(i).encode()) % 10 != 0))
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 10 == 0}


def test_no_training_texts_and_empty_table(make_docs):
    rows = L.score_texts(make_docs([(1, "a b"), (2, None)]), F.lit(False), PATH).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(0, 0, 0.0)] * 2
    assert L.score_texts(make_docs([]), F.lit(True), PATH).count() == 0


def test_forward_sums_all_segmentations():
    v = L.pieces(PATH)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = {sp.id_to_piece(i): i for i in range(v.size) if np.isfinite(v.prior[i])}
    words = ["the", "nation", "é", "zq", "ththnt", "x" * 40, "中文", "\U0001f642a"]

    def total(text):
        if not text:
            return 1.0
        out = sum(math.exp(v.prior[ids[text[:n]]]) * total(text[n:]) for n in range(1, len(text) + 1) if text[:n] in ids
                  and not text[:n].startswith("<0x"))
        if text[0] not in ids:
            out += math.exp(sum(v.prior[v.bytes[b]] for b in text[0].encode())) * total(text[1:])
        return out
    got = L.log_marginals([w.encode() for w in words], PATH, v.prior)
    for w, g in zip(words, got):
        if len(w) < 12:
            assert g == pytest.approx(math.log(total("▁" + w)), rel=1e-9)
        assert math.isfinite(g)


def test_expectation_counts_pieces_of_a_segmentation():
    """Expected uses, weighted by piece lengths, add up to the word's length."""
    v = L.pieces(PATH)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for _, lattice in L.lattices([b"nation", b"blending"], v, v.prior):
        use = lattice.expected(np.ones(len(lattice.len)), v)
        size = np.array([len(sp.id_to_piece(i)) for i in range(v.size)])
        assert (use * size).sum() == pytest.approx(lattice.len.sum())
