"""Phrases against brute force; the index against plain counting; shards, ties and edge cases (SQL runs with the others)."""

import collections
import random
import re

import numpy as np
import pytest

from netscope.llm import phrase_index as P

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        yield tuple(re.findall(r"[^\x20\x09]+", piece))


def brute(rows, min_count, top=2000):
    """All rows of the result from (text, lang)."""
    f, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(w[i:i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        inside = collections.Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        best = []
        for p, a in cand.items():
            if inside[p] >= a:
                continue
            score, k = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), p[:k], p[k:]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, c[left], c[right], total[lang], -s))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, 1, "p", 2) for i, (t, x) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string, shard int")


def result(spark, rows, min_count, top=2000):
    return sorted(tuple(r) for r in P.mine(frame(spark, rows), min_count=min_count, top=top).collect())


def corpus(seed, n, words, length):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("aBé中") for _ in range(rng.randint(1, 3))) for _ in range(words)]
    def text():
        return "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"])
                       for _ in range(rng.randint(0, length)))
    return [(text(), rng.choice(["en", "de", None])) for _ in range(n)]


@pytest.mark.parametrize("seed,block", [(0, 1 << 20), (1, 50)])
def test_index_enumerates_every_phrase_with_its_count(monkeypatch, seed, block):
    monkeypatch.setattr(P, "BLOCK_ROWS", block)
    rng = np.random.default_rng(seed)
    text = P.single_breaks(rng.choice([0, 1, 2, 3, 3, 70_000], 3000).astype(np.int32))
    want = [collections.Counter() for _ in range(6)]
    for i in range(len(text)):
        for m in range(1, 6):
            p = tuple(text[i:i + m].tolist())
            if len(p) == m and 0 not in p:
                want[m][p] += 1
    got = list(P.phrases(text, 5))
    assert len(got) == 5
    for m, (words, n) in enumerate(got, 1):
        assert len({tuple(w) for w in words.tolist()}) == len(words)
        assert {tuple(w): c for w, c in zip(words.tolist(), n.tolist())} == dict(want[m])


def test_either_side_first_gives_the_same_intervals():
    text = P.single_breaks(np.random.default_rng(2).integers(0, 4, 500).astype(np.int32))
    index = P.Index(text, 4)
    one = index.extend(index.extend(index.words(), True), False)
    two = index.extend(index.extend(index.words(), False), True)
    rows = lambda x: sorted(zip(map(tuple, x[0].tolist()), *(v.tolist() for v in x[1:])))
    assert rows(one) == rows(two)


def test_stretches():
    text = np.array([1, 2, 3, 9, 1, 2, 0, 2, 3, 4, 0, 3, 0], np.int32)
    given = np.array([(1, 2), (2, 3), (3, 4)])
    assert P.stretches(text, given[:, 0], given[:, 1]).tolist() == [1, 2, 3, 0, 2, 3, 4, 0]


def test_stretches_of_three_words():
    text = np.array([1, 2, 3, 4, 5, 0, 2, 3, 4, 9, 1, 2, 3, 4, 9, 3, 4, 5], np.int32)
    given = np.array([(1, 2, 3), (2, 3, 4), (3, 4, 5)]).T
    assert P.stretches(text, *given).tolist() == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4, 0]
    assert P.stretches(np.array([1, 2], np.int32), *given).tolist() == []


def test_longer_phrases_need_frequent_threes():
    """A shard sends no phrase of four words that holds an infrequent one of three, even if its pairs are frequent."""
    import pyarrow as pa
    text = np.array([1, 2, 3, 4, 0, 1, 2, 3, 0, 5, 2, 3, 0], np.int32)
    texts = pa.table({"shard": pa.array([7], pa.int64()), "body": pa.array([P.pack(text)], pa.binary())})
    words = [{"a": i, "b": i + 10, "phrase": False} for i in range(1, 6)]
    given = lambda phrases: pa.Table.from_pylist(words + [
        {**dict(zip("abc", [w + 10 for w in p])), "phrase": True} for p in phrases],
        pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("phrase", pa.bool_())]))
    threes = P._threes(texts, given([(1, 2), (2, 3), (3, 4), (5, 2)])).to_pylist()
    assert sorted((r["w1"], r["w2"], r["w3"], r["n"]) for r in threes) == [(11, 12, 13, 2), (12, 13, 14, 1), (15, 12, 13, 1)]
    assert len(P._long(texts, given([(1, 2, 3)]))) == 0
    assert [list(r.values()) for r in P._long(texts, given([(1, 2, 3), (2, 3, 4)])).to_pylist()] == [[11, 12, 13, 14, None, 1]]


def test_threes_outside_full_buckets_stay_in_their_shard():
    """Threes that all shards together hold too seldom are not sent, whatever their pairs; frequent ones all are."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    text = np.column_stack([rng.integers(1, 30, (4000, 3)), np.zeros(4000, int)]).ravel().astype(np.int32)
    text = np.append(text, np.tile([5, 6, 7, 0], 90)).astype(np.int32)
    shards = [pa.table({"shard": pa.array([i], pa.int64()), "body": pa.array([P.pack(text)], pa.binary())}) for i in (1, 2)]
    pairs = {(int(a), int(b)) for a, b in zip(text, text[1:]) if a and b}
    given = pa.Table.from_pylist([{"a": i, "b": i + 10, "phrase": False} for i in range(1, 30)] + [
        {"a": a + 10, "b": b + 10, "phrase": True} for a, b in pairs],
        pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("phrase", pa.bool_())]))
    buckets, total = 1 << 20, np.zeros(1 << 20, np.int64)
    for texts in shards:
        for r in P._bucket_counts(texts, given, buckets, 100).to_pylist():
            at = P.unpack(r["at"], np.int32) + r["chunk"] * (buckets // P.CHUNKS)
            total[at] += P.unpack(r["n"], np.int32)
    full = np.packbits(total >= 100)
    rows = [P._threes(t, given, full).to_pylist() for t in shards]
    assert len(P._threes(shards[0], given)) > 3000 and [len(r) for r in rows] == [1, 1]
    assert [tuple(r.values())[1:4] for r in rows[0]] == [(15, 16, 17)] and 2 * rows[0][0]["n"] >= 180


def test_segments_cut_between_pieces_only():
    text = "one two.three four\nfive\x0bsix " * 50
    whole = [w for s in P.segments(text) for w in s if w]
    small = [s for s in P.segments(text, 10)]
    assert len(small) > 50 and [w for s in small for w in [*s, b"\n"] if w and w != b"\n"] == [w for w in whole if w != b"\n"]


@pytest.mark.parametrize("seed,shard,segment", [(0, 1 << 21, 1 << 22), (1, 50, 30), (2, 400, 1 << 22)])
def test_against_brute_force(spark, monkeypatch, seed, shard, segment):
    """Counts come together from many small shards; a phrase that no shard holds often is found."""
    monkeypatch.setattr(P, "SHARD_TOKENS", shard)
    monkeypatch.setattr(P, "SEGMENT_BYTES", segment)
    rows = corpus(seed, 120, 6, 60)
    got = result(spark, rows, 8)
    assert got == brute(rows, 8) and len(got) > 30
    assert result(spark, rows, 8, top=7) == brute(rows, 8, 7)


def test_edge_cases(spark):
    rows = [(None, "en"), ("", "en"), (" \t. ", None), ("a b a b a b a b a b", "en"), ("a b a b a b a b a b", "en"),
            ("A B\x0bA B", None), ("a b", "und"), ("a b a", "und"), ("x" * 9000 + " y\x00z " + "q " * 3000, "fr"), ("one two", "")]
    for low in (2, 3):
        assert result(spark, rows, low) == brute(rows, low)
    assert result(spark, rows, 10_000) == []
    assert P.mine(frame(spark, rows).limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    big = [(10 ** 13, 7 * 10 ** 13, 3 * 10 ** 12 + 1, 10 ** 13 + 7), (100, 10 ** 13, 100, 100), (9 * 10 ** 17, 9 * 10 ** 15, 10 ** 18, 10 ** 18)]
    got = spark.createDataFrame(big, "a long, n long, l long, r long").select(
        "*", P._score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r["s"] for r in got] == [1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in got]


def test_a_full_shard_stays_small():
    """Two tasks share an executor with its heap: a shard of full size, and the batches it sends, stay small."""
    import tracemalloc

    import pyarrow as pa
    text = (np.random.default_rng(1).zipf(1.3, P.SHARD_TOKENS) % 30_000).astype(np.int32)
    ids = np.unique(text[text > 0]).astype(np.int64)
    texts = pa.table({"shard": pa.array([7], pa.int64()), "body": pa.array([P.pack(P.single_breaks(text))], pa.binary())})
    words = pa.table({"of": np.full(len(ids), 7), "a": ids, "b": ids + 1000})
    tracemalloc.start()
    try:
        got = P._pairs(texts, words)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 160e6
    assert len(got) > P.SENT_ROWS >= max(len(b) for b in got.to_batches())
    pair = text[:-1].astype(np.int64) * 30_000 + text[1:]
    pair, n = np.unique(pair[(text[:-1] > 0) & (text[1:] > 0)], return_counts=True)
    assert np.array_equal(np.sort(got["w1"].to_numpy() * 40_000 + got["w2"].to_numpy()),
                          np.sort((pair // 30_000 + 1000) * 40_000 + pair % 30_000 + 1000))
    assert got["n"].to_numpy().sum() == n.sum()
