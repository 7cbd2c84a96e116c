"""Substring dedup against brute force over all windows."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from netscope.llm import recompression as R
from netscope.llm.common import words_column


def brute(rows, window=20):
    """doc_id -> (words, removed, kept words); rows that repeat a key are the same document."""
    seen, out = {}, {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            first = seen.setdefault(tuple(w[k:k + window]), (i, k))
            if first != (i, k):
                gone[k:k + window] = [True] * window
        out[i] = (len(w), sum(gone), [a for a, g in zip(w, gone) if not g])
    return out


def _got(docs, **kw):
    rows = R.dedup(docs, **kw).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    return {r[0]: (r[1], r[2], (r[3] or "").encode().split()) for r in rows if r[0] is not None}, rows


def test_equals_brute_force_with_edge_cases(make_docs, edge_rows):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    rows = list(edge_rows)
    for i in range(20, 60):
        a, b = (" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in "ab")
        rows.append((i, f"{a} {passage if i % 3 else passage[:200]}\n{b}"))
    rows.append((70, " ".join(["same"] * 100)))
    got, all_rows = _got(make_docs(rows))
    assert got == brute(rows)
    assert len(all_rows) == len(rows)


def test_clean_text_stays_as_it_is(make_docs):
    rows = [(1, "  some  spaced\n\ttext "), (2, None)]
    kept = {r[0]: r[1] for r in R.dedup(make_docs(rows)).select("row.doc_id", "kept").collect()}
    assert kept == dict(rows)


def test_empty_table(make_docs):
    assert R.dedup(make_docs([])).count() == 0


def test_a_full_filter_changes_nothing(make_docs, edge_rows, monkeypatch):
    """A filter that lets everything through costs time only."""
    rows = [*edge_rows, (80, edge_rows[0][1] + " tail")]
    monkeypatch.setattr(R, "bloom", lambda names: np.full(R.SEGMENT_BITS // 8, 255, np.uint8))
    assert _got(make_docs(rows))[0] == brute(rows)


def test_candidates_hold_every_repeated_window():
    """No repeated window holds a symbol that occurs once, whatever stands around it."""
    rng = np.random.default_rng(3)
    for seed in range(20):
        vocabulary = rng.integers(1, 2 ** 63, 4 + seed * 10, dtype=np.uint64)
        part = vocabulary[rng.integers(0, len(vocabulary), 45)]
        docs = [np.concatenate([vocabulary[rng.integers(0, len(vocabulary), rng.integers(0, 30))], part,
                                vocabulary[rng.integers(0, len(vocabulary), rng.integers(0, 30))]]) for _ in range(4)]
        words, doc = np.concatenate(docs), np.repeat(np.arange(4, dtype=np.int32), [len(d) for d in docs])
        name, first, last = R.anchors(words, doc, 20)
        names, n = np.unique(name, return_counts=True)
        once = np.isin(name, names[n == 1])
        windows = {}
        for s in range(len(words) - 19):
            if doc[s] == doc[s + 19]:
                windows.setdefault(words[s:s + 20].tobytes(), []).append(s)
        for places in windows.values():
            if len(places) > 1:
                for s in places:
                    assert not ((first[once] >= s) & (last[once] <= s + 20)).any()


def test_query_digest(spark):
    got = {r["doc_id"]: r for r in R.query(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute([tuple(r) for r in docs])
    assert got.keys() == want.keys()
    for i, (n, removed, kept) in want.items():
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, removed)
        assert got[i]["kept_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_words_column_is_the_same_split(make_docs, edge_rows):
    rows = make_docs(edge_rows).select("text", words_column(F.col("text")).alias("w")).collect()
    for text, words in rows:
        assert [w.encode() for w in words] == (text or "").encode().split()


def test_repeated_keys_with_other_texts(make_docs):
    """Rows of one key with other texts (shorter, null) are documents of their own."""
    words = [f"w{k}" for k in range(80)]
    passage, more = " ".join(words[:50]), " ".join(words[50:])
    rows = [(1, passage), (2, f"{passage} {more}"), (2, "tiny text"), (2, None), (3, f"{more} end"), (3, "tiny text"),
            (4, f"{passage} x"), (4, f"x {more}")]
    got = sorted((r[0], r[1], r[2], (r[3] or "").split()) for r in R.dedup(make_docs(rows)).select(
        "row.doc_id", "n_words", "n_removed", "kept").collect())
    end = f"{more} end".split()
    assert got == sorted([(1, 50, 0, words[:50]), (2, 80, 50, words[50:]), (2, 2, 0, ["tiny", "text"]), (2, 0, 0, []),
                          (3, 31, 30, end[30:]), (3, 2, 0, ["tiny", "text"]), (4, 51, 50, ["x"]), (4, 31, 30, ["x"])])


def test_windows_travel_as_five_numbers(make_docs, capsys):
    """A window is its two hashes, its place and its document; a hash with the highest bit set keeps its place."""
    import re
    docs = make_docs([(1, "a b")])
    R.repeats(docs, "doc_id", "text", 20, np.full(R.SEGMENT_BITS // 8, 255, np.uint8), F.lit(0).cast("bigint")).explain("formatted")
    sent = re.findall(r"Exchange\nInput \[(\d+)\]", capsys.readouterr().out)
    assert sent and set(sent) == {"5"}
    import pyarrow as pa
    y, a = np.array([0, -1, -2 ** 31, 2 ** 31 - 1], np.int32), np.array([0, 2 ** 31 - 1, 5, 7])
    z = R._batch((pa.array([1]), pa.array([0])), np.zeros(4, np.int64), np.zeros(4, np.int64), y, a, None).column("z").to_numpy()
    assert (z >> 32).tolist() == y.tolist() and (z & 0xFFFFFFFF).tolist() == a.tolist()
