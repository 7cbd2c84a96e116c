"""Near-dedup against brute force on all pairs."""

import random

import pytest

from netscope.llm import minhash_links as M


def sets(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


def brute(rows, percent=80, k=4):
    s = {i: sets(t, k) for i, t in rows if i is not None}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(s)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in ids}


def got(docs):
    return M.classes(docs).collect()


def test_edge_cases(make_docs, edge_rows):
    rows = got(make_docs(edge_rows))
    assert len(rows) == len(edge_rows)
    want = brute(edge_rows)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("seed", [1, 2])
def test_family_of_near_copies(make_docs, monkeypatch, seed):
    """Hundreds of copies with edits on both sides of the threshold, over many small blocks."""
    monkeypatch.setattr(M, "BLOCK", 20)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(150):
        w = base[:]
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    for i in range(150, 190):  # a shared passage is no link
        rows.append((i, " ".join(base[:30] + [rng.choice(words) + str(i) for _ in range(90)])))
    rows += [(200 + i, rows[i][1].upper()) for i in range(10)]
    rng.shuffle(rows)
    want = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got(make_docs(rows))} == want


def test_empty_table(make_docs):
    assert got(make_docs([])) == []


def test_missing_a_link_is_unlikely():
    from math import comb
    k, t = M.COORDINATES, M.MATCHES
    assert sum(comb(k, i) * 0.8 ** i * 0.2 ** (k - i) for i in range(t)) < 2e-6


def test_repeated_keys_with_other_texts(make_docs):
    """Each text of a key has links of its own: no link is lost to the other texts that stand on the key."""
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join(reversed(words))
    rows = [(1, a), (2, b), (2, a + " more"), (2, None), (3, b + " end"), (4, "short"), (4, a + " more"), (5, "short")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in M.classes(make_docs(rows)).collect())
    assert got == sorted([(1, 57, 1, True), (2, 57, 2, True), (2, 58, 1, False), (2, 0, 2, True), (3, 58, 2, False),
                          (4, 1, 4, True), (4, 58, 1, False), (5, 1, 4, False)])
