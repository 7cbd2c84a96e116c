"""Whitening against big-integer brute force; exact scatter; lengths, edge cases and planted structure."""

import math
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_SMALL
from netscope.llm import whitening as W


def integer(v):
    """The integer vector, or None where the row is dropped."""
    if v is None or any(c is None or not math.isfinite(c) or abs(c) >= 2.0 ** 54 for c in v):
        return None
    return tuple(math.floor(Fraction(float(c)) * 256) for c in v)


def brute(vectors):
    """(key, deviation, centred vector) of each usable row, and per length n and the exact covariance."""
    rows = [(i, x) for i, v in vectors if (x := integer(v)) is not None]
    model = {}
    for d in {len(x) for _, x in rows}:
        own = {x for _, x in rows if len(x) == d}
        n, s = len(own), [sum(c) for c in zip(*own)]
        mean = [Fraction(a, n) for a in s]
        cov = [[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in own) / n) for j in range(d)] for i in range(d)]
        model[d] = (n, s, np.array(cov).reshape(d, d))
    out = []
    for i, x in rows:
        n, s, _ = model[len(x)]
        num = [n * a - b for a, b in zip(x, s)]
        out.append((i, sum(a * a for a in num), [a / n for a in num]))
    return out, model


def frame(spark, vectors, kind="double"):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "k", 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, component int, key string, n double")


def check(got, vectors):
    """All rows as brute force has them, up to the sign of each component."""
    want, model = brute(vectors)
    got = sorted(got, key=lambda r: (r["component"], r["deviation"] is None, r["deviation"] or 0, r["vec_id"] or -1))
    width = {c: sum(1 for _, _, x in want if len(x) >= c) for c in range(1, 5)}
    assert len(got) == sum(width.values())
    for d, (n, _, cov) in model.items():
        e, u = np.linalg.eigh(cov)
        e, u = e[::-1], u[:, ::-1]
        of = [(i, dev, x) for i, dev, x in want if len(x) == d]
        for c in range(1, min(4, d) + 1):
            mine = [r for r in got if r["component"] == c and r["n"] == n and
                    any(r["vec_id"] == i and r["deviation"] == (dev if dev < 2 ** 63 else None) for i, dev, _ in of)]
            assert len(mine) >= len(of)
            if len(model) > 1 or e[c - 1] <= 1e-9 * max(e[0], 1) or (
                    min(abs(e[c - 1] - o) for k, o in enumerate(e) if k != c - 1) < 1e-6 * e[0] if d > 1 else False):
                continue
            at = {}
            for i, _, x in of:
                at.setdefault(i, []).append(float(np.dot(x, u[:, c - 1]) / math.sqrt(e[c - 1])))
            sign = None
            for r in mine:
                w = min(at[r["vec_id"]], key=lambda v: abs(abs(v) - abs(r["whitened"])))
                assert abs(abs(w) - abs(r["whitened"])) < 1e-6 * max(1, abs(w))
                if abs(w) > 1e-3:
                    now = math.copysign(1, w) * math.copysign(1, r["whitened"])
                    assert sign in (None, now)
                    sign = now
                assert abs(r["explained"] - e[c - 1] / np.trace(cov)) <= 1e-4 * e[c - 1] / np.trace(cov)
                assert 0 <= r["identity_error"] <= 1e-4


@pytest.mark.parametrize("n,d,reach", [(1, 3, 5), (63, 4, 1), (64, 7, 300), (65, 5, 2 ** 20), (200, 3, 2 ** 61), (50, 6, 0)])
def test_scatter_is_exact(n, d, reach):
    x = np.random.default_rng(n).integers(-reach, reach + 1, (n, d))
    s, p = W.scatter(x)
    rows = [list(map(int, r)) for r in x]
    assert s.tolist() == [sum(r[i] for r in rows) for i in range(d)]
    assert p.tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]


def test_limbs_add_up():
    for v in (0, 1, -1, 2 ** 31, -2 ** 31, -2 ** 31 - 1, 2 ** 64, -(2 ** 130) + 12345):
        assert sum(x << 32 * k for k, x in W.limbs(v)) == v and all(abs(x) < 2 ** 32 for _, x in W.limbs(v))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ENTRIES", 200)   # many blocks, each with its own shifts
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 6)) @ rng.normal(size=(6, 6))
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(i, x[0].tolist()) for i in range(200, 260)]
    check(W.whiten(frame(spark, vectors)).collect(), vectors)


def test_repeats_count_once(spark):
    """A vector that a third of all rows repeat weighs as much as any other."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3)).tolist()
    one = W.whiten(frame(spark, list(enumerate(x)))).collect()
    more = W.whiten(frame(spark, [*enumerate(x), *((100 + i, x[7]) for i in range(30))])).collect()
    key = lambda r: (r["vec_id"], r["component"])
    assert {key(r): r["whitened"] for r in one} == {key(r): r["whitened"] for r in more if r["vec_id"] < 100}
    assert {r["whitened"] for r in more if r["vec_id"] >= 100} == {r["whitened"] for r in one if r["vec_id"] == 7}


def test_edge_cases(spark):
    base = [0.5, -1.25, 3.0, 0.0, -0.0]
    vectors = [(1, base), (1, base), (1, base[::-1]), (2, None), (3, [None, 1, 2, 3, 4]), (4, [float("nan"), 1, 2, 3, 4]),
               (5, [float("inf"), 1, 2, 3, 4]), (6, [1, 1, 1, 1, 1]), (None, [2, 0, 1, 5, 5]), (7, []), (8, [1.0]), (9, [4.0]),
               (10, [1.5, 2.5]), (11, [-1e-9, 1e-9, 7, 7, 7]), (12, [2.0 ** 54, 1, 1, 1, 1])]
    got = W.whiten(frame(spark, vectors)).collect()
    want, model = brute(vectors)
    count = lambda rows: sorted((str(a), b) for a, b in rows)
    assert count((r["vec_id"], r["deviation"]) for r in got) == count(
        (i, dev) for i, dev, x in want for _ in range(min(4, len(x))))
    single = [r for r in got if r["vec_id"] == 10]      # the only vector of its length: no variance
    assert len(single) == 2 and all(r["whitened"] is None and r["explained"] is None and r["n"] == 1 for r in single)
    assert all(r["n"] == model[5][0] for r in got if r["vec_id"] in (1, 6, None))
    assert all(r["identity_error"] <= 1e-4 for r in got)
    assert W.whiten(frame(spark, vectors).limit(0)).count() == 0
    assert W.whiten(frame(spark, [(1, None)])).count() == 0


def test_huge_entries(spark):
    vectors = [(i, [2.0 ** 50 + i * 2.0 ** 40, float(i % 3), -2.0 ** 53]) for i in range(9)]
    got = W.whiten(frame(spark, vectors)).collect()
    assert len(got) == 27 and all(r["deviation"] is None for r in got if r["vec_id"] == 0)
    first = {r["vec_id"]: r["whitened"] for r in got if r["component"] == 1}
    assert abs(abs(first[8]) - 4 / math.sqrt(60 / 9)) < 1e-9
    assert all(r["whitened"] is None for r in got if r["component"] == 3)  # a constant dimension


def test_given_embeddings(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = W.query(spark, SF_SMALL).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    check(got, vectors)
    one = {}
    for r in got:   # whitened rows of the fit list have unit covariance
        one.setdefault(integer(dict(vectors)[r["vec_id"]]), {})[r["component"]] = r["whitened"]
    w = np.array([[c[k] for k in (1, 2, 3, 4)] for c in one.values()])
    assert np.abs(w.T @ w / len(w) - np.eye(4)).max() < 1e-6 and np.abs(w.mean(0)).max() < 1e-9
