"""Vector links against brute force; codes; edge cases."""

import numpy as np
import pytest

from netscope.llm import itq_neighbors as N


def brute(vectors, threshold=0.9):
    use = {i: N.unit(u) for i, v in vectors if (u := N.usable(v)) is not None}
    links = {i: [j for j in use if j != i and len(use[i]) == len(use[j]) and use[i] @ use[j] >= threshold] for i in use}
    root = {i: i for i, _ in vectors}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in links:
        for j in links[i]:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(links.get(i, [])), find(i)) for i, _ in vectors}


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "u")
                                  for i, v in vectors], f"vec_id long, embedding array<{kind}>, label int, unit string")


def test_edge_cases(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=16)
    vectors = [(1, base), (2, base), (3, base * 5), (4, -base), (5, None), (6, np.zeros(16)), (7, [None] * 16),
               (8, [float("nan")] * 16), (9, [float("inf"), *base[1:]]), (10, base[:8]), (11, [1e300, *[0] * 15]),
               (12, [1e-300, *[0] * 15]), (13, []), (14, base + rng.normal(size=16) * 0.05)]
    got = N.neighbors(frame(spark, vectors, "double")).collect()
    want = brute(vectors)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert N.neighbors(frame(spark, vectors).limit(0)).count() == 0


def test_null_id(spark):
    got = N.neighbors(frame(spark, [(None, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(None, 0, None, True), (1, 0, 1, True)}


@pytest.mark.parametrize("block", [7, 1000])
def test_families_and_recall(spark, monkeypatch, block):
    """Near copies in buckets of many blocks are all found; at the threshold itself recall holds."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(30, 32))
    vectors = [(i, centres[i % 30] + rng.normal(size=32) * (0.02 if i % 2 else 0.3)) for i in range(400)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in N.neighbors(frame(spark, vectors, "double")).collect()}
    want = brute(vectors)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())


def test_rotation_lowers_quantisation_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8)) * np.arange(1, 9)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = N.learn_rotation(x, 8)
    assert np.allclose(p.T @ p, np.eye(8), atol=1e-8)
    loss = lambda r: ((np.where(x @ r >= 0, 1, -1) / np.sqrt(8) - x @ r) ** 2).sum()
    directions = np.linalg.svd(x.T @ x)[2].T
    assert loss(p) < loss(directions)


def test_repeated_keys_with_other_vectors(spark):
    """Each content of a key has links of its own, whatever else stands on the key (null and shorter vectors too)."""
    rows = [(1, [1.0, 2.0]), (1, None), (1, [2.0, -1.0]), (2, [1.0, 2.1]), (3, [2.0, -1.1]), (3, [1.0, 2.0]), (4, [0.0, 0.0]),
            (4, [-1.0, 0.0]), (5, [1.0]), (5, [1.0, 2.05])]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in N.neighbors(frame(spark, rows, "double")).collect())
    # [1, 2] stands on 1 and 3, its near copies on 2 and 5; [2, -1] on 1, its near copy on 3
    assert got == sorted([(1, 3, 1), (1, 0, 1), (1, 1, 1), (2, 3, 1), (3, 1, 1), (3, 3, 1), (4, 0, 4), (4, 0, 4), (5, 0, 5), (5, 3, 1)])
