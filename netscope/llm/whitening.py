"""Whitening of embeddings from exact integer scatter.

1. Every entry c becomes the integer floor(256 c); Spark keeps each distinct integer vector once (the fit list).
2. Tasks take the fit list in blocks.  In a block each dimension is shifted by its own minimum and cut into bit
   planes, packed across the rows into 64-bit words; the cross-product of two dimensions is the sum over their
   planes of 2^(a+b) popcount(plane_a AND plane_b).  The shifts are undone in whole numbers, so sums and
   cross-products are exact, and they leave the task as limbs of 32 bits that Spark adds up.
3. The products are centred as integers (n * sum xy - sum x * sum y) before they become a covariance and meet
   ``eigh``.  One task holds the square of a vector's length, never more; the driver gets the first
   ``COMPONENTS`` directions.
4. All rows, the repeated ones too, are projected along their own partitions.

Vectors of different lengths are whitened apart, each length on its own fit list.  Rows whose vector is null or
holds a null, NaN, infinite or huge entry (2^54 or more, whose integer passes 62 bits) are dropped; an empty
vector has no components, hence no rows.  Repeated rows and rows with a null key come back as often as they
stand.  A component without variance has null ``whitened``; where there is no variance at all ``explained`` is
null too.  ``deviation`` is exact, and null where it passes 63 bits.  An empty table gives an empty result;
other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import table

NAME = "op12_whitening"
SCALE, COMPONENTS = 256, 4
LARGEST = 2.0 ** 54
BLOCK_ENTRIES = 1 << 22
LIMB = 32


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimum per dimension, then words, dimension and weight's exponent of every plane of ``x - minimum``."""
    low = x.min(0)
    u = (x - low).view(np.uint64)
    planes, dims, exps = [], [], []
    for b in range(int(u.max()).bit_length()):
        bits = ((u >> np.uint64(b)) & np.uint64(1)).astype(bool)
        use = np.flatnonzero(bits.any(0))
        planes.append(np.packbits(np.pad(bits[:, use], ((0, -len(x) % 64), (0, 0))), axis=0).T)
        dims.append(use)
        exps.append(np.full(len(use), b))
    if not planes:
        return low, np.zeros((0, 1), np.uint64), np.zeros(0, int), np.zeros(0, int)
    dim, exp = np.concatenate(dims), np.concatenate(exps)
    order = np.lexsort((exp, dim))
    words = np.ascontiguousarray(np.concatenate(planes)[order]).view(np.uint64)
    return low, words, dim[order], exp[order]


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products (Python integers) of the rows of ``x``, by popcounts of bit planes."""
    n, d = x.shape
    low, words, dim, exp = bit_planes(x)
    # a weighted count stays below n * 4^bits
    exact = np.int64 if 2 * (int(exp.max(initial=0)) + 1) + n.bit_length() < 63 else object
    weight = np.array([1 << int(e) for e in exp], exact)
    sums, products = np.zeros(d, object), np.zeros((d, d), object)
    ones = np.bitwise_count(words).sum(1, dtype=np.int64).astype(exact) * weight
    np.add.at(sums, dim, ones.astype(object))
    has, first = np.unique(dim, return_index=True)
    last = np.append(first[1:], len(dim))
    for k, (lo, hi) in enumerate(zip(first, last)):
        acc = np.zeros(len(has) - k, object)
        for p in range(lo, hi):
            both = np.bitwise_count(words[p] & words[lo:]).sum(1, dtype=np.int64).astype(exact) * weight[lo:]
            acc += np.add.reduceat(both, first[k:] - lo).astype(object) * (1 << int(exp[p]))
        products[has[k], has[k:]] = acc
    products = np.triu(products) + np.triu(products, 1).T
    m = low.astype(object)
    products += np.outer(m, sums) + np.outer(sums, m) + n * np.outer(m, m)
    return sums + n * m, products


def limbs(v: int) -> Iterator[tuple[int, int]]:
    """``(k, limb)`` with ``v`` the sum of ``limb << 32 k``; only the last limb is signed."""
    k = 0
    while not -(1 << LIMB - 1) <= v < 1 << LIMB - 1:
        yield k, v & ((1 << LIMB) - 1)
        v, k = v >> LIMB, k + 1
    yield k, v


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors (rows x length) of a list column, by length."""
    at = column.offsets.to_numpy()
    size = np.diff(at)
    values = column.values.to_numpy()
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield rows, values[at[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0), np.int64)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``dim, i, j, k, v``: limbs of the products, of the sums (j = -1) and of the count (i = j = -1)."""
    waiting: dict[int, list[np.ndarray]] = {}
    total: dict[int, list] = {}

    def add(d: int) -> None:
        x = np.concatenate(waiting.pop(d))
        s, p = scatter(x)
        if d in total:
            n, s0, p0 = total[d]
            total[d] = [n + len(x), s0 + s, p0 + p]
        else:
            total[d] = [len(x), s, p]

    for batch in batches:
        for _, x in _matrix(batch.column(0)):
            d = x.shape[1]
            if d:
                waiting.setdefault(d, []).append(x)
                if sum(map(len, waiting[d])) * d >= BLOCK_ENTRIES:
                    add(d)
    for d in list(waiting):
        add(d)
    for d, (n, s, p) in total.items():
        for i in range(-1, d):
            cells = [(-1, n)] if i < 0 else [(-1, s[i]), *((j, p[i, j]) for j in range(i, d))]
            rows = [(j, k, v) for j, value in cells for k, v in limbs(int(value))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(rows), pa.int32()), pa.array([i] * len(rows), pa.int32()),
                 *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64())))],
                names=["dim", "i", "j", "k", "v"])


def _axes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums and first directions of one vector length, from its added-up limbs."""
    d, cell = int(pdf["dim"].iat[0]), {}
    for i, j, k, v in zip(pdf["i"].tolist(), pdf["j"].tolist(), pdf["k"].tolist(), pdf["v"].tolist()):
        cell[i, j] = cell.get((i, j), 0) + (v << LIMB * k)
    n, s = cell[-1, -1], [cell[i, -1] for i in range(d)]
    centred = [[n * cell[min(i, j), max(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)]
    cov = np.array([[c / (n * n) for c in row] for row in centred])
    trace = sum(centred[i][i] for i in range(d)) / (n * n)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:COMPONENTS], u[:, ::-1][:, :COMPONENTS]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    good = e > trace * d * 2.0 ** -52
    axes = np.where(good, u / np.sqrt(np.where(good, e, 1.0)), np.nan)
    a = axes[:, good]
    error = float(np.abs(a.T @ cov @ a - np.eye(a.shape[1])).max(initial=0.0))
    return pd.DataFrame([{"dim": d, "n": str(n), "sums": [str(v) for v in s], "axes": axes.T.ravel().tolist(),
                          "explained": (e / trace if trace else e * np.nan).tolist(), "identity_error": error}])


def integers(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``key, x``: the usable rows with their integer vectors."""
    entry = F.col(column)
    usable = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return vectors.filter(usable).select(F.col(key).alias("key"), F.transform(
        entry, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def fit(x: DataFrame) -> DataFrame:
    """``dim, n, sums, axes, explained, identity_error``: one row for each vector length of ``x``."""
    parts = x.select("x").distinct().mapInArrow(_scatter, "dim int, i int, j int, k int, v bigint")
    return parts.groupBy("dim", "i", "j", "k").agg(F.sum("v").alias("v")).groupBy("dim").applyInPandas(
        _axes, "dim int, n string, sums array<string>, axes array<double>, explained array<double>, identity_error double")


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``x - sums / n`` and the exact sum of the squares of ``n x - sums`` (None past 63 bits) of each row."""
    reach = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0)
    if x.shape[1] * reach * reach < 1 << 63:
        num = n * x - np.array(sums, np.int64)
        return num / n, (num * num).sum(1).tolist()
    num = n * x.astype(object) - np.array(sums, object)
    squares = (num * num).sum(1).tolist()
    return num.astype(np.float64) / n, [v if v < 1 << 63 else None for v in squares]


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of every usable row and component."""
    kind = vectors.schema[key].dataType.simpleString()
    x = integers(vectors, key, column)
    # one row for each vector length: its size follows the lengths, not the rows
    models = {r["dim"]: (int(r["n"]), [int(v) for v in r["sums"]], np.array(r["axes"], float).reshape(-1, r["dim"]),
                         r["explained"], r["identity_error"]) for r in fit(x).collect()}
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, v in _matrix(batch.column(1)):
                if not v.shape[1]:
                    continue
                n, sums, axes, explained, error = shared.value[v.shape[1]]
                apart, squares = deviations(v, n, sums)
                white, c = apart @ axes.T, len(axes)
                of = np.repeat(np.arange(len(rows)), c)
                number = pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(rows)))
                nan_null = lambda a: pa.array(a, pa.float64(), from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[of])), number, pa.array(np.full(len(of), n, np.int64)),
                     pa.array(squares, pa.int64()).take(pa.array(of)), nan_null(white.ravel()),
                     nan_null(np.tile(np.array(explained, float), len(rows))), pa.array(np.full(len(of), error))],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = x.mapInArrow(project, f"key {kind}, component int, n bigint, deviation bigint, whitened double, "
                                "explained double, identity_error double")
    return out.withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings"))
