"""Near-duplicate vectors: iterative quantisation codes, multi-index Hamming tables, exact rerank.

Rotations are learned on a bounded sample (at most ``SAMPLE`` vectors) so that the signs of the rotated
vectors lose as little as possible; those signs are the code (several rotations, if it has more bits
than the vectors have dimensions).  The code is cut into ``TABLES`` substrings, each the key of one
table.  By the pigeonhole principle vectors whose codes differ in fewer than ``TABLES`` bits share a
bucket; at a cosine of 0.9 a pair shares one with probability 0.96 or more, closer pairs nearly surely.
Vectors that share a bucket are compared by the cosine of the original vectors in double precision; a
pair counts in the first table in which it meets.

Equal vectors collapse to one class before anything else.  Buckets of more than ``BLOCK`` classes are
dealt to blocks, block meets block, and a task gives back sums (links per class) and the few links that
join components, never a list of all pairs: a group of thousands of near copies costs its comparisons
but no rows.

Vectors that are null, zero, or hold null or non-finite components link with nothing (their own
component, kept).  Vectors of different lengths never link.  Rows with a null id have a null component
and are kept; rows that repeat an id and vector are one vector; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.llm.common import table
from netscope.llm.components import components
from netscope.session import cut_lineage

NAME = "op9_itq_neighbors"
THRESHOLD = 0.9
SAMPLE, ROUNDS = 20_000, 30
TABLES, TABLE_BITS = 20, 12
BLOCK = 1_000


def usable(values: object) -> np.ndarray | None:
    """The vector in double precision, or None if it links with nothing."""
    if values is None:
        return None
    v = np.array([np.nan if x is None else x for x in values] if isinstance(values, list) else values, np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    return v if top > 0 else None


def unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max()
    return scaled / np.sqrt((scaled * scaled).sum())


def learn_rotation(x: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Projection (dimension x bits) whose signs are the code of a unit vector.

    Per group of at most ``dimension`` bits: principal directions, then alternating updates of the
    signs and of the rotation that fits them best (orthogonal Procrustes).
    """
    dim, rng = x.shape[1], np.random.default_rng(seed)
    out = []
    while sum(p.shape[1] for p in out) < bits:
        n = min(dim, bits - sum(p.shape[1] for p in out))
        _, _, directions = np.linalg.svd(x.T @ x)
        basis = directions[:n].T
        v = x @ basis
        r = np.linalg.qr(rng.standard_normal((n, n)))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(basis @ r)
    return np.concatenate(out, axis=1)


def codes(x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Substrings of the codes: one integer per table."""
    bits = (x @ projection >= 0).astype(np.int64).reshape(len(x), -1, TABLE_BITS)
    return (bits << np.arange(TABLE_BITS)).sum(2).astype(np.int32)


def _digest(v: np.ndarray) -> bytes:
    """Hash of a vector's content; negative zero counts as zero."""
    return xxhash.xxh3_128_digest((v + 0.0).tobytes())


def _classes(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``key, dim, same``: the vector's length and a hash of its content (null for unusable ones)."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [usable(v.as_py()) for v in batch.column(1)]
            digest = [None if v is None else _digest(v) for v in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if v is None else len(v) for v in found], pa.int32()),
                 pa.array(digest, pa.binary())], names=["key", "dim", "same"])

    return vectors.select(F.col(key).alias("key"), F.col(column).alias("v")).mapInArrow(
        run, f"key {kind}, dim int, same binary")


def _find(parent: dict, x):
    while parent.get(x, x) != x:
        parent[x] = parent.get(parent[x], parent[x])
        x = parent[x]
    return x


def _compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside the buckets of one group: sums per class, and links that join components here."""
    table_, same = int(pdf["t"].iat[0]), bool((pdf["x"] == pdf["y"]).all())
    pdf = pdf.sort_values(["v", "side", "key"])
    keys, copies, v, side = (pdf[c].to_numpy() for c in ("key", "copies", "v", "side"))
    units = np.stack([unit(np.asarray(u, np.float64)) for u in pdf["vector"]])
    code = np.stack(pdf["code"].to_numpy())
    starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]).tolist()
    n, parent, joins = np.zeros(len(pdf), np.int64), {}, []
    for lo, hi in zip(starts, [*starts[1:], len(pdf)]):
        cut = hi if same else lo + int((side[lo:hi] == 0).sum())
        first, second = slice(lo, cut), slice(lo if same else cut, hi)
        a, b = np.nonzero(units[first] @ units[second].T >= threshold)
        a, b = a + first.start, b + second.start
        if same:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 200_000):  # a pair counts in the first table in which it meets
            p, q = a[at:at + 200_000], b[at:at + 200_000]
            mine = (code[p] == code[q]).argmax(1) == table_
            p, q = p[mine], q[mine]
            n += np.bincount(p, copies[q], len(n)).astype(np.int64)
            n += np.bincount(q, copies[p], len(n)).astype(np.int64)
            for i, j in zip(keys[p].tolist(), keys[q].tolist()):
                i, j = _find(parent, i), _find(parent, j)
                if i != j:
                    parent[max(i, j)] = min(i, j)
                    joins.append((max(i, j), min(i, j)))
    at = np.flatnonzero(n)
    return pd.DataFrame({"a": [*keys[at].tolist(), *[j[0] for j in joins]],
                         "n": [*n[at].tolist(), *[0] * len(joins)],
                         "b": pd.array([*[None] * len(at), *[j[1] for j in joins]], dtype=object)})


def neighbors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
              threshold: float = THRESHOLD, tables: int = TABLES) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row of ``vectors``."""
    items = vectors.schema[column].dataType.simpleString()
    rows = cut_lineage(_classes(vectors, key, column))
    # a class of equal vectors is a node of its own: its smallest key may hold other vectors too
    groups = cut_lineage(rows.filter("same is not null and key is not null").groupBy("dim", "same").agg(
        F.min("key").alias("of"), F.countDistinct("key").alias("copies")))
    classes = cut_lineage(groups.withColumn("key", F.monotonically_increasing_id()))
    content = vectors.select(F.col(key).alias("of"), F.col(column).alias("vector"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [usable(v.as_py()) for v in batch.column(4)]
            yield batch.filter(pa.array([v is not None and _digest(v) == d.as_py() for v, d in zip(found, batch.column(2))], pa.bool_()))

    units = classes.join(content, "of").select("key", "dim", "same", "copies", "vector").mapInArrow(
        own, f"key bigint, dim int, same binary, copies bigint, vector {items}").dropDuplicates(["key"])

    # rotations per vector length, each from a bounded sample
    projections = {}
    for dim, n in classes.groupBy("dim").count().collect():
        bound = min(1.0, SAMPLE / n) * 2.0 ** 62
        picked = units.filter((F.col("dim") == dim) & (F.abs(F.shiftright(F.xxhash64("same", F.lit(5)), 1)) <= bound))
        x = np.stack([unit(np.asarray(u, np.float64)) for u in picked.select("vector").toPandas()["vector"]])
        projections[dim] = learn_rotation(x[np.lexsort(x.T)], tables * TABLE_BITS)
    shared = vectors.sparkSession.sparkContext.broadcast(projections)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [unit(np.array(u.as_py(), np.float64)) for u in batch.column(4)]
            out = [codes(u[None], shared.value[len(u)])[0].tolist() for u in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "code"])

    coded = cut_lineage(units.select("key", "dim", "same", "copies", "vector").mapInArrow(
        encode, f"key bigint, dim int, same binary, copies bigint, vector {items}, code array<int>"))

    # every class stands in one bucket a table; large buckets are dealt to parts, and part meets part
    stand = coded.select("key", "dim", F.posexplode("code").alias("t", "v"))
    buckets = cut_lineage(stand.groupBy("dim", "t", "v").agg(F.count("*").alias("n")).filter("n > 1").select(
        "dim", "t", "v", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")))
    slices = max(16, min(1 << TABLE_BITS, coded.count() // 500))
    mine = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    met = stand.join(buckets, ["dim", "t", "v"]).withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            "key", "dim", "t", "v", F.pmod("v", F.lit(slices)).alias("slice"), F.least("mine", "other").alias("x"),
            F.greatest("mine", "other").alias("y"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    found = cut_lineage(met.join(coded.select("key", "copies", "vector", "code"), "key").groupBy(
        "dim", "t", "slice", "x", "y").applyInPandas(
            lambda pdf: _compare(pdf, threshold), "a bigint, n bigint, b bigint"))

    roots = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    label = classes.select("same", "key", "of", "copies").join(links, F.col("key") == F.col("a"), "left").join(
        roots, F.col("key") == F.col("node"), "left").select(
            "same", "of", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "key").alias("group"))
    smallest = label.groupBy("group").agg(F.min("of").alias("component"))
    label = label.join(smallest, "group").select("same", "n_links", "component")
    out = rows.select("key", "same").join(cut_lineage(label), "same", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    count = F.when(F.col("key").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0)))
    return out.select(F.col("key").alias(key), count.cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.9 between all embeddings."""
    return neighbors(table(spark, sf_dir, "embeddings"))
