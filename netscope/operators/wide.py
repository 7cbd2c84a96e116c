"""Figures over all (pairs of) columns of wide tables, from one scan: correlations and exact distinct counts.

A task turns its Arrow batches into small arrays, so neither the plan nor the rows grow with the number of
pairs or columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 64    # columns of a row block of the matrices of pairs
SALTS = 64    # states of a block are added up by this many tasks before one adds up theirs


# ---------------------------------------------------------------- co-moments of pairs

def _batch_state(x):
    """(n, mean_i, mean_j, m_ii, m_jj, c_ij, k_i, k_j) of the rows in which both of a pair are present; k is the
    column's value if it has only one there, else NaN.

    Values are taken from a centre (exactly the value itself where a column is constant), so large offsets cancel
    before they are squared; means are doubles, so offsets may be some 1e9 deviations large."""
    import numpy as np
    there = np.isfinite(x)
    w = there.astype(float)
    count = w.sum(0)
    first = np.where(count > 0, x[there.argmax(0), np.arange(x.shape[1])], 0.0)
    rest = np.where(there, x, first) - first
    centre = first + rest.sum(0) / np.maximum(count, 1)
    raw, x = x, np.where(there, x, centre) - centre
    n, s, q, p = w.T @ w, x.T @ w, (x * x).T @ w, x.T @ x
    mu = s / np.maximum(n, 1)
    m = q - s * mu
    k = np.full(n.shape, np.nan)
    for i, maybe in enumerate((n > 0) & (m <= 1e-10 * q)):   # looked at by value, rounding can't tell
        js = np.flatnonzero(maybe)
        if len(js):
            both = there[:, [i]] & there[:, js]
            value = raw[both.argmax(0), i]
            k[i, js] = np.where(((raw[:, [i]] == value) | ~both).all(0), value, np.nan)
    mean = centre[:, None] + mu
    return np.stack([n, mean, mean.T, m, m.T, p - s * mu.T, k, k.T])


def _merged(one, two):
    """State of two disjoint sets of rows."""
    import numpy as np
    n = one[0] + two[0]
    both = (one[0] > 0) & (two[0] > 0)
    share = np.where(both, two[0] / np.maximum(n, 1), 0.0)
    f = one[0] * share
    di, dj = np.where(both, two[1] - one[1], 0.0), np.where(both, two[2] - one[2], 0.0)
    empty = one[0] == 0
    ki, kj = (np.where(empty, two[k], np.where((two[0] == 0) | (one[k] == two[k]), one[k], np.nan)) for k in (6, 7))
    return np.stack([n, np.where(empty, two[1], one[1] + di * share), np.where(empty, two[2], one[2] + dj * share),
                     one[3] + two[3] + di * di * f, one[4] + two[4] + dj * dj * f, one[5] + two[5] + di * dj * f, ki, kj])


def _add_up(rows: Iterator, d: int) -> dict:
    """State per block of the rows of one task, read as a stream."""
    import numpy as np
    found = {}
    for batch in rows:
        for block, state in zip(batch.column("block").to_pylist(), batch.column("state")):
            x = np.frombuffer(state.as_py(), "<f8").reshape(8, -1, d)
            found[block] = _merged(found[block], x) if block in found else x
    return found


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``i, j, n, corr`` of all pairs of columns ``j < i`` (places in ``cols``), pairwise complete.

    NULL, NaN and infinite values are missing; ``corr`` is NULL where a column is constant over the pair's rows.
    Tasks hold a few matrices of d x d doubles and emit them in blocks of rows; the blocks are added up in two
    rounds.  A table without rows gives no pairs."""
    import numpy as np
    import pyarrow as pa
    d = len(cols)
    state = "block int, salt int, state binary"

    def blocks(total: dict, salt: int) -> Iterator[pa.RecordBatch]:
        for block, x in sorted(total.items()):
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "salt": pa.array([salt], pa.int32()),
                                              "state": pa.array([np.ascontiguousarray(x, "<f8").tobytes()], pa.binary())})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = None
        with np.errstate(all="ignore"):
            for batch in batches:
                if batch.num_rows:
                    one = _batch_state(np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1))
                    total = one if total is None else _merged(total, one)
        if total is not None:
            yield from blocks({a // BLOCK: total[:, a:a + BLOCK] for a in range(0, d, BLOCK)},
                              TaskContext.get().partitionId() % SALTS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            yield from blocks(_add_up(batches, d), 0)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for block, x in _add_up(batches, d).items():
                for k in range(x.shape[1]):
                    i = block * BLOCK + k
                    n, _, _, mi, mj, c, ki, kj = x[:, k, :i]
                    r = np.where(np.isnan(ki) & np.isnan(kj), c / (np.sqrt(mi) * np.sqrt(mj)), np.nan)
                    yield pa.RecordBatch.from_pydict({
                        "i": pa.array(np.full(i, i, np.int32)), "j": pa.array(np.arange(i, dtype=np.int32)),
                        "n": pa.array(n.astype(np.int64)), "corr": pa.array(r, mask=~np.isfinite(r))})

    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    part = x.mapInArrow(scan, state).repartition("block", "salt").mapInArrow(add, state)
    return part.repartition("block").mapInArrow(finish, "i int, j int, n bigint, corr double")


def correlations(df: DataFrame, cols: Sequence[str], decimals: int = 6) -> DataFrame:
    """``col_a, col_b, n, corr`` for the strict lower triangle of ``cols``; every pair has a row."""
    cols = list(cols)
    names = F.array(*[F.lit(c) for c in cols]) if cols else F.array(F.lit(""))
    pairs = (df.sparkSession.range(1, max(len(cols), 1)).select(F.col("id").cast("int").alias("i"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("i") - 1))))
    return pairs.join(pair_moments(df, cols), ["i", "j"], "left").select(
        F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.round("corr", decimals).alias("corr"))


# ---------------------------------------------------------------- distinct counts

def _text(df: DataFrame, name: str) -> Column:
    """A text that is equal for equal values of the column only."""
    x, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.when(x == 0, F.lit("0")).otherwise(x.cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.hex(x)
    return x.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(x))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``k, value``: the distinct non-missing values of every column (its place in ``cols``) as text.

    A batch emits each of its values once, whatever the number of rows; Spark then combines equal rows in the
    task and by (column, value) over all tasks, so a column of many values is spread over all of them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, column in enumerate(batch.columns):
                values = pc.drop_null(pc.unique(column))
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(values), pa.int32()), values.cast(pa.string())],
                                                 names=["k", "value"])

    texts = df.select(*[_text(df, c).alias(f"c{k}") for k, c in enumerate(cols)])
    return texts.mapInArrow(run, "k int, value string").distinct()


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, n_distinct`` (exact), 0 for a column without values."""
    cols = list(cols)
    counts = distinct_values(df, cols).groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("k"))
    return every.join(counts, "k", "left").select(
        F.get(F.array(*[F.lit(c) for c in cols]), F.col("k")).alias("column"),
        F.coalesce("c", F.lit(0)).cast("bigint").alias("n_distinct"))
