"""Random forests whose trees never pass through the driver.

Spark's own forest keeps every node on the driver and makes one pass per group of nodes, which is what stops
deep trees at any size.  Here:

1. *Store*: features become small codes (ordered values, one code per one-hot block) and rows are packed into
   chunks of a Parquet table.  The driver sees the cut points only (at most ``MAX_CUTS`` a feature).
2. *Upper levels*: while a node holds more than ``bound`` rows of its tree's bag, tasks route the chunks through
   the tree so far and add up histograms over coarse codes, one per node; one group per node picks the split.
   The splits are a table (``tree, path``) that meets the chunks by a join.
3. *Finish*: rows of all other nodes are sent to one task per node, at most ``bound`` rows each, which grows the
   whole subtree at once.  A subtree is one row of the node table, written as Parquet.
4. *Scoring* takes the same way: chunks are routed through the upper splits, meet their subtrees by a co-group,
   and the trees' answers are added up per chunk.

Bags are Poisson(1) weights from a generator seeded by (seed, tree, chunk), so a task that runs again draws the
same rows.  A split sends codes up to a cut (or all but one category) to the left; the best one by impurity
decrease wins, ties by feature, then cut.  With a feature subset, features are tried in a random order per node
and the search goes on past the subset until a feature splits the node.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, HasWeightCol
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
                             MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, UserDefinedType
from pyspark import TaskContext

from netscope.session import unique_subdir

MAX_CUTS, COARSE = 4096, 256
BOUND = 1 << 19
TRAIN_CHUNK, SCORE_CHUNK = 32_768, 4_096
TREES = 8                # that one visit to a chunk draws for
MOST_TASKS = 2_000
UPPER_BYTES = 1 << 26   # of a batch's upper splits, which are broadcast
# a subtree has up to a million nodes in one row, and readers decode a whole row group's rows at once
ROW_GROUPS = {"parquet.block.size": str(1 << 22), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}

_SUBTREE = ("tree int, path string, column array<int>, cut array<int>, feature array<int>, threshold array<double>, "
            "left array<int>, right array<int>, value array<double>, gain array<double>, n array<bigint>")
_FIELDS = ["column", "cut", "feature", "threshold", "left", "right", "value", "gain", "n"]


# ---------------------------------------------------------------- columns and codes

def columns_of(df: DataFrame, features: str) -> list[dict]:
    """Columns behind a feature vector: ordered ones (one feature) and one-hot blocks (told by their metadata)."""
    attrs = df.schema[features].metadata.get("ml_attr", {})
    named = {a["idx"]: a.get("name", "") for kind in attrs.get("attrs", {}).values() for a in kind}
    size = attrs.get("num_attrs") or len(named)
    if not size:
        size = len(df.select(vector_to_array(features).alias("x")).first()["x"])
    out: list[dict] = []
    for i in range(size):
        block = named.get(i, "").partition("__ohe_")
        if block[1] and out and out[-1].get("block") == block[0]:
            out[-1]["features"].append(i)
        else:
            out.append({"features": [i], **({"block": block[0]} if block[1] else {})})
    return out


def with_cuts(df: DataFrame, x: str, columns: list[dict], most: int = MAX_CUTS) -> list[dict]:
    """Cut points of the ordered columns: between all neighbouring values, or between ``most`` quantiles."""
    ordered = [c for c in columns if "block" not in c]
    if not ordered:
        return columns
    at = lambda c: F.get(x, F.lit(c["features"][0]))
    n = df.agg(*[F.approx_count_distinct(at(c), 0.02).alias(str(i)) for i, c in enumerate(ordered)]).first()
    few = [n[str(i)] <= 0.9 * most for i in range(len(ordered))]
    # as text: thousands of literals cost seconds one by one
    quantiles = f"percentile_approx(get({x}, %d), array({', '.join(f'{k / most!r}D' for k in range(1, most))}), {10 * most})"
    v = df.agg(*[(F.collect_set(at(c)) if f else F.expr(quantiles % c["features"][0])).alias(str(i))
                 for i, (c, f) in enumerate(zip(ordered, few))]).first()
    for i, c in enumerate(ordered):
        values = np.unique(np.array([u for u in v[str(i)] or [] if u == u], float))
        c["cuts"] = (values[:-1] / 2 + values[1:] / 2 if few[i] else values).tolist()
    return columns


def codes_of(x: np.ndarray, columns: list[dict]) -> np.ndarray:
    """Codes (columns x rows) of a feature matrix; NaN lies above all cuts, a row without category has the last code."""
    out = np.empty((len(columns), len(x)), np.uint16)
    for k, c in enumerate(columns):
        own = x[:, c["features"]]
        if "block" in c:
            out[k] = np.where(own.any(1), own.argmax(1), len(c["features"]))
        else:
            out[k] = np.searchsorted(np.array(c["cuts"]), own[:, 0], side="left")
    return out


def store(df: DataFrame, features: str, columns: list[dict], others: list[str], size: int) -> DataFrame:
    """``chunk, n, codes, rest``: rows in chunks, ``rest`` being the columns ``others`` as an Arrow stream."""
    spark = df.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, rows = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, rows
            flat = pa.concat_arrays([b.column(0) for b in waiting]).flatten().to_numpy().reshape(rows, -1)
            t = pa.Table.from_batches(waiting).remove_column(0)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(t)
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([rows], pa.int32()),
                 pa.array([codes_of(flat, columns).tobytes()], pa.binary()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "n", "codes", "rest"])
            waiting.clear()
            number, rows = number + 1, 0
            return out

        for batch in batches:
            for lo in range(0, len(batch), size):
                part = batch.slice(lo, size)
                if rows + len(part) > size:
                    yield flush()
                waiting.append(part)
                rows += len(part)
        if rows:
            yield flush()

    packed = df.select(vector_to_array(features).alias("_x"), *others)
    at = unique_subdir(spark, "forest")
    packed.mapInArrow(run, "chunk bigint, n int, codes binary, rest binary").write.parquet(at)
    return spark.read.parquet(at)


def _table(rest: bytes) -> pa.Table:
    return pa.ipc.open_stream(rest).read_all()


# ---------------------------------------------------------------- splits

class Rules:
    """What a split search needs to know, the same in the upper levels and in the subtrees."""

    def __init__(self, columns: list[dict], subset: int, max_depth: int, seed: int, classes: int):
        self.columns, self.subset, self.max_depth, self.seed, self.classes = columns, subset, max_depth, seed, classes
        self.n_features = sum(len(c["features"]) for c in columns)
        self.kinds = ["block" in c for c in columns]

    def stats(self, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Weighted target sums of each row: one column, or one per class."""
        if not self.classes:
            return (y * w)[:, None]
        return np.eye(self.classes)[y.astype(int)] * w[:, None]

    def generator(self, tree: int, path: str) -> np.random.Generator:
        return np.random.default_rng([self.seed, tree, 7, *path.encode()])

    def order(self, nodes: int, rng: np.random.Generator) -> np.ndarray | None:
        """Each node's random order of the features (as one number a feature); None if all features are tried."""
        return rng.random((nodes, self.n_features)) if self.subset < self.n_features else None

    def tried(self, order: np.ndarray) -> np.ndarray:
        """The features (a mask) that each node tries first."""
        return order <= np.partition(order, self.subset - 1, 1)[:, self.subset - 1:self.subset]

    def choose(self, gains: np.ndarray, order: np.ndarray | None) -> np.ndarray:
        """Feature (by number) of each node's split, -1 if none splits it.  Features past the subset count for
        nodes that no feature of the subset splits."""
        can = np.isfinite(gains)
        best = gains.argmax(1)
        if order is not None:
            tried = np.where(self.tried(order), gains, -np.inf)
            first = np.where(can, order, 2.0).argmin(1)
            best = np.where(np.isfinite(tried).any(1), tried.argmax(1), first)
        return np.where(can.any(1), best, -1)


def _score(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (s[..., 0] ** 2 if s.shape[-1] == 1 else np.einsum("...j,...j->...", s, s)) / w


def _category_gains(s, w, n, total_s, total_w, total_n):
    """Gains (nodes x categories) of one category against the others."""
    ok = (n > 0) & (n < total_n[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        g = _score(s, w) + _score(total_s[:, None] - s, total_w[:, None] - w)
    return np.where(ok, g, -np.inf)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return np.flatnonzero(first)


def _sums(x: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the runs; most have one entry."""
    out, long = x[start], lengths > 1
    if long.any():
        each = lengths[long]
        out[long] = np.add.reduceat(x[np.repeat(long, lengths)], np.cumsum(each) - each)
    return out


def _cells(code: np.ndarray, node: np.ndarray, w: np.ndarray, v: np.ndarray, nodes: int, size: int, classes: int):
    """``node, code, weight, sums`` of the pairs of node and code that have rows, in this order.

    ``v`` is a row's target sum, or its class.  Where the pairs are many more than the rows, rows are sorted;
    their number in the key keeps the order, and so the sums, the same on all machines.
    """
    key = node * size
    key += code
    if nodes * size <= 4 * len(key) + 1024:
        weight = np.bincount(key, w, nodes * size)
        there = np.flatnonzero(weight != 0)      # told from a mask, which is much faster than from numbers
        weight, cell, place = weight[there], there, None
        if classes:
            place = np.zeros(nodes * size, np.int64)
            place[there] = np.arange(len(there))
            group = place[key]
    else:
        bits = int(len(key)).bit_length()
        order = np.sort(key << bits | np.arange(len(key)))
        key, order = order >> bits, order & ((1 << bits) - 1)
        w, v = w[order], v[order]
        start = _starts(key)
        lengths = np.diff(start, append=len(key))
        cell, weight = key[start], _sums(w, start, lengths)
        if classes:
            group = np.repeat(np.arange(len(start)), lengths)
    if classes:
        sums = np.bincount(group * classes + v, w, len(cell) * classes).reshape(-1, classes)
    elif nodes * size <= 4 * len(key) + 1024:
        sums = np.bincount(key, v, nodes * size)[cell][:, None]
    else:
        sums = _sums(v, start, lengths)[:, None]
    return cell // size, cell % size, weight, sums


def _fill_gains(gains, cuts, k, nodes, cells, rules, at, ts, tw) -> None:
    """Gains of column ``k`` at ``nodes`` (all of them by number), from their cells; an ordered column's best cut too."""
    g, c, weight, sums = cells
    with np.errstate(divide="ignore", invalid="ignore"):
        if rules.kinds[k]:
            several = np.bincount(g, minlength=len(nodes)) > 1
            own = np.flatnonzero(several[g] & (c < len(rules.columns[k]["features"])))
            if len(own):
                to = nodes[g[own]]
                gains[to, at[k] + c[own]] = (_score(sums[own], weight[own])
                                             + _score(ts[to] - sums[own], tw[to] - weight[own]))
            return
        cand = np.flatnonzero(g[:-1] == g[1:])
        if not len(cand):
            return
        start = _starts(g)
        cw, cs = np.cumsum(weight), np.cumsum(sums, 0)
        bw, bs = np.zeros(len(nodes)), np.zeros((len(nodes), sums.shape[1]))    # of what stands before a node's cells
        bw[g[start[1:]]], bs[g[start[1:]]] = cw[start[1:] - 1], cs[start[1:] - 1]
        own = g[cand]
        to = nodes[own]
        lw, ls = cw[cand] - bw[own], cs[cand] - bs[own]
        gain = _score(ls, lw) + _score(ts[to] - ls, tw[to] - lw)
    begin = _starts(own)     # own rises
    best = np.maximum.reduceat(gain, begin)
    hit = np.flatnonzero(gain == np.repeat(best, np.diff(begin, append=len(own))))
    hit = hit[_starts(own[hit])]
    gains[to[begin], at[k]] = best
    cuts[to[begin], k] = c[cand[hit]]


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, rules: Rules, tree: int, path: str) -> dict[str, np.ndarray]:
    """One subtree over all given rows, level by level; arrays of its nodes, the root first.

    A column is looked at in the nodes that try one of its features, and in those that nothing has split yet.
    """
    rng, columns = rules.generator(tree, path), rules.columns
    m, classes = rules.classes or 1, rules.classes
    out = {k: [] for k in _FIELDS}
    at = np.concatenate([[0], np.cumsum([len(c["features"]) for c in columns])])
    of = np.repeat(np.arange(len(columns)), np.diff(at))
    number = np.array([f for c in columns for f in c["features"]])
    sizes = [len(c["features"] if "block" in c else c["cuts"]) + 1 for c in columns]
    kinds = np.array(rules.kinds)
    # rows stand by node; ``row`` is each one's place in ``codes``, ``node`` its node
    codes, row, v = np.ascontiguousarray(codes), np.arange(len(y)), y.astype(np.int64) if classes else y * w
    node, n, depth = np.zeros(len(y), np.int64), np.array([len(y)]), len(path)
    count, first = 1, 0            # nodes of this level, and the number of its first one
    while count:
        tw = np.bincount(node, w, count)
        if classes:
            ts = np.bincount(node * m + v, w, count * m).reshape(count, m)
            pure = (ts > 0).sum(1) <= 1
        else:
            ts = np.bincount(node, v, count)[:, None]
            pure = np.ones(count, bool)
            pure[node[y != np.repeat(y[np.cumsum(n) - n], n)]] = False
        order = rules.order(count, rng) if depth < rules.max_depth and not pure.all() else None
        # leaves are done: what follows sees the open nodes only
        nodes = np.flatnonzero(~pure) if depth < rules.max_depth else np.zeros(0, np.int64)
        if len(nodes) < count:
            still = np.zeros(count, bool)
            still[nodes] = True
            rows = np.flatnonzero(np.repeat(still, n))
            row, v, w, y = row[rows], v[rows], w[rows], y[rows]
            node = np.repeat(np.arange(len(nodes)), n[nodes])
            order = None if order is None else order[nodes]
        size, os, ow, on_ = len(nodes), ts[nodes], tw[nodes], n[nodes]
        gains = np.full((size, len(of)), -np.inf)
        cuts = np.zeros((size, len(columns)), np.int64)

        def look(k: int, wanted: np.ndarray) -> None:
            """Gains of column ``k``, at the wanted nodes at least."""
            own = np.flatnonzero(wanted)
            if not len(own):
                return
            if 2 * len(own) > size:    # noqa: B023
                own, code, nd, wo, vo = np.arange(size), codes[k][row], node, w, v     # noqa: B023
            else:
                rows = np.flatnonzero(np.repeat(wanted, on_))   # noqa: B023
                nd = np.repeat(np.arange(len(own)), on_[own])   # noqa: B023
                code, wo, vo = codes[k][row[rows]], w[rows], v[rows]  # noqa: B023
            cells = _cells(code, nd, wo, vo, len(own), sizes[k], classes)
            _fill_gains(gains, cuts, k, own, cells, rules, at, os, ow)           # noqa: B023

        if order is None:
            for k in range(len(columns)):
                look(k, np.ones(size, bool))
        else:
            tried = rules.tried(order)
            seen = np.stack([tried[:, lo:hi].any(1) for lo, hi in zip(at[:-1], at[1:])], 1)
            for k in range(len(columns)):
                look(k, seen[:, k])
            late = ~np.isfinite(np.where(tried, gains, -np.inf)).any(1)
            for k in range(len(columns)):
                look(k, late & ~seen[:, k])
        picked = rules.choose(gains, order)
        pick, cutting = np.full(count, -1), np.full(count, -1)
        pick[nodes] = picked
        col = np.where(pick >= 0, of[pick], -1)
        block = kinds[col] & (col >= 0)
        cutting[nodes] = np.where(block[nodes], picked - at[col[nodes]], cuts[np.arange(size), col[nodes]])
        split = pick >= 0
        got = np.zeros(count)
        got[nodes] = np.where(picked >= 0, gains[np.arange(size), picked] - _score(os, ow), 0.0)
        children = first + count + 2 * (np.cumsum(split) - 1)
        level = {"column": col, "cut": np.where(split, cutting, -1), "feature": np.where(split, number[pick], -1),
                 "threshold": np.full(count, np.nan), "left": np.where(split, children, -1),
                 "right": np.where(split, children + 1, -1), "value": (ts / tw[:, None]).ravel(),
                 "gain": np.maximum(got, 0.0), "n": n}
        for k, c in enumerate(columns):
            own = np.flatnonzero(col == k)
            level["threshold"][own] = 0.5 if "block" in c else np.array(c["cuts"])[cutting[own]]
        for f in _FIELDS:
            out[f].append(level[f])
        # rows of split nodes go on: a node's left rows, then its right ones, both in their order
        if (picked < 0).any():
            rows = np.flatnonzero(np.repeat(picked >= 0, on_))
            row, v, w, y = row[rows], v[rows], w[rows], y[rows]
        own = nodes[picked >= 0]
        each = n[own]
        begin, on = np.cumsum(each) - each, np.repeat(col[own], each)
        cut = np.repeat(cutting[own], each)
        code = codes.ravel()[on * codes.shape[1] + row]
        right = code > cut
        if kinds.any():
            right = np.where(kinds[on], code == cut, right)
        first, count, depth = first + count, 2 * len(own), depth + 1
        if not count:
            break
        n = np.empty(count, np.int64)
        n[1::2] = np.add.reduceat(right, begin, dtype=np.int64)
        n[::2] = each - n[1::2]
        rows = np.empty(len(row), np.int64)
        begin = np.cumsum(n) - n
        for side, to in enumerate((np.flatnonzero(~right), np.flatnonzero(right))):
            # the j-th of a side's rows goes to where its node begins, and on by its place among the node's
            rows[np.arange(len(to)) + np.repeat(begin[side::2] - (np.cumsum(n[side::2]) - n[side::2]), n[side::2])] = to
        row, v, w, y, node = row[rows], v[rows], w[rows], y[rows], np.repeat(np.arange(count), n)
    return {f: np.concatenate(p) for f, p in out.items()}


def _one_list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values).cast(kind))


def walk(codes: np.ndarray, nodes: dict[str, np.ndarray], kinds: list[bool]) -> np.ndarray:
    """The leaf (its number) of every row."""
    at, open_ = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
    blocks = np.array(kinds)
    while True:
        column = nodes["column"][at[open_]]
        open_ = open_[column >= 0]
        if not len(open_):
            return at
        here = at[open_]
        column, cut = nodes["column"][here], nodes["cut"][here]
        code = codes[column, open_]
        right = np.where(blocks[column], code == cut, code > cut)
        at[open_] = np.where(right, nodes["right"][here], nodes["left"][here])


# ---------------------------------------------------------------- upper levels

def _route(codes: np.ndarray, upper: list[tuple[str, int, int]], kinds: list[bool]) -> dict[str, np.ndarray]:
    """Rows by the path of the node that they reach; ``upper`` are the splits so far (path, column, cut)."""
    splits = {p: (k, c) for p, k, c in upper}
    found, open_ = {}, [("", np.arange(codes.shape[1]))]
    while open_:
        path, rows = open_.pop()
        if path not in splits:
            found[path] = rows
            continue
        k, c = splits[path]
        right = codes[k][rows] == c if kinds[k] else codes[k][rows] > c
        open_ += [(path + "L", rows[~right]), (path + "R", rows[right])]
    return {p: r for p, r in found.items() if len(r)}


def _coarse(column: dict) -> np.ndarray:
    """Coarse code of each code, and so the last code of each coarse one."""
    n = len(column["features"]) + 1 if "block" in column else len(column["cuts"]) + 1
    return np.arange(n) if "block" in column or n <= COARSE else np.arange(n) * COARSE // n


def histogram(codes: np.ndarray, y: np.ndarray, w: np.ndarray, rules: Rules) -> np.ndarray:
    """Rows, weights and target sums per coarse code of all columns, one after another."""
    stats = rules.stats(y, w)
    parts = []
    for k, c in enumerate(rules.columns):
        to = _coarse(c)
        key = to[codes[k]]
        parts.append(np.stack([np.bincount(key, v, to[-1] + 1) for v in (np.ones(len(y)), w, *stats.T)], 1))
    return np.concatenate(parts)


def best_split(hist: np.ndarray, rules: Rules, tree: int, path: str) -> dict | None:
    """Split of a node from its histogram; None if nothing splits it (or it is pure, as far as sums tell)."""
    gains, cuts, at = [], [], 0
    total = None
    for c in rules.columns:
        to = _coarse(c)
        h = hist[at:at + to[-1] + 1]
        at += len(h)
        total = h.sum(0)
        if "block" in c:
            size = len(c["features"])
            h = h[:size]
            g = _category_gains(h[None, :, 2:], h[None, :, 1], h[None, :, 0], total[None, 2:], total[None, 1], total[None, 0])[0]
            gains += g.tolist()
            cuts += list(range(size))
            continue
        left = np.cumsum(h, 0)[:-1]
        right = total - left
        ok = (left[:, 0] > 0) & (right[:, 0] > 0) & (h[:-1, 0] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = np.where(ok, _score(left[:, 2:], left[:, 1]) + _score(right[:, 2:], right[:, 1]), -np.inf)
        best = int(g.argmax()) if len(g) else 0
        gains.append(float(g[best]) if len(g) else -np.inf)
        cuts.append(int(np.flatnonzero(to == best)[-1]))
    if rules.classes and (total[2:] > 0).sum() <= 1:
        return None
    pick = int(rules.choose(np.array([gains]), rules.order(1, rules.generator(tree, path)))[0])
    if pick < 0:
        return None
    sizes = [len(c["features"]) for c in rules.columns]
    k = int(np.repeat(np.arange(len(sizes)), sizes)[pick])
    h = hist[sum(int(_coarse(c)[-1]) + 1 for c in rules.columns[:k]):]
    to = _coarse(rules.columns[k])
    n = total[0]
    right = h[cuts[pick], 0] if rules.kinds[k] else n - h[:to[cuts[pick]] + 1, 0].sum()
    return {"column": k, "cut": cuts[pick], "feature": [f for c in rules.columns for f in c["features"]][pick],
            "gain": max(gains[pick] - float(_score(total[2:], total[1])), 0.0), "n_left": int(n - right), "n_right": int(right)}


_UPPER = "tree int, path string, column int, cut int, feature int, gain double, n_left bigint, n_right bigint"


def _block(trees: range):
    """The first tree of a tree's block."""
    return (F.col("tree") - (F.col("tree") - trees[0]) % TREES).cast("int")


def _work(chunks: DataFrame, trees: range, upper: DataFrame) -> DataFrame:
    """``chunk, codes, rest, block, upper``: each chunk once per block of ``TREES`` trees, with their splits so far."""
    each = chunks.withColumn("block", F.explode(F.sequence(F.lit(trees[0]), F.lit(trees[-1]), F.lit(TREES)).cast("array<int>")))
    splits = upper.groupBy(_block(trees).alias("block")).agg(F.collect_list(F.struct("tree", "path", "column", "cut")).alias("upper"))
    return each.join(F.broadcast(splits), "block", "left").select("chunk", "codes", "rest", "block", "upper")


def _of_block(block: int, upper: list[dict] | None, trees: range) -> Iterator[tuple]:
    """``tree, splits`` of a block's trees."""
    splits: dict[int, list] = {}
    for u in upper or []:
        splits.setdefault(u["tree"], []).append((u["path"], u["column"], u["cut"]))
    for tree in range(block, min(block + TREES, trees.stop)):
        yield tree, splits.get(tree, [])


def _bags(batches: Iterator[pa.RecordBatch], rules: Rules, trees: range) -> Iterator[tuple]:
    """``chunk, tree, path, codes, y, w`` of the rows in a tree's bag, by the node that they reach."""
    for batch in batches:
        for chunk, packed, rest, block, upper in zip(*(c.to_pylist() for c in batch.columns)):
            all_ = np.frombuffer(packed, np.uint16).reshape(len(rules.columns), -1)
            t = _table(rest)
            all_y, all_w = t.column("y").to_numpy(), t.column("w").to_numpy()
            for tree, splits in _of_block(block, upper, trees):
                w = all_w * np.random.default_rng([rules.seed, tree, chunk]).poisson(1.0, all_.shape[1])
                drawn = np.flatnonzero(w > 0)
                codes, y, w = all_[:, drawn], all_y[drawn], w[drawn]
                for path, rows in _route(codes, splits, rules.kinds).items():
                    yield (chunk, tree, path, *((codes[:, rows], y[rows], w[rows]) if splits else (codes, y, w)))


def _upper_splits(chunks: DataFrame, trees: range, rules: Rules, bound: int, total: int) -> DataFrame:
    """Splits of all nodes with more than ``bound`` rows, level by level."""
    spark = chunks.sparkSession
    upper = spark.createDataFrame([], _UPPER)
    names = [f"{t}" for t in trees]
    open_ = spark.createDataFrame([(int(t), "") for t in names], "tree int, path string") if total > bound else None
    while open_ is not None:
        wanted = open_.groupBy(_block(trees).alias("block")).agg(F.collect_list(F.struct("tree", "path")).alias("open"))
        work = _work(chunks, trees, upper).join(F.broadcast(wanted), "block").select(
            "chunk", "codes", "rest", "block", "upper", "open")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, str], np.ndarray] = {}
            for batch in batches:
                wanted = {(n["tree"], n["path"]) for o in batch.column(5).to_pylist() for n in o}
                for _, tree, path, codes, y, w in _bags([batch.select([0, 1, 2, 3, 4])], rules, trees):
                    if (tree, path) in wanted:
                        h = histogram(codes, y, w, rules)
                        sums[tree, path] = sums[tree, path] + h if (tree, path) in sums else h
                if len(sums) * (COARSE + 2) * 64 * len(rules.columns) > UPPER_BYTES:
                    yield from emit(sums)
            yield from emit(sums)

        def emit(sums: dict) -> Iterator[pa.RecordBatch]:
            for (tree, path), h in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([path]),
                                                  pa.array([h.tobytes()], pa.binary())], names=["tree", "path", "h"])
            sums.clear()

        def split(key: tuple, t: pa.Table) -> pa.Table:
            tree, path = key[0].as_py(), key[1].as_py()
            hist = sum(np.frombuffer(b, float).reshape(-1, 2 + (rules.classes or 1)) for b in t.column("h").to_pylist())
            s = best_split(hist, rules, tree, path)
            rows = [] if s is None or len(path) >= rules.max_depth else [{"tree": tree, "path": path, **s}]
            return pa.Table.from_pylist(rows, pa.schema([
                ("tree", pa.int32()), ("path", pa.string()), ("column", pa.int32()), ("cut", pa.int32()), ("feature", pa.int32()),
                ("gain", pa.float64()), ("n_left", pa.int64()), ("n_right", pa.int64())]))

        at = unique_subdir(spark, "forest-level")
        work.mapInArrow(count, "tree int, path string, h binary").groupBy("tree", "path").applyInArrow(
            split, _UPPER).write.parquet(at)
        level = spark.read.parquet(at)
        upper = upper.unionByName(level)
        sides = level.select("tree", F.explode(F.array(
            F.struct(F.concat("path", F.lit("L")).alias("path"), F.col("n_left").alias("n")),
            F.struct(F.concat("path", F.lit("R")).alias("path"), F.col("n_right").alias("n")))).alias("s"))
        open_ = sides.select("tree", "s.path", "s.n").filter(F.col("n") > bound).select("tree", "path")
        open_ = None if open_.isEmpty() else open_
    return upper


# ---------------------------------------------------------------- estimator and model

class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level of a split node plus one", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "all or sqrt", TypeConverters.toString)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "bag size by rows", TypeConverters.toFloat)

    def getNumTrees(self) -> int:
        return self.getOrDefault("numTrees")

    def getFeatureSubsetStrategy(self) -> str:
        return self.getOrDefault("featureSubsetStrategy")

    def getMinInstancesPerNode(self) -> int:
        return self.getOrDefault("minInstancesPerNode")

    def getSubsamplingRate(self) -> float:
        return self.getOrDefault("subsamplingRate")


class _Forest(Estimator, _ForestParams):
    """Common part of both forests; ``bound``: rows that one task grows into a subtree."""

    def __init__(self, labelCol: str = "label", featuresCol: str = "features", weightCol: str | None = None,
                 bound: int = BOUND, **params):
        super().__init__()
        self._setDefault(numTrees=100, maxDepth=30, featureSubsetStrategy="all", minInstancesPerNode=1,
                         subsamplingRate=1.0, predictionCol="prediction", seed=42)
        self.bound = bound
        self._set(labelCol=labelCol, featuresCol=featuresCol, **params, **({"weightCol": weightCol} if weightCol else {}))

    def _fit(self, df: DataFrame) -> ForestModel:
        spark, features = df.sparkSession, self.getFeaturesCol()
        label = F.col(self.getLabelCol()).cast("double")
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        data = df.select(features, label.alias("y"), weight.alias("w"))
        columns = with_cuts(data.select(vector_to_array(features).alias("_x")), "_x", columns_of(df, features))
        chunks = store(data, features, columns, ["y", "w"], TRAIN_CHUNK)
        total = chunks.agg(F.sum("n")).first()[0]
        if not total:
            raise ValueError("a forest needs at least one row")
        classes = int(data.agg(F.max("y")).first()[0]) + 1 if self.classifies else 0
        n_features = sum(len(c["features"]) for c in columns)
        subset = max(1, int(n_features ** 0.5)) if self.getFeatureSubsetStrategy() == "sqrt" else n_features
        rules = Rules(columns, subset, self.getOrDefault("maxDepth"), self.getSeed(), classes)
        trees, at = self.getNumTrees(), unique_subdir(spark, "forest-nodes")
        # a chunk is drawn from once for every tree, so few tasks must not hold them all
        chunks = chunks.repartition(2 * spark.sparkContext.defaultParallelism)
        # a batch's upper splits: some 100 bytes for each of at most 2 total / bound nodes a tree
        most = max(1, int(UPPER_BYTES / (100 * max(1, 2 * total // self.bound))))
        least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)

        def bags(batch: range):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for chunk, tree, path, codes, y, w in _bags(batches, rules, batch):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int32()), pa.array([path]), pa.array([chunk], pa.int64()),
                         *(pa.array([v.tobytes()], pa.binary()) for v in (codes, y, w))],
                        names=["tree", "path", "chunk", "codes", "y", "w"])
            return run

        def finish(key: tuple, t: pa.Table) -> pa.Table:
            tree, path = key[0].as_py(), key[1].as_py()
            t = t.sort_by("chunk")     # the shuffle's order must not show
            codes = np.concatenate([np.frombuffer(b, np.uint16).reshape(len(rules.columns), -1)
                                    for b in t.column("codes").to_pylist()], 1)
            y, w = (np.concatenate([np.frombuffer(b, float) for b in t.column(c).to_pylist()]) for c in ("y", "w"))
            nodes = grow(codes, y, w, rules, tree, path)
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
            return pa.table([pa.array([tree], pa.int32()), pa.array([path]), *(
                _one_list(nodes[f], k) for f, k in zip(_FIELDS, kinds))], names=["tree", "path", *_FIELDS])

        for lo in range(0, trees, most):
            batch = range(lo, min(lo + most, trees))
            upper = _upper_splits(chunks, batch, rules, self.bound, total)
            upper.write.mode("append").parquet(f"{at}/upper")
            # a large subtree is seconds of work: as many tasks as there may be, so that none waits behind several others
            tasks = max(least, min(MOST_TASKS, len(batch) * max(1, 2 * total // self.bound), len(batch) * total // TRAIN_CHUNK))
            _work(chunks, batch, upper).mapInArrow(bags(batch), "tree int, path string, chunk bigint, codes binary, y binary, w binary").repartition(
                tasks, "tree", "path").groupBy("tree", "path").applyInArrow(
                    finish, _SUBTREE).write.mode("append").options(**ROW_GROUPS).parquet(f"{at}/subtrees")
        meta = {"columns": columns, "classes": classes, "trees": trees, "features": n_features}
        model = ForestModel(spark.read.parquet(f"{at}/upper"), spark.read.parquet(f"{at}/subtrees"), meta)
        return self._copyValues(model)


class ForestRegressor(_Forest):
    classifies = False


class ForestClassifier(_Forest):
    """Labels are class numbers from 0; the mean of the trees' class shares decides."""
    classifies = True


class ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """Trees as two tables: ``upper`` (one row per split) and ``subtrees`` (one row per finished node)."""

    def __init__(self, upper: DataFrame | None = None, subtrees: DataFrame | None = None, meta: dict | None = None):
        super().__init__()
        self.upper, self.subtrees, self.meta = upper, subtrees, meta

    @property
    def numFeatures(self) -> int:
        return self.meta["features"]

    @property
    def featureImportances(self) -> DenseVector:
        """Impurity decrease by feature, each tree's adding up to one; a vector of fixed length."""
        inner = self.subtrees.select("tree", F.explode(F.arrays_zip("feature", "gain")).alias("z")).select("tree", "z.*")
        gains = inner.unionByName(self.upper.select("tree", "feature", "gain")).filter("feature >= 0").groupBy(
            "tree", "feature").agg(F.sum("gain").alias("g"))
        per_tree = gains.join(gains.groupBy("tree").agg(F.sum("g").alias("all")).filter("all > 0"), "tree")
        rows = per_tree.groupBy("feature").agg(F.sum(F.col("g") / F.col("all")).alias("v")).collect()
        out = np.zeros(self.numFeatures)
        for r in rows:
            out[r["feature"]] = r["v"]
        return DenseVector(out / out.sum() if out.sum() else out)

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` without vector columns, with ``prediction``."""
        spark, columns, classes = df.sparkSession, self.meta["columns"], self.meta["classes"]
        kinds, m = ["block" in c for c in columns], max(1, classes)
        others = [f.name for f in df.schema.fields if not isinstance(f.dataType, UserDefinedType)]
        chunks = store(df, self.getFeaturesCol(), columns, others, SCORE_CHUNK)
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, codes, block, upper in zip(*(c.to_pylist() for c in batch.columns)):
                    codes = np.frombuffer(codes, np.uint16).reshape(len(kinds), -1)
                    for tree, splits in _of_block(block, upper, trees):
                        for path, rows in _route(codes, splits, kinds).items():
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([tree], pa.int32()), pa.array([path]), pa.array([chunk], pa.int64()),
                                 pa.array([rows.astype(np.int32).tobytes()], pa.binary()),
                                 pa.array([np.ascontiguousarray(codes[:, rows]).tobytes()], pa.binary())],
                                names=["t", "p", "chunk", "rows", "codes"])

        def answer(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if len(left) and len(right):
                nodes = {f: left.column(f)[0].values.to_numpy() for f in ("column", "cut", "left", "right", "value")}
                value = nodes["value"].reshape(-1, m)
                for chunk, rows, codes in zip(*(right.column(c).to_pylist() for c in ("chunk", "rows", "codes"))):
                    leaf = walk(np.frombuffer(codes, np.uint16).reshape(len(kinds), -1), nodes, kinds)
                    out.append((chunk, rows, value[leaf].tobytes()))
            cols = list(zip(*out)) if out else [[], [], []]
            return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()))],
                            names=["chunk", "rows", "v"])

        def add(key: tuple, t: pa.Table) -> pa.Table:
            parts = [(np.frombuffer(r, np.int32), np.frombuffer(v, float).reshape(-1, m))
                     for r, v in zip(t.column("rows").to_pylist(), t.column("v").to_pylist())]
            size = 1 + max(int(r.max()) for r, _ in parts)
            total, trees = np.zeros((size, m)), np.zeros(size)
            # the shuffle's order must not show in the sums' last digits
            for r, v in sorted(parts, key=lambda x: (x[0].tobytes(), x[1].tobytes())):
                total[r] += v
                trees[r] += 1
            best = total.argmax(1).astype(float) if classes else total[:, 0] / trees
            return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([best.tobytes()], pa.binary())], names=["chunk", "best"])

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rest, best in zip(*(c.to_pylist() for c in batch.columns)):
                    t = _table(rest).append_column("prediction", pa.array(np.frombuffer(best, float)))
                    yield from t.combine_chunks().to_batches()

        trees = range(self.meta["trees"])
        work = _work(chunks.select("chunk", "codes", F.lit(None).cast("binary").alias("rest")), trees, self.upper).select(
            "chunk", "codes", "block", "upper")
        routed = work.mapInArrow(route, "t int, p string, chunk bigint, rows binary, codes binary").repartition(tasks, "t", "p")
        subtrees = self.subtrees.select("tree", "path", "column", "cut", "left", "right", "value")
        answers = subtrees.repartition(tasks, "tree", "path").groupBy("tree", "path").cogroup(
            routed.groupBy("t", "p")).applyInArrow(answer, "chunk bigint, rows binary, v binary")
        best = answers.groupBy("chunk").applyInArrow(add, "chunk bigint, best binary")
        schema = StructType([df.schema[c] for c in others]).add("prediction", "double")
        return chunks.select("chunk", "rest").join(best, "chunk").select("rest", "best").mapInArrow(unpack, schema)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"forest": json.dumps(self.model.meta)})
        self.model.upper.write.parquet(f"{path}/upper")
        self.model.subtrees.write.options(**ROW_GROUPS).parquet(f"{path}/subtrees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        read = self.sparkSession.read
        model = ForestModel(read.parquet(f"{path}/upper"), read.parquet(f"{path}/subtrees"), json.loads(metadata["forest"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
