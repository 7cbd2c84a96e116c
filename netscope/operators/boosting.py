"""Gradient boosting (squared loss) whose rounds carry a margin column.

1. *Store*: features become codes of at most ``MAX_BINS`` bins, packed into chunks of a Parquet table
   (``operators.forest.store``), written once, with a margin of every row beside them.
2. *Round*: a tree grows level by level.  Tasks add up one histogram of the residuals per open node; their sums (at
   most ``2 ** depth`` histograms a level, from at most ``GATHERED`` places) come to the driver, which picks the splits.
3. *Margins*: a round's margins stay persisted until the next round's are; every ``every`` rounds they are checkpointed,
   so a round costs the same however many came before it, and a lost executor repeats at most that.
4. As in the forests, what holds at most ``bound`` rows is finished inside one task: there, all rounds over the whole
   store.  It is the same code over one histogram in place of many, so the trees are the same.

A split sends codes up to a cut (or all but one category) to the left; the best one by decrease of the squared error
wins, ties by feature, then cut.  A leaf's value is its mean residual, scaled by ``stepSize``; the first margin is the
mean of the target.  Rows without target are no training rows (ValueError if none is left); a missing feature (NaN)
lies above all cuts.  A weight of zero leaves a row out.
"""

from __future__ import annotations

import functools
import json
import operator
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
from pyspark import RDD, StorageLevel

from netscope.operators import forest as Fo
from netscope.session import unique_subdir

MAX_BINS = Fo.COARSE
MAX_DEPTH = 10          # a tree is an array of 2 ** (depth + 1) - 1 nodes
EVERY = 20
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 20     # of a task, where there are enough rows for several
GATHERED = 64           # lists of histograms that are added up in one place

_NODE = ("round int, node int, column int, cut int, feature int, threshold double, gain double, value double, "
         "n bigint, loss double")


class Tree:
    """A binary tree as arrays; the children of node i are 2i + 1 and 2i + 2, ``column`` is -1 at a leaf."""

    def __init__(self, depth: int):
        size = (2 << depth) - 1
        self.column, self.cut = np.full(size, -1), np.zeros(size, np.int64)
        self.value = np.zeros(size)

    def walk(self, codes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The node at which each row stops."""
        at, rows = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
        while len(rows):
            column = self.column[at[rows]]
            rows, column = rows[column >= 0], column[column >= 0]
            code, cut = codes[column, rows], self.cut[at[rows]]
            at[rows] = 2 * at[rows] + 1 + np.where(blocks[column], code == cut, code > cut)
        return at

    def step(self, at: np.ndarray, codes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Rows one level further, from the nodes at which they stand."""
        column = self.column[at]
        rows = np.arange(len(at)) if (column >= 0).all() else np.flatnonzero(column >= 0)
        column, here = column[rows], at[rows]
        code, cut = codes[column, rows], self.cut[here]
        out = at.copy()
        out[rows] = 2 * here + 1 + np.where(blocks[column], code == cut, code > cut)
        return out


def _sizes(rules: Fo.Rules) -> list[int]:
    """Codes of each column; a histogram holds one column's codes after another's."""
    return [len(c["features"] if "block" in c else c["cuts"]) + 1 for c in rules.columns]


def _histograms(codes: np.ndarray, at: np.ndarray, nodes: list[int], r: np.ndarray, w: np.ndarray, rules: Fo.Rules) -> np.ndarray:
    """Rows, weights and residual sums (nodes x codes of all columns x 3) of the rows that stand at ``nodes``."""
    place = np.full((2 << rules.max_depth) - 1, -1)
    place[nodes] = np.arange(len(nodes))
    nd = place[at]
    if (nd < 0).any():
        own = np.flatnonzero(nd >= 0)
        codes, nd, r, w = codes[:, own], nd[own], r[own], w[own]
    plain, rw = bool((w == 1.0).all()), r * w
    parts = []
    for k, size in enumerate(_sizes(rules)):
        key = nd * size + codes[k]
        n = np.bincount(key, None, len(nodes) * size).astype(float)
        sums = (n, n if plain else np.bincount(key, w, len(nodes) * size), np.bincount(key, rw, len(nodes) * size))
        parts.append(np.stack(sums, 1).reshape(len(nodes), size, 3))
    return np.concatenate(parts, 1)


def _sides(hist: np.ndarray, rules: Fo.Rules, split: dict) -> tuple[np.ndarray, np.ndarray]:
    """Rows, weight and residual sum of a split's two sides."""
    sizes, k, cut = _sizes(rules), split["column"], split["cut"]
    own = hist[sum(sizes[:k]):sum(sizes[:k + 1])]
    if rules.kinds[k]:
        return own.sum(0) - own[cut], own[cut]
    return own[:cut + 1].sum(0), own[cut + 1:].sum(0)


def _split(hist: np.ndarray, rules: Fo.Rules) -> dict | None:
    """Best split of a node, with both sides' rows, weights and sums; None if nothing lowers the error."""
    s = Fo.best_split(hist, rules, 0, "")
    if s is None or not s["gain"] > 0:
        return None
    left, right = _sides(hist, rules, s)
    if not (left[1] > 0 and right[1] > 0):
        return None
    return {**s, "left": left.tolist(), "right": right.tolist()}


def _grown(depth: int, root: np.ndarray, level) -> tuple[Tree, dict[int, dict]]:
    """A tree, and its nodes' figures.  ``level(tree, nodes)`` gives the splits of open nodes by number."""
    tree, figures = Tree(depth), {0: {"n": int(root[0]), "gain": 0.0, "feature": -1}}
    tree.value[0] = root[2] / root[1]
    nodes = [0]
    for _ in range(depth):
        splits, below = level(tree, nodes), []
        for i in nodes:
            s = splits.get(i)
            if s is None:
                continue
            tree.column[i], tree.cut[i] = s["column"], s["cut"]
            figures[i].update(gain=s["gain"], feature=s["feature"])
            for j, side in ((2 * i + 1, s["left"]), (2 * i + 2, s["right"])):
                tree.value[j] = side[2] / side[1]
                figures[j] = {"n": int(side[0]), "gain": 0.0, "feature": -1}
                if side[0] > 1:
                    below.append(j)
        nodes = below
        if not nodes:
            break
    return tree, figures


def _rows(number: int, loss: float, tree: Tree, figures: dict[int, dict], rules: Fo.Rules) -> list[tuple]:
    """A tree's nodes as rows; ``loss`` is the mean squared error before its round."""
    out = []
    for i, f in sorted(figures.items()):
        k, cut = int(tree.column[i]), int(tree.cut[i])
        threshold = None if k < 0 else 0.5 if rules.kinds[k] else rules.columns[k]["cuts"][cut]
        out.append((number, i, k, cut, f["feature"], threshold, f["gain"], float(tree.value[i]), f["n"], loss))
    return out


def _trees(rows: list[tuple], depth: int) -> list[Tree]:
    """Trees by round from ``(round, node, column, cut, value)``."""
    out: list[Tree] = []
    for number, node, column, cut, value in sorted(rows):
        while len(out) <= number:
            out.append(Tree(depth))
        out[number].column[node], out[number].cut[node], out[number].value[node] = column, cut, value
    return out


def _margins(codes: np.ndarray, margin: np.ndarray, trees: list[Tree], blocks: np.ndarray, step: float) -> np.ndarray:
    for t in trees:
        margin = margin + step * t.value[t.walk(codes, blocks)]
    return margin


def _opened(codes: bytes, rest: bytes, margin: bytes, rules: Fo.Rules) -> tuple[np.ndarray, ...]:
    t = Fo._table(rest)
    return (np.frombuffer(codes, np.uint16).reshape(len(rules.columns), -1), t.column("y").to_numpy(),
            t.column("w").to_numpy(), np.frombuffer(margin, float))


def _in_one_task(chunks: DataFrame, rules: Fo.Rules, rounds: int, step: float) -> DataFrame:
    """All rounds over the chunks of one group (at most ``bound`` rows)."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("chunk")     # the shuffle's order must not show
        parts = [_opened(*p, rules) for p in zip(*(t.column(c).to_pylist() for c in ("codes", "rest", "margin")))]
        codes = np.concatenate([p[0] for p in parts], 1)
        y, w, margin = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        codes, y, w, margin = codes[:, w > 0], y[w > 0], w[w > 0], margin[w > 0]
        blocks, out = np.array(rules.kinds), []
        for number in range(rounds):
            r = y - margin
            stand = [np.zeros(len(r), np.int64)]     # where each row stands in the round's tree

            def level(tree: Tree, nodes: list[int], r=r, stand=stand) -> dict[int, dict]:
                if nodes != [0]:
                    stand[0] = tree.step(stand[0], codes, blocks)
                hists = _histograms(codes, stand[0], nodes, r, w, rules)
                return {i: s for i, h in zip(nodes, hists) if (s := _split(h, rules))}

            tree, figures = _grown(rules.max_depth, np.array([len(r), w.sum(), (r * w).sum()]), level)
            out += _rows(number, float((w * r * r).sum() / w.sum()), tree, figures, rules)
            margin = margin + step * tree.value[tree.step(stand[0], codes, blocks)]
        names = [f.split()[0] for f in _NODE.split(", ")]
        kinds = [pa.int32()] * 5 + [pa.float64()] * 3 + [pa.int64(), pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return chunks.groupBy(F.lit(0).alias("all")).applyInArrow(run, _NODE)


def _gathered(parts: RDD) -> list:
    """Sums of the parts' lists (entry by entry, one list a partition), always added in the partitions' order."""
    n = parts.getNumPartitions()

    def added(lists: list) -> list:
        return [functools.reduce(operator.add, e) for e in zip(*lists)]

    found = parts.mapPartitionsWithIndex(lambda i, lists: [(i, x) for x in lists])
    if n > GATHERED:      # few lists come to the driver, however many partitions there are
        found = found.map(lambda p: (p[0] // GATHERED, p)).groupByKey(-(-n // GATHERED)).mapValues(
            lambda ps: added([x for _, x in sorted(ps, key=lambda p: p[0])]))
    return added([x for _, x in sorted(found.collect(), key=lambda p: p[0])])


def _places(tree: Tree, codes: np.ndarray, blocks: np.ndarray) -> dict[int, np.ndarray | None]:
    """Rows by the node at which they stop (None: all of them at the root)."""
    found, open_ = {}, [(0, None)]
    while open_:
        i, rows = open_.pop()
        if tree.column[i] < 0:
            found[i] = rows
            continue
        own = codes[tree.column[i]] if rows is None else codes[tree.column[i]][rows]
        right = own == tree.cut[i] if blocks[tree.column[i]] else own > tree.cut[i]
        open_ += [(2 * i + 1 + side, np.flatnonzero(to) if rows is None else rows[to]) for side, to in enumerate((~right, right))]
    return found


def _over_tasks(chunks: DataFrame, rules: Fo.Rules, rounds: int, step: float, every: int, total: int) -> DataFrame:
    """Rounds over chunks of any number; each level is one sum of histograms, those of the smaller children: what a
    split's parent has besides is its other child's.

    A round's residuals are kept until the next round has its own, so no level adds up earlier trees."""
    spark, blocks = chunks.sparkSession, np.array(rules.kinds)
    rows: list[tuple] = []

    def opened(own: Iterator) -> Iterator[tuple]:
        own = sorted(own, key=lambda p: p[0])      # the shuffle's order must not show
        if own:
            parts = [_opened(bytes(p[1]), bytes(p[2]), bytes(p[3]), rules) for p in own]
            codes, (y, w, margin) = np.concatenate([p[0] for p in parts], 1), (
                np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            drawn = w > 0
            yield np.ascontiguousarray(codes[:, drawn]), (y - margin)[drawn], w[drawn]

    def counted(held: RDD, tree: Tree, nodes: list[int]) -> list:
        """Loss (before the tree), and histogram of every node."""
        def count(part: tuple) -> list:
            codes, r, w = part
            places, out = _places(tree, codes, blocks), []
            for i in nodes:
                own = places[i]
                x = part if own is None else (codes[:, own], r[own], w[own])
                out.append(_histograms(x[0], np.zeros(len(x[1]), np.int64), [0], x[1], x[2], rules)[0])
            return [float((w * r * r).sum()) if nodes == [0] else 0.0, *out]
        return _gathered(held.map(count))

    def with_tree(held: RDD, tree: Tree) -> RDD:
        def add(part: tuple) -> tuple:
            r = part[1].copy()
            for i, own in _places(tree, part[0], blocks).items():
                r[slice(None) if own is None else own] -= step * tree.value[i]
            return part[0], r, part[2]
        return held.map(add)

    tasks = max(min(spark.sparkContext.defaultParallelism, -(-total // LEAST_ROWS)), -(-total // MOST_ROWS))
    held = chunks.select("chunk", "codes", "rest", "margin").repartition(tasks).rdd.mapPartitions(opened).persist(
        StorageLevel.MEMORY_AND_DISK)
    late = None
    for number in range(rounds):
        loss, root = counted(held, Tree(rules.max_depth), [0])
        if late is not None:
            late.unpersist()
        weight = root[:_sizes(rules)[0]].sum(0)
        known = {0: root}      # of the level above, then of this one too

        def level(tree: Tree, nodes: list[int], known=known, held=held) -> dict[int, dict]:
            small = []
            for i in nodes if nodes != [0] else ():
                up, other = (i - 1) // 2, i + 1 if i % 2 else i - 1
                n = [_sides(known[up], rules, {"column": tree.column[up], "cut": tree.cut[up]})[(j - 1) % 2][0] for j in (i, other)]
                if other not in nodes or (n[0], i) < (n[1], other):
                    small.append(i)
            if small:
                known.update(zip(small, counted(held, tree, small)[1:]))
            for i in nodes:
                if i not in known:
                    h = known[(i - 1) // 2] - known[i + 1 if i % 2 else i - 1]
                    known[i] = np.where(h[:, :1] > 0, h, 0.0)
            return {i: s for i in nodes if (s := _split(known[i], rules))}

        tree, figures = _grown(rules.max_depth, weight, level)
        rows += _rows(number, loss / float(weight[1]), tree, figures, rules)
        late, held = held, with_tree(held, tree).persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % every == 0:
            held.checkpoint()       # what a lost executor held is made again from here
    for own in (late, held):
        own.unpersist()
    return spark.createDataFrame(rows, _NODE)


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol, HasSeed):
    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "weight of a round's tree", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits in a tree", TypeConverters.toInt)
    checkpointInterval = Param(Params._dummy(), "checkpointInterval", "rounds between writes of the margins", TypeConverters.toInt)

    def getMaxIter(self) -> int:
        return self.getOrDefault("maxIter")

    def getStepSize(self) -> float:
        return self.getOrDefault("stepSize")

    def getMaxDepth(self) -> int:
        return self.getOrDefault("maxDepth")

    def getFeatureSubsetStrategy(self) -> str:
        """Every split looks at all features,"""
        return "all"

    def getMinInstancesPerNode(self) -> int:
        """a leaf needs one row,"""
        return 1

    def getSubsamplingRate(self) -> float:
        """and every round sees all rows."""
        return 1.0


class BoostedRegressor(Estimator, _BoostingParams):
    """Boosted regression trees; ``bound``: rows that one task takes through all rounds."""

    def __init__(self, labelCol: str = "label", featuresCol: str = "features", weightCol: str | None = None,
                 bound: int = Fo.BOUND, **params):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.1, maxDepth=5, checkpointInterval=EVERY, predictionCol="prediction", seed=42)
        self.bound = bound
        self._set(labelCol=labelCol, featuresCol=featuresCol, **params, **({"weightCol": weightCol} if weightCol else {}))

    def _fit(self, df: DataFrame) -> BoostedModel:
        spark, features, depth = df.sparkSession, self.getFeaturesCol(), self.getMaxDepth()
        if not 1 <= depth <= MAX_DEPTH:
            raise ValueError(f"maxDepth is 1 to {MAX_DEPTH}")
        label = F.col(self.getLabelCol()).cast("double")
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        data = df.select(features, label.alias("y"), weight.alias("w")).filter("y is not null and not isnan(y)")
        columns = Fo.with_cuts(data.select(vector_to_array(features).alias("_x")), "_x", Fo.columns_of(df, features), MAX_BINS)
        chunks = Fo.store(data, features, columns, ["y", "w"], Fo.TRAIN_CHUNK)
        total = chunks.agg(F.sum("n")).first()[0]
        start = data.agg(F.try_divide(F.sum(F.col("y") * F.col("w")), F.sum("w"))).first()[0]
        if not total or start is None:
            raise ValueError("boosting needs at least one row")
        # as many doubles as rows, all the same: the text of one double in hex, repeated
        margin = F.expr(f"unhex(repeat('{np.float64(start).tobytes().hex()}', n))")
        chunks = chunks.withColumn("margin", margin)
        n_features = sum(len(c["features"]) for c in columns)
        rules = Fo.Rules(columns, n_features, depth, self.getSeed(), 0)
        rounds, step = self.getMaxIter(), self.getStepSize()
        nodes = (_in_one_task(chunks, rules, rounds, step) if total <= self.bound else
                 _over_tasks(chunks, rules, rounds, step, self.getOrDefault("checkpointInterval"), total))
        at = unique_subdir(spark, "boosting-nodes")
        nodes.write.parquet(at)
        meta = {"columns": columns, "start": start, "step": step, "depth": depth, "features": n_features}
        return self._copyValues(BoostedModel(spark.read.parquet(at), meta))


class BoostedModel(Model, _BoostingParams, MLWritable, MLReadable):
    """Trees as a table ``nodes`` (one row per node and round)."""

    def __init__(self, nodes: DataFrame | None = None, meta: dict | None = None):
        super().__init__()
        self.nodes, self.meta = nodes, meta

    @property
    def numFeatures(self) -> int:
        return self.meta["features"]

    def losses(self) -> DataFrame:
        """``round, loss``: the mean squared error on the training rows before each round."""
        return self.nodes.filter("node = 0").select("round", "loss")

    @property
    def featureImportances(self) -> DenseVector:
        """Decrease of the squared error by feature, adding up to one; a vector of fixed length."""
        out = np.zeros(self.numFeatures)
        for r in self.nodes.filter("feature >= 0").groupBy("feature").agg(F.sum("gain").alias("g")).collect():
            out[r["feature"]] = r["g"]
        return DenseVector(out / out.sum() if out.sum() else out)

    def _trees(self) -> list[Tree]:
        rows = self.nodes.select("round", "node", "column", "cut", "value").collect()
        return _trees([tuple(r) for r in rows], self.meta["depth"])

    def evaluateEachIteration(self, df: DataFrame, loss: str = "squared") -> list[float]:
        """Mean squared error over ``df`` after each round, in one pass; [] if it has no row with a target."""
        if loss != "squared":
            raise ValueError("the loss is squared")
        columns, step, start, trees = self.meta["columns"], self.meta["step"], self.meta["start"], self._trees()
        blocks = np.array(["block" in c for c in columns])

        def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, rows = np.zeros(len(trees)), 0
            for batch in batches:
                if not len(batch):
                    continue
                codes = Fo.codes_of(batch.column(0).flatten().to_numpy().reshape(len(batch), -1), columns)
                y, margin = batch.column(1).to_numpy(), np.full(len(batch), start)
                for i, t in enumerate(trees):
                    margin = _margins(codes, margin, [t], blocks, step)
                    total[i] += ((y - margin) ** 2).sum()
                rows += len(batch)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([rows])], names=["e", "n"])

        label = F.col(self.getOrDefault("labelCol")).cast("double")
        sums = df.select(vector_to_array(self.getFeaturesCol()), label.alias("y")).filter("y is not null").mapInArrow(
            errors, "e array<double>, n bigint")
        each = sums.select("n", F.posexplode("e").alias("round", "e")).groupBy("round").agg(
            F.try_divide(F.sum("e"), F.sum("n")).alias("mse")).orderBy("round")
        return [r["mse"] for r in each.collect() if r["mse"] is not None]

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` without vector columns, with ``prediction``.

        The trees travel with the tasks: rounds times ``2 ** (depth + 1)`` nodes of 24 bytes, whatever the data.
        """
        columns, step, start = self.meta["columns"], self.meta["step"], self.meta["start"]
        blocks = np.array(["block" in c for c in columns])
        trees = self._trees()
        others = [f.name for f in df.schema.fields if not isinstance(f.dataType, UserDefinedType)]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
                codes = Fo.codes_of(x, columns)
                found = _margins(codes, np.full(len(batch), start), trees, blocks, step)
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], names=[*others, "prediction"])

        schema = StructType([df.schema[c] for c in others]).add("prediction", "double")
        return df.select(vector_to_array(self.getFeaturesCol()), *(F.col(f"`{c}`") for c in others)).mapInArrow(score, schema)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: BoostedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"boosting": json.dumps(self.model.meta)})
        self.model.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedModel(self.sparkSession.read.parquet(f"{path}/nodes"), json.loads(metadata["boosting"]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
