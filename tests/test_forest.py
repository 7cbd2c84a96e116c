"""Forests: subtrees against a plain recursive tree, upper levels, planted signal, tables instead of driver objects."""

import glob

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from netscope.operators import forest as Fo


def impurity(y, w, classes):
    if not len(y):
        return 0.0
    if classes:
        s = np.array([w[y == k].sum() for k in range(classes)])
        return w.sum() - (s ** 2).sum() / w.sum()
    m = (y * w).sum() / w.sum()
    return (w * (y - m) ** 2).sum()


def brute_tree(x, y, w, blocks, classes, depth):
    """Nested (feature, threshold, left, right) of the best splits, found by trying all; leaves are values."""
    value = (np.array([w[y == k].sum() for k in range(classes)]) if classes else np.array([(y * w).sum()])) / w.sum()
    if depth == 0 or len(set(y)) == 1:
        return value
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for lo, hi in zip(values[:-1], values[1:]):
            left = x[:, f] <= (lo + hi) / 2
            gain = impurity(y, w, classes) - impurity(y[left], w[left], classes) - impurity(y[~left], w[~left], classes)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, (lo + hi) / 2, left)
    if best is None:
        return value
    _, f, t, left = best
    return (f, t, brute_tree(x[left], y[left], w[left], blocks, classes, depth - 1),
            brute_tree(x[~left], y[~left], w[~left], blocks, classes, depth - 1))


def answer(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def data(seed, n=300, classes=0):
    """Two ordered features, a block of three one-hot features, target with noise; values are whole, so sums are exact."""
    rng = np.random.default_rng(seed)
    block = rng.integers(0, 3, n)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 200, n), np.eye(3)[block]]).astype(float)
    y = 3 * x[:, 0] + 10 * (block == 1) + rng.integers(0, 6, n)
    if classes:
        y = (y // 12 % classes)
    w = rng.integers(1, 4, n).astype(float)
    columns = [{"features": [i], "cuts": ((v := np.unique(x[:, i]))[:-1] / 2 + v[1:] / 2).tolist()} for i in (0, 1)]
    return x, y.astype(float), w, [*columns, {"features": [2, 3, 4], "block": "b"}]


@pytest.mark.parametrize("classes,depth", [(0, 30), (0, 3), (3, 30), (3, 4)])
def test_subtree_equals_brute_force(classes, depth):
    x, y, w, columns = data(classes + depth, classes=classes)
    rules = Fo.Rules(columns, 5, depth, 1, classes)
    codes = Fo.codes_of(x, columns)
    nodes = Fo.grow(codes, y, w, rules, 0, "")
    got = nodes["value"].reshape(-1, classes or 1)[Fo.walk(codes, nodes, rules.kinds)]
    tree = brute_tree(x, y, w, None, classes, depth)
    want = np.array([answer(tree, r) for r in x])
    # equal gains may be met in another order, so the fit as a whole is compared where rows differ
    same = np.isclose(got, want).all(1)
    loss = lambda p: ((p - (np.eye(classes)[y.astype(int)] if classes else y[:, None])) ** 2 * w[:, None]).sum()
    assert same.mean() > 0.97 and loss(got) == pytest.approx(loss(want), rel=0.02, abs=1e-9)
    assert nodes["n"][0] == len(y) and (nodes["n"][nodes["column"] < 0]).sum() == len(y)
    leaf = nodes["column"] < 0
    assert np.isnan(nodes["threshold"][leaf]).all() and not np.isnan(nodes["threshold"][~leaf]).any()


def test_histogram_split_equals_the_subtrees_first(monkeypatch):
    for classes in (0, 3):
        x, y, w, columns = data(5, 500, classes)
        rules = Fo.Rules(columns, 5, 30, 1, classes)
        codes = Fo.codes_of(x, columns)
        root = Fo.grow(codes, y, w, rules, 0, "")
        split = Fo.best_split(Fo.histogram(codes, y, w, rules), rules, 0, "")
        assert (split["column"], split["cut"], split["feature"]) == tuple(root[k][0] for k in ("column", "cut", "feature"))
        assert split["gain"] == pytest.approx(root["gain"][0]) and split["n_left"] + split["n_right"] == len(y)
        assert split["n_left"] == root["n"][root["left"][0]]
        parts = Fo._route(codes, [("", split["column"], split["cut"])], rules.kinds)
        assert (len(parts["L"]), len(parts["R"])) == (split["n_left"], split["n_right"])
        # a coarse grid still takes whole coarse codes only
        monkeypatch.setattr(Fo, "COARSE", 8)
        split = Fo.best_split(Fo.histogram(codes, y, w, rules), rules, 0, "")
        parts = Fo._route(codes, [("", split["column"], split["cut"])], rules.kinds)
        assert (len(parts["L"]), len(parts["R"])) == (split["n_left"], split["n_right"])
        monkeypatch.undo()


def table(spark, n=1500, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c, k = rng.uniform(0, 10), rng.normal(), rng.normal(), "pqr"[rng.integers(0, 3)]
        y = 4 * a + (25 if k == "q" else 0) + rng.normal(0, 0.3)
        rows.append((i, float(a), float(b), float(c), k, float(y), float(int(y > 30) + int(y > 45))))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, k string, y double, cls double").repartition(3)


def stages(est):
    return Pipeline(stages=[StringIndexer(inputCol="k", outputCol="k__idx"),
                            OneHotEncoder(inputCol="k__idx", outputCol="k__ohe", dropLast=False),
                            VectorAssembler(inputCols=["a", "b", "c", "k__ohe"], outputCol="features"), est])


@pytest.mark.parametrize("bound", [1 << 19, 200])
def test_signal_and_importance(spark, bound):
    """The same quality whether a tree is grown in one task or mostly by histograms."""
    df = table(spark)
    train, test = df.filter("id < 1200"), df.filter("id >= 1200")
    model = stages(Fo.ForestRegressor(labelCol="y", numTrees=12, bound=bound)).fit(train)
    forest = model.stages[-1]
    assert (forest.upper.count() > 12 * 3) == (bound == 200)
    assert forest.subtrees.select(F.max(F.element_at("n", 1))).first()[0] <= (200 if bound == 200 else 1200)
    pred = model.transform(test).select("id", "y", "prediction").collect()
    y, p = np.array([r["y"] for r in pred]), np.array([r["prediction"] for r in pred])
    assert len(pred) == 300 and 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.98
    imp = forest.featureImportances.toArray()
    assert imp.sum() == pytest.approx(1) and imp[0] + imp[3:].sum() > 0.97 and min(imp[0], imp[3:].max()) > 0.2


def test_classifier_with_feature_subsets(spark):
    df = table(spark)
    est = Fo.ForestClassifier(labelCol="cls", numTrees=25, featureSubsetStrategy="sqrt", bound=400)
    model = stages(est).fit(df.filter("id < 1200"))
    pred = model.transform(df.filter("id >= 1200"))
    assert pred.filter("prediction = cls").count() > 0.93 * 300
    assert model.stages[-1].meta["classes"] == 3


def test_saved_forest_answers_alike(spark, workdir):
    df = table(spark, 400)
    for bound in (1 << 19, 100):
        model = stages(Fo.ForestRegressor(labelCol="y", numTrees=5, maxDepth=6, bound=bound)).fit(df)
        model.write().overwrite().save(f"{workdir}/m{bound}")
        again = PipelineModel.load(f"{workdir}/m{bound}")
        one, two = (sorted(m.transform(df).select("id", "prediction").collect()) for m in (model, again))
        assert one == two and len(one) == 400
        assert again.stages[-1].numFeatures == 6


def test_fit_is_repeatable(spark):
    df = table(spark, 300).coalesce(1).sortWithinPartitions("id")
    fit = lambda: sorted(stages(Fo.ForestRegressor(labelCol="y", numTrees=4, bound=80)).fit(df).transform(df).select(
        "id", "prediction").collect())
    assert fit() == fit()


def test_nodes_never_reach_the_driver(spark, monkeypatch):
    """What is collected while a forest is trained: cut points, counts and class numbers, one row each time."""
    df = table(spark, 600)
    seen = []
    frame = type(df)
    collect = frame.collect
    monkeypatch.setattr(frame, "toPandas", lambda self: pytest.fail("toPandas"))
    est = Fo.ForestRegressor(labelCol="y", numTrees=3, bound=100)
    prepared = stages(est).getStages()[:-1]
    ready = Pipeline(stages=prepared).fit(df).transform(df)
    seen.clear()
    monkeypatch.setattr(frame, "collect", lambda self: (seen.append((self.columns, collect(self))), collect(self))[1])
    est.fit(ready)
    assert len(seen) >= 3 and all(len(rows) <= 1 for _, rows in seen)
    assert not any({"path", "tree", "subtrees", "feature"} & set(c) for c, _ in seen)


def test_empty_and_tiny_tables(spark):
    df = table(spark, 3)
    model = stages(Fo.ForestRegressor(labelCol="y", numTrees=8)).fit(df)
    assert model.transform(df).count() == 3
    assert model.transform(df.limit(0)).count() == 0
    ready = model.stages[2].transform(model.stages[1].transform(model.stages[0].transform(df)))
    with pytest.raises(ValueError):
        Fo.ForestRegressor(labelCol="y").fit(ready.limit(0))


def test_a_column_is_looked_at_only_where_it_is_tried(monkeypatch):
    """With one feature in twenty tried per node, a level costs a few columns' rows, not all columns'."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 300, (4000, 20)).astype(float)
    columns = [{"features": [i], "cuts": (np.arange(299) + 0.5).tolist()} for i in range(20)]
    seen, cells = [], Fo._cells
    monkeypatch.setattr(Fo, "_cells", lambda code, *a: (seen.append(len(code)), cells(code, *a))[1])
    rules = Fo.Rules(columns, 1, 12, 1, 3)
    nodes = Fo.grow(Fo.codes_of(x, columns), rng.integers(0, 3, 4000).astype(float), np.ones(4000), rules, 0, "")
    assert nodes["n"][0] == 4000 and sum(seen) <= 12 * 4000 * 4
    leaf = nodes["column"] < 0
    assert nodes["n"][leaf].sum() == 4000


def test_every_tree_is_grown_once_whatever_the_batches(spark, monkeypatch):
    """A batch of trees ends inside a block, and a chunk is opened once per block of trees."""
    df = table(spark, 600)
    trees = lambda b: sorted((r["tree"], r["path"], r["n"][0]) for r in stages(Fo.ForestRegressor(
        labelCol="y", numTrees=11, bound=b)).fit(df).stages[-1].subtrees.select("tree", "path", "n").collect())
    whole, parts = trees(1 << 19), trees(150)
    assert [t for t, _, _ in whole] == list(range(11)) and {t for t, _, _ in parts} == set(range(11))
    assert len(set(parts)) == len(parts)
    monkeypatch.setattr(Fo, "UPPER_BYTES", 100 * 8 * 3)      # three trees a batch
    again = trees(150)
    assert again == parts
    x, y, w, columns = data(1)
    rules, t, sink = Fo.Rules(columns, 5, 30, 1, 0), pa.table({"y": y, "w": w}), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as out:
        out.write_table(t)
    batch = pa.RecordBatch.from_pydict({"chunk": [5], "codes": [Fo.codes_of(x, columns).tobytes()], "rest": [sink.getvalue().to_pybytes()],
                                        "block": [0], "upper": pa.nulls(1)})
    opened, real = [], Fo._table
    monkeypatch.setattr(Fo, "_table", lambda rest: (opened.append(1), real(rest))[1])
    assert [b[1] for b in Fo._bags([batch], rules, range(11))] == list(range(Fo.TREES)) and len(opened) == 1


def test_a_row_group_holds_about_one_large_subtree(spark, workdir, monkeypatch):
    """Readers decode the rows of a row group at once, so subtrees of many nodes don't share one."""
    rng = np.random.default_rng(1)
    at = lambda i: spark.createDataFrame([(i, rng.random(200_000).tolist())], "tree int, value array<double>")
    df = at(0).union(at(1)).union(at(2)).union(at(3)).coalesce(1)
    df.write.options(**Fo.ROW_GROUPS).parquet(f"{workdir}/g")
    meta = pq.ParquetFile(glob.glob(f"{workdir}/g/part-*")[0]).metadata
    assert meta.num_rows == 4 and meta.num_row_groups >= 2
