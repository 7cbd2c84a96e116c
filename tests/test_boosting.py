"""Boosted trees: both ways against plain boosting by exhaustive search, falling loss, saved models, awkward rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

from netscope.operators import boosting as Bo


def brute(x, y, w, rounds, step, depth):
    """Margins after all rounds; each tree by trying every threshold of every feature."""
    def tree(rows, r, left):
        value = np.zeros(len(r))
        value[rows] = (w[rows] * r[rows]).sum() / w[rows].sum()
        best = None
        if left and len(rows) > 1:
            score = lambda i: (w[i] * r[i]).sum() ** 2 / w[i].sum()
            for f in range(x.shape[1]):
                values = np.unique(x[rows, f])
                for lo, hi in zip(values[:-1], values[1:]):
                    side = x[rows, f] <= (lo + hi) / 2
                    gain = score(rows[side]) + score(rows[~side]) - score(rows)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, rows[side], rows[~side])
        if best is None or best[0] <= 1e-9:
            return value
        return tree(best[1], r, left - 1) + tree(best[2], r, left - 1)

    margin = np.full(len(y), (w * y).sum() / w.sum())
    for _ in range(rounds):
        margin = margin + step * tree(np.flatnonzero(w > 0), y - margin, depth)
    return margin


def table(spark, n=240, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(i, float(rng.integers(0, 12)), float(rng.integers(0, 40)), "pqr"[rng.integers(0, 3)], float(rng.integers(1, 4)))
            for i in range(n)]
    rows = [(*r, 3.0 * r[1] + (9.0 if r[3] == "q" else 0.0) + float(rng.normal())) for r in rows]
    return spark.createDataFrame(rows, "id long, a double, b double, k string, w double, y double").repartition(4, "id")


def stages(est):
    return Pipeline(stages=[StringIndexer(inputCol="k", outputCol="k__idx", stringOrderType="alphabetAsc"),
                            OneHotEncoder(inputCol="k__idx", outputCol="k__ohe", dropLast=False),
                            VectorAssembler(inputCols=["a", "b", "k__ohe"], outputCol="features"), est])


@pytest.mark.parametrize("bound", [1 << 19, 0])
def test_equals_brute_force(spark, bound):
    df = table(spark)
    est = Bo.BoostedRegressor(labelCol="y", weightCol="w", maxIter=5, stepSize=0.3, maxDepth=3, checkpointInterval=2, bound=bound)
    model = stages(est).fit(df)
    got = sorted(model.transform(df).select("id", "a", "b", "k", "w", "y", "prediction").collect())
    x = np.array([[r["a"], r["b"], *(float(r["k"] == k) for k in "pqr")] for r in got])
    y, w = (np.array([r[c] for r in got]) for c in ("y", "w"))
    want = brute(x, y, w, 5, 0.3, 3)
    assert np.allclose([r["prediction"] for r in got], want, atol=1e-9)
    loss = [r["loss"] for r in model.stages[-1].losses().orderBy("round").collect()]
    assert len(loss) == 5 and loss[0] == pytest.approx((w * (y - (w * y).sum() / w.sum()) ** 2).sum() / w.sum())
    assert all(b < a for a, b in zip(loss, loss[1:]))
    nodes = model.stages[-1].nodes
    assert nodes.filter("node = 0 and n <> 240").isEmpty()
    # every row stands in one leaf of each tree
    assert [r[0] for r in nodes.filter("column < 0").groupBy("round").sum("n").select("sum(n)").collect()] == [240] * 5


def test_saved_model_answers_alike(spark, workdir):
    df = table(spark)
    model = stages(Bo.BoostedRegressor(labelCol="y", maxIter=8)).fit(df)
    model.write().overwrite().save(f"{workdir}/boosted")
    again = PipelineModel.load(f"{workdir}/boosted")
    one, two = (sorted(m.transform(df).select("id", "prediction").collect()) for m in (model, again))
    assert one == two and len(one) == 240 and again.stages[-1].numFeatures == 5
    imp = model.stages[-1].featureImportances.toArray()
    assert imp.sum() == pytest.approx(1) and imp[0] > 0.5
    ready = df
    for st in model.stages[:-1]:
        ready = st.transform(ready)
    errors = model.stages[-1].evaluateEachIteration(ready)
    assert len(errors) == 8 and all(b < a for a, b in zip(errors, errors[1:]))
    assert model.stages[-1].evaluateEachIteration(ready.limit(0)) == []


def test_awkward_rows(spark):
    df = table(spark, 60)
    ready = stages(Bo.BoostedRegressor(labelCol="y", maxIter=2)).fit(df)
    feed = df
    for st in ready.stages[:-1]:
        feed = st.transform(feed)
    with pytest.raises(ValueError):
        Bo.BoostedRegressor(labelCol="y").fit(feed.limit(0))
    with pytest.raises(ValueError):
        Bo.BoostedRegressor(labelCol="y").fit(feed.selectExpr("features", "cast(null as double) as y"))
    with pytest.raises(ValueError):
        Bo.BoostedRegressor(labelCol="y", maxDepth=11).fit(feed)
    for bound in (1 << 19, 0):
        # rows without target or weight don't count, a constant target gives one leaf
        holes = feed.selectExpr("features", "if(id % 2 = 0, null, 7.0D) as y", "if(id % 3 = 0, 0D, 1D) as w")
        model = Bo.BoostedRegressor(labelCol="y", weightCol="w", maxIter=3, bound=bound).fit(holes)
        assert model.nodes.count() == 3 and model.nodes.filter("n <> 20 or loss <> 0").isEmpty()
        assert {r[0] for r in model.transform(feed).select("prediction").collect()} == {7.0}
    assert model.transform(feed.limit(0)).count() == 0


def test_steps_lead_where_a_walk_ends():
    rng = np.random.default_rng(3)
    codes, blocks = rng.integers(0, 6, (3, 200)).astype(np.uint16), np.array([False, True, False])
    tree = Bo.Tree(3)
    for i in (0, 1, 2, 4, 6):
        tree.column[i], tree.cut[i] = rng.integers(0, 3), rng.integers(1, 5)
    at = np.zeros(200, np.int64)
    for _ in range(4):
        at = tree.step(at, codes, blocks)
    assert (at == tree.walk(codes, blocks)).all() and len(set(at)) > 3


def test_places_hold_the_rows_that_walk_there():
    rng = np.random.default_rng(3)
    codes, blocks = rng.integers(0, 6, (3, 200)).astype(np.uint16), np.array([False, True, False])
    tree = Bo.Tree(3)
    assert list(Bo._places(tree, codes, blocks).items()) == [(0, None)]
    for i in (0, 1, 2, 4, 6):
        tree.column[i], tree.cut[i] = rng.integers(0, 3), rng.integers(1, 5)
    at = np.full(200, -1)
    for i, rows in Bo._places(tree, codes, blocks).items():
        assert (at[rows] == -1).all()
        at[rows] = i
    assert (at == tree.walk(codes, blocks)).all()


def test_sums_of_many_partitions_meet_in_few_places(spark, monkeypatch):
    """Lists are added in the partitions' order, and at most one list per place comes to the driver."""
    parts = spark.sparkContext.parallelize(range(30), 30).map(lambda i: [np.array([0.1 * i, 1.0]), float(i)])
    want = [sum((np.array([0.1 * i, 1.0]) for i in range(1, 30)), np.array([0.0, 1.0])), 435.0]
    got = Bo._gathered(parts)
    assert (got[0] == want[0]).all() and got[1] == want[1]
    monkeypatch.setattr(Bo, "GATHERED", 8)
    seen, frame = [], type(parts.map(len))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (seen.append(self.getNumPartitions()), collect(self))[1])
    got = Bo._gathered(parts)
    assert np.allclose(got[0], want[0]) and got[1] == want[1] and seen == [4]


def test_many_tasks_grow_the_trees_of_one_task(spark, monkeypatch):
    monkeypatch.setattr(Bo, "LEAST_ROWS", 100)
    df = table(spark, 1200)
    nodes = [sorted(tuple(r) for r in stages(Bo.BoostedRegressor(labelCol="y", maxIter=4, stepSize=0.3, maxDepth=3, checkpointInterval=2,
                                                                 bound=b)).fit(df).stages[-1].nodes.select(
        "round", "node", "column", "cut", "n").collect()) for b in (1 << 19, 0)]
    assert nodes[0] == nodes[1] and len(nodes[0]) > 30
