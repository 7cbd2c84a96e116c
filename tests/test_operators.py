"""Properties of the operators on small hand-written inputs and on the smallest driver tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from netscope.functions.labels import performance_class, slo_tier
from netscope.operators import outliers as O
from netscope.operators import profile as P
from netscope.operators import series as S


def test_summary_stats_equal_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [(g, float(v)) for g in range(5) for v in rng.normal(10, 3, size=int(rng.integers(1, 40)))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r for r in S.summary_stats(df, ["g"], "v").collect()}
    for g in range(5):
        x = np.array([v for k, v in rows if k == g])
        r = got[g]
        assert r["n"] == len(x)
        assert math.isclose(r["std"], float(np.std(x)), rel_tol=1e-9, abs_tol=1e-12)
        for name, q in zip(S.PCTL_NAMES, S.PCTLS):
            assert math.isclose(r[name], float(np.percentile(x, q * 100)), rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(r["median"], float(np.median(x)), rel_tol=1e-12)


def test_blocked_lags_equal_plain_window(spark):
    from pyspark.sql import Window
    s = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").alias("exp_id"), "ts", "value", "event_id")
    # tiny blocks and hourly chunks force many halo crossings
    blocked = S.supervised_lags(s, ["exp_id"], "ts", "event_id", lags=3, horizon=2, block_rows=4)
    w = Window.partitionBy("exp_id").orderBy("ts", "event_id")
    plain = s.select("exp_id", "event_id", F.lead("value", 2).over(w).alias("y"),
                     *[F.lag("value", i).over(w).alias(f"lag_{i}") for i in (1, 2, 3)]).na.drop()
    a = sorted(tuple(r) for r in blocked.select("exp_id", "event_id", "y", "lag_1", "lag_2", "lag_3").collect())
    b = sorted(tuple(r) for r in plain.collect())
    assert a == b and len(a) > 0


def test_rolling_and_chrono_split(spark):
    rows = [(1, i, float(i)) for i in range(20)] + [(2, i, float(i * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "exp_id int, event_id int, value double").withColumn(
        "ts", F.timestamp_seconds(F.col("event_id") * 1000))
    r = {(x["exp_id"], x["event_id"]): x for x in
         S.rolling(df, ["exp_id"], "ts", "event_id", mean_window=3, std_window=4, block_rows=7).collect()}
    assert r[(1, 1)]["roll_mean_3"] is None and r[(1, 2)]["roll_mean_3"] == 1.0
    assert math.isclose(r[(1, 10)]["roll_std_4"], float(np.std([7, 8, 9, 10], ddof=1)))
    sp = S.chrono_split(df, ["exp_id"], "ts", "event_id", 0.8).groupBy("exp_id", "split").count().collect()
    cnt = {(x["exp_id"], x["split"]): x["count"] for x in sp}
    assert cnt[(1, "train")] == 16 and cnt[(1, "test")] == 4 and cnt[(2, "train")] == 4


def _brute_noise(X, eps, ms):
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= ms
    return ~core & ~(nb & core[None, :]).any(1)


@pytest.mark.parametrize("eps,ms", [(0.3, 5), (0.7, 5), (1.0, 10)])
def test_dbscan_noise_equals_brute_force(spark, eps, ms):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 1, (300, 3)), rng.normal(0, 0.05, (150, 3)) + 2.0,  # dense blob
                   np.repeat([[1.5, -1.5, 0.5]], 40, axis=0),                      # identical points
                   rng.uniform(-6, 6, (20, 3))])
    rows = [(i, *map(float, x)) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r["id"]: r["is_noise"] for r in O.dbscan_noise(df, ["id"], ["a", "b", "c"], eps, ms).collect()}
    exp = _brute_noise(X, eps, ms)
    assert [got[i] for i in range(len(X))] == list(exp)


def test_isolation_forest_ranks_planted_outliers(spark):
    rng = np.random.default_rng(11)
    X = np.vstack([rng.normal(0, 1, (1000, 2)), [[8, 8], [-9, 7], [10, -10]]])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(X)], "id long, a double, b double")
    forest = O.fit_isolation_forest(df, ["a", "b"], "id", n_trees=50, max_samples=128, seed=1)
    scored = O.score_isolation_forest(df, forest, ["a", "b"])
    top = [r["id"] for r in scored.orderBy(F.desc("iforest_score")).limit(3).collect()]
    assert set(top) == {1000, 1001, 1002}
    rates = {r["contamination"]: r for r in O.contamination_rates(scored, "iforest_score").collect()}
    assert len(rates) == 6 and [c for c, r in rates.items() if r["selected"]] == [0.03 if rates[0.03]["rate"] <= 0.03 else 0.02]


def test_saved_detector_against_walking_its_trees(spark, workdir):
    """Scores of a loaded forest equal a walk through its stored nodes, row by row; nodes split their sample."""
    import math
    import os

    import numpy as np
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(300, 3)), np.zeros((40, 3)), [[9.0, 9, 9]]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    at = os.path.join(workdir, "detector")
    O.save_forest(O.fit_isolation_forest(df, ["a", "b", "c"], "id", n_trees=20, max_samples=64, seed=3), ["a", "b", "c"], at)
    forest, cols = O.load_forest(spark, at)
    assert cols == ["a", "b", "c"]
    trees = forest.collect()
    assert len(trees) == 20 and all(t["n_sample"] == 64 and t["size"][0] == 64 for t in trees)

    def unsuccessful(n):
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    def depth(t, row):
        node, steps = 0, 0
        while t["feat"][node] >= 0:
            assert t["size"][node] == t["size"][t["left"][node]] + t["size"][t["right"][node]]
            node = t["left"][node] if row[t["feat"][node]] < t["thr"][node] else t["right"][node]
            steps += 1
        assert steps <= 6
        return steps + unsuccessful(t["size"][node])

    for r in O.score_isolation_forest(df, forest, cols).collect():
        want = 2 ** (-np.mean([depth(t, x[r["id"]]) for t in trees]) / unsuccessful(64))
        assert abs(r["iforest_score"] - want) < 1e-9


def test_experiment_without_points_is_a_mismatch(spark):
    from netscope.operators.series import PCTL_NAMES, compare_summaries
    stats = ["mean", "median", "min", "max", "std", *PCTL_NAMES]
    exp = spark.createDataFrame([("a", 1, *[2.0] * 4, 0.0, *[2.0] * 4), ("b", 3, *[1.0] * 9), ("c", 0, *[None] * 9)],
                                "k string, tput_n long, " + ", ".join(f"tput_{s} double" for s in stats))
    r = compare_summaries(exp, spark.createDataFrame([("a", 2.0)], "k string, value double"), "k").first()
    assert (r["n_experiments"], r["n_count_mismatch"], r["max_diff_mean"]) == (3, 1, 0.0)


def test_orders_and_bounds_of_profiles(spark):
    from netscope.operators import profile as P
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in P.value_counts(df, "x").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert [r["d"] for r in P.count_by(df, F.col("x"), "d").where("d is not null").collect()] == ["a", "b", "c"]
    wide = spark.range(P.MAX_PIVOT + 1).select(F.lit("r").alias("r"), "id")
    with pytest.raises(ValueError, match="more than"):
        P.crosstab(wide, "r", "id")


def test_forest_samples_are_exact_and_spread(spark):
    """90 % identical rows: every tree still draws exactly 256 rows, and not the same ones."""
    df = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, F.rand(1)).otherwise(0.0).alias("a"))
    got = O.forest_samples(df, ["a"], ["id"], 40_000, 20, 256, 7).groupBy("tree").agg(
        F.count("*").alias("n"), F.avg((F.col("a") == 0).cast("int")).alias("same")).collect()
    assert len(got) == 20 and all(r["n"] == 256 for r in got)
    assert all(0.8 < r["same"] < 0.98 for r in got)


def test_forest_threshold_never_vanishes(spark):
    """At 1e12 rows the share is 7.7e-8: the threshold at full hash width still lets that share through."""
    share = 3 * 256 * 100 / 1e12
    df = spark.range(1).select(O._below(F.lit(-2 ** 63), share).alias("lowest"), O._below(F.lit(0), share).alias("middle"))
    assert df.first().asDict() == {"lowest": True, "middle": False}
    n = spark.range(2_000_000).where(O._below(F.xxhash64("id"), 0.001)).count()
    assert 1700 < n < 2300
    with pytest.raises(ValueError):
        O.fit_isolation_forest(spark.range(0).withColumn("a", F.lit(1.0)), ["a"], "id")


def test_slo_tier_boundaries_and_missing(spark):
    rows = [(75.0, 150.0, 0.25), (74.9, 150.0, 0.25), (150.0, 100.0, 1.0), (225.0, 50.0, 2.0),
            (225.1, 50.0, 2.0), (None, 100.0, 1.0), (float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "d double, t double, l double")
    from netscope.functions.exprs import finite_or_null
    t = df.select(slo_tier(finite_or_null("d"), "t", "l").alias("tier")).collect()
    assert [r["tier"] for r in t] == [2, 3, 2, 1, 0, None, None]
    pc = df.limit(1).select(performance_class(F.lit(None).cast("double"), F.lit(None).cast("double"),
                                              F.lit(None).cast("double"), F.lit(None).cast("double")).alias("c"))
    assert pc.first()["c"] == "Poor"
    plan = df.select(slo_tier("d", "t", "l"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_constant_column_and_rare_classes(spark):
    df = spark.createDataFrame([(1.0, 5.0, "a"), (2.0, 5.0, "a"), (3.0, 5.0, "b")], "x double, c double, k string")
    corr = P.correlation_pairs(df, ["x", "c"]).first()
    assert corr["corr"] is None
    z = O.zscore(df, ["c"]).select("z_c").collect()
    assert all(r["z_c"] == 0.0 for r in z)
    from netscope.operators.labels import merge_rare_classes
    m = sorted(r["k"] for r in merge_rare_classes(df, "k").collect())
    assert m == ["Good", "a", "a"]
    empty = df.where("x > 100")
    s = P.numeric_summary(empty, ["x"]).first()
    assert s["median"] is None


def test_histogram_and_report_totals(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    h = P.histogram(ev, "value", 30).collect()
    assert len(h) == 30 and sum(r["count"] for r in h) == ev.count()
    from netscope.operators.metrics import classification_report
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    rep = {r["label"]: r for r in classification_report(df, "y", "p").collect()}
    assert rep["c"]["precision"] == 0.0 and rep["accuracy"]["f1"] == 0.5
    assert sum(rep[k]["support"] for k in ("a", "b", "c")) == 4


def test_splits_and_fingerprint(spark):
    from netscope.operators.lineage import fingerprint
    from netscope.operators.sampling import hash_split, sample_exact
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = hash_split(ev, "event_id").select("event_id", "split")
    b = hash_split(ev.repartition(7), "event_id").select("event_id", "split")
    assert sorted(a.collect()) == sorted(b.collect())
    frac = a.where("split = 'train'").count() / ev.count()
    assert 0.75 < frac < 0.85
    assert sample_exact(ev, 100, "event_id").count() == 100
    f1 = fingerprint(ev).first()
    f2 = fingerprint(ev.orderBy(F.desc("value")).repartition(5)).first()
    assert f1 == f2


def test_registered_fingerprint_covers_every_column(spark, tmp_path):
    from netscope.plans.registry import load_all
    whole = load_all()[0]["table_fingerprint_all"]
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(50) for t in ("lineitem", "events")}
    runs = iter(range(100))

    def marks(**changed):
        sf = f"{tmp_path}/{next(runs)}"
        for t, df in {**tables, **changed}.items():
            df.write.parquet(f"{sf}/{t}.parquet")
        return {r["table_name"]: (r["n_rows"], r["content_hash"], r["schema_hash"]) for r in whole(spark, sf).collect()}

    tables = {t: spark.createDataFrame(df.collect(), df.schema) for t, df in tables.items()}
    base = marks()
    assert {t: n for t, (n, _, _) in base.items()} == {"lineitem": 50, "events": 50}
    assert marks(events=tables["events"].repartition(3)) == base
    for t, df in tables.items():
        key = F.struct(*df.columns) == df.agg(F.max(F.struct(*df.columns)).alias("k")).scalar()
        for c in df.columns:
            got = marks(**{t: df.withColumn(c, F.when(~key, F.col(c)))})
            assert got[t][1] != base[t][1] and got[t][2] == base[t][2], c
        renamed = marks(**{t: df.withColumnRenamed(df.columns[-1], "other")})
        assert renamed[t][1] == base[t][1] and renamed[t][2] != base[t][2]


def test_lag_plan_has_no_single_partition(spark):
    s = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").alias("exp_id"), "ts", "value", "event_id")
    plan = S.supervised_lags(s, ["exp_id"], "ts", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


class _Trained(Exception):
    pass


@pytest.mark.parametrize("name, params", [
    ("rf_throughput", dict(numTrees=300, maxDepth=30)), ("gbt_latency", dict(maxIter=200, stepSize=0.05, maxDepth=5)),
    ("forecast_preview", dict(numTrees=300, maxDepth=30)), ("rf_performance_class", dict(numTrees=200, maxDepth=30)),
    ("rf_slo_tier", dict(numTrees=400, maxDepth=30)), ("rf_provider", dict(numTrees=200, maxDepth=30)),
    ("feature_importance", dict(numTrees=200, maxDepth=30))])
def test_registered_models_are_whole(spark, monkeypatch, name, params):
    """The estimator that each query trains (it isn't trained here)."""
    from pyspark.ml import Pipeline
    from netscope.plans.registry import load_all

    def fit(self, df):
        raise _Trained(self.getStages()[-1])

    query = load_all()[0][name]
    monkeypatch.setattr(Pipeline, "fit", fit)
    with pytest.raises(_Trained) as caught:
        query(spark, SF_SMALL)
    est = caught.value.args[0]
    assert {k: est.getOrDefault(k) for k in params} == params and est.getSeed() == 42
    assert est.getFeatureSubsetStrategy() == ("sqrt" if "Classifier" in type(est).__name__ else "all")
    assert est.getMinInstancesPerNode() == 1 and est.getSubsamplingRate() == 1.0


def test_model_roundtrip(spark, workdir):
    from netscope.operators import models as Mo
    rng = np.random.default_rng(5)
    rows = [(i, float(x), float(2 * x + rng.normal(0, 0.1)), "ab"[i % 2]) for i, x in enumerate(rng.uniform(0, 10, 400))]
    df = spark.createDataFrame(rows, "id long, x double, y double, k string")
    model, pred, m = Mo.regression_task(df, "y", ["x"], ["k"], ["id"], "rf", dict(numTrees=10, maxDepth=5, seed=1))
    assert m.first()["r2"] > 0.9
    Mo.save_model(model, f"{workdir}/m")
    again = Mo.load_model(f"{workdir}/m").transform(df).select("id", "prediction").collect()
    first = model.transform(df).select("id", "prediction").collect()
    assert sorted(again) == sorted(first)


@pytest.mark.parametrize("window", [20_000, 15])
def test_exact_quantiles_match_spark_percentile(spark, monkeypatch, window):
    """Groups of 1 to 20,000 values with ties; a window of 15 values forces repeated narrowing."""
    from netscope.operators import quantiles
    from netscope.operators.quantiles import exact_quantiles
    monkeypatch.setattr(quantiles, "WINDOW", window)
    monkeypatch.setattr(quantiles, "PARTS", 8 if window < 100 else 512)
    rng = np.random.default_rng(1)
    rows = []
    for g, n in enumerate([1, 2, 5, 300, 5000, 20000]):
        vals = rng.integers(0, 50, n).astype(float) if g == 4 else rng.normal(0, 1, n)  # g=4: heavy ties
        rows += [(g, float(v)) for v in vals]
    rows += [(9, None)] * 3
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs, accuracy=100, max_exact=100).collect()}  # > 100: brackets
    ref = {r["g"]: r["q"] for r in
           df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    for g, q in ref.items():
        assert [got[g][f"q{i}"] for i in range(len(probs))] == (list(q) if q else [None] * len(probs))
    assert got[9]["_n"] == 0


@pytest.mark.parametrize("accuracy,window", [(None, None), (300, 50), (200, 4)])
def test_wide_quantiles_equal_spark_percentile(spark, accuracy, window):
    """All columns in each scan; a small window forces several turns of narrowing."""
    from netscope.operators import quantiles as Q
    rng = np.random.default_rng(8)
    n = 6000
    cols = {"a": rng.normal(0, 1, n), "ties": rng.integers(0, 3, n).astype(float), "one": np.full(n, 7.25),
            "heavy": np.where(rng.random(n) < 0.6, 1.5, rng.exponential(1, n)), "big": rng.normal(0, 1e300, n),
            "inf": np.where(rng.random(n) < 0.2, np.inf, rng.normal(0, 1, n))}
    rows = [tuple(None if (i + k) % 17 == 0 else float(v[i]) for k, v in enumerate(cols.values())) + (None,) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", none double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = Q.wide_quantiles(df, [*cols, "none"], probs, accuracy, window)
    for c in cols:
        want = df.agg(F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias("q"), F.count(c).alias("n")).first()
        assert got[c] == (want["n"], list(want["q"]))
    assert got["none"] == (0, [None] * len(probs))
    assert Q.wide_quantiles(df.limit(0), ["a"], [0.5]) == {"a": (0, [None])}


def test_wide_quantiles_never_stack_the_input(spark, monkeypatch):
    """Each scan is one aggregate row over the input: no Generate, no row leaves a task."""
    from netscope.operators import clean, profile, quantiles
    monkeypatch.setattr(quantiles, "WINDOW", 100)
    frame, plans = type(spark.range(1)), []
    select = frame.selectExpr
    monkeypatch.setattr(frame, "selectExpr", lambda self, *e: (out := select(self, *e), plans.append(
        out._jdf.queryExecution().executedPlan().toString()))[0])
    df = spark.range(5000).selectExpr("id", "id % 7 as a", "cast(id as double) as b")
    assert clean.impute_median(df, ["a", "b"]).count() == 5000
    scans = [p for p in plans if "percentile" in p]
    assert len(scans) >= 2 and not any("Generate" in p or "Expand" in p or "hashpartitioning" in p for p in scans)
    assert profile.describe(df, ["a", "b"]).count() == 2


def test_pr_auc_equals_brute_force(spark):
    """Average precision over distinct scores, whatever the ranges; ties count together."""
    from netscope.operators import metrics as M
    rng = np.random.default_rng(4)
    for scores in (rng.integers(0, 12, 800).astype(float), rng.normal(0, 1, 800), np.zeros(50)):
        y = rng.integers(0, 2, len(scores))
        df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, scores)] + [(None, 1.0), (1, None)], "y int, s double")
        want, cut = 0.0, 0
        for v in sorted(set(scores), reverse=True):
            tp, n = y[scores >= v].sum(), (scores >= v).sum()
            want += (tp - cut) * tp / n
            cut = tp
        r = M.pr_auc(df.repartition(5), "y", "s").first()
        assert (r["positives"], r["n"]) == (y.sum(), len(y)) and abs(r["pr_auc"] - want / y.sum()) < 1e-6
        curve = M.pr_curve(df, "y", "s").orderBy(F.desc("score")).collect()
        assert curve[-1]["recall"] == 1.0 and curve[-1]["n"] == len(y) and len(curve) == len(set(scores))
    empty = M.pr_auc(df.limit(0), "y", "s").first()
    assert (empty["positives"], empty["n"], empty["pr_auc"]) == (0, 0, None)


def test_boosting_loss_falls_every_round(spark):
    from netscope.operators import models as Mo
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 10, 500)
    df = spark.createDataFrame([(i, float(a), float(np.sin(a) * 5 + 6 + rng.normal(0, 0.2))) for i, a in enumerate(x)], "id long, x double, y double")
    model, _, m = Mo.regression_task(df, "y", ["x"], [], ["id"], "gbt", dict(maxIter=15, stepSize=0.3, maxDepth=3, seed=1))
    ready = model.stages[0].transform(df)
    for st in model.stages[1:-1]:
        ready = st.transform(ready)
    loss = model.stages[-1].evaluateEachIteration(ready.withColumn("y", F.col("y")), "squared")
    assert len(loss) == 15 and all(b < a for a, b in zip(loss, loss[1:])) and m.first()["r2"] > 0.9


def test_path_lengths_equal_a_walk_of_each_tree():
    import numpy as np

    from netscope.operators import outliers as O
    rng = np.random.default_rng(2)
    trees = [O._grow_tree(rng.normal(size=(64, 3)).round(1), rng, 6) for _ in range(7)] + [O._grow_tree(np.ones((4, 3)), rng, 6)]
    x = rng.normal(size=(50, 3))
    x[4, 1] = np.nan

    def walk(row, tree):
        feat, thr, left, right, size = tree
        node, depth = 0, 0.0
        while feat[node] >= 0:
            node = left[node] if row[feat[node]] < thr[node] else right[node]
            depth += 1
        return depth + O._c_factor(size[node])

    want = [sum(walk(r, t) for t in trees) / len(trees) for r in x]
    assert np.allclose(O._path_lengths(x, O._joined(trees)), want, rtol=1e-12)


def test_quantiles_of_repeated_values_need_no_bracket(spark, monkeypatch):
    """Many rows of few values are counted where they are read; few groups' figures are broadcast to their rows."""
    from netscope.operators import profile as P
    from netscope.operators import quantiles as Q
    monkeypatch.setattr(Q, "_bracket_quantiles", lambda *a: pytest.fail("rows were bracketed"))
    df = spark.range(30_000).selectExpr("id % 3 AS g", "CASE WHEN id % 7 > 0 THEN CAST(id % 40 AS DOUBLE) END AS x")
    got = {r["g"]: (r["_n"], r["a"], r["b"]) for r in Q.exact_quantiles(
        df, ["g"], "x", [0.25, 0.9], ["a", "b"], accuracy=100, max_exact=100).collect()}
    want = {r["g"]: (r["n"], *r["q"]) for r in df.groupBy("g").agg(
        F.count("x").alias("n"), F.expr("percentile(x, array(0.25D, 0.9D))").alias("q")).collect()}
    assert got == want
    plan = P.iqr_outlier_flags(df, "g", "x")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
