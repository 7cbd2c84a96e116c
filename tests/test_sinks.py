"""Sinks, listings and small helpers."""

import os
import time

from pyspark.sql import functions as F


def test_latest_file_and_clean_and_save(spark, workdir):
    from netscope.sinks import clean_and_save, latest_file
    for i, name in enumerate(["a.csv", "b.csv"]):
        p = os.path.join(workdir, "in", name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("x\n1\n")
        os.utime(p, (time.time() + i * 10, time.time() + i * 10))
    assert latest_file(spark, os.path.join(workdir, "in"), "*.csv").endswith("b.csv")
    df = spark.range(1500).select(F.col("id"), (F.col("id") % 7).alias("k"))
    out = clean_and_save(df, os.path.join(workdir, "out"), sample_n=1000, key="id")
    assert spark.read.parquet(out["parquet"]).count() == 1500
    assert spark.read.option("header", "true").csv(out["sample"]).count() == 1000


def test_task_features_and_basic_clean(spark):
    from netscope.operators.clean import basic_clean
    from netscope.operators.models import task_features
    df = spark.createDataFrame([("TCP", "12.5", 1433498540, float("inf"))],
                               "proto string, tput_mean_mbps string, start bigint, delay_mean double")
    c = basic_clean(df).first()
    assert c["proto"] == "tcp" and c["tput_mean"] == 12.5 and c["delay_mean"] is None
    assert c["hour"] == 10 and c["dow"] == 4  # 2015-06-05 was a Friday (Monday = 0)
    num, cat = task_features(df.withColumn("provider", F.lit("AWS")), "throughput")
    assert num == ["delay_mean"] and cat == ["provider", "proto"]


def test_run_log(spark, workdir):
    from netscope.operators.lineage import log_run
    p = os.path.join(workdir, "runs")
    log_run(spark, p, "r1", "metric", {"rmse": 1.5, "mae": 1.0})
    log_run(spark, p, "r1", "param", {"trees": 300})
    assert spark.read.parquet(p).count() == 3


def test_psi_no_drift_on_identical_windows(spark):
    from netscope.operators.drift import psi
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    r = psi(df, df, "v").first()
    assert r["psi"] == 0.0 and r["drifted"] is False


def test_psi_of_awkward_groups(spark):
    """Groups without current rows, without values, and rows of neither side; two sides counted in one scan."""
    from netscope.operators.drift import psi_of_sides
    rows = ([("a", float(i), True) for i in range(20)] + [("a", float(i + 100), False) for i in range(5)]
            + [("a", 3.0, None), ("a", None, False)] + [("b", float(i), True) for i in range(10)]
            + [("c", None, True), ("d", 1.0, False)])
    df = spark.createDataFrame(rows, "k string, v double, side boolean")
    got = {r["k"]: r for r in psi_of_sides(df, "v", "side", ["k"]).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"]["n_ref"], got["a"]["n_cur"], got["a"]["drifted"]) == (20, 5, True)
    assert (got["b"]["n_ref"], got["b"]["n_cur"]) == (10, 0) and (got["c"]["n_ref"], got["c"]["psi"]) == (0, 0.0)
    assert psi_of_sides(df.limit(0), "v", "side", ["k"]).count() == 0


def test_insights_ties_and_empty(spark):
    from netscope.operators.report import insights
    rows = [("q", "tcp", "r2", "x"), ("p", "udp", "r1", "y"), (None, "udp", None, "x"), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "provider string, proto string, region_snd string, tool string")
    assert tuple(insights(df).first()) == ("p", 50.0, "udp", "r1", "x,y")
    assert tuple(insights(df.limit(0)).first()) == (None, None, None, None, "")
    plan = insights(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and "Join" not in plan and "subquery" not in plan
