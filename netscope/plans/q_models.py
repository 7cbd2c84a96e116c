"""Registered model queries (rows-only checks: tree ensembles have no SQL oracle).

Every query trains the reference's model of its task (``operators.models.PRESETS``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.functions.labels import performance_class, slo_tier
from netscope.operators import models as Mo
from netscope.operators import series as S
from netscope.operators.forest import ForestRegressor
from netscope.plans.catalog import SHIP_CLASS, SHIP_SLO
from netscope.plans.registry import query
from netscope.plans.standins import series, ship
from netscope.session import cut_lineage

NUM = ["delay_mean", "loss_mean", "granularity_snd", "granularity_rcv", "target_bwd"]
CAT = ["provider", "proto", "region_snd", "region_rcv"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "delay_mean", "tput_mean", "target_bwd"]


@query("rf_throughput")
def q_rf_throughput(spark, sf):
    _, _, m = Mo.regression_task(ship(spark, sf), "tput_mean", NUM, CAT, KEY, "rf",
                                 Mo.PRESETS["throughput_rf"])
    return m


@query("gbt_latency")
def q_gbt_latency(spark, sf):
    """M3 on the days between order and shipping, whichever came first: a latency is never negative, so no row is lost."""
    num = ["tput_mean", "loss_mean", "granularity_snd", "granularity_rcv", "target_bwd"]
    s = ship(spark, sf).withColumn("delay_mean", F.abs("delay_mean"))
    _, _, m = Mo.regression_task(s, "delay_mean", num, CAT, KEY, "gbt", Mo.PRESETS["latency_gbt"])
    return m


def _forecast_split(spark, sf):
    """M4's rows: 12 lags per series (one metric each), chronological 80/20 split per series."""
    lagged = S.supervised_lags(series(spark, sf), ["exp_id", "metric"], "ts", "event_id", lags=12, horizon=1)
    return cut_lineage(S.chrono_split(lagged, ["exp_id", "metric"], "ts", "event_id", 0.8))


@query("forecast_rows", sql="""
WITH l AS (SELECT exp_id, metric, event_id, ts, LEAD(value) OVER w AS y, LAG(value, 12) OVER w AS last
           FROM series WINDOW w AS (PARTITION BY exp_id, metric ORDER BY ts, event_id)),
r AS (SELECT *, ROW_NUMBER() OVER w AS i, COUNT(*) OVER (PARTITION BY exp_id, metric) AS n
      FROM l WHERE y IS NOT NULL AND last IS NOT NULL WINDOW w AS (PARTITION BY exp_id, metric ORDER BY ts, event_id))
SELECT exp_id, metric, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, ROUND(y, 6) AS y_true
FROM r WHERE i > FLOOR(n * 0.8)""", views=("series",))
def q_forecast_rows(spark, sf):
    """The rows that the forecaster is tested on, with what it should have predicted."""
    return _forecast_split(spark, sf).where(F.col("split") == "test").select(
        "exp_id", "metric", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.round("y", 6).alias("y_true"))


@query("forecast_preview")
def q_forecast_preview(spark, sf):
    """M4: pooled forecaster over ``_forecast_split``."""
    split = _forecast_split(spark, sf)
    lags = [f"lag_{i}" for i in range(1, 13)]
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    pipe = Pipeline(stages=[VectorAssembler(inputCols=lags, outputCol="features"),
                            ForestRegressor(labelCol="y", featuresCol="features", featureSubsetStrategy="all",
                                                  **Mo.PRESETS["forecast_rf"])])
    model = pipe.fit(split.where(F.col("split") == "train"))
    pred = model.transform(split.where(F.col("split") == "test"))
    return pred.select("exp_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                       F.col("y").alias("y_true"), F.round("prediction", 6).alias("y_pred"))


def _ship_labels(spark, sf):
    s = ship(spark, sf)
    return s.withColumns({
        "performance_class": performance_class("delay_mean", "target_bwd", "granularity_snd", "granularity_rcv",
                                               **SHIP_CLASS),
        "slo_tier": slo_tier("delay_mean", "tput_mean", "loss_mean", **SHIP_SLO),
    })


@query("rf_performance_class")
def q_rf_performance_class(spark, sf):
    _, _, rep = Mo.classification_task(_ship_labels(spark, sf), "performance_class", NUM + ["tput_mean"], CAT, KEY,
                                       Mo.PRESETS["class_rf"], rare_into="Good")
    return rep


@query("rf_slo_tier")
def q_rf_slo_tier(spark, sf):
    _, _, rep = Mo.classification_task(_ship_labels(spark, sf), "slo_tier", NUM + ["tput_mean"], CAT, KEY,
                                       Mo.PRESETS["tier_rf"])
    return rep


@query("rf_provider")
def q_rf_provider(spark, sf):
    cat = ["proto", "region_snd", "region_rcv", "size_snd", "size_rcv"]
    _, _, rep = Mo.classification_task(ship(spark, sf), "provider", NUM + ["tput_mean"], cat, KEY,
                                       Mo.PRESETS["class_rf"])
    return rep


@query("feature_importance")
def q_feature_importance(spark, sf):
    num = NUM + ["tput_mean"]
    model, _, _ = Mo.classification_task(_ship_labels(spark, sf), "performance_class", num, CAT, KEY,
                                         Mo.PRESETS["class_rf"], rare_into="Good")
    return Mo.feature_importance(model, spark, 10)
