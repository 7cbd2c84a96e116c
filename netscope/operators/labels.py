"""Label-level operators: rare-class merging, class weights, SLO compliance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netscope.functions.exprs import region_pair
from netscope.functions.labels import slo_tier


def merge_rare_classes(df: DataFrame, label: str, min_count: int = 2, into: str = "Good") -> DataFrame:
    """Classes with fewer than ``min_count`` rows are relabelled ``into``.

    The class table is one row per class (an aggregate); joining it back is an
    ordinary equi-join that AQE broadcasts when it is small.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cls_n"))
    j = df.join(counts, label, "left")
    return j.withColumn(label, F.when(F.col("_cls_n") < min_count, F.lit(into)).otherwise(F.col(label))).drop("_cls_n")


def stratify_ok(df: DataFrame, label: str) -> bool:
    """Stratify only with >= 2 classes each holding >= 2 rows (one small aggregate)."""
    r = df.groupBy(label).count().agg(F.count(F.lit(1)).alias("k"), F.min("count").alias("m")).first()
    return bool(r and r["k"] >= 2 and r["m"] >= 2)


def class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return counts.select(label, "n_c", (tot.select("n").scalar() /
                                        (tot.select("k").scalar() * F.col("n_c"))).alias(weight_col))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    w = class_weights(df, label, weight_col).drop("n_c")
    return df.join(w, label, "left")


def slo_by_region_pair(df: DataFrame, delay_limit: float = 150.0, tput_limit: float = 100.0,
                       loss_limit: float = 1.0, decimals: int = 6) -> DataFrame:
    """I4: per region pair, experiments, labelled ones, mean tier and SLA compliance (tier >= 2)."""
    t = df.select(region_pair("region_snd", "region_rcv").alias("region_pair"),
                  slo_tier("delay_mean", "tput_mean", "loss_mean", delay_limit, tput_limit, loss_limit).alias("tier"))
    return t.groupBy("region_pair").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("tier").alias("n_labelled"),
        F.round(F.avg("tier"), decimals).alias("mean_tier"),
        F.round(F.avg(F.when(F.col("tier").isNotNull(), (F.col("tier") >= 2).cast("double"))), decimals)
        .alias("compliance_rate"),
        F.sum(F.when(F.col("tier") == 3, 1).otherwise(0)).cast("bigint").alias("n_tier3"),
    )
