"""Evaluation metrics as plain aggregates over (y, y_hat) columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netscope.session import cut_lineage

EPS = 1e-8


def regression_metrics(df: DataFrame, y: str, p: str, decimals: int = 6) -> DataFrame:
    """MAE, RMSE, R^2, MAPE (|y|+eps and signed y+eps forms), NRMSE in one pass."""
    yc, pc = F.col(y), F.col(p)
    err = yc - pc
    base = df.where(yc.isNotNull() & pc.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("sse"),
        F.avg(yc).alias("ybar"),
        F.var_pop(yc).alias("yvar"),
        F.avg(F.abs(err / (F.abs(yc) + F.lit(EPS)))).alias("mape_frac"),
        F.avg(F.abs(err / (yc + F.lit(EPS)))).alias("mape_signed_frac"),
        F.avg(F.abs(yc)).alias("mean_abs_y"),
    )
    rmse = F.sqrt("mse")
    return base.select(
        "n",
        F.round("mae", decimals).alias("mae"),
        F.round(rmse, decimals).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("yvar") * F.col("n")), decimals).alias("r2"),
        F.round(F.col("mape_frac") * 100, decimals).alias("mape"),
        F.round(F.col("mape_signed_frac") * 100, decimals).alias("mape_signed"),
        F.round(rmse / (F.col("mean_abs_y") + F.lit(EPS)), decimals).alias("nrmse"),
    )


def _per_class(df: DataFrame, y: str, p: str) -> DataFrame:
    """Confusion-derived counts per class (union of true and predicted labels)."""
    t = df.select(F.col(y).cast("string").alias("y"), F.col(p).cast("string").alias("p"))
    conf = t.groupBy("y", "p").agg(F.count(F.lit(1)).alias("c"))  # k x k rows at most
    true_c = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("c").alias("support"))
    pred_c = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("pred"))
    tp = conf.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("c").alias("tp"))
    cls = true_c.join(pred_c, "cls", "full").join(tp, "cls", "left").na.fill(0, ["support", "pred", "tp"])
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    cls = cls.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                    F.lit(0.0))
    return cls.withColumn("f1", f1)


def classification_report(df: DataFrame, y: str, p: str, decimals: int = 6) -> DataFrame:
    """Rows per class plus ``macro avg``, ``weighted avg`` and ``accuracy``:
    (label, precision, recall, f1, support).  Zero divisions give 0."""
    cls = _per_class(df, y, p)
    per = cls.select(F.col("cls").alias("label"), "precision", "recall", "f1", F.col("support").cast("bigint"))
    tot = cls.agg(F.sum("support").alias("n"), F.sum("tp").alias("correct"))
    macro = cls.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    weighted = cls.agg(
        F.lit("weighted avg").alias("label"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"),
        F.sum("support").cast("bigint").alias("support"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     F.try_divide(F.col("correct").cast("double"), F.col("n")).alias("f1"),
                     F.col("n").cast("bigint").alias("support"))
    out = per.unionByName(macro).unionByName(weighted).unionByName(acc)
    return out.select("label", *[F.round(c, decimals).alias(c) for c in ("precision", "recall", "f1")], "support")


def classification_metrics(df: DataFrame, y: str, p: str, decimals: int = 6) -> DataFrame:
    """Accuracy, macro F1, weighted F1, balanced accuracy (mean recall)."""
    cls = _per_class(df, y, p)
    return cls.agg(
        F.try_divide(F.sum("tp").cast("double"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.sum("support").cast("bigint").alias("n"),
    ).select(*[F.round(c, decimals).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1", "balanced_accuracy")],
             "n")


def group_mean_prediction(df: DataFrame, keys, y: str, out: str = "y_pred") -> DataFrame:
    """Baseline predictor: the mean target of the row's group (an aggregate joined back)."""
    keys = list(keys)
    means = df.groupBy(*keys).agg(F.avg(y).alias(out))
    return df.join(means, keys, "left")


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down: ``score, tp, n, precision, recall`` of flagging
    all rows with that score or more.  ``label`` is 0/1; rows without label or score are left out.

    The global running counts need no single task: distinct scores are dealt out by ranges, every range's counts
    give the next ones their offset, and rows are added up inside their range.
    """
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    counts = df.where(y.isNotNull() & s.isNotNull()).groupBy(s.alias("score")).agg(F.sum(y).alias("p"), F.count(F.lit(1)).alias("c"))
    # written once, so that a range keeps its number
    ranged = cut_lineage(counts.repartitionByRange(F.desc("score")).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range").agg(F.sum("p").alias("_p"), F.sum("c").alias("_c"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sums.select("_range", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p0"),
                          F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0"))
    inside = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.join(offsets, "_range").select(
        "score", "p", (F.col("_p0") + F.sum("p").over(inside)).alias("tp"), (F.col("_c0") + F.sum("c").over(inside)).alias("n"))
    total = ranged.agg(F.sum("p")).scalar()
    return rows.select("score", "p", "tp", "n", (F.col("tp") / F.col("n")).alias("precision"),
                       F.try_divide(F.col("tp").cast("double"), total).alias("recall"))


def pr_auc(df: DataFrame, label: str, score: str, decimals: int = 6) -> DataFrame:
    """Area under the precision-recall curve as average precision (each score's precision weighted by the
    recall that it adds): ``positives, n, pr_auc``; NULL without positives."""
    return pr_curve(df, label, score).agg(
        F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("positives"), F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("n"),
        F.round(F.try_divide(F.sum(F.col("p") * F.col("precision")), F.sum("p")), decimals).alias("pr_auc"))
