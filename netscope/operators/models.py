"""Feature preparation and model tasks on Spark ML.

One ``Pipeline`` holds imputation, encoding, scaling and the estimator, so the
saved model carries its scaler (the reference fitted it outside).  Forests
are grown by ``operators.forest``, boosted trees by ``operators.boosting``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netscope.functions.exprs import finite_or_null
from netscope.operators.boosting import BoostedRegressor
from netscope.operators.forest import ForestClassifier, ForestRegressor
from netscope.operators.labels import with_class_weights
from netscope.operators.metrics import classification_report, regression_metrics
from netscope.operators.quantiles import exact_quantiles_long
from netscope.operators.sampling import hash_split, stratified_split
from netscope.session import cut_lineage, cut_to_table

# The reference's task presets (trees, depth, rates, seed); its unlimited depth is 30 levels here.
PRESETS = {
    "throughput_rf": dict(numTrees=300, maxDepth=30, seed=42),
    "latency_gbt": dict(maxIter=200, stepSize=0.05, maxDepth=5, seed=42),
    "forecast_rf": dict(numTrees=300, maxDepth=30, seed=42),
    "class_rf": dict(numTrees=200, maxDepth=30, seed=42),
    "tier_rf": dict(numTrees=400, maxDepth=30, seed=42),
}


# The reference's feature lists per task (absent columns are skipped).
TASK_FEATURES = {
    "throughput": {"cat": ["provider", "region_pair", "vm_size_pair", "proto"],
                   "num": ["delay_mean", "loss_mean", "hour", "dow"]},
    "throughput_v2": {"cat": ["provider_pair", "region_pair", "vm_size_pair", "proto"],
                      "num": ["delay_mean", "loss_mean", "jitter_mean", "hour", "dow"]},
    "latency": {"num": ["duration_s", "granularity_snd", "granularity_rcv", "target_bwd"],
                "cat": ["provider", "proto", "region_snd", "region_rcv", "size_snd", "size_rcv", "port"]},
    "performance_class": {"num": ["duration_s", "delay_mean", "granularity_snd", "granularity_rcv", "target_bwd"],
                          "cat": ["provider", "proto", "size_snd", "size_rcv", "region_snd", "region_rcv", "port"]},
    "slo_tier": {"cat": ["provider_pair", "region_pair", "vm_size_pair", "proto"],
                 "num": ["tput_mean", "delay_mean", "loss_mean", "jitter_mean", "hour", "dow"]},
    "anomaly": {"num": ["duration_s", "granularity_snd", "granularity_rcv", "target_bwd", "tput_mean", "tput_pctl95",
                        "tput_pctl5", "delay_mean", "loss_mean", "tput_n", "delay_n", "loss_n"]},
    "config": {"cat": ["provider", "region", "az", "vm_size", "l4_protocol"],
               "num": ["cpu_pct", "mem_pct", "packet_loss", "jitter_ms"]},
}


def task_features(df: DataFrame, task: str) -> tuple[list[str], list[str]]:
    """M1g / D6: the task's (numeric, categorical) lists restricted to present columns."""
    spec = TASK_FEATURES[task]
    return ([c for c in spec.get("num", []) if c in df.columns], [c for c in spec.get("cat", []) if c in df.columns])


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def preprocessor(train: DataFrame, num: Sequence[str], cat: Sequence[str], impute: bool = True,
                 scale: bool = True) -> tuple[list, list[str]]:
    """M1a/M1b stages fitted on ``train``, and the numeric columns that they use.

    Numeric columns without any value in ``train`` are dropped; the others get their exact median and are
    scaled by the population standard deviation.  Categories get their most frequent value (smallest on
    ties), then string index (values unseen in ``train`` in a bucket of their own) and one-hot.  All
    figures stand in the first stage's statement, so they are saved with the pipeline.
    """
    num, cat = list(num), list(cat)
    if num:
        have = train.agg(*[F.count(c).alias(c) for c in num]).first()
        num = [c for c in num if have[c]]
    exprs = {}
    if num:
        median = {}
        if impute:
            median = {r["column"]: r["m"] for r in exact_quantiles_long(train, num, [0.5], ["m"]).collect()}
        filled = {c: f"COALESCE(`{c}`, {median[c]!r}D)" if c in median else f"`{c}`" for c in num}
        exprs = {f"{c}__num": f"CAST({filled[c]} AS DOUBLE)" for c in num}
        if scale:
            st = train.agg(*[F.struct(F.avg(F.expr(filled[c])), F.stddev_pop(F.expr(filled[c]))).alias(c) for c in num]).first()
            exprs = {f"{c}__num": f"({filled[c]} - ({st[c][0]!r}D)) / {(st[c][1] or 1.0)!r}D" for c in num}
    for c in cat:
        top = train.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), F.asc(c)).first() if impute else None
        exprs[f"{c}__cat"] = f"COALESCE(`{c}`, {_literal(top[c])})" if top else f"`{c}`"
    stages = [SQLTransformer(statement="SELECT *, " + ", ".join(f"{e} AS `{n}`" for n, e in exprs.items()) + " FROM __THIS__")]
    parts = [f"{c}__num" for c in num]
    if cat:
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in cat], outputCols=[f"{c}__idx" for c in cat],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cat], outputCols=[f"{c}__ohe" for c in cat],
                                    dropLast=False, handleInvalid="error"))
        parts += [f"{c}__ohe" for c in cat]
    # without imputation a missing number stays NaN, which trees accept
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="error" if impute else "keep"))
    return stages, num


def encoded_names(model: PipelineModel) -> list[str]:
    """M1e: feature names in vector order: numeric names, then ``col_value`` per category and
    ``col___unknown`` for values not seen in training.  They must be as many as the model has features."""
    names = []
    for st in model.stages:
        kind = type(st).__name__
        if kind == "VectorAssembler":
            names += [c.removesuffix("__num") for c in st.getInputCols() if c.endswith("__num")]
    for st in model.stages:
        if type(st).__name__ == "StringIndexerModel" and st.isSet("inputCols"):
            for c, labels in zip(st.getInputCols(), st.labelsArray):
                c = c.removesuffix("__cat")
                names += [f"{c}_{v}" for v in labels] + [f"{c}___unknown"]
    if len(names) != model.stages[-1].numFeatures:
        raise ValueError(f"{len(names)} names for {model.stages[-1].numFeatures} features")
    return names


def _clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite_or_null(F.col(c).cast("double")) for c in cols})


def regression_task(df: DataFrame, target: str, num: Sequence[str], cat: Sequence[str], key_cols: Sequence[str],
                    model: str = "rf", params: dict | None = None, seed: int = 42):
    """M2/M3: clean (finite, non-negative target), 80/20 hash split, fit, evaluate.
    Returns (fitted pipeline, test predictions, metrics row)."""
    d = _clean_numeric(df, [*num, target]).where(F.col(target).isNotNull() & (F.col(target) >= 0))
    d = d.withColumn("_key", F.xxhash64(*[F.col(c) for c in key_cols]))
    # the estimators make several passes (imputer, indexers, scaler, one per tree level):
    # materialise the prepared input once in the shared checkpoint dir
    d = cut_to_table(hash_split(d, "_key", 80, seed).select(*num, *cat, target, "_key", "split"))
    p = dict(params or {})
    if model == "rf":
        p.setdefault("featureSubsetStrategy", "all")  # every feature at every split, as the reference's forest
    est = (ForestRegressor(labelCol=target, featuresCol="features", **p) if model == "rf"
           else BoostedRegressor(labelCol=target, featuresCol="features", **p))
    train = d.where(F.col("split") == "train")
    fitted = Pipeline(stages=preprocessor(train, num, cat)[0] + [est]).fit(train)
    pred = fitted.transform(d.where(F.col("split") == "test"))
    return fitted, pred, regression_metrics(pred, target, "prediction")


def classification_task(df: DataFrame, label: str, num: Sequence[str], cat: Sequence[str], key_cols: Sequence[str],
                        params: dict | None = None, seed: int = 42, balanced: bool = True,
                        rare_into: str | None = None, drop_label_inputs: Sequence[str] = ()):
    """M7/M8/M9: label NULLs dropped, stratified split (plain where a class has a single row), balanced
    class weights of the training rows, random forest, per-class report.

    ``rare_into`` merges classes of one row into that class; ``drop_label_inputs`` leaves out features
    from which the label is computed.
    """
    from netscope.operators.labels import merge_rare_classes, stratify_ok
    num, cat = ([c for c in cols if c not in drop_label_inputs] for cols in (num, cat))
    d = _clean_numeric(df, num).where(F.col(label).isNotNull())
    d = d.withColumn(label, F.col(label).cast("string"))
    if rare_into is not None:
        d = merge_rare_classes(d, label, into=rare_into)
    d = cut_lineage(d.withColumn("_key", F.xxhash64(*[F.col(c) for c in key_cols])).select(*num, *cat, label, "_key"))
    d = stratified_split(d, "_key", label, 80, seed) if stratify_ok(d, label) else hash_split(d, "_key", 80, seed)
    d = cut_lineage(d)
    train = d.where(F.col("split") == "train")
    if balanced:
        train = cut_lineage(with_class_weights(train, label, "_w"))
    lab_idx = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep", stringOrderType="alphabetAsc")
    est = ForestClassifier(labelCol="_label", featuresCol="features", weightCol="_w" if balanced else None,
                                 featureSubsetStrategy="sqrt", **dict(params or {}))
    # the preprocessor's figures take several passes and no order; the forest's bags follow the rows' order
    fitted = Pipeline(stages=[lab_idx] + preprocessor(cut_to_table(train), num, cat)[0] + [est]).fit(train)
    pred = fitted.transform(d.where(F.col("split") == "test"))
    labels = fitted.stages[0].labels
    lab_map = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(float(i)), F.lit(v))])
    pred = pred.withColumn("predicted", lab_map[F.col("prediction")])
    # the report reads the predictions in several branches: score the test split once
    scored = cut_lineage(pred.select(label, "predicted"))
    return fitted, pred, classification_report(scored, label, "predicted")


def feature_importance(model: PipelineModel, spark, k: int = 10) -> DataFrame:
    """M10 + T7: importance per encoded feature name, top-k (a vector of fixed length)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(encoded_names(model), imp, strict=True)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    """K8: persist the whole fitted pipeline (scaler included)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
