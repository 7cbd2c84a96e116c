"""Profiling aggregates (value counts, cross-tabs, numeric summaries, correlations,
histograms, box statistics, data-quality figures).

Everything is a single aggregate pass or a grouping-sets pass; wide profiles
put all columns into one ``agg`` so the table is scanned once.  Small results
are turned into long form with ``stack``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MAX_PIVOT = 1000   # columns of a cross-tab whose values are read from the data


def _stack(df: DataFrame, names: Sequence[str], value_exprs: Sequence[Sequence[str]],
           out_cols: Sequence[str]) -> DataFrame:
    """Turn one wide row per group into one row per name (``stack``)."""
    n = len(names)
    args = []
    for name, vals in zip(names, value_exprs):
        args.append(f"'{name}'")
        args.extend(vals)
    expr = f"stack({n}, {', '.join(args)}) as ({', '.join(out_cols)})"
    return df.selectExpr(expr)


def _q(name: str) -> str:
    return f"`{name}`"


# ---------------------------------------------------------------- A1 value counts

def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-missing value, largest first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def value_counts_multi(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All dimensions in one grouping-sets pass -> (dimension, value, count)."""
    cols = list(cols)
    g = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    gs = g.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("count"), *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for c in cols:
        dim = F.when(F.col(f"_g_{c}") == 0, F.lit(c)).otherwise(dim)
        val = F.when(F.col(f"_g_{c}") == 0, F.col(c)).otherwise(val)
    return gs.select(dim.alias("dimension"), val.alias("value"), "count").where(F.col("value").isNotNull())


def value_share(counts: DataFrame, count_col: str = "count", decimals: int = 2) -> DataFrame:
    """Share of the total in %, the total coming from a scalar subquery."""
    total = counts.agg(F.sum(count_col).alias("_t"))
    return counts.withColumn("share_pct", F.round(F.col(count_col) * 100.0 / total.scalar(), decimals))


def top_k(counts: DataFrame, key: str, k: int, count_col: str = "count") -> DataFrame:
    """Top-k by count desc, ties by key asc."""
    return counts.orderBy(F.desc(count_col), F.asc(key)).limit(k)


def top_k_per_group(long_counts: DataFrame, group: str, key: str, k: int,
                    count_col: str = "count", salt_buckets: int = 64) -> DataFrame:
    """Top-k rows per group by count desc, key asc, with a ``rank`` column.

    Two rounds so that a group with very many keys is never ranked in one task:
    first the top-k inside (group, hash bucket of key), then the top-k among the
    at most ``salt_buckets * k`` survivors of each group."""
    order = [F.desc(count_col), F.asc(key)]
    salted = long_counts.withColumn("_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_salt", "_r1")
    w2 = Window.partitionBy(group).orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- A2 distinct counts

def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-missing values per column: exact (``operators.wide``) or by sketches, one scan either way."""
    if not approx:
        from netscope.operators.wide import distinct_counts as exact
        return exact(df, cols)
    wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    return _stack(wide, cols, [[f"CAST({_q(c)} AS BIGINT)"] for c in cols], ["column", "n_distinct"])


# ---------------------------------------------------------------- A3 / A5 cross tab with zero fill

def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None, prefix: str | None = None) -> DataFrame:
    """Counts of ``row`` x ``col`` with 0 for absent pairs; columns named ``<prefix><value>``.

    Without ``values`` they are read from the data: at most ``MAX_PIVOT`` of them, more is an error (a table that
    wide is no cross-tab: use ``value_counts`` on both columns)."""
    if values is None:
        rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_PIVOT + 1).collect()
        if len(rows) > MAX_PIVOT:
            raise ValueError(f"{col} has more than {MAX_PIVOT} values")
        values = sorted(r[0] for r in rows)
    p = df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(values)).count().na.fill(0)
    prefix = f"{col}_" if prefix is None else prefix
    return p.select(row, *[F.col(_q(str(v))).cast("bigint").alias(f"{prefix}{v}") for v in values])


# ---------------------------------------------------------------- A4 calendar counts

def count_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Rows per value of ``key``, in its order (T5)."""
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count")).orderBy(name)


# ---------------------------------------------------------------- A7 numeric summary, A17 describe

def numeric_summary(df: DataFrame, cols: Sequence[str], decimals: int = 6, method: str = "bounded") -> DataFrame:
    """mean, median, sample std, min, max, missing % per column.

    Moments come from one aggregate pass; medians from ``quantiles`` (exact, all columns
    in each scan, by default; ``method="approx"`` for a sketch)."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).cast("double").alias(f"{c}__min"), F.max(x).cast("double").alias(f"{c}__max"),
                 (F.avg(F.when(x.isNull(), 1.0).otherwise(0.0)) * 100).alias(f"{c}__missing_pct")]
    wide = df.agg(*aggs)
    stats = ["mean", "std", "min", "max", "missing_pct"]
    mom = _stack(wide, cols, [[f"`{c}__{s}`" for s in stats] for c in cols], ["column", *stats])
    med = _column_quantiles(df, cols, [0.5], ["median"], method)
    out = mom.join(med, "column", "left")
    return out.select("column", *[F.round(c, decimals).alias(c) for c in ["mean", "median", "std", "min", "max",
                                                                          "missing_pct"]])


def _column_quantiles(df: DataFrame, cols: Sequence[str], probs, names, method: str) -> DataFrame:
    """(column, <names>) for every column of ``cols``."""
    from netscope.operators.quantiles import exact_quantiles_long, quantile_columns
    if method == "bounded":
        return exact_quantiles_long(df, cols, probs, names).drop("_n")
    parts = [quantile_columns(df, [], c, probs, names, method).withColumn("column", F.lit(c)) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(df: DataFrame, cols: Sequence[str], decimals: int = 6, method: str = "bounded") -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max; quartiles exact (bounded memory)
    by default, ``method="approx"`` for sketch quartiles."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).cast("double").alias(f"{c}__min"),
                 F.max(x).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stats = ["count", "mean", "std", "min", "max"]
    mom = _stack(wide, cols, [[f"`{c}__{s}`" for s in stats] for c in cols], ["column", *stats])
    qs = _column_quantiles(df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], method)
    out = mom.join(qs, "column", "left")
    return out.select("column", "count", *[F.round(c, decimals).alias(c) for c in
                                           ["mean", "std", "min", "p25", "p50", "p75", "max"]])


# ---------------------------------------------------------------- A8 / A10 / A19 missingness and overview

def null_counts(df: DataFrame, cols: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    cols = list(cols or df.columns)
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in cols])
    out = _stack(wide, cols, [[_q(c)] for c in cols], ["column", "null_count"])
    return out.where(F.col("null_count") > 0) if only_positive else out


def quality_score(df: DataFrame, decimals: int = 2) -> DataFrame:
    """(1 - missing cells / all cells) * 100 and the pieces."""
    cols = df.columns
    missing = sum((F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) for c in cols), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), missing.cast("bigint").alias("missing_cells")).select(
        "n_rows", "missing_cells", (F.col("n_rows") * len(cols)).cast("bigint").alias("total_cells"),
        F.round((F.lit(1.0) - F.try_divide(F.col("missing_cells"), F.col("n_rows") * len(cols))) * 100, decimals)
        .alias("quality_score"))


def dataset_overview(df: DataFrame) -> DataFrame:
    from netscope.functions.exprs import split_numeric_categorical
    num, cat = split_numeric_categorical(df)
    return df.agg(F.count(F.lit(1)).alias("n_records")).select(
        "n_records", F.lit(len(df.columns)).cast("bigint").alias("n_features"),
        F.lit(len(num)).cast("bigint").alias("n_numeric"), F.lit(len(cat)).cast("bigint").alias("n_categorical"))


# ---------------------------------------------------------------- A9 / A11 duplicates

def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group (map-side pre-aggregated)."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("bigint").alias("n_rows"),
                 F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                 F.sum(F.col("_c") - 1).cast("bigint").alias("n_duplicates"))


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


# ---------------------------------------------------------------- A14 correlations

def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None, decimals: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation for the strict lower triangle, one scan (``operators.wide``);
    without ``cols`` over all correlation candidates of the table.  A constant or empty pair yields NULL."""
    from netscope.functions.exprs import correlation_candidates
    from netscope.operators.wide import correlations
    return correlations(df, correlation_candidates(df) if cols is None else cols, decimals).drop("n")


# ---------------------------------------------------------------- A15 histogram

def histogram(df: DataFrame, col: str, bins: int = 30, decimals: int = 6) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, every bin present (zero-filled)."""
    x = F.col(col)
    rng = df.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    skeleton = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = skeleton.select("bin", F.round(lo + F.col("bin") * width, decimals).alias("lo"),
                            F.round(lo + (F.col("bin") + 1) * width, decimals).alias("hi"))
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi",
                                                      F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


# ---------------------------------------------------------------- A16 / D7 box statistics and IQR outliers

def box_stats(df: DataFrame, group: str, col: str, decimals: int = 6, method: str = "bounded") -> DataFrame:
    """Quartiles, 1.5*IQR whiskers clipped to the data, outlier counts per group."""
    from netscope.operators.quantiles import for_join, quantile_columns
    x = F.col(col)
    quart = for_join(quantile_columns(df, [group], col, [0.25, 0.5, 0.75], ["q1", "median", "q3"], method))
    quart = quart.where(F.col("q1").isNotNull()).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = df.select(group, x.alias("_x")).where(F.col("_x").isNotNull()).join(quart, group)
    inside = (F.col("_x") >= lo_f) & (F.col("_x") <= hi_f)
    agg = j.groupBy(group, "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("bigint").alias("n_outliers"))
    return agg.select(group, "n", *[F.round(c, decimals).alias(c) for c in
                                    ["q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi"]], "n_outliers")


def iqr_outlier_flags(df: DataFrame, group: str, col: str, k: float = 1.5, method: str = "bounded") -> DataFrame:
    """Per-row outlier flag against the group's 1.5*IQR fences."""
    from netscope.operators.quantiles import for_join, quantile_columns
    x = F.col(col)
    quart = for_join(quantile_columns(df, [group], col, [0.25, 0.75], ["_q1", "_q3"], method))
    j = df.join(quart, group)
    iqr = F.col("_q3") - F.col("_q1")
    flag = (x < F.col("_q1") - k * iqr) | (x > F.col("_q3") + k * iqr)
    return j.withColumn("is_outlier", F.coalesce(flag, F.lit(False))).drop("_q1", "_q3")


# ---------------------------------------------------------------- P33 / P34 column screens

def nonnull_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    out = _stack(wide, cols, [[f"CAST({_q(c)} AS BIGINT)"] for c in cols], ["column", "nonnull"])
    return out.withColumn("kept", F.col("nonnull") > 0)


def nonconstant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One pass of min < max per candidate (cheaper than distinct counts)."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c)).cast("double").alias(f"{c}__lo"), F.max(F.col(c)).cast("double").alias(f"{c}__hi")]
    wide = df.agg(*aggs)
    out = _stack(wide, cols, [[f"`{c}__lo` < `{c}__hi`"] for c in cols], ["column", "nonconstant"])
    return out.withColumn("nonconstant", F.coalesce(F.col("nonconstant"), F.lit(False)))


def first_nonconstant(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate with more than one distinct value (one aggregate pass)."""
    row = nonconstant_columns(df, candidates).collect()  # one row per candidate: bounded
    flags = {r["column"]: r["nonconstant"] for r in row}
    for c in candidates:
        if flags.get(c):
            return c
    raise ValueError(f"every candidate is constant or empty: {', '.join(candidates)}")
