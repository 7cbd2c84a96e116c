"""Time-series operators over the long SERIES table (exp_id, metric, ts, value).

Ordered window work (lags, leads, rolling frames, chronological splits) is
planned so that no single task has to hold a whole series: a series is cut
into ranges of bounded row count, a global row index is derived from their counts, and
the window functions then run per fixed-size block of that index with a
small halo of neighbouring rows.  A series holding a third of all rows is
therefore spread over many tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netscope.operators.ranges import RANGE_ROWS, range_of

PCTLS = (0.05, 0.25, 0.75, 0.95)
PCTL_NAMES = ("pctl5", "pctl25", "pctl75", "pctl95")


# ---------------------------------------------------------------- A24 summary statistics

def summary_stats(df: DataFrame, keys: Sequence[str], value: str, prefix: str = "",
                  method: str = "bounded", accuracy: int | None = None) -> DataFrame:
    """n, mean, median, min, max, population std and p5/p25/p75/p95 per group.

    Moments are one algebraic aggregate.  Quantiles are exact with linear
    interpolation (numpy's default); ``method="bounded"`` computes them with
    bounded memory per group (sketch bracket + exact rank walk, see
    ``operators.quantiles``), ``"spark"`` with Spark's single-pass exact
    ``percentile`` (one group histogram per task), ``"approx"`` with the sketch.
    """
    from netscope.operators.quantiles import quantile_columns
    keys = list(keys)
    v = F.col(value)
    mom = df.groupBy(*keys).agg(
        F.count(v).alias(f"{prefix}n"),
        F.avg(v).alias(f"{prefix}mean"),
        F.min(v).alias(f"{prefix}min"),
        F.max(v).alias(f"{prefix}max"),
        F.stddev_pop(v).alias(f"{prefix}std"),
    )
    qn = ["_p5", "_p25", "_med", "_p75", "_p95"]
    qs = quantile_columns(df, keys, value, [0.05, 0.25, 0.5, 0.75, 0.95], qn, method, accuracy)
    g = mom.join(qs, keys, "left")
    return g.select(*keys, f"{prefix}n", f"{prefix}mean", F.col("_med").alias(f"{prefix}median"), f"{prefix}min",
                    f"{prefix}max", f"{prefix}std",
                    *[F.col(q).alias(f"{prefix}{nm}") for q, nm in zip(["_p5", "_p25", "_p75", "_p95"], PCTL_NAMES)])


# ---------------------------------------------------------------- I2 align metrics per timestamp

def align_metrics(series: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("exp_id", "ts")) -> DataFrame:
    """One row per (exp_id, ts) with one column per metric (mean of duplicates)."""
    return series.groupBy(*keys).pivot("metric", list(metrics)).agg(F.avg("value"))


# ---------------------------------------------------------------- skew-safe row index

def series_index(df: DataFrame, keys: Sequence[str], ts: str, tie: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``_idx`` (1-based position of the row inside its series by (ts, tie)) and ``_n``.

    Plan: rows are cut into ranges of (series, time, tie) that hold at most some ``range_rows`` rows each, however
    fast a series comes in; per-range counts are aggregated (partial aggregation, small output) and turned into
    offsets by a window over ranges; the row number is then taken inside each range only.  No window ever spans a
    whole series.  Ties that are no integers share the range of their time.
    """
    keys = list(keys)
    place = [F.xxhash64(*keys), F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(-2 ** 63))]
    if isinstance(df.schema[tie].dataType, T.IntegralType):
        place.append(F.coalesce(F.col(tie).cast("bigint"), F.lit(-2 ** 63)))
    d = df.withColumn("_chunk", range_of(df, place, range_rows))
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*keys)
    offsets = counts.select(*keys, "_chunk",
                            F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(wall).alias("_n"))
    rn = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(ts, tie))
    d = d.withColumn("_rn", rn)
    return (d.join(offsets, [*keys, "_chunk"])
            .withColumn("_idx", F.col("_off") + F.col("_rn"))
            .drop("_chunk", "_rn", "_off"))


def _blocked(indexed: DataFrame, keys: Sequence[str], back: int, fwd: int,
             block_rows: int) -> DataFrame:
    """Replicate halo rows into neighbour blocks so a block-local window sees
    ``back`` rows before and ``fwd`` rows after each of its own rows."""
    if block_rows <= max(back, fwd):
        raise ValueError("block_rows must exceed the lag/lead reach")
    b = F.floor((F.col("_idx") - 1) / block_rows).cast("bigint")
    pos = (F.col("_idx") - 1) - b * block_rows
    targets = F.array(b)
    if back > 0:
        targets = F.when(pos >= block_rows - back, F.array(b, b + 1)).otherwise(targets)
    if fwd > 0:
        targets = F.when(pos < fwd, F.array_union(targets, F.array(b - 1))).otherwise(targets)
    return (indexed.withColumn("_home", b)
            .withColumn("_block", F.explode(targets)))


def windowed(df: DataFrame, keys: Sequence[str], ts: str, tie: str,
             make_cols, back: int, fwd: int, block_rows: int = 100_000, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Apply window expressions built by ``make_cols(window)`` row-by-row in
    series order, using the skew-safe index + block + halo plan."""
    idx = series_index(df, keys, ts, tie, range_rows)
    blk = _blocked(idx, keys, back, fwd, block_rows)
    w = Window.partitionBy(*keys, "_block").orderBy("_idx")
    cols: dict[str, Column] = make_cols(w)
    out = blk.withColumns(cols).where(F.col("_home") == F.col("_block"))
    return out.drop("_home", "_block", "_idx", "_n")


# ---------------------------------------------------------------- W1 / D1 lags

def supervised_lags(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str = "value",
                    lags: int = 12, horizon: int = 1, drop_incomplete: bool = True,
                    block_rows: int = 100_000, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``y = value[t+h]``, ``lag_i = value[t-i]`` (i=1..lags); value at t is not a feature."""
    def mk(w):
        cols = {"y": F.lead(value, horizon).over(w)}
        for i in range(1, lags + 1):
            cols[f"lag_{i}"] = F.lag(value, i).over(w)
        return cols
    out = windowed(df, keys, ts, tie, mk, back=lags, fwd=horizon, block_rows=block_rows,
                   range_rows=range_rows)
    if drop_incomplete:
        out = out.na.drop(subset=["y"] + [f"lag_{i}" for i in range(1, lags + 1)])
    return out


def lag_set(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str = "value",
            offsets: Sequence[int] = (1, 3, 6, 12), block_rows: int = 100_000, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Selected lags, NULL where the series is too short."""
    def mk(w):
        return {f"lag_{i}": F.lag(value, i).over(w) for i in offsets}
    return windowed(df, keys, ts, tie, mk, back=max(offsets), fwd=0, block_rows=block_rows,
                    range_rows=range_rows)


# ---------------------------------------------------------------- D2 rolling frames

def rolling(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str = "value",
            mean_window: int = 6, std_window: int = 12, block_rows: int = 100_000, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rolling mean over ``mean_window`` rows and sample std over ``std_window`` rows;
    NULL until the frame is full (pandas ``rolling(w)`` default)."""
    def mk(w):
        wm = w.rowsBetween(-(mean_window - 1), 0)
        ws = w.rowsBetween(-(std_window - 1), 0)
        return {
            f"roll_mean_{mean_window}": F.when(F.count(value).over(wm) == mean_window, F.avg(value).over(wm)),
            f"roll_std_{std_window}": F.when(F.count(value).over(ws) == std_window, F.stddev_samp(value).over(ws)),
        }
    return windowed(df, keys, ts, tie, mk, back=max(mean_window, std_window) - 1, fwd=0,
                    block_rows=block_rows, range_rows=range_rows)


# ---------------------------------------------------------------- U6 chronological split

def chrono_split(df: DataFrame, keys: Sequence[str], ts: str, tie: str, train_frac: float = 0.8, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per series, the first floor(frac*n) rows by time are ``train``, the rest ``test``."""
    idx = series_index(df, keys, ts, tie, range_rows)
    cut = F.floor(F.col("_n") * F.lit(train_frac))
    return (idx.withColumn("split", F.when(F.col("_idx") <= cut, F.lit("train")).otherwise(F.lit("test")))
            .drop("_idx", "_n"))


# ---------------------------------------------------------------- T4 longest series

def longest_series(df: DataFrame, key: str = "exp_id", min_points: int | None = None) -> DataFrame:
    """Rows of the longest series (ties -> smallest key); with ``min_points`` keep
    every series of at least that many points instead."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_len"))
    if min_points is not None:
        keep = sizes.where(F.col("_len") >= min_points).select(key)
        return df.join(keep, key, "left_semi")
    top = sizes.orderBy(F.desc("_len"), F.asc(key)).limit(1).select(key)
    # one row by construction: safe to broadcast
    return df.join(F.broadcast(top), key, "left_semi")


def compare_summaries(exp: DataFrame, points: DataFrame, key: str, prefix: str = "tput_",
                      value: str = "value") -> DataFrame:
    """Recompute the nine statistics from the points and report, per statistic,
    the largest absolute difference to the stored ones (one aggregate row).  An experiment without points
    counts as zero points."""
    re = summary_stats(points, [key], value, prefix="re_")
    j = exp.join(re, key, "left")
    stats = ["mean", "median", "min", "max", "std", *PCTL_NAMES]
    return j.agg(F.count(F.lit(1)).alias("n_experiments"),
                 F.sum((F.coalesce(f"{prefix}n", F.lit(0)) != F.coalesce("re_n", F.lit(0))).cast("int")).cast("bigint").alias("n_count_mismatch"),
                 *[F.max(F.abs(F.col(f"{prefix}{s}") - F.col(f"re_{s}"))).alias(f"max_diff_{s}") for s in stats])
