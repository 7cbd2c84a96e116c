"""Cleaning: KPI alias resolution, coercion, finite filtering, imputation, dedup.

Imputation statistics are computed in one aggregate and referenced through a
scalar subquery, so the plan stays lazy and no table passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netscope.functions.exprs import calendar_parts, epoch_to_ts, finite_or_null, pair_na, safe_double

# Alias lists per canonical KPI, first present column wins.
KPI_ALIASES = {
    "tput_mean": ["tput_mean_bps", "tput_mean", "tput.synt.mean", "tput_mean_mbps", "throughput_mbps"],
    "delay_mean": ["delay_mean_ms", "delay_mean", "delay.synt.mean", "latency_ms"],
    "loss_mean": ["loss_mean_pct", "loss_mean", "loss.synt.mean"],
    "jitter_mean": ["jitter_mean_ms", "jitter_mean", "jitter.synt.mean"],
}
START_CANDIDATES = ["start", "start_ts", "info_snd.start_time", "start_time"]


def column_paths(df: DataFrame) -> dict[str, tuple]:
    """Name -> (column, type) of every top-level column and struct field; a top-level column whose own
    name has dots goes before a field of that path."""
    out: dict[str, tuple] = {}

    def walk(fields, prefix: str, base) -> None:
        for f in fields:
            name, col = prefix + f.name, (base.getField(f.name) if base is not None else F.col(f"`{f.name}`"))
            out.setdefault(name, (col, f.dataType))
            if isinstance(f.dataType, T.StructType):
                nested.append((f.dataType.fields, name + ".", col))

    nested = [(df.schema.fields, "", None)]
    while nested:
        walk(*nested.pop(0))
    return out


def basic_clean(df: DataFrame) -> DataFrame:
    """Canonical KPI columns (plan-time alias choice), numeric coercion,
    lower-case protocol, start timestamp with hour and Monday=0 weekday.

    The schema alone decides, so the result is one projection over ``df``.
    """
    known = column_paths(df)
    pick = lambda names: next((known[n] for n in names if n in known), None)
    new = {kpi: finite_or_null(safe_double(found[0])) for kpi, names in KPI_ALIASES.items()
           if (found := pick(names)) is not None}
    if "proto" in df.columns:
        new["proto"] = F.lower(known["proto"][0])
    if (start := pick(START_CANDIDATES)) is not None:
        col, kind = start
        ts = col if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else epoch_to_ts(col)
        parts = calendar_parts(ts)
        new |= {"start_ts": ts, "hour": parts["hour"], "dow": parts["dow"]}
    return df.withColumns(new) if new else df


def target_filter(df: DataFrame, target: str) -> DataFrame:
    """finite, non-null, non-negative target."""
    y = finite_or_null(F.col(target))
    return df.where(y.isNotNull() & (y >= 0))


def finite_mask(df: DataFrame, target: str) -> DataFrame:
    """keep rows with a finite non-null target."""
    return df.where(finite_or_null(F.col(target)).isNotNull())


def finite_report(df: DataFrame, target: str) -> DataFrame:
    """how many rows ``finite_mask`` keeps and drops (one aggregate row)."""
    kept = F.count_if(finite_or_null(F.col(target)).isNotNull())
    return df.agg(kept.alias("n_kept"), (F.count(F.lit(1)) - kept).alias("n_dropped"))


# Where the two sides of each pair are found, first present name wins.
PAIR_SIDES = {
    "region_pair": (("camp.region_snd", "region_snd"), ("camp.region_rcv", "region_rcv")),
    "vm_size_pair": (("camp.size_snd", "size_snd"), ("camp.size_rcv", "size_rcv")),
    "provider_pair": (("camp.provider_snd", "provider_snd"), ("camp.provider_rcv", "provider_rcv")),
}


def standard_pairs(df: DataFrame) -> DataFrame:
    """Region, size and provider pairs from nested or flat columns; absent or NULL sides are ``NA``."""
    known = column_paths(df)

    def side(names):
        return next((known[n][0] for n in names if n in known), F.lit(None).cast("string"))

    return df.withColumns({pair: pair_na(side(a), side(b)) for pair, (a, b) in PAIR_SIDES.items()})


def drop_any_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(cols))


def impute_median(df: DataFrame, cols: Sequence[str], zero_last: bool = False,
                  method: str = "bounded") -> DataFrame:
    """Fill NULLs with each column's exact median (``method="approx"`` for a sketch).
    All medians come from the same few scans (``quantiles.wide_quantiles``)."""
    from netscope.operators.profile import _column_quantiles
    cols = list(cols)
    if not cols:
        return df
    med = {r["column"]: r["median"] for r in _column_quantiles(df, cols, [0.5], ["median"], method).collect()}  # a row per column
    if zero_last:
        med = {c: 0.0 if m is None else m for c, m in med.items()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")) for c in cols})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M1d: most frequent value (smallest on ties) for each column."""
    out = df
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.where(F.col("_n") == counts.agg(F.max("_n")).scalar()).agg(F.min(c).alias("_m"))
        out = out.withColumn(c, F.coalesce(F.col(c), top.scalar()))
    return out


def fill_unknown(df: DataFrame, cols: Sequence[str] | None = None, value: str = "Unknown") -> DataFrame:
    """Constant fill for string columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(value, subset=list(cols))


def drop_duplicates_counted(df: DataFrame, cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A11 with the removed count as a second (lazy, one-row) frame."""
    d = df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()
    removed = df.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") - d.agg(F.count(F.lit(1))).scalar()).alias("removed"))
    return d, removed


def prepare(df: DataFrame, string_fill: str = "Unknown") -> DataFrame:
    """Prepared-table cleaning: normalised names, dedup, median fill of numeric
    columns, constant fill of strings (reference order)."""
    from netscope.functions.exprs import normalize_columns, split_numeric_categorical
    d = normalize_columns(df).dropDuplicates()
    num, cat = split_numeric_categorical(d)
    d = impute_median(d, num)
    return fill_unknown(d, cat, string_fill)


def parseable_dates(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """keep rows whose ``col`` parses as a timestamp."""
    ts = F.try_to_timestamp(F.col(col).cast("string"), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col).cast("string"))
    return df.where(ts.isNotNull())
