"""Distribution drift between a reference window and a current window (PSI)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netscope.operators.quantiles import quantile_columns

FLOOR = 1e-6


def psi(ref: DataFrame, cur: DataFrame, value: str, keys: Sequence[str] = (), bins: int = 10,
        threshold: float = 0.2, decimals: int = 6, method: str = "bounded") -> DataFrame:
    """``psi_of_sides`` of two tables."""
    sides = [df.select(*keys, value, F.lit(side).alias("_side")) for df, side in ((ref, True), (cur, False))]
    return psi_of_sides(sides[0].unionByName(sides[1]), value, "_side", keys, bins, threshold, decimals, method)


def psi_of_sides(df: DataFrame, value: str, side: str, keys: Sequence[str] = (), bins: int = 10,
                 threshold: float = 0.2, decimals: int = 6, method: str = "bounded") -> DataFrame:
    """Population stability index per group; ``side`` is true for reference rows, false for current ones, null for others.

    Edges are the reference window's quantiles at 1/bins .. (bins-1)/bins; a
    value falls in bin = number of edges strictly below it.  Proportions are
    floored at 1e-6; PSI = sum((c - r) * ln(c / r)).  ``drifted`` = PSI > threshold.
    Both sides are counted in one scan, as ``2 * bins`` sums per group; groups are those of the reference.
    """
    keys = list(keys)
    if not keys:  # one global group
        return psi_of_sides(df.withColumn("_all", F.lit(0)), value, side, ["_all"], bins, threshold, decimals, method).drop("_all")
    probs = [i / bins for i in range(1, bins)]
    names = [f"_e{i}" for i in range(len(probs))]
    edges = quantile_columns(df.where(F.col(side)), keys, value, probs, names, method).select(
        *keys, F.array(*[F.col(n) for n in names]).alias("_edges"))
    # one row of edges per group: AQE broadcasts it when small, else a shuffle join
    bin_ = F.size(F.filter(F.col("_edges"), lambda e: F.col(value) > e))
    sides = {"r": F.col(side), "c": ~F.col(side)}
    counted = df.where(F.col(value).isNotNull() & F.col(side).isNotNull()).join(edges, keys).groupBy(*keys).agg(
        *[F.count_if(of & (bin_ == i)).alias(f"_{s}{i}") for s, of in sides.items() for i in range(bins)])
    t = edges.select(*keys).join(counted, keys, "left").na.fill(0)
    total = {s: sum((F.col(f"_{s}{i}") for i in range(1, bins)), F.col(f"_{s}0")) for s in sides}

    def share(s: str, i: int):
        return F.greatest(F.try_divide(F.col(f"_{s}{i}"), total[s]), F.lit(FLOOR))

    terms = [(share("c", i) - share("r", i)) * F.ln(share("c", i) / share("r", i)) for i in range(bins)]
    out = t.select(*keys, sum(terms[1:], terms[0]).alias("psi"), total["r"].cast("bigint").alias("n_ref"),
                   total["c"].cast("bigint").alias("n_cur"))
    return out.select(*keys, F.round("psi", decimals).alias("psi"), "n_ref", "n_cur",
                      (F.col("psi") > threshold).alias("drifted"))


def time_sides(df: DataFrame, ts: str, ref_days: int = 7, cur_days: int = 1, side: str = "side") -> DataFrame:
    """Rows of both windows, with ``side``: false in the last ``cur_days`` calendar days of the data, true in the
    ``ref_days`` days before them.  The last day is a scalar subquery."""
    last = df.agg(F.max(F.to_date(ts)).alias("d")).scalar()
    day = F.to_date(ts)
    return df.where(day > F.date_sub(last, cur_days + ref_days)).withColumn(side, day <= F.date_sub(last, cur_days))
