"""Summary report rows (insights) built from aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insights(df: DataFrame, provider: str = "provider", proto: str = "proto",
             region: str = "region_snd", tool: str = "tool") -> DataFrame:
    """One row: top provider and its share, dominant protocol, most active region, tool list.

    One scan counts the values of all four columns by grouping sets; the row is read off the counts.  Ties go
    to the smallest value; missing values don't count; without rows all is null and the list empty.
    """
    cols = [provider, proto, region, tool]
    counts = df.select(*cols).groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("_c"), *[(F.grouping(c) == 0).alias(f"_of{i}") for i, c in enumerate(cols)])
    of = {c: F.col(f"_of{i}") & F.col(c).isNotNull() for i, c in enumerate(cols)}

    def top(c: str) -> Column:
        return F.min(F.when(of[c], F.struct((-F.col("_c")).alias("n"), F.col(c).alias("v"))))

    best = counts.agg(top(provider).alias("p"), top(proto).alias("q"), top(region).alias("r"),
                      F.sum(F.when(of[provider], F.col("_c"))).alias("n"),
                      F.array_join(F.array_sort(F.collect_set(F.when(of[tool], F.col(tool)))), ",").alias("tools"))
    return best.select(F.col("p.v").alias("top_provider"),
                       F.round(-F.col("p.n") * 100.0 / F.col("n"), 2).alias("top_provider_share_pct"),
                       F.col("q.v").alias("dominant_proto"), F.col("r.v").alias("most_active_region"), "tools")
