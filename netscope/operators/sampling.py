"""Samples and splits that do not depend on partitioning (hash of a stable key)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netscope.operators.ranges import RANGE_ROWS, range_of


def digest(key: str, seed: int):
    """Seeded md5 of the key's text: an order that any engine can reproduce."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_exact(df: DataFrame, n: int, key: str | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows when more exist (all rows otherwise): the ``n`` smallest seeded digests of
    the key, ties by key.  Without ``key`` the whole row decides.  Planned as a top-k (partial per task)."""
    if key is not None:
        return df.orderBy(digest(key, seed), F.col(key)).limit(n)
    from netscope.operators.lineage import row_digest
    by = F.md5(F.concat(F.lit(f"{seed}:"), row_digest(df)))
    return df.withColumn("_by", by).orderBy("_by").limit(n).drop("_by")


def hash_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 42) -> DataFrame:
    """U4: ``split`` = train/test by a seeded digest bucket (stable under repartition)."""
    bucket = F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(bucket < train_pct, "train").otherwise("test"))


def stratified_split(df: DataFrame, key: str, label: str, train_pct: int = 80, seed: int = 42,
                     range_rows: int = RANGE_ROWS) -> DataFrame:
    """``train_pct`` % of every class, and at least one row on each side of a class of two or more.

    Rows of a class are ordered by a seeded digest.  Classes are cut into digest ranges of at most some
    ``range_rows`` rows whose counts give each range its offset, so a class is never ranked in one task.
    """
    d = df.withColumn("_by", digest(key, seed))
    start = F.coalesce(F.conv(F.substring("_by", 1, 15), 16, 10).cast("bigint"), F.lit(-1))
    d = d.withColumn("_range", range_of(d, [F.xxhash64(label), start], range_rows))
    counts = d.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label).orderBy("_range")
    counts = counts.withColumn("_off", F.sum("_n").over(before) - F.col("_n")).withColumn(
        "_all", F.sum("_n").over(Window.partitionBy(label)))
    rank = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_by", key))
    rows = d.withColumn("_rank", rank).join(counts.drop("_n"), [label, "_range"])
    cut = F.floor(F.col("_all") * train_pct / 100.0)
    cut = F.when(F.col("_all") >= 2, F.least(F.greatest(cut, F.lit(1)), F.col("_all") - 1)).otherwise(F.col("_all"))
    return rows.withColumn("split", F.when(F.col("_off") + F.col("_rank") <= cut, "train").otherwise("test")).select(
        *df.columns, "split")
