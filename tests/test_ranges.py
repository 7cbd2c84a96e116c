"""Ranges by count: a third of all rows in one hour, ties, and results that don't depend on the ranges."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from netscope.operators import sampling
from netscope.operators import series as S
from netscope.operators.ranges import range_of


@pytest.fixture(scope="module")
def bursts(spark):
    """30,000 rows: a third of them in one hour of one series, ties in time, many short series."""
    i = F.col("id")
    hot = i < 10_000
    return spark.range(30_000).select(
        F.when(hot | (i % 3 == 0), F.lit("hot")).otherwise(F.concat(F.lit("s"), i % 50)).alias("k"),
        F.timestamp_micros(F.when(hot, 1_700_000_000_000_000 + F.pmod(F.xxhash64(i), F.lit(3000)) * 1_000_000)
                           .otherwise(1_600_000_000_000_000 + i * 10_000_000_000)).alias("ts"),
        i.alias("tie"), F.pmod(F.xxhash64(i, F.lit(1)), F.lit(1000)).cast("double").alias("value")).repartition(5)


def test_no_range_holds_more_than_its_bound(bursts):
    by = [F.xxhash64("k"), F.unix_micros("ts"), F.col("tie")]
    d = bursts.withColumn("r", range_of(bursts, by, 1000, 8000))
    sizes = [r["count"] for r in d.groupBy("r").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) <= 1000 and len(sizes) >= 50
    edges = d.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("ts", "tie", "r"))).getField("r").alias("r")).collect()
    assert all(list(x["r"]) == sorted(x["r"]) for x in edges)


def test_series_results_do_not_depend_on_ranges(bursts):
    w = Window.partitionBy("k").orderBy("ts", "tie")
    want = {tuple(r) for r in bursts.select("k", "tie", F.row_number().over(w).alias("i"),
                                            F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n")).collect()}
    for rows in (700, 10 ** 9):
        idx = S.series_index(bursts, ["k"], "ts", "tie", rows)
        assert {tuple(r) for r in idx.select("k", "tie", "_idx", "_n").collect()} == want


def test_stratified_split_does_not_depend_on_ranges(bursts):
    one, two = (sampling.stratified_split(bursts.select("tie", "k"), "tie", "k", range_rows=n) for n in (500, 10 ** 9))
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in two.collect()}
    assert sampling.stratified_split(bursts.limit(0), "tie", "k").count() == 0
