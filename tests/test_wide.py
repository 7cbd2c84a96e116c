"""Wide figures against pandas, and fingerprints of every column."""

import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from netscope.operators import profile as P
from netscope.operators import wide as W
from netscope.operators.lineage import canonical, fingerprint


def test_300_columns_in_one_scan(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 300)) + rng.normal(size=(900, 1))
    x[:, 5] = 1e9 + x[:, 4]                 # large offset
    x[:, 6], x[:, 7] = 42.1, np.nan         # constant, empty
    x[rng.random(x.shape) < 0.1] = np.nan
    x[np.isfinite(x[:, 8]), 9] = 7.3        # constant where 8 is present
    x[:600, 10] = np.nan                    # missing in some tasks altogether
    pdf = pd.DataFrame(x, columns=[f"x.{i}" if i == 3 else f"x{i}" for i in range(300)])
    table = pa_table(pdf)
    df = spark.createDataFrame(table).repartition(7)
    out = W.correlations(df, df.columns, 9)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and len(plan) < 200_000
    got = {(r["col_a"], r["col_b"]): r for r in out.collect()}
    assert len(got) == 300 * 299 // 2
    want = pdf.corr().to_numpy()
    counts = np.isfinite(x).T.astype(int) @ np.isfinite(x).astype(int)
    for i, a in enumerate(pdf.columns):
        for j in range(i):
            r = got[a, pdf.columns[j]]
            assert r["n"] == counts[i, j]
            if 6 in (i, j) or 7 in (i, j) or (i, j) == (9, 8):
                assert r["corr"] is None, (i, j)
            else:
                assert abs(r["corr"] - want[i, j]) < 1e-6, (i, j, r["corr"], want[i, j])


def pa_table(pdf):
    import pyarrow as pa
    return pa.Table.from_pandas(pdf, preserve_index=False)


def test_correlation_edges(spark):
    schema = "a double, b double, row_id double, c int"
    empty = spark.createDataFrame([], schema)
    rows = P.correlation_pairs(empty).collect()
    assert {(r["col_a"], r["col_b"], r["corr"]) for r in rows} == {("b", "a", None), ("c", "a", None), ("c", "b", None)}
    odd = spark.createDataFrame([(1.0, 2.0, 0.0, 1), (2.0, 4.0, 0.0, None), (3.0, 6.0, 0.0, 2), (float("nan"), 1.0, 0.0, 9),
                                 (float("inf"), 0.0, 0.0, 9)], schema)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation_pairs(odd).collect()}
    assert got["b", "a"] == 1.0 and got["c", "a"] == 1.0
    assert W.correlations(odd, ["a"]).count() == 0


def test_distinct_counts(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("few"), F.col("id").alias("many"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("zeros"), F.array(F.col("id") % 3).alias("arrays"),
        F.concat(F.lit("s"), F.col("id") % 11).alias("s.t"), F.encode(F.lit("x"), "utf-8").alias("bin"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("gaps"))
    out = P.distinct_counts(df, df.columns)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["column"]: r["n_distinct"] for r in out.collect()} == {
        "few": 7, "many": 5000, "none": 0, "zeros": 1, "arrays": 3, "s.t": 11, "bin": 1, "gaps": 4}
    assert {r["n_distinct"] for r in P.distinct_counts(df.limit(0), df.columns).collect()} == {0}


def test_fingerprint_sees_every_column(spark):
    t = datetime.datetime(2024, 1, 1, 0, 0, 7, 179575)
    base = [(1, t, 6.55, "p", t.date()), (2, t, None, None, None), (3, t, -0.1, "", t.date())]
    schema = "id long, ts timestamp, value double, props string, day date"

    def print_of(rows):
        r = fingerprint(canonical(spark.createDataFrame(rows, schema))).first()
        return r["n_rows"], r["content_hash"]

    assert print_of(base) == print_of(base[::-1])
    seen = {print_of(base)}
    for k, other in ((0, 9), (1, t + datetime.timedelta(microseconds=1)), (2, np.nextafter(6.55, 7).item()), (3, "q"),
                     (4, t.date() + datetime.timedelta(days=1))):
        row = list(base[0])
        row[k] = other
        seen.add(print_of([tuple(row), *base[1:]]))
    assert len(seen) == 6


def test_exact_text_of_doubles(spark):
    """The text gives back the same number, for all sizes of numbers."""
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64) | (rng.integers(0, 2, 4000, dtype=np.uint64) << np.uint64(63))
    x = bits.view(np.float64)
    x = np.concatenate([x[np.isfinite(x)], [0.0, 5e-324, 2.0 ** -1022, 1.7976931348623157e308, 8.0, 2 ** 53 - 1, 0.1]])
    df = spark.createDataFrame([(v,) for v in x.tolist()], "v double")
    from netscope.operators.lineage import canonical_text
    for r in df.select("v", canonical_text(df, "v").alias("t")).collect():
        m, _, e = r["t"].partition("p")
        import fractions
        assert r["v"] == float(fractions.Fraction(int(m)) * fractions.Fraction(2) ** (int(e or 52) - 52)), r
