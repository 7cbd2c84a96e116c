"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import oracle_sql, queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLES = oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    got = [r.asDict() for r in df.collect()]
    rel = con.sql(ORACLES[key])
    cols = rel.columns
    exp = [dict(zip(cols, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    c = sorted(cols)
    assert _rows(got, c) == _rows(exp, c)


@pytest.mark.parametrize("key", ["numeric_summary", "box_stats", "impute_median", "iqr_outliers", "psi_drift"])
def test_large_group_quantiles_match_oracle(spark, con, key, monkeypatch):
    """The branch for groups beyond one task's histogram, forced by a low threshold."""
    from netscope.operators import quantiles
    monkeypatch.setattr(quantiles, "MAX_EXACT", 200)
    monkeypatch.setattr(quantiles, "ACCURACY", 200)
    monkeypatch.setattr(quantiles, "WINDOW", 100)
    test_query_matches_oracle(spark, con, key)


def test_every_key_has_callable():
    qs = queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 80


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "compliance_rate" in df.columns
