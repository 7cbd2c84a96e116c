"""Registered time-series queries over the ``series`` stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.functions.exprs import ts_text
from netscope.operators import series as S
from netscope.plans.registry import query
from netscope.plans.standins import series

TS_FMT = "'%Y-%m-%d %H:%M:%S'"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


@query("series_summary", sql="""
SELECT exp_id, metric, COUNT(value) AS n, ROUND(AVG(value), 6) AS mean, ROUND(MEDIAN(value), 6) AS median,
       ROUND(MIN(value), 6) AS min, ROUND(MAX(value), 6) AS max, ROUND(STDDEV_POP(value), 6) AS std,
       ROUND(QUANTILE_CONT(value, 0.05), 6) AS pctl5, ROUND(QUANTILE_CONT(value, 0.25), 6) AS pctl25,
       ROUND(QUANTILE_CONT(value, 0.75), 6) AS pctl75, ROUND(QUANTILE_CONT(value, 0.95), 6) AS pctl95
FROM series GROUP BY exp_id, metric""", views=("series",))
def q_series_summary(spark, sf):
    g = S.summary_stats(series(spark, sf), ["exp_id", "metric"], "value")
    stats = ["mean", "median", "min", "max", "std", "pctl5", "pctl25", "pctl75", "pctl95"]
    return g.select("exp_id", "metric", "n", *[_r(c) for c in stats])


LAGS = 12
_lag_cols = ", ".join(f"LAG(value, {i}) OVER w AS lag_{i}" for i in range(1, LAGS + 1))
_lag_nn = " AND ".join(f"lag_{i} IS NOT NULL" for i in range(1, LAGS + 1))


@query("lag_features", sql=f"""
SELECT exp_id, event_id, strftime(ts, {TS_FMT}) AS ts, y, {", ".join(f"lag_{i}" for i in range(1, LAGS + 1))}
FROM (SELECT exp_id, event_id, ts, LEAD(value, 1) OVER w AS y, {_lag_cols}
      FROM series WINDOW w AS (PARTITION BY exp_id, metric ORDER BY ts, event_id)) t
WHERE y IS NOT NULL AND {_lag_nn}""", views=("series",))
def q_lag_features(spark, sf):
    s = series(spark, sf)
    out = S.supervised_lags(s, ["exp_id", "metric"], "ts", "event_id", lags=LAGS, horizon=1)
    return out.select("exp_id", "event_id", ts_text("ts").alias("ts"), "y",
                      *[f"lag_{i}" for i in range(1, LAGS + 1)])


LAG_SET = (1, 3, 6, 12)


@query("lag_set", sql=f"""
SELECT exp_id, event_id, {", ".join(f"LAG(value, {i}) OVER w AS lag_{i}" for i in LAG_SET)}
FROM series WINDOW w AS (PARTITION BY exp_id, metric ORDER BY ts, event_id)""", views=("series",))
def q_lag_set(spark, sf):
    out = S.lag_set(series(spark, sf), ["exp_id", "metric"], "ts", "event_id", offsets=LAG_SET)
    return out.select("exp_id", "event_id", *[f"lag_{i}" for i in LAG_SET])


@query("rolling_features", sql="""
SELECT exp_id, event_id,
       ROUND(CASE WHEN COUNT(value) OVER w6 = 6 THEN AVG(value) OVER w6 END, 6) AS roll_mean_6,
       ROUND(CASE WHEN COUNT(value) OVER w12 = 12 THEN STDDEV_SAMP(value) OVER w12 END, 6) AS roll_std_12
FROM series
WINDOW w6 AS (PARTITION BY exp_id, metric ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
       w12 AS (PARTITION BY exp_id, metric ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
       views=("series",))
def q_rolling_features(spark, sf):
    out = S.rolling(series(spark, sf), ["exp_id", "metric"], "ts", "event_id", mean_window=6, std_window=12)
    return out.select("exp_id", "event_id", _r("roll_mean_6"), _r("roll_std_12"))


@query("chrono_split", sql="""
SELECT exp_id, event_id,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY exp_id, metric ORDER BY ts, event_id)
                 <= FLOOR(COUNT(*) OVER (PARTITION BY exp_id, metric) * 0.8) THEN 'train' ELSE 'test' END AS split
FROM series""", views=("series",))
def q_chrono_split(spark, sf):
    out = S.chrono_split(series(spark, sf), ["exp_id", "metric"], "ts", "event_id", 0.8)
    return out.select("exp_id", "event_id", "split")


@query("longest_series", sql="""
WITH top AS (SELECT exp_id FROM series GROUP BY exp_id ORDER BY COUNT(*) DESC, exp_id ASC LIMIT 1)
SELECT exp_id, event_id, metric, value FROM series WHERE exp_id IN (SELECT exp_id FROM top)""", views=("series",))
def q_longest_series(spark, sf):
    return S.longest_series(series(spark, sf), "exp_id").select("exp_id", "event_id", "metric", "value")


@query("align_metrics", sql=f"""
SELECT exp_id, strftime(ts, {TS_FMT}) AS ts, {", ".join(
    f"ROUND(AVG(CASE WHEN metric = '{m}' THEN value END), 6) AS {m}" for m in EVENT_TYPES)}
FROM series GROUP BY exp_id, ts""", views=("series",))
def q_align_metrics(spark, sf):
    a = S.align_metrics(series(spark, sf), EVENT_TYPES)
    return a.select("exp_id", ts_text("ts").alias("ts"), *[_r(m) for m in EVENT_TYPES])
