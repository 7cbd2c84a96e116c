"""Registered evaluation-metric and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.functions.labels import slo_tier
from netscope.operators import drift as D
from netscope.operators import metrics as M
from netscope.plans.catalog import SHIP_SLO, tier_sql
from netscope.plans.registry import query
from netscope.plans.standins import ship, table

# second labeller for the classification checks: looser delay, stricter throughput/loss
ALT_SLO = dict(delay_limit=200.0, tput_limit=25.0, loss_limit=4.0)


@query("regression_metrics", sql="""
WITH m AS (SELECT region_snd, region_rcv, AVG(tput_mean) AS y_pred FROM ship GROUP BY region_snd, region_rcv),
j AS (SELECT s.tput_mean AS y, m.y_pred AS p FROM ship s LEFT JOIN m ON s.region_snd = m.region_snd AND s.region_rcv = m.region_rcv),
b AS (SELECT COUNT(*) AS n, AVG(ABS(y - p)) AS mae, AVG((y - p) * (y - p)) AS mse, SUM((y - p) * (y - p)) AS sse,
             VAR_POP(y) AS yvar, AVG(ABS((y - p) / (ABS(y) + 1e-8))) AS mf, AVG(ABS((y - p) / (y + 1e-8))) AS msf,
             AVG(ABS(y)) AS may FROM j WHERE y IS NOT NULL AND p IS NOT NULL)
SELECT n, ROUND(mae, 6) AS mae, ROUND(SQRT(mse), 6) AS rmse, ROUND(1.0 - sse / (yvar * n), 6) AS r2,
       ROUND(mf * 100, 6) AS mape, ROUND(msf * 100, 6) AS mape_signed, ROUND(SQRT(mse) / (may + 1e-8), 6) AS nrmse
FROM b""", views=("ship",))
def q_regression_metrics(spark, sf):
    s = M.group_mean_prediction(ship(spark, sf), ["region_snd", "region_rcv"], "tput_mean")
    return M.regression_metrics(s, "tput_mean", "y_pred")


def _tiers(spark, sf):
    s = ship(spark, sf)
    return s.select(slo_tier("delay_mean", "tput_mean", "loss_mean", **SHIP_SLO).cast("string").alias("y"),
                    slo_tier("delay_mean", "tput_mean", "loss_mean", **ALT_SLO).cast("string").alias("p"))


_T1 = tier_sql(D=SHIP_SLO["delay_limit"], T=SHIP_SLO["tput_limit"], Lp=SHIP_SLO["loss_limit"])
_T2 = tier_sql(D=ALT_SLO["delay_limit"], T=ALT_SLO["tput_limit"], Lp=ALT_SLO["loss_limit"])
_CLS = f"""t AS (SELECT CAST({_T1} AS VARCHAR) AS y, CAST({_T2} AS VARCHAR) AS p FROM ship),
conf AS (SELECT y, p, COUNT(*) AS c FROM t GROUP BY y, p),
tc AS (SELECT y AS cls, SUM(c) AS support FROM conf GROUP BY y),
pc AS (SELECT p AS cls, SUM(c) AS pred FROM conf GROUP BY p),
tp AS (SELECT y AS cls, c AS tp FROM conf WHERE y = p),
c1 AS (SELECT COALESCE(tc.cls, pc.cls) AS cls, COALESCE(support, 0) AS support, COALESCE(pred, 0) AS pred
       FROM tc FULL JOIN pc ON tc.cls = pc.cls),
c2 AS (SELECT c1.*, COALESCE(tp.tp, 0) AS tp FROM c1 LEFT JOIN tp ON c1.cls = tp.cls),
c3 AS (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(pred, 0), 0.0) AS prec,
              COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS rec FROM c2),
c4 AS (SELECT *, COALESCE(2 * prec * rec / NULLIF(prec + rec, 0), 0.0) AS f1 FROM c3)"""


@query("classification_report", sql=f"""WITH {_CLS}
SELECT cls AS label, ROUND(prec, 6) AS "precision", ROUND(rec, 6) AS recall, ROUND(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM c4
UNION ALL SELECT 'macro avg', ROUND(AVG(prec), 6), ROUND(AVG(rec), 6), ROUND(AVG(f1), 6), CAST(SUM(support) AS BIGINT) FROM c4
UNION ALL SELECT 'weighted avg', ROUND(SUM(prec * support) / SUM(support), 6), ROUND(SUM(rec * support) / SUM(support), 6),
                 ROUND(SUM(f1 * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c4
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(CAST(SUM(tp) AS DOUBLE) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM c4""",
       views=("ship",))
def q_classification_report(spark, sf):
    return M.classification_report(_tiers(spark, sf), "y", "p")


@query("classification_metrics", sql=f"""WITH {_CLS}
SELECT ROUND(CAST(SUM(tp) AS DOUBLE) / SUM(support), 6) AS accuracy, ROUND(AVG(f1), 6) AS macro_f1,
       ROUND(SUM(f1 * support) / SUM(support), 6) AS weighted_f1,
       ROUND(AVG(CASE WHEN support > 0 THEN rec END), 6) AS balanced_accuracy, CAST(SUM(support) AS BIGINT) AS n
FROM c4""", views=("ship",))
def q_classification_metrics(spark, sf):
    return M.classification_metrics(_tiers(spark, sf), "y", "p")


_PROBS = ", ".join(f"{i / 10}" for i in range(1, 10))


@query("psi_drift", sql=f"""
WITH e AS (SELECT event_type, value, CAST(ts AS DATE) AS day FROM events),
lst AS (SELECT MAX(day) AS d FROM e),
ref AS (SELECT e.* FROM e, lst WHERE e.day <= lst.d - 1 AND e.day > lst.d - 8),
cur AS (SELECT e.* FROM e, lst WHERE e.day > lst.d - 1),
edges AS (SELECT event_type, QUANTILE_CONT(value, [{_PROBS}]) AS edges FROM ref GROUP BY event_type),
rb AS (SELECT r.event_type, len(list_filter(edges, lambda x: r.value > x)) AS bin, COUNT(*) AS r_n
       FROM ref r JOIN edges g ON r.event_type = g.event_type WHERE r.value IS NOT NULL GROUP BY 1, 2),
cb AS (SELECT c.event_type, len(list_filter(edges, lambda x: c.value > x)) AS bin, COUNT(*) AS c_n
       FROM cur c JOIN edges g ON c.event_type = g.event_type WHERE c.value IS NOT NULL GROUP BY 1, 2),
sk AS (SELECT g.event_type, r.range AS bin FROM edges g, range(10) r),
t AS (SELECT sk.event_type, sk.bin, COALESCE(rb.r_n, 0) AS r_n, COALESCE(cb.c_n, 0) AS c_n FROM sk
      LEFT JOIN rb ON sk.event_type = rb.event_type AND sk.bin = rb.bin
      LEFT JOIN cb ON sk.event_type = cb.event_type AND sk.bin = cb.bin),
p AS (SELECT *, GREATEST(r_n / SUM(r_n) OVER (PARTITION BY event_type), 1e-6) AS r_p,
              GREATEST(c_n / SUM(c_n) OVER (PARTITION BY event_type), 1e-6) AS c_p FROM t)
SELECT event_type, ROUND(SUM((c_p - r_p) * LN(c_p / r_p)), 6) AS psi, CAST(SUM(r_n) AS BIGINT) AS n_ref,
       CAST(SUM(c_n) AS BIGINT) AS n_cur, SUM((c_p - r_p) * LN(c_p / r_p)) > 0.2 AS drifted
FROM p GROUP BY event_type""")
def q_psi_drift(spark, sf):
    e = table(spark, sf, "events").select("event_type", "value", "ts")
    return D.psi_of_sides(D.time_sides(e, "ts", ref_days=7, cur_days=1), "value", "side", ["event_type"], bins=10, threshold=0.2)


_SCORES = {"price": "target_bwd", "quantity": "tput_mean", "wait": "delay_mean"}


@query("pr_auc", sql="\nUNION ALL\n".join(f"""SELECT '{name}' AS score, positives, n, pr_auc FROM (
  SELECT CAST(SUM(p) AS BIGINT) AS positives, CAST(SUM(c) AS BIGINT) AS n, ROUND(SUM(p * CAST(cp AS DOUBLE) / cn) / SUM(p), 6) AS pr_auc
  FROM (SELECT p, c, SUM(p) OVER (ORDER BY s DESC) AS cp, SUM(c) OVER (ORDER BY s DESC) AS cn
        FROM (SELECT {col} AS s, SUM(CASE WHEN provider = 'R' THEN 1 ELSE 0 END) AS p, COUNT(*) AS c FROM ship GROUP BY {col})))"""
    for name, col in _SCORES.items()), views=("ship",))
def q_pr_auc(spark, sf):
    """Three scores against the returned rows; whole numbers of days and pieces give long ties."""
    s = ship(spark, sf).withColumn("hit", (F.col("provider") == "R").cast("int"))
    out = None
    for name, col in _SCORES.items():
        one = M.pr_auc(s, "hit", col).select(F.lit(name).alias("score"), "positives", "n", "pr_auc")
        out = one if out is None else out.unionByName(one)
    return out
