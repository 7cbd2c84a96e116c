"""Registered anomaly-detection queries over the ``exp`` stand-in (and ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.operators import outliers as O
from netscope.plans.registry import query
from netscope.plans.standins import EXP_FEATURES, exp, table
from netscope.session import cut_lineage, unique_subdir

EPS_LIST = (0.3, 0.5, 0.7, 1.0)
MS_LIST = (5, 10, 20)
EPS, MS = 0.7, 5
Z_LIMIT = 3.0
ZCOLS = [f"z_{c}" for c in EXP_FEATURES]


def _dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


_ZSQL = (
    "st AS (SELECT " + ", ".join(f"AVG({c}) AS m{i}, STDDEV_POP({c}) AS s{i}" for i, c in enumerate(EXP_FEATURES))
    + " FROM exp),\n"
    "z AS (SELECT user_id, day, " + ", ".join(
        f"CASE WHEN s{i} = 0 THEN 0.0 ELSE ({c} - m{i}) / s{i} END AS z_{c}" for i, c in enumerate(EXP_FEATURES))
    + " FROM exp, st)")
_DIST2 = "0.0 + " + " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in EXP_FEATURES)


def _zexp(spark, sf):
    # read many times by the detectors below: computed once and checkpointed
    # the stand-in is read twice by the z-score (statistics + rows): materialise it first
    return cut_lineage(O.zscore(cut_lineage(exp(spark, sf)), EXP_FEATURES))


@query("zscore", sql="WITH " + _ZSQL + "\nSELECT user_id, day, " + ", ".join(
    f"ROUND(z_{c}, 6) AS z_{c}" for c in EXP_FEATURES) + " FROM z", views=("exp",))
def q_zscore(spark, sf):
    z = _zexp(spark, sf)
    return z.select("user_id", "day", *[F.round(c, 6).alias(c) for c in ZCOLS])


@query("top_scores", sql="""
WITH st AS (SELECT AVG(value) AS m, STDDEV_POP(value) AS s FROM events)
SELECT event_id, ROUND(CASE WHEN s = 0 THEN 0.0 ELSE (value - m) / s END, 6) AS score
FROM events, st ORDER BY (CASE WHEN s = 0 THEN 0.0 ELSE (value - m) / s END) DESC, event_id ASC LIMIT 50""")
def q_top_scores(spark, sf):
    e = O.zscore(table(spark, sf, "events").select("event_id", "value"), ["value"])
    return (e.orderBy(F.desc("z_value"), F.asc("event_id")).limit(50)
            .select("event_id", F.round("z_value", 6).alias("score")))


_NOISE_SQL = f"""WITH {_ZSQL},
pairs AS (SELECT a.user_id AS u, a.day AS d, b.user_id AS u2, b.day AS d2 FROM z a JOIN z b
          ON {_DIST2} <= {_dbl(EPS * EPS)}),
cnt AS (SELECT u, d, COUNT(*) AS c FROM pairs GROUP BY u, d),
core AS (SELECT u, d FROM cnt WHERE c >= {MS}),
near AS (SELECT DISTINCT p.u, p.d FROM pairs p JOIN core c ON p.u2 = c.u AND p.d2 = c.d),
flags AS (SELECT z.*, NOT (EXISTS (SELECT 1 FROM core c WHERE c.u = z.user_id AND c.d = z.day)
                        OR EXISTS (SELECT 1 FROM near n WHERE n.u = z.user_id AND n.d = z.day)) AS dbscan_noise
          FROM z)"""


def _noise(spark, sf):
    z = _zexp(spark, sf)
    pts = O.dbscan_points(z, ZCOLS, [EPS], [MS]).select("pt", F.col(f"noise_0_{MS}").alias("dbscan_noise"))
    return z.withColumn("pt", F.array(*[F.col(c) for c in ZCOLS])).join(pts, "pt").drop("pt")


@query("dbscan_noise", sql=_NOISE_SQL + "\nSELECT user_id, day, dbscan_noise FROM flags", views=("exp",))
def q_dbscan_noise(spark, sf):
    return _noise(spark, sf).select("user_id", "day", "dbscan_noise")


_EPS_VALUES = ", ".join(f"({_dbl(e)}, {_dbl(e * e)})" for e in EPS_LIST)
_MS_VALUES = ", ".join(f"({m})" for m in MS_LIST)


@query("dbscan_sweep", sql=f"""WITH {_ZSQL},
ev AS (SELECT * FROM (VALUES {_EPS_VALUES}) t(eps, eps2)),
mv AS (SELECT * FROM (VALUES {_MS_VALUES}) t(ms)),
pairs AS (SELECT a.user_id AS u, a.day AS d, b.user_id AS u2, b.day AS d2, {_DIST2} AS dist2 FROM z a JOIN z b
          ON {_DIST2} <= {_dbl(max(EPS_LIST) ** 2)}),
pe AS (SELECT p.*, ev.eps FROM pairs p JOIN ev ON p.dist2 <= ev.eps2),
cnt AS (SELECT u, d, eps, COUNT(*) AS c FROM pe GROUP BY u, d, eps),
core AS (SELECT cnt.u, cnt.d, cnt.eps, mv.ms FROM cnt JOIN mv ON cnt.c >= mv.ms),
near AS (SELECT DISTINCT pe.u, pe.d, pe.eps, core.ms FROM pe JOIN core ON core.u = pe.u2 AND core.d = pe.d2 AND core.eps = pe.eps),
flags AS (SELECT z.user_id, z.day, ev.eps, mv.ms,
                 NOT (EXISTS (SELECT 1 FROM core c WHERE c.u = z.user_id AND c.d = z.day AND c.eps = ev.eps AND c.ms = mv.ms)
                   OR EXISTS (SELECT 1 FROM near n WHERE n.u = z.user_id AND n.d = z.day AND n.eps = ev.eps AND n.ms = mv.ms))
                 AS is_noise
          FROM z CROSS JOIN ev CROSS JOIN mv),
rates AS (SELECT eps, ms, AVG(CAST(is_noise AS DOUBLE)) AS noise_rate, CAST(SUM(CAST(is_noise AS INTEGER)) AS BIGINT) AS n_noise
          FROM flags GROUP BY eps, ms),
best AS (SELECT eps, ms FROM rates ORDER BY CASE WHEN noise_rate > 0 AND noise_rate <= 0.05 THEN 0 ELSE 1 END,
         ABS(noise_rate - 0.01), eps, ms LIMIT 1)
SELECT r.eps, CAST(r.ms AS INTEGER) AS min_samples, ROUND(r.noise_rate, 6) AS noise_rate, r.n_noise,
       (r.eps = b.eps AND r.ms = b.ms) AS selected
FROM rates r, best b""", views=("exp",))
def q_dbscan_sweep(spark, sf):
    z = _zexp(spark, sf)
    r = O.sweep_rates(O.dbscan_sweep(z, ZCOLS, EPS_LIST, MS_LIST))
    return r.select("eps", "min_samples", F.round("noise_rate", 6).alias("noise_rate"), "n_noise", "selected")


_ZFLAG_SQL = " OR ".join(f"ABS(z_{c}) > {Z_LIMIT}" for c in EXP_FEATURES)


def _combined(spark, sf):
    n = _noise(spark, sf)
    zf = F.lit(False)
    for c in ZCOLS:
        zf = zf | (F.abs(F.col(c)) > Z_LIMIT)
    return O.combine_flags(n.withColumn("z_flag", zf), "dbscan_noise", "z_flag")


@query("anomaly_combined", sql=_NOISE_SQL + f"""
SELECT user_id, day, dbscan_noise, ({_ZFLAG_SQL}) AS z_flag, (dbscan_noise OR ({_ZFLAG_SQL})) AS anomaly
FROM flags""", views=("exp",))
def q_anomaly_combined(spark, sf):
    return _combined(spark, sf).select("user_id", "day", "dbscan_noise", "z_flag", "anomaly")


@query("anomaly_rates", sql=_NOISE_SQL + f""",
fl AS (SELECT dbscan_noise, ({_ZFLAG_SQL}) AS z_flag, (dbscan_noise OR ({_ZFLAG_SQL})) AS anomaly FROM flags)
SELECT 'dbscan_noise' AS detector, CAST(SUM(CAST(dbscan_noise AS INTEGER)) AS BIGINT) AS n_flagged,
       ROUND(AVG(CAST(dbscan_noise AS DOUBLE)), 6) AS rate FROM fl
UNION ALL SELECT 'z_flag', CAST(SUM(CAST(z_flag AS INTEGER)) AS BIGINT), ROUND(AVG(CAST(z_flag AS DOUBLE)), 6) FROM fl
UNION ALL SELECT 'anomaly', CAST(SUM(CAST(anomaly AS INTEGER)) AS BIGINT), ROUND(AVG(CAST(anomaly AS DOUBLE)), 6) FROM fl""",
       views=("exp",))
def q_anomaly_rates(spark, sf):
    return O.flag_rates(_combined(spark, sf), ["dbscan_noise", "z_flag", "anomaly"])


GROUP_DIMS = ["day", "day_name", "user"]


@query("anomaly_group_summary", sql=_NOISE_SQL + """,
fl AS (SELECT day, dayname(CAST(day AS DATE)) AS day_name, CAST(user_id AS VARCHAR) AS "user" FROM flags WHERE dbscan_noise),
vc AS (SELECT 'day' AS dimension, day AS value, COUNT(*) AS count FROM fl GROUP BY day
       UNION ALL SELECT 'day_name', day_name, COUNT(*) FROM fl GROUP BY day_name
       UNION ALL SELECT 'user', "user", COUNT(*) FROM fl GROUP BY "user")
SELECT * FROM (SELECT dimension, value, count,
                      CAST(ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY count DESC, value ASC) AS INTEGER) AS rank
               FROM vc) t WHERE rank <= 20""", views=("exp",))
def q_anomaly_group_summary(spark, sf):
    n = _noise(spark, sf).select("day", F.date_format(F.to_date("day"), "EEEE").alias("day_name"),
                                 F.col("user_id").cast("string").alias("user"), "dbscan_noise")
    return O.group_summary(n, "dbscan_noise", GROUP_DIMS, 20)


def _forest(spark, sf, n_trees: int = 100):
    z = _zexp(spark, sf)
    forest = O.fit_isolation_forest(z, ZCOLS, ["user_id", "day"], n_trees=n_trees, max_samples=256, seed=42)
    return cut_lineage(O.score_isolation_forest(z.select("user_id", "day", *ZCOLS), forest, ZCOLS))


@query("iforest_scores")
def q_iforest_scores(spark, sf):
    """The 400-tree detector with its automatic cut."""
    scored = _forest(spark, sf, 400)
    return scored.select("user_id", "day", F.round("iforest_score", 6).alias("iforest_score"),
                         (F.col("iforest_score") > 0.5).alias("iforest_flag"))


_RATES = ", ".join(f"({c!r})" for c in O.CONTAMINATIONS)


@query("iforest_sweep", sql=f"""
SELECT CAST(c AS DOUBLE) AS contamination, (SELECT CAST(COUNT(*) AS BIGINT) FROM exp) AS n_rows,
       CAST(TRUE AS BOOLEAN) AS rate_fits FROM (VALUES {_RATES}) t(c)""", views=("exp",))
def q_iforest_sweep(spark, sf):
    """M5: what holds for any forest: every cut flags its contamination's share of the rows, up to ties."""
    scored = _forest(spark, sf)
    n = scored.count()
    r = O.contamination_rates(scored, "iforest_score").where("contamination is not null")
    return r.select("contamination", F.lit(n).cast("long").alias("n_rows"),
                    (F.col("n_flagged") <= F.ceil(F.col("contamination") * n)).alias("rate_fits"))


@query("detector_roundtrip", sql="SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM exp", views=("exp",))
def q_detector_roundtrip(spark, sf):
    """The fitted detector saved with its features, loaded, and applied in batch to all rows: the scores
    are those of the detector in memory."""
    z = _zexp(spark, sf)
    forest = cut_lineage(O.fit_isolation_forest(z, ZCOLS, ["user_id", "day"], n_trees=50, max_samples=256, seed=42))
    at = unique_subdir(spark, "detector")
    O.save_forest(forest, ZCOLS, at)
    loaded, cols = O.load_forest(spark, at)
    both = O.score_isolation_forest(O.score_isolation_forest(z, forest, ZCOLS, "before"), loaded, cols, "after")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("n_differing"))


@query("iforest_rates")
def q_iforest_rates(spark, sf):
    """Observed rate per contamination, the selected one marked, and the automatic cut."""
    r = O.contamination_rates(_forest(spark, sf), "iforest_score")
    return r.select("contamination", F.round("threshold", 6).alias("threshold"), "n_flagged",
                    F.round("rate", 6).alias("rate"), "selected")


@query("anomaly_forest_union")
def q_anomaly_forest_union(spark, sf):
    """Forest (selected contamination) or DBSCAN noise."""
    scored = _forest(spark, sf)
    cut = O.contamination_rates(scored, "iforest_score").where("selected").select("threshold").scalar()
    flags = scored.select("user_id", "day", (F.col("iforest_score") > cut).alias("iforest_flag"))
    noise = _noise(spark, sf).select("user_id", "day", "dbscan_noise")
    both = noise.join(flags, ["user_id", "day"])
    return O.combine_flags(both, "dbscan_noise", "iforest_flag").select(
        "user_id", "day", "dbscan_noise", "iforest_flag", "anomaly")
