"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator,
and for each SQL-expressible one an independent DuckDB oracle text.

Every query reads the driver tables (directly or through the stand-in views in
``standins``) over their whole extent.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.functions import exprs as X
from netscope.functions.labels import performance_class, slo_tier
from netscope.operators import labels as L
from netscope.operators import profile as P
from netscope.plans.registry import ORACLES, query
from netscope.plans.standins import SHIP_DIMS, SHIP_NUMERIC, exp, series, ship, table

# ---------------------------------------------------------------- shared SQL fragments

def tier_sql(dl="delay_mean", tp="tput_mean", ls="loss_mean", D=150.0, T=100.0, Lp=1.0) -> str:
    return (f"CAST(CASE WHEN {dl} IS NULL OR {tp} IS NULL OR {ls} IS NULL THEN NULL "
            f"WHEN {dl} < {0.5 * D} AND {tp} >= {1.5 * T} AND {ls} <= {0.25 * Lp} THEN 3 "
            f"WHEN {dl} <= {D} AND {tp} >= {T} AND {ls} <= {Lp} THEN 2 "
            f"WHEN {dl} <= {1.5 * D} AND {tp} >= {0.5 * T} AND {ls} <= {2.0 * Lp} THEN 1 "
            f"ELSE 0 END AS INTEGER)")


# Query parameters for the ship stand-in (its KPIs are quantities and days, so
# thresholds are scaled to them; the library defaults are the reference's).
SHIP_SLO = dict(delay_limit=150.0, tput_limit=20.0, loss_limit=5.0)
SHIP_CLASS = dict(delay_steps=(100.0, 200.0, 300.0), bandwidth_steps=(75000.0, 50000.0, 25000.0),
                  granularity_steps=(0.02, 0.04, 0.06))


def perf_class_sql() -> str:
    g = "LEAST(granularity_snd, granularity_rcv)"
    d = ("CASE WHEN delay_mean < 100.0 THEN 4 WHEN delay_mean < 200.0 THEN 3 "
         "WHEN delay_mean < 300.0 THEN 2 ELSE 1 END")
    b = ("CASE WHEN target_bwd > 75000.0 THEN 4 WHEN target_bwd > 50000.0 THEN 3 "
         "WHEN target_bwd > 25000.0 THEN 2 ELSE 1 END")
    gr = f"CASE WHEN {g} <= 0.02 THEN 4 WHEN {g} <= 0.04 THEN 3 WHEN {g} <= 0.06 THEN 2 ELSE 1 END"
    tot = f"(({d}) + ({b}) + ({gr})) / 3.0"
    return (f"CASE WHEN {tot} >= 3.5 THEN 'Excellent' WHEN {tot} >= 2.5 THEN 'Good' "
            f"WHEN {tot} >= 1.5 THEN 'Fair' ELSE 'Poor' END")


# pages URL parts (fixed patterns shared by the Spark side and the oracle)
RX_HOST = r"^[a-z]+://([^/]+)/"
RX_SCHEME = r"^([a-z]+)://"
RX_LANG = r"^[a-z]+://[^/]+/([a-z]{2})/"
RX_LAST = r"^[a-z]+://[^/]+/[a-z]{2}/([^/?#]*)"
RX_TLD = r"\.([a-z]+)/"
RX_QUERY = r"\?([^#]*)"
RX_FRAGMENT = r"#(.*)$"
RX_PAGE = r"[?&]page=([0-9]+)"
RX_QKEY = r"\?([a-z_]+)="


def pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url")


# ================================================================ flagship: SLO compliance by region pair

@query("slo_tier_by_region_pair", sql=f"""
SELECT region_pair, COUNT(*) AS n, COUNT(tier) AS n_labelled, ROUND(AVG(tier), 6) AS mean_tier,
       ROUND(AVG(CASE WHEN tier IS NOT NULL THEN CAST(tier >= 2 AS DOUBLE) END), 6) AS compliance_rate,
       CAST(SUM(CASE WHEN tier = 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_tier3
FROM (SELECT NULLIF(region_snd, '') || '->' || NULLIF(region_rcv, '') AS region_pair,
             {tier_sql(D=150.0, T=20.0, Lp=5.0)} AS tier FROM ship) t
GROUP BY region_pair""", views=("ship",))
def q_slo_tier_by_region_pair(spark, sf):
    return L.slo_by_region_pair(ship(spark, sf), **SHIP_SLO)


@query("slo_tiers", sql=f"""
SELECT tier, COUNT(*) AS count FROM (SELECT {tier_sql(D=150.0, T=20.0, Lp=5.0)} AS tier FROM ship) t
GROUP BY tier""", views=("ship",))
def q_slo_tiers(spark, sf):
    s = ship(spark, sf)
    return (s.select(slo_tier("delay_mean", "tput_mean", "loss_mean", **SHIP_SLO).alias("tier"))
            .groupBy("tier").agg(F.count(F.lit(1)).alias("count")))


@query("performance_class", sql=f"""
SELECT performance_class, COUNT(*) AS count
FROM (SELECT {perf_class_sql()} AS performance_class FROM ship WHERE target_bwd IS NOT NULL) t
GROUP BY performance_class""", views=("ship",))
def q_performance_class(spark, sf):
    s = ship(spark, sf).na.drop(subset=["target_bwd"])
    c = performance_class("delay_mean", "target_bwd", "granularity_snd", "granularity_rcv", **SHIP_CLASS)
    return s.select(c.alias("performance_class")).groupBy("performance_class").agg(
        F.count(F.lit(1)).alias("count"))


# ================================================================ scalar projections

@query("region_pair", sql="""
SELECT NULLIF(region_snd, '') || '->' || NULLIF(region_rcv, '') AS region_pair, COUNT(*) AS count
FROM ship GROUP BY 1""", views=("ship",))
def q_region_pair(spark, sf):
    s = ship(spark, sf)
    return s.groupBy(X.region_pair("region_snd", "region_rcv").alias("region_pair")).agg(
        F.count(F.lit(1)).alias("count"))


@query("pair_na", sql=f"""
SELECT COALESCE(NULLIF(regexp_extract(url, '{RX_PAGE}', 1), ''), 'NA') || '->' ||
       COALESCE(NULLIF(regexp_extract(url, '{RX_FRAGMENT}', 1), ''), 'NA') AS page_fragment_pair,
       COALESCE(NULLIF(regexp_extract(url, '{RX_SCHEME}', 1), ''), 'NA') || '->' ||
       COALESCE(NULLIF(regexp_extract(url, '{RX_TLD}', 1), ''), 'NA') AS scheme_tld_pair,
       COUNT(*) AS count
FROM pages GROUP BY 1, 2""")
def q_pair_na(spark, sf):
    p = pages(spark, sf)
    a = X.pair_na(X.regex_or_default("url", RX_PAGE), X.regex_or_default("url", RX_FRAGMENT))
    b = X.pair_na(X.regex_or_default("url", RX_SCHEME), X.regex_or_default("url", RX_TLD))
    return p.groupBy(a.alias("page_fragment_pair"), b.alias("scheme_tld_pair")).agg(
        F.count(F.lit(1)).alias("count"))


@query("path_segment", sql=f"""
SELECT page_id, COALESCE(NULLIF(regexp_extract(url, '{RX_HOST}', 1), ''), 'Unknown') AS host FROM pages""")
def q_path_segment(spark, sf):
    return pages(spark, sf).select("page_id", X.path_segment("url", r"^[a-z]+://").alias("host"))


@query("regex_extract", sql=f"""
SELECT page_id,
       regexp_extract(url, '{RX_SCHEME}', 1) AS scheme,
       COALESCE(NULLIF(regexp_extract(url, '{RX_LANG}', 1), ''), 'Unknown') AS lang,
       COALESCE(NULLIF(regexp_extract(url, '{RX_TLD}', 1), ''), 'Unknown') AS tld,
       CASE WHEN regexp_extract(url, '{RX_SCHEME}', 1) IN ('http', 'https')
            THEN COALESCE(NULLIF(regexp_extract(url, '{RX_LAST}', 1), ''), 'Unknown') ELSE 'Unknown' END AS doc
FROM pages""")
def q_regex_extract(spark, sf):
    p = pages(spark, sf)
    scheme = F.regexp_extract("url", RX_SCHEME, 1)
    return p.select("page_id", scheme.alias("scheme"),
                    X.regex_or_default("url", RX_LANG, default="Unknown").alias("lang"),
                    X.regex_or_default("url", RX_TLD, default="Unknown").alias("tld"),
                    F.when(scheme.isin("http", "https"),
                           X.regex_or_default("url", RX_LAST, default="Unknown")).otherwise("Unknown").alias("doc"))


@query("safe_cast", sql=f"""
SELECT page_id, TRY_CAST(NULLIF(TRIM(regexp_extract(url, '{RX_LAST}', 1)), '') AS DOUBLE) AS doc_num,
       TRY_CAST(NULLIF(TRIM(regexp_extract(url, '{RX_PAGE}', 1)), '') AS DOUBLE) AS page_num
FROM pages""")
def q_safe_cast(spark, sf):
    p = pages(spark, sf)
    return p.select("page_id", X.safe_double(F.regexp_extract("url", RX_LAST, 1)).alias("doc_num"),
                    X.safe_double(F.regexp_extract("url", RX_PAGE, 1)).alias("page_num"))


@query("falsy_coalesce", sql=f"""
SELECT page_id,
       COALESCE(NULLIF(regexp_extract(url, '{RX_QUERY}', 1), ''), NULLIF(regexp_extract(url, '{RX_FRAGMENT}', 1), ''))
         AS query_or_fragment,
       COALESCE(NULLIF(TRY_CAST(NULLIF(regexp_extract(url, '{RX_PAGE}', 1), '') AS BIGINT), 0),
                NULLIF(TRY_CAST(NULLIF(regexp_extract(url, '{RX_LAST}', 1), '') AS BIGINT), 0)) AS page_or_doc
FROM pages""")
def q_falsy_coalesce(spark, sf):
    p = pages(spark, sf)
    return p.select(
        "page_id",
        X.falsy_coalesce(F.regexp_extract("url", RX_QUERY, 1), F.regexp_extract("url", RX_FRAGMENT, 1))
        .alias("query_or_fragment"),
        X.falsy_coalesce(X.safe_bigint(F.regexp_extract("url", RX_PAGE, 1)),
                         X.safe_bigint(F.regexp_extract("url", RX_LAST, 1)), numeric=True).alias("page_or_doc"))


# Query mapping for the part stand-in (sizes of part types).
PART_TYPE_MAPPING = {"SMALL": "Small", "MEDIUM": "Medium", "LARGE": "Large"}


@query("map_values", sql="""
SELECT p_type, CASE p_type WHEN 'SMALL' THEN 'Small' WHEN 'MEDIUM' THEN 'Medium' WHEN 'LARGE' THEN 'Large'
                ELSE p_type END AS size_class, COUNT(*) AS count
FROM part GROUP BY 1, 2""")
def q_map_values(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy("p_type", X.map_values("p_type", PART_TYPE_MAPPING).alias("size_class")).agg(
        F.count(F.lit(1)).alias("count"))


@query("split_first", sql="""
SELECT name, CASE WHEN strpos(name, '_') > 0 THEN split_part(name, '_', 1) ELSE name END AS head,
       CASE WHEN strpos(name, '_') > 0 THEN substr(name, strpos(name, '_') + 1) ELSE 'UNKNOWN' END AS tail
FROM (SELECT n_name AS name FROM nation UNION ALL SELECT r_name AS name FROM region) t""")
def q_split_first(spark, sf):
    names = (table(spark, sf, "nation").select(F.col("n_name").alias("name"))
             .unionByName(table(spark, sf, "region").select(F.col("r_name").alias("name"))))
    h, t = X.split_first("name")
    return names.select("name", h.alias("head"), t.alias("tail"))


@query("lower_col", sql="""
SELECT lower(c_mktsegment) AS segment, COUNT(*) AS count FROM customer GROUP BY 1""")
def q_lower_col(spark, sf):
    c = table(spark, sf, "customer")
    return c.groupBy(F.lower("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("count"))


@query("calendar_parts", sql="""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day, dayname(ts) AS day_name FROM events""")
def q_calendar_parts(spark, sf):
    e = table(spark, sf, "events")
    parts = X.calendar_parts("ts")
    return e.select("event_id", *[v.alias(k) for k, v in parts.items()])


@query("epoch_to_ts", sql="""
SELECT event_id, epoch_us(ts) // 1000000 AS epoch_s,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(epoch_us(ts) // 1000000), '%Y-%m-%d %H:%M:%S') AS ts_back
FROM events""")
def q_epoch_to_ts(spark, sf):
    e = table(spark, sf, "events").select("event_id", X.ts_to_epoch("ts").alias("epoch_s"))
    return e.select("event_id", "epoch_s", X.ts_text(X.epoch_to_ts("epoch_s")).alias("ts_back"))


@query("json_props_parse", sql="""
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_props_parse(spark, sf):
    e = table(spark, sf, "events")
    v = F.try_parse_json("props")
    return e.select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"))


@query("array_mean_count", sql="""
SELECT vec_id, label, ROUND(CASE WHEN len(embedding) > 0 THEN list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding) END, 6)
         AS embedding_mean,
       CAST(CASE WHEN len(embedding) > 0 THEN len(embedding) END AS INTEGER) AS embedding_count
FROM embeddings""")
def q_array_mean_count(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.round(X.array_mean("embedding"), 6).alias("embedding_mean"),
                    X.array_count("embedding").alias("embedding_count"))


@query("finite_only", sql="""
WITH raw AS (
  SELECT l_returnflag,
         CASE WHEN l_tax = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_discount = 0 THEN CAST('Infinity' AS DOUBLE)
              WHEN l_discount = 0.1 THEN CAST('-Infinity' AS DOUBLE) ELSE l_extendedprice END AS x
  FROM lineitem),
clean AS (SELECT l_returnflag, CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END AS x FROM raw)
SELECT l_returnflag, COUNT(*) AS n_rows, COUNT(x) AS n_finite, ROUND(SUM(x), 6) AS sum_finite
FROM clean GROUP BY l_returnflag""")
def q_finite_only(spark, sf):
    li = table(spark, sf, "lineitem")
    raw = (F.when(F.col("l_tax") == 0, F.lit(float("nan")))
           .when(F.col("l_discount") == 0, F.lit(float("inf")))
           .when(F.col("l_discount") == 0.1, F.lit(float("-inf")))
           .otherwise(F.col("l_extendedprice")))
    c = li.select("l_returnflag", X.finite_or_null(raw).alias("x"))
    return c.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), F.count("x").alias("n_finite"),
                                         F.round(F.sum("x"), 6).alias("sum_finite"))


# ================================================================ scans / filters

SCAN_FILTERS = [[("l_returnflag", "=", "R"), ("l_quantity", ">=", 25.0)],
                [("l_linestatus", "in", ["O"]), ("l_discount", "<", 0.02)]]


@query("scan_project_filter", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem
WHERE (l_returnflag = 'R' AND l_quantity >= 25.0) OR (l_linestatus IN ('O') AND l_discount < 0.02)""")
def q_scan_project_filter(spark, sf):
    from netscope.sources.parquet import read_parquet
    return read_parquet(spark, f"{sf}/lineitem.parquet",
                        columns=["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"],
                        filters=SCAN_FILTERS)


@query("target_filter", sql="""
SELECT provider, COUNT(*) AS n, ROUND(SUM(delay_mean), 6) AS sum_delay FROM ship
WHERE delay_mean IS NOT NULL AND delay_mean >= 0 GROUP BY provider""", views=("ship",))
def q_target_filter(spark, sf):
    from netscope.operators.clean import target_filter
    s = target_filter(ship(spark, sf), "delay_mean")
    return s.groupBy("provider").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("delay_mean"), 6).alias("sum_delay"))


@query("drop_any_null", sql="""
SELECT provider, COUNT(*) AS n FROM ship
WHERE granularity_rcv IS NOT NULL AND NOT isnan(granularity_rcv) AND delay_mean IS NOT NULL GROUP BY provider""",
       views=("ship",))
def q_drop_any_null(spark, sf):
    s = ship(spark, sf).na.drop("any", subset=["granularity_rcv", "delay_mean"])
    return s.groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


@query("metric_filter", sql="""
SELECT exp_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM series WHERE lower(metric) = 'click'""",
       views=("series",))
def q_metric_filter(spark, sf):
    s = series(spark, sf)
    return s.where(F.lower("metric") == "click").select("exp_id", "event_id", X.ts_text("ts").alias("ts"), "value")


# ================================================================ profiling aggregates

@query("value_counts", sql="SELECT provider, COUNT(*) AS count FROM ship WHERE provider IS NOT NULL GROUP BY provider",
       views=("ship",))
def q_value_counts(spark, sf):
    return P.value_counts(ship(spark, sf), "provider")


@query("value_counts_multi", sql=" UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, COUNT(*) AS count FROM ship "
    f"WHERE {d} IS NOT NULL GROUP BY {d}" for d in SHIP_DIMS), views=("ship",))
def q_value_counts_multi(spark, sf):
    return P.value_counts_multi(ship(spark, sf), SHIP_DIMS)


@query("value_share", sql="""
SELECT provider, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS share_pct
FROM ship WHERE provider IS NOT NULL GROUP BY provider""", views=("ship",))
def q_value_share(spark, sf):
    return P.value_share(P.value_counts(ship(spark, sf), "provider"))


DISTINCT_COLS = SHIP_DIMS + ["l_suppkey", "l_partkey"]


@query("distinct_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct FROM ship" for c in DISTINCT_COLS),
       views=("ship",))
def q_distinct_counts(spark, sf):
    return P.distinct_counts(ship(spark, sf), DISTINCT_COLS)


@query("crosstab", sql="""
SELECT provider, CAST(SUM(CASE WHEN tool = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS tool_F,
       CAST(SUM(CASE WHEN tool = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS tool_O,
       CAST(SUM(CASE WHEN tool = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS tool_P
FROM ship WHERE provider IS NOT NULL GROUP BY provider""", views=("ship",))
def q_crosstab(spark, sf):
    return P.crosstab(ship(spark, sf), "provider", "tool", ["F", "O", "P"])


@query("daily_counts", sql="SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS count FROM events GROUP BY 1")
def q_daily_counts(spark, sf):
    return P.count_by(table(spark, sf, "events"), F.to_date("ts").cast("string"), "day")


@query("hourly_counts", sql="SELECT CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS count FROM events GROUP BY 1")
def q_hourly_counts(spark, sf):
    return P.count_by(table(spark, sf, "events"), F.hour("ts"), "hour")


@query("dow_counts", sql="""
SELECT CAST(isodow(ts) - 1 AS INTEGER) AS dow, dayname(ts) AS day_name, COUNT(*) AS count FROM events GROUP BY 1, 2""")
def q_dow_counts(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.weekday("ts").alias("dow"), F.date_format("ts", "EEEE").alias("day_name")).agg(
        F.count(F.lit(1)).alias("count")).orderBy("dow")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("daily_by_type_pivot", sql="SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, " + ", ".join(
    f"CAST(SUM(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS event_type_{t}" for t in EVENT_TYPES)
       + " FROM events GROUP BY 1")
def q_daily_by_type_pivot(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type")
    return P.crosstab(e, "day", "event_type", EVENT_TYPES)


def _numeric_summary_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, ROUND(AVG({c}), 6) AS mean, ROUND(MEDIAN({c}), 6) AS median, "
        f"ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, "
        f"ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max, "
        f"ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS missing_pct FROM ship" for c in cols)


@query("numeric_summary", sql=_numeric_summary_sql(SHIP_NUMERIC), views=("ship",))
def q_numeric_summary(spark, sf):
    return P.numeric_summary(ship(spark, sf), SHIP_NUMERIC)


SHIP_ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"] + SHIP_DIMS + SHIP_NUMERIC + ["ts"]


@query("null_counts", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM ship"
    for c in SHIP_ALL) + ") t WHERE null_count > 0", views=("ship",))
def q_null_counts(spark, sf):
    return P.null_counts(ship(spark, sf))


@query("duplicate_count", sql=f"""
SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_distinct, CAST(SUM(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT {', '.join(SHIP_DIMS)}, COUNT(*) AS c FROM ship GROUP BY ALL) t""", views=("ship",))
def q_duplicate_count(spark, sf):
    return P.duplicate_count(ship(spark, sf), SHIP_DIMS)


@query("quality_score", sql=f"""
SELECT n_rows, missing_cells, CAST(n_rows * {len(SHIP_ALL)} AS BIGINT) AS total_cells,
       ROUND((1.0 - missing_cells / (n_rows * {len(SHIP_ALL)})) * 100, 2) AS quality_score
FROM (SELECT COUNT(*) AS n_rows, CAST({' + '.join(f'SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)' for c in SHIP_ALL)}
      AS BIGINT) AS missing_cells FROM ship) t""", views=("ship",))
def q_quality_score(spark, sf):
    return P.quality_score(ship(spark, sf))


@query("dataset_overview", sql=f"""
SELECT COUNT(*) AS n_records, CAST({len(SHIP_ALL)} AS BIGINT) AS n_features,
       CAST({len(SHIP_NUMERIC) + 4} AS BIGINT) AS n_numeric, CAST({len(SHIP_DIMS)} AS BIGINT) AS n_categorical
FROM ship""", views=("ship",))
def q_dataset_overview(spark, sf):
    return P.dataset_overview(ship(spark, sf))


@query("dedup_rows", sql="SELECT DISTINCT user_id, event_type, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def q_dedup_rows(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.hour("ts").alias("hour"))
    return P.dedup_rows(e)


@query("correlation_pairs", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(COVAR_POP({a}, {b}) / NULLIF("
    f"STDDEV_POP(CASE WHEN {b} IS NOT NULL THEN {a} END) * STDDEV_POP(CASE WHEN {a} IS NOT NULL THEN {b} END), 0), 6)"
    f" AS corr FROM ship"
    for i, a in enumerate(SHIP_NUMERIC) for j, b in enumerate(SHIP_NUMERIC) if j < i), views=("ship",))
def q_correlation_pairs(spark, sf):
    return P.correlation_pairs(ship(spark, sf), SHIP_NUMERIC)


_CANDIDATES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("correlation_candidates", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, COUNT(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"ROUND(CORR({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_CANDIDATES) for j, b in enumerate(_CANDIDATES) if j < i))
def q_correlation_candidates(spark, sf):
    """P32 + A14: all numeric columns that are no identifiers, found from the schema."""
    from netscope.functions.exprs import correlation_candidates
    from netscope.operators.wide import correlations
    li = table(spark, sf, "lineitem")
    return correlations(li, correlation_candidates(li))


@query("histogram30", sql="""
WITH r AS (SELECT MIN(delay_mean) AS lo, MAX(delay_mean) AS hi FROM ship),
b AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE LEAST(FLOOR((s.delay_mean - r.lo) / ((r.hi - r.lo) / 30.0)), 29) END AS INTEGER) AS bin,
             COUNT(*) AS c
      FROM ship s, r WHERE s.delay_mean IS NOT NULL GROUP BY 1),
k AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT k.bin, ROUND(r.lo + k.bin * ((r.hi - r.lo) / 30.0), 6) AS lo, ROUND(r.lo + (k.bin + 1) * ((r.hi - r.lo) / 30.0), 6) AS hi,
       CAST(COALESCE(b.c, 0) AS BIGINT) AS count
FROM k CROSS JOIN r LEFT JOIN b ON k.bin = b.bin""", views=("ship",))
def q_histogram30(spark, sf):
    return P.histogram(ship(spark, sf), "delay_mean", 30)


@query("box_stats", sql="""
WITH q AS (SELECT provider, QUANTILE_CONT(delay_mean, 0.25) AS q1, QUANTILE_CONT(delay_mean, 0.5) AS median,
                  QUANTILE_CONT(delay_mean, 0.75) AS q3 FROM ship GROUP BY provider)
SELECT s.provider, COUNT(*) AS n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       ROUND(q3 - q1, 6) AS iqr,
       ROUND(MIN(CASE WHEN delay_mean >= q1 - 1.5 * (q3 - q1) AND delay_mean <= q3 + 1.5 * (q3 - q1) THEN delay_mean END), 6) AS whisker_lo,
       ROUND(MAX(CASE WHEN delay_mean >= q1 - 1.5 * (q3 - q1) AND delay_mean <= q3 + 1.5 * (q3 - q1) THEN delay_mean END), 6) AS whisker_hi,
       CAST(SUM(CASE WHEN delay_mean >= q1 - 1.5 * (q3 - q1) AND delay_mean <= q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM ship s JOIN q ON s.provider = q.provider WHERE delay_mean IS NOT NULL
GROUP BY s.provider, q1, median, q3""", views=("ship",))
def q_box_stats(spark, sf):
    return P.box_stats(ship(spark, sf), "provider", "delay_mean")


@query("iqr_outliers", sql="""
WITH q AS (SELECT provider, QUANTILE_CONT(delay_mean, 0.25) AS q1, QUANTILE_CONT(delay_mean, 0.75) AS q3 FROM ship GROUP BY provider)
SELECT s.provider, COUNT(*) AS n,
       CAST(SUM(CASE WHEN delay_mean < q1 - 1.5 * (q3 - q1) OR delay_mean > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM ship s JOIN q ON s.provider = q.provider GROUP BY s.provider""", views=("ship",))
def q_iqr_outliers(spark, sf):
    f = P.iqr_outlier_flags(ship(spark, sf), "provider", "delay_mean")
    return f.groupBy("provider").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(F.col("is_outlier").cast("int")).cast("bigint").alias("n_outliers"))


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, "
        f"ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, "
        f"ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, "
        f"ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM ship" for c in cols)


@query("describe", sql=_describe_sql(SHIP_NUMERIC), views=("ship",))
def q_describe(spark, sf):
    return P.describe(ship(spark, sf), SHIP_NUMERIC)


NONNULL_CANDIDATES = SHIP_NUMERIC + ["jitter_mean"]


def _ship_with_jitter(spark, sf):
    return ship(spark, sf).withColumn("jitter_mean", F.lit(None).cast("double"))


@query("nonnull_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(COUNT({c}) AS BIGINT) AS nonnull, COUNT({c}) > 0 AS kept FROM ship2"
    for c in NONNULL_CANDIDATES), views=("ship",))
def q_nonnull_counts(spark, sf):
    return P.nonnull_counts(_ship_with_jitter(spark, sf), NONNULL_CANDIDATES)


@query("nonconstant_columns", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column, COALESCE(MIN({c}) < MAX({c}), false) AS nonconstant FROM ship2"
    for c in NONNULL_CANDIDATES), views=("ship",))
def q_nonconstant_columns(spark, sf):
    return P.nonconstant_columns(_ship_with_jitter(spark, sf), NONNULL_CANDIDATES)


@query("top_region_pairs", sql="""
SELECT region_snd || ' → ' || region_rcv AS region_pair, COUNT(*) AS count FROM ship
WHERE region_snd || ' → ' || region_rcv IS NOT NULL
GROUP BY 1 ORDER BY count DESC, region_pair ASC LIMIT 15""", views=("ship",))
def q_top_region_pairs(spark, sf):
    s = ship(spark, sf).select(X.arrow_pair("region_snd", "region_rcv").alias("region_pair"))
    return P.top_k(P.value_counts(s, "region_pair"), "region_pair", 15)


@query("semi_top_regions", sql="""
WITH top AS (SELECT l_suppkey FROM ship GROUP BY l_suppkey ORDER BY COUNT(*) DESC, l_suppkey ASC LIMIT 10)
SELECT l_suppkey, provider, COUNT(*) AS count FROM ship WHERE l_suppkey IN (SELECT l_suppkey FROM top)
GROUP BY l_suppkey, provider""", views=("ship",))
def q_semi_top_regions(spark, sf):
    s = ship(spark, sf)
    top = P.top_k(P.value_counts(s, "l_suppkey"), "l_suppkey", 10).select("l_suppkey")
    # ten rows by construction: a proven bound for the broadcast
    return (s.join(F.broadcast(top), "l_suppkey", "left_semi")
            .groupBy("l_suppkey", "provider").agg(F.count(F.lit(1)).alias("count")))


@query("insights", sql="""
WITH pc AS (SELECT provider, COUNT(*) AS c FROM ship WHERE provider IS NOT NULL GROUP BY provider),
tp AS (SELECT provider, c FROM pc ORDER BY c DESC, provider ASC LIMIT 1),
pr AS (SELECT proto FROM ship WHERE proto IS NOT NULL GROUP BY proto ORDER BY COUNT(*) DESC, proto ASC LIMIT 1),
rg AS (SELECT region_snd FROM ship WHERE region_snd IS NOT NULL GROUP BY region_snd ORDER BY COUNT(*) DESC, region_snd ASC LIMIT 1),
tl AS (SELECT array_to_string(list_sort(list_distinct(list(tool))), ',') AS tools FROM ship)
SELECT tp.provider AS top_provider, ROUND(tp.c * 100.0 / (SELECT SUM(c) FROM pc), 2) AS top_provider_share_pct,
       pr.proto AS dominant_proto, rg.region_snd AS most_active_region, tl.tools AS tools
FROM tp, pr, rg, tl""", views=("ship",))
def q_insights(spark, sf):
    from netscope.operators.report import insights
    return insights(ship(spark, sf))


@query("class_weights", sql="""
WITH c AS (SELECT provider, COUNT(*) AS n_c FROM ship GROUP BY provider)
SELECT provider, n_c, ROUND((SELECT SUM(n_c) FROM c) / ((SELECT COUNT(*) FROM c) * n_c), 6) AS weight FROM c""",
       views=("ship",))
def q_class_weights(spark, sf):
    w = L.class_weights(ship(spark, sf), "provider")
    return w.select("provider", "n_c", F.round("weight", 6).alias("weight"))


@query("merge_rare_classes", sql="""
WITH e AS (SELECT CAST(tput_n AS VARCHAR) AS label FROM exp),
c AS (SELECT label, COUNT(*) AS n FROM e GROUP BY label)
SELECT CASE WHEN c.n < 2 THEN 'Good' ELSE e.label END AS label, COUNT(*) AS count
FROM e JOIN c ON e.label = c.label GROUP BY 1""", views=("exp",))
def q_merge_rare_classes(spark, sf):
    e = exp(spark, sf).select(F.col("tput_n").cast("string").alias("label"))
    m = L.merge_rare_classes(e, "label")
    return m.groupBy("label").agg(F.count(F.lit(1)).alias("count"))


@query("union_by_name", sql="""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment,
       'customer' AS kind FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, 'supplier' AS kind FROM supplier""")
def q_union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("kind"))
    return c.unionByName(s, allowMissingColumns=True)


@query("date_range", sql="""
SELECT strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_ts,
       COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT event_type) AS n_event_types FROM events""")
def q_date_range(spark, sf):
    e = table(spark, sf, "events")
    return e.agg(X.ts_text(F.min("ts")).alias("first_ts"), X.ts_text(F.max("ts")).alias("last_ts"),
                 F.count_distinct("user_id").alias("n_users"), F.count_distinct("event_type").alias("n_event_types"))


@query("fill_unknown", sql=f"""
SELECT page_id, COALESCE(NULLIF(regexp_extract(url, '{RX_QUERY}', 1), ''), 'Unknown') AS query,
       COALESCE(NULLIF(regexp_extract(url, '{RX_FRAGMENT}', 1), ''), 'Unknown') AS fragment FROM pages""")
def q_fill_unknown(spark, sf):
    from netscope.operators.clean import fill_unknown
    p = pages(spark, sf).select("page_id", X.regex_or_default("url", RX_QUERY).alias("query"),
                                X.regex_or_default("url", RX_FRAGMENT).alias("fragment"))
    return fill_unknown(p, ["query", "fragment"])


@query("impute_median", sql="""
SELECT l_orderkey, l_linenumber, ROUND(COALESCE(granularity_rcv, (SELECT MEDIAN(granularity_rcv) FROM ship)), 6)
       AS granularity_rcv, ROUND(COALESCE(delay_mean, (SELECT MEDIAN(delay_mean) FROM ship)), 6) AS delay_mean
FROM ship""", views=("ship",))
def q_impute_median(spark, sf):
    from netscope.operators.clean import impute_median
    s = ship(spark, sf).select("l_orderkey", "l_linenumber", "granularity_rcv", "delay_mean")
    out = impute_median(s, ["granularity_rcv", "delay_mean"])
    return out.select("l_orderkey", "l_linenumber", F.round("granularity_rcv", 6).alias("granularity_rcv"),
                      F.round("delay_mean", 6).alias("delay_mean"))


@query("impute_mode", sql=f"""
WITH p AS (SELECT page_id, NULLIF(regexp_extract(url, '{RX_QKEY}', 1), '') AS qkey FROM pages),
m AS (SELECT qkey FROM p WHERE qkey IS NOT NULL GROUP BY qkey ORDER BY COUNT(*) DESC, qkey ASC LIMIT 1)
SELECT page_id, COALESCE(qkey, (SELECT qkey FROM m)) AS qkey FROM p""")
def q_impute_mode(spark, sf):
    from netscope.operators.clean import impute_mode
    p = pages(spark, sf).select("page_id", X.regex_or_default("url", RX_QKEY).alias("qkey"))
    return impute_mode(p, ["qkey"])


_EXP_STATS = ["tput_mean", "tput_median", "tput_min", "tput_max", "tput_std", "tput_pctl5", "tput_pctl25",
              "tput_pctl75", "tput_pctl95"]


@query("summary_flatten", sql="SELECT user_id, day, tput_n, " + ", ".join(
    f"ROUND({c}, 6) AS {c}" for c in _EXP_STATS) + " FROM exp", views=("exp",))
def q_summary_flatten(spark, sf):
    e = exp(spark, sf)
    return e.select("user_id", "day", "tput_n", *[F.round(c, 6).alias(c) for c in _EXP_STATS])


# ship2 = ship + an all-NULL jitter column, for the column screens
ORACLES["nonnull_counts"] = ORACLES["nonnull_counts"].replace(
    "\nSELECT", ",\nship2 AS (SELECT *, CAST(NULL AS DOUBLE) AS jitter_mean FROM ship)\nSELECT", 1)
ORACLES["nonconstant_columns"] = ORACLES["nonconstant_columns"].replace(
    "\nSELECT", ",\nship2 AS (SELECT *, CAST(NULL AS DOUBLE) AS jitter_mean FROM ship)\nSELECT", 1)
