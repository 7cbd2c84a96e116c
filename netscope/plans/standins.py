"""Stand-in views over the driver tables.

The reference's data shapes (EXPERIMENT, SERIES, and a dimension-rich
experiment table) are built from the driver's parquet tables so that every
registered query grows with them:

- ``exp``    : ``events`` grouped by (user_id, day) with the nine summary
               statistics of ``value`` plus its count; plays EXPERIMENT.
- ``series`` : ``events`` as (exp_id=user_id, metric=event_type, ts, value).
- ``ship``   : lineitem + orders + customer + supplier + nation/region; regions
               and sizes play the sender/receiver dimensions, KPIs come from
               quantities, discounts and dates.

Each builder has a matching SQL text (``*_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.operators.series import summary_stats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- series

def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("exp_id"), F.col("event_type").alias("metric"),
                    "ts", "value", "event_id")


SERIES_SQL = """series AS (
  SELECT user_id AS exp_id, event_type AS metric, ts, value, event_id FROM events)"""


# ---------------------------------------------------------------- exp

def exp(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").cast("string").alias("day"), "value")
    return summary_stats(e, ["user_id", "day"], "value", prefix="tput_")


EXP_SQL = """exp AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
         COUNT(value) AS tput_n, AVG(value) AS tput_mean, MEDIAN(value) AS tput_median,
         MIN(value) AS tput_min, MAX(value) AS tput_max, STDDEV_POP(value) AS tput_std,
         QUANTILE_CONT(value, 0.05) AS tput_pctl5, QUANTILE_CONT(value, 0.25) AS tput_pctl25,
         QUANTILE_CONT(value, 0.75) AS tput_pctl75, QUANTILE_CONT(value, 0.95) AS tput_pctl95
  FROM events GROUP BY user_id, CAST(CAST(ts AS DATE) AS VARCHAR))"""

EXP_FEATURES = ["tput_n", "tput_mean", "tput_pctl95", "tput_pctl5"]


# ---------------------------------------------------------------- ship

def ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with sender (supplier) and receiver (customer) dimensions.

    Joins are declared plainly; Catalyst/AQE choose broadcast for the dimension
    tables from their measured size and sort-merge for the large ones.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                              "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", F.col("r_name").alias("region_rcv"))
    supp = s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        "s_suppkey", F.col("r_name").alias("region_snd"))
    # join order chosen for scale: orders x customer first (the smaller fact side
    # meets its dimension), then the lineitem fact joins once on orderkey, then the
    # supplier side; nation/region are 25/5 rows and are broadcast by size
    oc = o.join(cust, o.o_custkey == cust.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(supp, li.l_suppkey == supp.s_suppkey)
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_returnflag").alias("provider"),
        F.col("l_linestatus").alias("proto"),
        "region_snd", "region_rcv",
        F.col("o_orderpriority").alias("size_snd"),
        F.col("c_mktsegment").alias("size_rcv"),
        F.col("o_orderstatus").alias("tool"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("double").alias("delay_mean"),
        F.col("l_quantity").alias("tput_mean"),
        (F.col("l_discount") * 100).alias("loss_mean"),
        F.col("l_tax").alias("granularity_snd"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)) * 10).alias("granularity_rcv"),
        F.col("l_extendedprice").alias("target_bwd"),
        F.col("l_shipdate").alias("ts"),
    )


SHIP_SQL = """ship AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         l.l_returnflag AS provider, l.l_linestatus AS proto,
         rs.r_name AS region_snd, rc.r_name AS region_rcv,
         o.o_orderpriority AS size_snd, c.c_mktsegment AS size_rcv, o.o_orderstatus AS tool,
         CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS DOUBLE) AS delay_mean,
         l.l_quantity AS tput_mean, l.l_discount * 100 AS loss_mean,
         l.l_tax AS granularity_snd, NULLIF(l.l_discount, 0.0) * 10 AS granularity_rcv,
         l.l_extendedprice AS target_bwd, l.l_shipdate AS ts
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN region rc ON nc.n_regionkey = rc.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN region rs ON ns.n_regionkey = rs.r_regionkey)"""

SHIP_NUMERIC = ["delay_mean", "tput_mean", "loss_mean", "granularity_snd", "granularity_rcv", "target_bwd"]
SHIP_DIMS = ["provider", "proto", "region_snd", "region_rcv", "size_snd", "size_rcv", "tool"]


def with_views(sql: str, *views: str) -> str:
    """Prefix an oracle query with the stand-in CTEs it names."""
    parts = {"ship": SHIP_SQL, "exp": EXP_SQL, "series": SERIES_SQL}
    ctes = [parts[v] for v in views]
    if not ctes:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
