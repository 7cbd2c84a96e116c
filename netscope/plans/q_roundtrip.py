"""Registered queries for cleaning helpers, splits, and write/read round trips over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope import sinks
from netscope.functions import exprs as X
from netscope.operators import clean as C
from netscope.operators import outliers as O
from netscope.operators import profile as P
from netscope.plans.catalog import SHIP_ALL
from netscope.plans.registry import query
from netscope.plans.standins import ship, table
from netscope.session import unique_subdir
from netscope.sources.parquet import read_partitioned, write_partitioned


@query("standard_pairs", sql="""
SELECT region_snd || '->' || region_rcv AS region_pair, 'NA->' || size_rcv AS vm_size_pair, 'NA->NA' AS provider_pair,
       COUNT(*) AS count FROM ship GROUP BY ALL""", views=("ship",))
def q_standard_pairs(spark, sf):
    """Nested regions, one flat size side, no providers."""
    s = ship(spark, sf).select(F.struct("region_snd", "region_rcv").alias("camp"), "size_rcv")
    return C.standard_pairs(s).groupBy("region_pair", "vm_size_pair", "provider_pair").agg(F.count(F.lit(1)).alias("count"))


@query("kpi_aliases", sql="""
SELECT proto, hour, dow, COUNT(*) AS count, ROUND(AVG(tput), 6) AS tput_mean, ROUND(AVG(delay), 6) AS delay_mean
FROM (SELECT lower(l_linestatus) AS proto, CAST(hour(l_shipdate) AS INTEGER) AS hour,
             CAST(isodow(l_shipdate) - 1 AS INTEGER) AS dow, l_quantity AS tput, l_tax AS delay FROM lineitem) t GROUP BY ALL""")
def q_kpi_aliases(spark, sf):
    """KPIs under other names, one of them nested, epoch start."""
    li = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("string").alias("throughput_mbps"),
        F.struct(F.struct(F.col("l_tax").alias("mean")).alias("synt")).alias("delay"), F.col("l_linestatus").alias("proto"),
        X.ts_to_epoch("l_shipdate").alias("start_time"))
    c = C.basic_clean(li)
    return c.groupBy("proto", "hour", "dow").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("tput_mean"), 6).alias("tput_mean"),
        F.round(F.avg("delay_mean"), 6).alias("delay_mean"))


@query("ints_to_double", sql="""
SELECT CAST(SUM(CAST(l_partkey AS DOUBLE)) AS DOUBLE) AS part_sum, 'double' AS part_type, 'string' AS flag_type FROM lineitem""")
def q_ints_to_double(spark, sf):
    """P26"""
    d = X.ints_to_double(table(spark, sf, "lineitem").select("l_partkey", "l_returnflag"))
    kinds = dict(d.dtypes)
    return d.agg(F.sum("l_partkey").alias("part_sum")).select(
        "part_sum", F.lit(kinds["l_partkey"]).alias("part_type"), F.lit(kinds["l_returnflag"]).alias("flag_type"))


@query("drop_empty_features", sql="""
SELECT 'granularity_rcv' AS feature, ROUND(AVG(COALESCE(granularity_rcv, (SELECT MEDIAN(granularity_rcv) FROM ship))), 6) AS mean FROM ship
UNION ALL SELECT 'tput_mean', ROUND(AVG(tput_mean), 6) FROM ship""", views=("ship",))
def q_drop_empty_features(spark, sf):
    """An all-missing candidate goes, the others are filled."""
    s = ship(spark, sf).select("tput_mean", "granularity_rcv", F.lit(None).cast("double").alias("jitter_mean"))
    d, feats = O.prepare_features(s, ["tput_mean", "jitter_mean", "granularity_rcv", "not_there"])
    wide = d.agg(*[F.round(F.avg(c), 6).alias(c) for c in feats])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean")) for c in feats])).alias("f")).select("f.*")


@query("finite_report", sql="""
SELECT CAST(COUNT(granularity_rcv) AS BIGINT) AS n_kept, CAST(COUNT(*) - COUNT(granularity_rcv) AS BIGINT) AS n_dropped FROM ship""",
       views=("ship",))
def q_finite_report(spark, sf):
    """F4"""
    return C.finite_report(ship(spark, sf), "granularity_rcv")


@query("parseable_dates", sql="""
SELECT strftime(CAST(o_orderdate AS DATE), '%Y') AS year, COUNT(*) AS count FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1""")
def q_parseable_dates(spark, sf):
    """every third text is no date."""
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return C.parseable_dates(o, "day").groupBy(F.substring("day", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("count"))


@query("hash_split", sql="""
SELECT event_id, CASE WHEN CAST('0x' || substr(md5('42:' || event_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 80
                 THEN 'train' ELSE 'test' END AS split FROM events""")
def q_hash_split(spark, sf):
    """U4"""
    from netscope.operators.sampling import hash_split
    return hash_split(table(spark, sf, "events").select("event_id"), "event_id")


@query("duplicate_rows", sql=f"""
SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_distinct, CAST(SUM(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT {', '.join(SHIP_ALL)}, COUNT(*) AS c FROM (SELECT * FROM ship UNION ALL SELECT * FROM ship WHERE l_linenumber = 1) u
      GROUP BY ALL) t""", views=("ship",))
def q_duplicate_rows(spark, sf):
    """A9 over whole rows, some of them twice."""
    s = ship(spark, sf)
    return P.duplicate_count(s.unionByName(s.where("l_linenumber = 1")))


@query("removed_duplicates", sql="""
WITH u AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 5 = 0)
SELECT CAST((SELECT COUNT(*) FROM u) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM u)) AS BIGINT) AS removed""")
def q_removed_duplicates(spark, sf):
    """A11 over whole rows: the removed count."""
    o = table(spark, sf, "orders")
    return C.drop_duplicates_counted(o.unionByName(o.where("o_orderkey % 5 = 0")))[1]


@query("partition_roundtrip", sql="""
SELECT event_type, COUNT(*) AS count, ROUND(SUM(value), 4) AS total FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""")
def q_partition_roundtrip(spark, sf):
    """Partitioned write, read of two partitions."""
    at = unique_subdir(spark, "partitioned")
    write_partitioned(table(spark, sf, "events").select("event_id", "event_type", "value"), at, ["event_type"])
    two = read_partitioned(spark, at, [("event_type", "in", ["click", "view"])])
    return two.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), F.round(F.sum("value"), 4).alias("total"))


@query("csv_roundtrip", sql="SELECT event_type, COUNT(*) AS count, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1")
def q_csv_roundtrip(spark, sf):
    """CSV files of bounded size, read by suffix, merged to Parquet."""
    at = unique_subdir(spark, "csv")
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    path = sinks.write_dataset(e, at, "csv", max_records_per_file=50_000)
    back = sinks.read_any(spark, sinks.merge_csv_to_parquet(spark, path, f"{at}/merged.parquet"))
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), F.round(F.sum("value"), 4).alias("total"))


@query("report_roundtrip", sql="SELECT event_type, COUNT(*) AS count FROM events GROUP BY 1")
def q_report_roundtrip(spark, sf):
    """K6"""
    at = unique_subdir(spark, "report")
    sinks.write_report_json(table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("count")), at)
    return spark.read.schema("event_type string, count bigint").json(at)


@query("clean_and_save", sql="""
SELECT COUNT(*) AS n_parquet, COUNT(*) AS n_csv, LEAST(COUNT(*), 1000) AS n_sample, COUNT(DISTINCT o_orderkey) AS n_keys FROM orders""")
def q_clean_and_save(spark, sf):
    """K2: both formats, an exact sample over whole rows, a summary."""
    at = unique_subdir(spark, "prepared")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = sinks.clean_and_save(o, at, 1000)
    n = {k: sinks.read_any(spark, out[k]) for k in ("parquet", "csv", "sample")}
    count = lambda k: n[k].agg(F.count(F.lit(1))).scalar()
    return n["parquet"].agg(F.count(F.lit(1)).alias("n_parquet"), F.countDistinct("o_orderkey").alias("n_keys")).select(
        "n_parquet", count("csv").alias("n_csv"), count("sample").alias("n_sample"), "n_keys")


@query("clean_and_save_content", sql="""
WITH s AS (SELECT * FROM orders ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey LIMIT 1000),
a AS (SELECT 'parquet' AS source, o_orderstatus, o_totalprice, o_orderkey FROM orders UNION ALL
      SELECT 'csv', o_orderstatus, o_totalprice, o_orderkey FROM orders UNION ALL
      SELECT 'sample', o_orderstatus, o_totalprice, o_orderkey FROM s)
SELECT source, o_orderstatus, COUNT(*) AS count, ROUND(SUM(o_totalprice), 2) AS total, CAST(SUM(o_orderkey) AS BIGINT) AS keys
FROM a GROUP BY source, o_orderstatus
UNION ALL SELECT 'summary', NULL, COUNT(*), 3.0, 2 FROM orders""")
def q_clean_and_save_content(spark, sf):
    """K2: what the written files hold: both formats by content, the sample by its rows, the summary's figures."""
    at = unique_subdir(spark, "prepared")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = sinks.clean_and_save(o, at, 1000, key="o_orderkey")
    rows = None
    for k in ("parquet", "csv", "sample"):
        one = sinks.read_any(spark, out[k]).groupBy(F.lit(k).alias("source"), "o_orderstatus").agg(
            F.count(F.lit(1)).alias("count"), F.round(F.sum("o_totalprice"), 2).alias("total"),
            F.sum("o_orderkey").cast("bigint").alias("keys"))
        rows = one if rows is None else rows.unionByName(one)
    facts = spark.read.schema("n_records bigint, n_features bigint, n_numeric bigint").json(out["summary"])
    return rows.unionByName(facts.select(F.lit("summary").alias("source"), F.lit(None).cast("string").alias("o_orderstatus"),
                                         F.col("n_records").alias("count"), F.col("n_features").cast("double").alias("total"),
                                         F.col("n_numeric").alias("keys")))


@query("overwrite_roundtrip", sql="""
SELECT event_type, COUNT(*) AS count, CAST(SUM(event_id) AS BIGINT) AS ids FROM events WHERE event_type <> 'click' GROUP BY 1""")
def q_overwrite_roundtrip(spark, sf):
    """A CSV dataset written again under its name; its newest file names the dataset that is read back."""
    at = unique_subdir(spark, "overwritten")
    e = table(spark, sf, "events").select("event_id", "event_type")
    for part in (e, e.where("event_type <> 'click'")):
        sinks.write_dataset(part, at, "csv", stamp=False, mode="overwrite")
    newest = sinks.latest_file(spark, at, "*.csv")
    back = sinks.read_any(spark, newest.rsplit("/", 1)[0])
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"), F.sum("event_id").cast("bigint").alias("ids"))
