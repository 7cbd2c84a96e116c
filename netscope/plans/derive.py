"""Raw experiment JSON derived from the driver's ``events`` table.

The reference's inputs are nested JSON result files.  To run the JSON scan,
flattening and series explosion over data that grows with the driver tables,
``events`` are turned into result records and written as JSON text under the
shared folder (a fresh sub-folder per call):

- one record per (provider, user, event type, 30 days of the epoch): tens of points each, and a bounded
  number of them (at most one per second of the 30 days);
- ``results.tput.detailed`` maps epoch seconds to the mean value in that second,
  ``results.tput.synt`` holds the nine summary statistics of those points;
- files are laid out as ``<root>/provider=<AWS|Azure>/vm=<size>_tput_<proto>/region=<type>/*.json``
  (JSON Lines: one record per line).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from netscope.functions.exprs import map_values
from netscope.operators.series import PCTLS
from netscope.plans.standins import table
from netscope.session import unique_subdir

BLOCK = 30 * 86_400
# event type -> provider / protocol of the derived records
PROVIDER_OF = {"click": "AWS", "view": "AWS", "signup": "AWS", "purchase": "Azure", "error": "Azure"}
PROTO_OF = {"click": "tcp", "view": "tcp", "signup": "udp", "purchase": "tcp", "error": "udp"}

POINTS_SQL = f"""pts AS (
  SELECT CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'AWS' ELSE 'Azure' END AS provider,
         user_id, event_type, epoch_us(ts) // 1000000 // {BLOCK} AS blk, epoch_us(ts) // 1000000 AS sec, AVG(value) AS value
  FROM events GROUP BY ALL),
rec AS (
  SELECT provider, 'u' || user_id || '-' || event_type || '-' || blk AS exp_name,
         CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'tcp' ELSE 'udp' END AS proto,
         'user-' || user_id AS region_snd, event_type AS region_rcv,
         MIN(sec) AS start_ts, CAST(MAX(sec) - MIN(sec) AS DOUBLE) AS duration_s,
         CAST(COUNT(*) * 1000 AS DOUBLE) AS target_bwd,
         COUNT(*) AS tput_n, AVG(value) AS tput_mean, MEDIAN(value) AS tput_median, MIN(value) AS tput_min,
         MAX(value) AS tput_max, STDDEV_POP(value) AS tput_std, QUANTILE_CONT(value, 0.05) AS tput_pctl5,
         QUANTILE_CONT(value, 0.25) AS tput_pctl25, QUANTILE_CONT(value, 0.75) AS tput_pctl75,
         QUANTILE_CONT(value, 0.95) AS tput_pctl95
  FROM pts GROUP BY provider, user_id, event_type, blk)"""


def write_raw_json(spark: SparkSession, sf_dir: str) -> str:
    e = table(spark, sf_dir, "events")
    pts = (e.select(map_values("event_type", PROVIDER_OF).alias("provider"), "user_id", "event_type",
                    F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / BLOCK).cast("bigint").alias("blk"),
                    F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec"), "value")
           .groupBy("provider", "user_id", "event_type", "blk", "sec").agg(F.avg("value").alias("value")))
    v = F.col("value")
    q = F.percentile(v, F.array(*[F.lit(p) for p in PCTLS]))
    rec = pts.groupBy("provider", "user_id", "event_type", "blk").agg(
        F.min("sec").alias("start"), (F.max("sec") - F.min("sec")).alias("dur"), F.count(F.lit(1)).alias("n"),
        F.map_from_entries(F.collect_list(F.struct(F.col("sec").cast("string"), v))).alias("detailed"),
        F.struct(F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"),
                 F.stddev_pop(v).alias("std"), q[0].alias("pctl5"), q[1].alias("pctl25"), q[2].alias("pctl75"),
                 q[3].alias("pctl95")).alias("synt"))
    proto = map_values("event_type", PROTO_OF)
    doc = F.struct(
        F.col("start"),
        proto.alias("proto"),
        F.concat(F.lit("u"), F.col("user_id"), F.lit("-"), F.col("event_type"), F.lit("-"), F.col("blk")).alias("exp_name"),
        F.col("dur").cast("string").alias("duration"),
        F.struct(F.concat(F.lit("user-"), F.col("user_id")).alias("region_snd"), F.col("event_type").alias("region_rcv"),
                 F.lit("m3.xlarge").alias("size_snd"), F.lit("m3.xlarge").alias("size_rcv")).alias("camp"),
        F.struct(F.lit("NUTTCP_S").alias("tool"), F.lit("1").alias("granularity"),
                 (F.col("n") * 1000).cast("string").alias("target_bwd"), F.col("start").alias("start_time")).alias("info_snd"),
        F.struct(F.lit("NUTTCP_R").alias("tool")).alias("info_rcv"),
        F.array(F.col("n"), F.col("dur")).alias("marks"),
        F.struct(F.struct(F.col("detailed"), F.col("synt")).alias("tput")).alias("results"),
    )
    out = unique_subdir(spark, "raw-json")
    (rec.select("provider", F.concat(F.lit("m3.xlarge_tput_"), proto).alias("vm"),
                F.col("event_type").alias("region"), doc.alias("d"))
     .select("provider", "vm", "region", "d.*")
     .write.partitionBy("provider", "vm", "region").json(out))
    return out


# Files of ``write_documents``: 256 events each, of eight kinds by the file's number.
FILE_EVENTS = 256
DOCUMENTS_SQL = f"""files AS (
  SELECT event_id // {FILE_EVENTS} AS f, (event_id // {FILE_EVENTS}) % 8 AS kind, event_id, event_type, value,
         epoch_us(ts) // 1000000 AS sec,
         event_id = MIN(event_id) OVER (PARTITION BY event_id // {FILE_EVENTS}) AS first_of_file
  FROM events),
named AS (
  SELECT *, CASE WHEN kind = 3 THEN 'AWS' ELSE CASE WHEN f % 3 = 0 THEN 'Azure' ELSE 'AWS' END || '/m3.xlarge_udp/US-EU' END
         || '/f' || f || CASE WHEN kind = 2 THEN '.txt' ELSE '.json' END AS rel_path
  FROM files)"""


def write_documents(spark: SparkSession, sf_dir: str) -> str:
    """Result files as single documents, good and bad ones, derived from all ``events``.

    Kind of a file by its number modulo 8: 0 an array of records, 1 one object (its first event), 2 records
    under a ``.txt`` name, 3 an array right below the provider's folder, 4 an empty file, 5 an array cut in
    its middle, 6 a bare number, 7 an array in which the records of ``error`` events are plain strings.
    Records of ``signup`` events have empty results."""
    from netscope.sinks import write_objects
    e = table(spark, sf_dir, "events")
    f = F.floor(F.col("event_id") / FILE_EVENTS).cast("bigint")
    sec = F.unix_seconds(F.col("ts").cast("timestamp"))
    name = F.concat(F.lit("e"), "event_id")
    tput = F.when(F.col("event_type") != "signup", F.struct(F.struct(F.col("value").alias("mean")).alias("synt")))
    record = F.to_json(F.struct(sec.alias("start"), F.col("event_type").alias("proto"), name.alias("exp_name"),
                                F.struct(tput.alias("tput")).alias("results")))
    kind = F.col("f") % 8
    member = F.when((kind == 7) & (F.col("event_type") == "error"), F.concat(F.lit('"'), name, F.lit('"'))).otherwise(record)
    docs = (e.select(f.alias("f"), "event_id", "event_type", "value", "ts")
            .select("f", "event_id", member.alias("member"))
            .groupBy("f").agg(F.array_sort(F.collect_list(F.struct("event_id", "member"))).getField("member").alias("m")))
    array = F.concat(F.lit("["), F.array_join("m", ",\n"), F.lit("]"))
    text = (F.when(kind == 1, F.col("m")[0]).when(kind == 4, F.lit(""))
            .when(kind == 5, F.substring(array, F.lit(1), F.length(array) - 5)).when(kind == 6, F.col("f").cast("string"))
            .otherwise(array))
    provider = F.when((F.col("f") % 3 == 0) & (kind != 3), F.lit("Azure")).otherwise(F.lit("AWS"))
    rel = F.concat(provider, F.when(kind == 3, F.lit("")).otherwise(F.lit("/m3.xlarge_udp/US-EU")), F.lit("/f"),
                   F.col("f").cast("string"), F.when(kind == 2, F.lit(".txt")).otherwise(F.lit(".json")))
    out = unique_subdir(spark, "documents")
    write_objects(docs.select(rel.alias("rel_path"), text.alias("text")), out)
    return out
