"""Experiment JSON scan and flattening (RAW -> EXPERIMENT, RAW -> SERIES).

A results file holds one JSON object or an array of objects.  Spark's JSON
reader with ``multiLine`` turns an array into one row per element; corrupt
text and non-object JSON land in the corrupt-record column; an empty file
yields no row at all, so empty files come from the listing source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netscope.functions.exprs import epoch_to_ts, falsy_coalesce, region_pair, safe_double
from netscope.sources.listing import list_files

METRICS = ("tput", "delay", "loss", "jitter")
STATS = ("mean", "median", "min", "max", "std", "pctl5", "pctl25", "pctl75", "pctl95")
CORRUPT = "_corrupt_record"

_S = T.StringType()
_INFO = T.StructType([T.StructField(n, _S) for n in (
    "protocol", "ip_receiver", "exp_name", "tool", "ip_agent", "duration", "ip_exp_sender", "ip_sender", "port",
    "ip_exp_receiver", "target_bwd", "granularity", "pkt_size", "flags")] + [T.StructField("start_time", T.LongType())])
_SYNT = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])
# ``detailed`` is kept as JSON text: it is an object (epoch -> value) in the data
# but a list is allowed too; it is parsed per form below.
_METRIC = T.StructType([T.StructField("detailed", _S), T.StructField("synt", _SYNT)])
RAW_SCHEMA = T.StructType([
    T.StructField("start", T.LongType()),
    T.StructField("start_time", T.LongType()),
    T.StructField("proto", _S),
    T.StructField("protocol", _S),
    T.StructField("exp_name", _S),
    T.StructField("duration", _S),
    T.StructField("camp", T.StructType([T.StructField(n, _S) for n in
                                        ("region_snd", "region_rcv", "size_snd", "size_rcv")])),
    T.StructField("info_snd", _INFO),
    T.StructField("info_rcv", _INFO),
    T.StructField("results", T.StructType([T.StructField(m, _METRIC) for m in METRICS])),
    T.StructField(CORRUPT, _S),
])

EXPERIMENT_IDS = ["provider", "proto", "exp_name", "start_ts", "start_dt", "duration_s", "region_snd", "region_rcv",
                  "region_pair", "size_snd", "size_rcv", "tool_snd", "tool_rcv", "ip_sender", "ip_receiver", "port",
                  "granularity_snd", "granularity_rcv", "target_bwd", "source_path"]
EXPERIMENT_METRICS = sorted([f"{m}_{s}" for m in METRICS for s in STATS] + [f"{m}_n" for m in METRICS])


def discover(spark: SparkSession, root: str, glob: str = "*_results.json") -> DataFrame:
    """Recursive listing (path, length, modificationTime) by tasks; contents are not read."""
    return list_files(spark, root, glob).withColumnRenamed("modified", "modificationTime")


def read_raw(spark: SparkSession, root: str, glob: str = "*_results.json", multiline: bool = True) -> DataFrame:
    """RAW rows with the file path; corrupt or non-object JSON keeps only ``_corrupt_record``.

    ``multiline`` parses each file as one document (object or array); without it
    every line is a record (JSON Lines)."""
    return (spark.read.schema(RAW_SCHEMA).option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).json(root)
            .withColumn("source_path", F.col("_metadata.file_path")))


def rejects(spark: SparkSession, root: str, glob: str = "*_results.json", multiline: bool = True) -> DataFrame:
    """Files or records that yield no experiment: (path, reason)."""
    raw = read_raw(spark, root, glob, multiline)
    empty = list_files(spark, root, glob).where("length = 0").select("path", F.lit("empty").alias("reason"))
    # one pass over the records; the corrupt column is read together with parsed fields
    reason = (F.when(F.col(CORRUPT).isNotNull(), F.lit("invalid_json"))
              .when(~_has_results(), F.lit("no_results")))
    bad = raw.select(F.regexp_replace("source_path", "^file:/+", "file:/").alias("path"), reason.alias("reason")).where(F.col("reason").isNotNull())
    return empty.unionByName(bad)


def _has_results():
    return F.coalesce(*[F.col(f"results.{m}") for m in METRICS]).isNotNull()


def provider_from_path(path_col, root: str) -> F.Column:
    """First segment under ``root`` (``key=value`` dirs give the value), else ``Unknown``."""
    root = root.rstrip("/")
    rel = F.regexp_replace(path_col, r"^(file:)?/*", "/")
    rroot = "/" + root.lstrip("/") if not root.startswith("file:") else "/" + root[5:].lstrip("/")
    seg = F.regexp_extract(rel, "^" + _re_escape(rroot) + r"/([^/]+)/", 1)
    seg = F.regexp_replace(seg, r"^[^=/]+=", "")
    return F.coalesce(F.nullif(seg, F.lit("")), F.lit("Unknown"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def detailed_count(detailed) -> F.Column:
    obj = F.from_json(detailed, T.MapType(_S, _S))
    arr = F.from_json(detailed, T.ArrayType(_S))
    trimmed = F.ltrim(detailed)
    return (F.when(trimmed.startswith("{"), F.size(obj))
            .when(trimmed.startswith("["), F.size(arr))
            .otherwise(F.lit(None))).cast("bigint")


def flatten(raw: DataFrame, root: str) -> DataFrame:
    """P3 + F1 + P8-P10: one EXPERIMENT row per record with a non-empty ``results``."""
    r = raw.where(F.col(CORRUPT).isNull() & _has_results()) if CORRUPT in raw.columns else raw.where(_has_results())
    snd, rcv = "info_snd", "info_rcv"
    cols = {
        "provider": provider_from_path(F.col("source_path"), root),
        "proto": falsy_coalesce("proto", "protocol"),
        "exp_name": F.col("exp_name"),
        "start_ts": F.coalesce(F.nullif(F.col("start"), F.lit(0)), F.col("start_time")),
        "duration_s": safe_double("duration"),
        "region_snd": F.col("camp.region_snd"),
        "region_rcv": F.col("camp.region_rcv"),
        "region_pair": region_pair("camp.region_snd", "camp.region_rcv"),
        "size_snd": F.col("camp.size_snd"),
        "size_rcv": F.col("camp.size_rcv"),
        "tool_snd": F.col(f"{snd}.tool"),
        "tool_rcv": F.col(f"{rcv}.tool"),
        "ip_sender": falsy_coalesce(f"{snd}.ip_sender", f"{rcv}.ip_sender"),
        "ip_receiver": falsy_coalesce(f"{snd}.ip_receiver", f"{rcv}.ip_receiver"),
        "port": falsy_coalesce(f"{snd}.port", f"{rcv}.port"),
        "granularity_snd": safe_double(f"{snd}.granularity"),
        "granularity_rcv": safe_double(f"{rcv}.granularity"),
        "target_bwd": safe_double(falsy_coalesce(f"{snd}.target_bwd", f"{rcv}.target_bwd")),
        "source_path": F.col("source_path"),
    }
    out = r.select(*[v.alias(k) for k, v in cols.items()],
                   *[F.col(f"results.{m}.synt.{s}").alias(f"{m}_{s}") for m in METRICS for s in STATS],
                   *[detailed_count(F.col(f"results.{m}.detailed")).alias(f"{m}_n") for m in METRICS])
    out = out.withColumn("start_dt", epoch_to_ts("start_ts"))
    return out.select(*EXPERIMENT_IDS, *EXPERIMENT_METRICS)


def experiment_id(df: DataFrame) -> F.Column:
    return F.xxhash64("source_path", "exp_name", "start_ts")


def explode_series(raw: DataFrame, root: str) -> DataFrame:
    """RAW ``detailed`` objects -> SERIES (exp_id, metric, ts, value); narrow, no shuffle."""
    r = raw.where(F.col(CORRUPT).isNull() & _has_results()) if CORRUPT in raw.columns else raw
    start = F.coalesce(F.nullif(F.col("start"), F.lit(0)), F.col("start_time"))
    base = r.select(F.xxhash64("source_path", "exp_name", start).alias("exp_id"), "exp_name",
                    *[F.col(f"results.{m}.detailed").alias(m) for m in METRICS])
    parts = []
    for m in METRICS:
        mp = F.from_json(F.col(m), T.MapType(_S, T.DoubleType()))
        parts.append(base.where(F.ltrim(F.col(m)).startswith("{"))
                     .select("exp_id", "exp_name", F.lit(m).alias("metric"), F.explode(mp).alias("k", "value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("exp_id", "exp_name", "metric", epoch_to_ts("k").alias("ts"), "value")
