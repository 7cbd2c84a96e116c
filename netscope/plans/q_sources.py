"""Registered source/sink queries: JSON experiment scan and flatten, series
explosion, ingest tagging, file row counts, fingerprints and exact samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from netscope.functions.exprs import ts_text
from netscope.plans.derive import DOCUMENTS_SQL, POINTS_SQL, write_documents, write_raw_json
from netscope.plans.registry import query
from netscope.plans.standins import table
from netscope.sources import experiments as E
from netscope.sources.ingest import ingest
from netscope.sources.parquet import file_row_counts

_EXP_COLS = ["provider", "proto", "exp_name", "start_ts", "duration_s", "region_pair", "target_bwd", "tput_n"]
_EXP_STATS = ["tput_mean", "tput_median", "tput_min", "tput_max", "tput_std", "tput_pctl5", "tput_pctl95"]


@query("experiment_build", sql=f"""WITH {POINTS_SQL}
SELECT provider, proto, exp_name, start_ts, duration_s, region_snd || '->' || region_rcv AS region_pair, target_bwd,
       tput_n, {", ".join(f"ROUND({c}, 6) AS {c}" for c in _EXP_STATS)}
FROM rec""")
def q_experiment_build(spark, sf):
    root = write_raw_json(spark, sf)
    exp = E.flatten(E.read_raw(spark, root, "*.json", multiline=False), root)
    return exp.select(*_EXP_COLS, *[F.round(c, 6).alias(c) for c in _EXP_STATS])


@query("series_explode", sql=f"""WITH {POINTS_SQL}
SELECT 'u' || user_id || '-' || event_type || '-' || blk AS exp_name, 'tput' AS metric,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(sec), '%Y-%m-%d %H:%M:%S') AS ts, ROUND(value, 6) AS value
FROM pts""")
def q_series_explode(spark, sf):
    root = write_raw_json(spark, sf)
    s = E.explode_series(E.read_raw(spark, root, "*.json", multiline=False), root)
    return s.select("exp_name", "metric", ts_text("ts").alias("ts"), F.round("value", 6).alias("value"))


@query("ingest_tagged", sql=f"""WITH {POINTS_SQL}
SELECT provider, event_type AS region, 'm3.xlarge' AS vm_size,
       'tput_' || CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'tcp' ELSE 'udp' END AS l4_protocol,
       COUNT(*) AS n_records
FROM (SELECT DISTINCT provider, user_id, event_type, blk FROM pts) t GROUP BY ALL""")
def q_ingest_tagged(spark, sf):
    root = write_raw_json(spark, sf)
    tagged, _skipped = ingest(spark, root, whole_file=False)
    return tagged.groupBy("provider", "region", "vm_size", "l4_protocol").agg(F.count(F.lit(1)).alias("n_records"))


@query("file_listing", sql=f"""WITH {DOCUMENTS_SQL}
SELECT DISTINCT rel_path, kind = 4 AS is_empty FROM named""")
def q_file_listing(spark, sf):
    """Names and emptiness of all files, listed by tasks."""
    from netscope.sources.ingest import listing
    return listing(spark, write_documents(spark, sf)).select("rel_path", (F.col("length") == 0).alias("is_empty"))


@query("ingest_documents", sql=f"""WITH {DOCUMENTS_SQL}
SELECT split_part(rel_path, '/', 1) AS provider, 'US-EU' AS region, 'm3.xlarge' AS vm_size, 'udp' AS l4_protocol,
       'e' || event_id AS exp_name, event_type AS proto
FROM named WHERE kind IN (0, 7) AND NOT (kind = 7 AND event_type = 'error') OR kind = 1 AND first_of_file""")
def q_ingest_documents(spark, sf):
    """S6 + S7: records of array and object documents, with their context tags."""
    tagged, _ = ingest(spark, write_documents(spark, sf))
    return tagged.select("provider", "region", "vm_size", "l4_protocol", "exp_name", "proto")


@query("ingest_rejects", sql=f"""WITH {DOCUMENTS_SQL}
SELECT rel_path, CASE kind WHEN 2 THEN 'not_json' WHEN 3 THEN 'short_path' WHEN 4 THEN 'empty' WHEN 5 THEN 'invalid_json'
                 ELSE 'not_object' END AS reason,
       CAST(CASE WHEN kind = 7 THEN COUNT(*) FILTER (event_type = 'error') ELSE 1 END AS BIGINT) AS n
FROM named WHERE kind >= 2 GROUP BY ALL HAVING n > 0""".replace("GROUP BY ALL", "GROUP BY rel_path, kind"))
def q_ingest_rejects(spark, sf):
    """skipped files and skipped array members, with the reason."""
    root = write_documents(spark, sf)
    _, skipped = ingest(spark, root)
    rel = F.substring_index("path", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    return skipped.groupBy(rel.alias("rel_path"), "reason").agg(F.count(F.lit(1)).alias("n"))


_DOCUMENT_EXPERIMENTS = f"""WITH {DOCUMENTS_SQL}
SELECT split_part(rel_path, '/', 1) AS provider, 'e' || event_id AS exp_name, event_type AS proto, sec AS start_ts,
       ROUND(value, 6) AS tput_mean
FROM named WHERE event_type <> 'signup' AND (kind IN (0, 3) OR kind = 1 AND first_of_file)"""


@query("experiment_documents", sql=_DOCUMENT_EXPERIMENTS)
def q_experiment_documents(spark, sf):
    """Experiments from whole-file documents, arrays and objects; a document that isn't made of records
    throughout is a reject as a whole."""
    root = write_documents(spark, sf)
    exp = E.flatten(E.read_raw(spark, root, "*.json"), root)
    return exp.select("provider", "exp_name", "proto", "start_ts", F.round("tput_mean", 6).alias("tput_mean"))


@query("experiment_stream", sql=_DOCUMENT_EXPERIMENTS)
def q_experiment_stream(spark, sf):
    """K5: the same documents through the file stream into Parquet, run twice (nothing arrives twice)."""
    from netscope.session import unique_subdir
    from netscope.streaming.ingest_stream import run_available
    root, out, state = write_documents(spark, sf), unique_subdir(spark, "stream-out"), unique_subdir(spark, "stream-state")
    for _ in range(2):
        run_available(spark, root, out, state, "*.json")
    return spark.read.parquet(out).select("provider", "exp_name", "proto", "start_ts",
                                          F.round("tput_mean", 6).alias("tput_mean"))


@query("experiment_rejects", sql=f"""WITH {DOCUMENTS_SQL}
SELECT rel_path, CASE WHEN kind = 4 THEN 'empty' WHEN kind IN (5, 6, 7) THEN 'invalid_json' ELSE 'no_results' END AS reason,
       CAST(CASE WHEN kind IN (0, 1, 3) THEN COUNT(*) FILTER (event_type = 'signup' AND (kind <> 1 OR first_of_file))
            ELSE 1 END AS BIGINT) AS n
FROM named WHERE kind <> 2 GROUP BY rel_path, kind
HAVING n > 0 AND (kind <> 7 OR COUNT(*) FILTER (event_type = 'error') > 0)""")
def q_experiment_rejects(spark, sf):
    """documents and records without an experiment, with the reason."""
    root = write_documents(spark, sf)
    rel = F.substring_index("path", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    return E.rejects(spark, root, "*.json").groupBy(rel.alias("rel_path"), "reason").agg(F.count(F.lit(1)).alias("n"))


_TABLES = ["lineitem", "orders", "customer", "supplier", "part", "events"]


@query("file_row_counts", sql=" UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS rows FROM {t}" for t in _TABLES))
def q_file_row_counts(spark, sf):
    out = None
    for t in _TABLES:
        c = file_row_counts(table(spark, sf, t))
        out = c if out is None else out.unionByName(c)
    return out


# The canonical row text of ``operators.lineage.row_digest`` over events, in SQL.
_EVENT_TEXT = " || ".join(f"coalesce(length({t})::VARCHAR || ':' || {t}, '-')" for t in (
    "event_id::VARCHAR", "user_id::VARCHAR", "event_type"))


@query("table_fingerprint", sql=f"""
SELECT COUNT(*) AS n_rows, CAST(SUM(CAST('0x' || substr(md5({_EVENT_TEXT}), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS content_hash
FROM events""")
def q_table_fingerprint(spark, sf):
    """Order-free content hash of a table + row count (its exact-text columns: engines print
    floating-point numbers and times differently)."""
    from netscope.operators.lineage import fingerprint
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return fingerprint(e).select("n_rows", "content_hash")


@query("table_fingerprint_all")
def q_table_fingerprint_all(spark, sf):
    """Fingerprint of every column of the whole tables, with the schema's hash (no SQL: engines print
    floating-point numbers and times differently)."""
    from netscope.operators.lineage import fingerprint
    out = None
    for t in ("lineitem", "events"):
        f = fingerprint(table(spark, sf, t)).select(F.lit(t).alias("table_name"), "*")
        out = f if out is None else out.unionByName(f)
    return out


# The canonical text of ``operators.lineage.canonical_text``, in SQL.
def _exact_double(c: str) -> str:
    e0 = f"floor(log2(abs({c})))"
    e = f"({e0} + CASE WHEN pow(2.0::DOUBLE, {e0} + 1) <= abs({c}) THEN 1 WHEN pow(2.0::DOUBLE, {e0}) > abs({c}) THEN -1 ELSE 0 END)"
    half = f"floor((52 - {e}) / 2)"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN isnan({c}) THEN 'nan' WHEN {c} = 0 THEN '0' WHEN isinf({c}) THEN "
            f"CASE WHEN {c} > 0 THEN 'inf' ELSE '-inf' END ELSE CASE WHEN {c} < 0 THEN '-' ELSE '' END || "
            f"(abs({c}) * pow(2.0::DOUBLE, {half}) * pow(2.0::DOUBLE, 52 - {e} - {half}))::BIGINT || 'p' || ({e})::INTEGER END")


_CANONICAL = {
    "events": ["event_id::VARCHAR", "epoch_us(ts)::VARCHAR", "user_id::VARCHAR", "event_type", _exact_double("value"), "props"],
    "lineitem": [*(f"{c}::VARCHAR" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
                 *map(_exact_double, ("l_quantity", "l_extendedprice", "l_discount", "l_tax")), "l_returnflag",
                 "l_linestatus", "epoch_us(l_shipdate)::VARCHAR"]}


def _fingerprint_sql(name: str, texts: list[str]) -> str:
    row = " || ".join(f"coalesce(length(t{i})::VARCHAR || ':' || t{i}, '-')" for i in range(len(texts)))
    inner = ", ".join(f"{t} AS t{i}" for i, t in enumerate(texts))
    return (f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows, CAST(SUM(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)"
            f"::HUGEINT) AS VARCHAR) AS content_hash FROM (SELECT {inner} FROM {name})")


@query("table_fingerprint_columns", sql=" UNION ALL ".join(_fingerprint_sql(*x) for x in _CANONICAL.items()))
def q_table_fingerprint_columns(spark, sf):
    """Fingerprint over every column of the whole tables, from canonical texts."""
    from netscope.operators.lineage import canonical, fingerprint
    out = None
    for t in _CANONICAL:
        f = fingerprint(canonical(table(spark, sf, t))).select(F.lit(t).alias("table_name"), "n_rows", "content_hash")
        out = f if out is None else out.unionByName(f)
    return out


@query("sample_exact", sql="""
SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5('42:' || event_id::VARCHAR), event_id LIMIT 1000""")
def q_sample_exact(spark, sf):
    """Exactly 1,000 rows (when more exist) chosen by a seeded hash of the key."""
    from netscope.operators.sampling import sample_exact
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return sample_exact(e, 1000, key="event_id", seed=42)


@query("stratified_split", sql="""
SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id::VARCHAR), event_id)
  <= CASE WHEN c < 2 THEN c ELSE least(greatest(floor(c * 0.8), 1), c - 1) END THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS c FROM events)""")
def q_stratified_split(spark, sf):
    """Exact 80/20 split within every event type."""
    from netscope.operators.sampling import stratified_split
    return stratified_split(table(spark, sf, "events").select("event_id", "event_type"), "event_id", "event_type")


_STATS = ["mean", "median", "min", "max", "std", "pctl5", "pctl25", "pctl75", "pctl95"]


@query("summary_check", sql=f"""WITH {POINTS_SQL}
,pt AS (SELECT 'u' || user_id || '-' || event_type || '-' || blk AS exp_name, value FROM pts),
again AS (SELECT exp_name, COUNT(*) AS n, SUM(value) / COUNT(*) AS mean, QUANTILE_CONT(value, 0.5) AS median,
                 MIN(value) AS min, MAX(value) AS max, SQRT(VAR_POP(value)) AS std, QUANTILE_CONT(value, 0.05) AS pctl5,
                 QUANTILE_CONT(value, 0.25) AS pctl25, QUANTILE_CONT(value, 0.75) AS pctl75,
                 QUANTILE_CONT(value, 0.95) AS pctl95 FROM pt GROUP BY exp_name)
SELECT COUNT(*) AS n_experiments, CAST(SUM(CASE WHEN r.tput_n <> a.n THEN 1 ELSE 0 END) AS BIGINT) AS n_count_mismatch,
       {", ".join(f"ROUND(MAX(ABS(r.tput_{s} - a.{s})), 6) AS max_diff_{s}" for s in _STATS)}
FROM rec r JOIN again a USING (exp_name)""")
def q_summary_check(spark, sf):
    """Statistics stored in the JSON records vs statistics recomputed from their points."""
    from netscope.operators.series import compare_summaries
    root = write_raw_json(spark, sf)
    raw = E.read_raw(spark, root, "*.json", multiline=False)
    exp = E.flatten(raw, root)
    pts = E.explode_series(raw, root).where(F.col("metric") == "tput")
    out = compare_summaries(exp, pts, "exp_name")
    return out.select("n_experiments", "n_count_mismatch",
                      *[F.round(F.col(f"max_diff_{s}"), 6).alias(f"max_diff_{s}") for s in _STATS])


_GENERIC_COLS = ["exp_name", "proto", "start", "duration", "camp_region_snd", "camp_region_rcv", "camp_size_snd",
                 "info_snd_tool", "info_snd_target_bwd", "info_rcv_tool"]
_GENERIC_META = ["path_provider", "path_vm_size", "path_protocol"]


@query("generic_flatten", sql=f"""WITH {POINTS_SQL},
r2 AS (SELECT provider, 'u' || user_id || '-' || event_type || '-' || blk AS exp_name,
              CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'tcp' ELSE 'udp' END AS proto,
              CAST(MIN(sec) AS VARCHAR) AS start, CAST(MAX(sec) - MIN(sec) AS VARCHAR) AS duration,
              'user-' || user_id AS camp_region_snd, event_type AS camp_region_rcv, 'm3.xlarge' AS camp_size_snd,
              'NUTTCP_S' AS info_snd_tool, CAST(COUNT(*) * 1000 AS VARCHAR) AS info_snd_target_bwd,
              'NUTTCP_R' AS info_rcv_tool, (COUNT(*) + MAX(sec) - MIN(sec)) / 2.0 AS marks_mean, '2' AS marks_count,
              provider AS path_provider, 'XLarge' AS path_vm_size, CASE WHEN event_type IN ('click', 'view', 'purchase')
              THEN 'TCP_Throughput' ELSE 'UDP_Throughput' END AS path_protocol
       FROM pts GROUP BY provider, user_id, event_type, blk)
SELECT {", ".join([*_GENERIC_COLS, *_GENERIC_META])}, marks_count, ROUND(marks_mean, 6) AS marks_mean FROM r2""")
def q_generic_flatten(spark, sf):
    """S3 + P11 + P13: schema-free JSON records flattened one level (scalars, numeric lists, object members;
    the nested ``results`` level is dropped) with path metadata, over JSON derived from ``events``."""
    from netscope.sources.generic_json import flatten_records, read_records
    root = write_raw_json(spark, sf)
    columns = [*_GENERIC_COLS, "marks_mean", "marks_count"]
    wide = flatten_records(read_records(spark, root, "*.json", whole_file=False), root, columns, merge=False)
    return wide.select(*_GENERIC_COLS, *_GENERIC_META, "marks_count",
                       F.round(F.col("marks_mean").cast("double"), 6).alias("marks_mean"))
