"""Ingest job: list JSON objects under a root, parse path context, read the
documents, tag every record with five context columns, one table out.

Path layout: ``<provider>/<vm>_<proto>/<region>[/<az>]/<file>.json`` relative to
the root (``key=value`` directory names are accepted and give the value).
Everything is a DataFrame plan; skipped files are kept with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.functions.exprs import split_first
from netscope.sources.listing import list_files

# record fields kept as columns (declared list; absent -> NULL)
RECORD_FIELDS = ("protocol", "exp_name", "start_time", "tool", "ip_sender", "ip_receiver", "port",
                 "duration", "granularity", "target_bwd", "pkt_size", "flags", "proto")
TAGS = ("provider", "region", "az", "vm_size", "l4_protocol")


def _rel_parts(path_col, root: str):
    root = root.rstrip("/")
    if root.startswith("file:"):
        root = root[5:]
    rel = F.regexp_replace(F.regexp_replace(path_col, r"^file:", ""), "^/*" + _esc(root.lstrip("/")) + "/", "")
    parts = F.split(rel, "/")
    return rel, F.transform(parts, lambda x: F.regexp_replace(x, r"^[^=]+=", ""))


def _esc(s: str) -> str:
    import re
    return re.escape(s)


def path_context(path, root: str) -> dict:
    """Relative path, the five tags and the reason to skip, from the path alone."""
    rel, parts = _rel_parts(path, root)
    vm, proto = split_first(F.get(parts, F.lit(1)), "_")
    deep = F.size(parts) >= 3
    az = F.when((F.size(parts) > 3) & ~F.get(parts, F.lit(3)).endswith(".json"), F.get(parts, F.lit(3)))
    reason = F.when(~path.endswith(".json"), F.lit("not_json")).when(~deep, F.lit("short_path"))
    return {"rel_path": rel, "provider": F.when(deep, F.get(parts, F.lit(0))), "region": F.when(deep, F.get(parts, F.lit(2))),
            "az": az, "vm_size": F.when(deep, vm), "l4_protocol": F.when(deep, proto), "skip_reason": reason}


def listing(spark: SparkSession, root: str) -> DataFrame:
    """S5 + F2 + P15: every object under ``root`` with its path context and a skip reason."""
    files = list_files(spark, root)
    context = path_context(F.col("path"), root)
    reason = F.coalesce(context.pop("skip_reason"), F.when(F.col("length") == 0, F.lit("empty")))
    return files.select("path", "length", *[c.alias(k) for k, c in context.items()], reason.alias("skip_reason"))


def read_documents(spark: SparkSession, root: str, whole_file: bool = True) -> DataFrame:
    """(path, doc) with ``doc`` a VARIANT (NULL when the text is not JSON).

    ``whole_file`` reads each file as one document (a JSON object or array);
    otherwise every line is a document (JSON Lines)."""
    txt = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
           .text(root, wholetext=whole_file))
    return txt.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path"),
                      F.col("value").alias("text"),
                      F.try_parse_json("value").alias("doc"))


def records(docs: DataFrame) -> DataFrame:
    """Array documents give one record per element, objects one record; other JSON
    types and unparsable text are rejects."""
    as_array = F.try_variant_get("doc", "$", "array<variant>")
    elems = F.when(as_array.isNotNull(), as_array).otherwise(F.array(F.col("doc")))
    ex = docs.where(F.col("doc").isNotNull()).select("path", F.posexplode(elems).alias("pos", "rec"))
    is_obj = F.try_variant_get("rec", "$", "map<string,variant>").isNotNull()
    return ex.withColumn("is_object", is_obj)


def ingest(spark: SparkSession, root: str, whole_file: bool = True,
           fields: Sequence[str] = RECORD_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(tagged records, skipped files with reasons).

    Tags come from the path of the row itself, in the same scan as the records."""
    docs = read_documents(spark, root, whole_file)
    context = path_context(F.col("path"), root)
    docs = docs.withColumn("skip", context["skip_reason"])
    recs = records(docs.where("skip is null"))
    cols = [F.try_variant_get("rec", f"$.{f}", "string").alias(f) for f in fields if f not in TAGS]
    tagged = recs.where("is_object").select("path", "pos", *cols, *[context[t].alias(t) for t in TAGS])
    lst = listing(spark, root)
    skipped = (lst.where(F.col("skip_reason").isNotNull()).select("path", F.col("skip_reason").alias("reason"))
               .unionByName(docs.where(F.col("skip").isNull() & F.col("doc").isNull() & (F.length("text") > 0))
                            .select("path", F.lit("invalid_json").alias("reason")))
               .unionByName(recs.where(~F.col("is_object")).select("path", F.lit("not_object").alias("reason"))))
    return tagged, skipped
