"""Schema-free JSON scan and one-level flattening (the "prepare" path).

Files under a root are read as whole documents, parsed to VARIANT, arrays
become one record per element, and each record is flattened one level:

- scalar values are kept (as text, typed later by ``try_cast``);
- non-empty lists whose elements are all numbers become ``<key>_mean`` and ``<key>_count``;
- objects contribute their scalar members as ``<key>_<member>``;
- deeper levels and NULLs are dropped.

All of it happens in the scan's own rows: a record becomes an array of
``(column, value)`` pairs, declared columns are looked up in it, and path
metadata (provider, VM size, protocol, epoch) comes from regexes on the same
row's file path; there is no shuffle.  Record keys overwrite metadata of the
same name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's path vocabularies.
PROVIDERS = ("Azure", "AWS")
VM_SIZE_MAPPING = {"m3.medium": "Medium", "m3.xlarge": "XLarge", "a2.medium": "Medium", "a4.xlarge": "XLarge"}
PROTOCOL_MAPPING = {"tput_tcp": "TCP_Throughput", "tput_udp": "UDP_Throughput"}
RX_VM = r"([am][0-9]\.[a-z]+)"
RX_PROTO = r"(tput_[a-z]+)"
RX_EPOCH = r"(\d{10})"


def _map(c, mapping: Mapping[str, str]):
    from netscope.functions.exprs import map_values
    return map_values(c, mapping)


def path_metadata(path_col, root: str) -> dict:
    """provider = first segment under ``root``; for AWS/Azure the VM size and
    protocol come from the second segment (mapped, pass-through otherwise); the
    first 10-digit run anywhere in the path is the epoch; defaults ``Unknown``.
    ``key=value`` directories give their value."""
    root = root.rstrip("/")
    if root.startswith("file:"):
        root = root[5:]
    import re
    rel = F.regexp_replace(F.regexp_replace(path_col, r"^file:/*", "/"), "^/*" + re.escape(root.lstrip("/")) + "/", "")
    parts = F.transform(F.split(rel, "/"), lambda x: F.regexp_replace(x, r"^[^=]+=", ""))
    provider = F.when(F.size(parts) > 1, parts[0]).otherwise(F.lit("Unknown"))
    known = provider.isin(*PROVIDERS) & (F.size(parts) >= 2)
    vm = F.nullif(F.regexp_extract(parts[1], RX_VM, 1), F.lit(""))
    proto = F.nullif(F.regexp_extract(parts[1], RX_PROTO, 1), F.lit(""))
    return {
        "filepath": path_col,
        "provider": provider,
        "vm_size": F.coalesce(F.when(known, _map(vm, VM_SIZE_MAPPING)), F.lit("Unknown")),
        "protocol": F.coalesce(F.when(known, _map(proto, PROTOCOL_MAPPING)), F.lit("Unknown")),
        "timestamp": F.nullif(F.regexp_extract(path_col, RX_EPOCH, 1), F.lit("")).cast("bigint"),
    }


def read_records(spark: SparkSession, root: str, glob: str = "*.json", whole_file: bool = True) -> DataFrame:
    """S3: (path, rec_id, rec VARIANT) for every object record under ``root``.

    ``whole_file`` parses each file as one document (object or array); otherwise
    every line is a document (JSON Lines)."""
    txt = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
           .text(root, wholetext=whole_file))
    # document id: file splits are deterministic, so the id is stable when a lost
    # partition is recomputed
    docs = txt.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("doc"),
                      F.monotonically_increasing_id().alias("_doc"))
    arr = F.try_variant_get("doc", "$", "array<variant>")
    recs = docs.where(F.col("doc").isNotNull()).select(
        "path", "_doc", F.posexplode(F.when(arr.isNotNull(), arr).otherwise(F.array(F.col("doc")))).alias("pos", "rec"))
    recs = recs.where(F.try_variant_get("rec", "$", "map<string,variant>").isNotNull())
    return recs.select("path", F.concat_ws(":", "_doc", "pos").alias("rec_id"), "rec")


MAX_COLUMNS = 10_000


def _pairs(rec):
    """A record's flattened ``(k, v)`` pairs, values as text."""
    def pair(name, value):
        return F.struct(name.alias("k"), value.cast("string").alias("v"))

    def kind(v, name: str):
        return F.schema_of_variant(v).startswith(name)

    def scalar(v):
        return ~kind(v, "OBJECT") & ~kind(v, "ARRAY") & ~F.is_variant_null(v)

    def members(e):
        inside = F.filter(F.map_entries(F.try_variant_get(e["value"], "$", "map<string,variant>")), lambda m: scalar(m["value"]))
        return F.transform(inside, lambda m: pair(F.concat(e["key"], F.lit("_"), m["key"]), F.try_variant_get(m["value"], "$", "string")))

    def numbers(e):
        # the cast keeps the array only when every element is a number
        nums, raw = F.try_variant_get(e["value"], "$", "array<double>"), F.try_variant_get(e["value"], "$", "array<variant>")
        whole = (F.size(nums) > 0) & (F.size(raw) == F.size(F.filter(nums, lambda x: x.isNotNull())))
        mean = F.aggregate(nums, F.lit(0.0), lambda t, x: t + x) / F.size(nums)
        return F.when(whole, F.array(pair(F.concat(e["key"], F.lit("_mean")), mean),
                                     pair(F.concat(e["key"], F.lit("_count")), F.size(nums))))

    def flat(e):
        own = F.when(scalar(e["value"]), F.array(pair(e["key"], F.try_variant_get(e["value"], "$", "string"))))
        found = F.when(kind(e["value"], "OBJECT"), members(e)).when(kind(e["value"], "ARRAY"), numbers(e)).otherwise(own)
        return F.coalesce(found, F.array().cast("array<struct<k:string,v:string>>"))

    entries = F.map_entries(F.try_variant_get(rec, "$", "map<string,variant>"))
    return F.flatten(F.transform(entries, flat))


def flatten_records(records: DataFrame, root: str, columns: Sequence[str] | None = None,
                    merge: bool = True) -> DataFrame:
    """Wide table: path metadata + flattened record columns.

    With ``merge`` a record key overwrites the path value of the same name row by
    row (so ``protocol`` mixes ``TCP_Throughput`` with ``tcp``, as in the
    reference); without it the path values keep their own ``path_<name>`` columns.
    Without ``columns`` the names are looked up first, with an error beyond
    ``MAX_COLUMNS`` of them."""
    md = path_metadata(F.col("path"), root)
    rows = records.select("rec_id", *[v.alias(f"_m_{k}") for k, v in md.items()], _pairs(F.col("rec")).alias("_p"))
    if columns is None:
        seen = rows.select(F.explode("_p.k").alias("k")).distinct().limit(MAX_COLUMNS + 1).collect()
        if len(seen) > MAX_COLUMNS:
            raise ValueError(f"the records have more than {MAX_COLUMNS} columns: name the ones wanted")
        columns = sorted(r[0] for r in seen)
    def last(name: str):
        return F.try_element_at(F.filter("_p", lambda x: x["k"] == F.lit(name)), F.lit(-1))["v"]

    value = {c: last(c) for c in columns}
    if not merge:
        return rows.select("rec_id", *[F.col(f"_m_{k}").alias(f"path_{k}") for k in md],
                           *[v.alias(c) for c, v in value.items()])
    # a record's own key overwrites the path value of the same name, row by row
    out = [F.coalesce(value[k], F.col(f"_m_{k}").cast("string")).alias(k) if k in value
           else F.col(f"_m_{k}").alias(k) for k in md]
    return rows.select("rec_id", *out, *[v.alias(c) for c, v in value.items() if c not in md])
