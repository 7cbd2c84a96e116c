"""Dataset fingerprints and run records."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_hash(df: DataFrame) -> str:
    """Hash of the schema as Spark writes it (names, types, nullability, order)."""
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def row_digest(df: DataFrame):
    """md5 of a row's canonical text: every value by its length, so that neither a moved NULL nor a
    shifted boundary between columns leaves it unchanged."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def canonical_text(df: DataFrame, name: str):
    """A value as a text that does not depend on an engine's way of printing: times as microseconds and days of
    the epoch, floating-point numbers as exact 53-bit integer and exponent, bytes as hex, nested values as JSON."""
    x, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(x.cast("timestamp")).cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(x).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x = x.cast("double")
        size, two = F.abs(x), F.lit(2.0)
        e = F.floor(F.log2(size))
        e = (e + F.when(F.pow(two, e + 1) <= size, 1).when(F.pow(two, e) > size, -1).otherwise(0)).cast("int")
        half = F.floor((F.lit(52) - e) / 2)
        whole = (size * F.pow(two, half) * F.pow(two, F.lit(52) - e - half)).cast("bigint")
        return (F.when(F.isnan(x), "nan").when(x == 0, "0").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
                .otherwise(F.concat(F.when(x < 0, "-").otherwise(""), whole.cast("string"), F.lit("p"), e.cast("string"))))
    if isinstance(kind, T.BinaryType):
        return F.hex(x)
    return x.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(x))


def canonical(df: DataFrame) -> DataFrame:
    """``df`` with every column as its canonical text: input for a ``fingerprint`` that other engines reproduce."""
    return df.select(*[canonical_text(df, c).alias(c) for c in df.columns])


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint over all rows: row count and the exact sum of 60-bit row digests, which
    partial aggregation combines.  The schema's hash goes with it in ``schema_hash``."""
    h = F.conv(F.substring(row_digest(df), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("string").alias("content_hash")).select(
        "n_rows", "content_hash", F.lit(schema_hash(df)).alias("schema_hash"))


def log_run(spark, path: str, run_id: str, kind: str, values: dict, step: int = 0) -> None:
    """K9: append run params/metrics/tags as rows ``(run_id, kind, key, value, step)``."""
    rows = [(run_id, kind, str(k), str(v), int(step)) for k, v in values.items()]
    spark.createDataFrame(rows, "run_id string, kind string, key string, value string, step int") \
        .write.mode("append").parquet(path)
