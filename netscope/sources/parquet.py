"""Parquet scans (column selection + filter tuples pushed to the scan), partitioned
datasets, and a distributed footer job for file metadata and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netscope.functions.exprs import dnf


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 filters=None) -> DataFrame:
    """``read.parquet(path).select(columns).where(dnf(filters))``.

    Catalyst pushes the predicate into the scan (``PushedFilters``) and prunes
    the read schema to the selected and filtered columns.
    """
    df = spark.read.parquet(path)
    cond = dnf(filters)
    if cond is not None:
        df = df.where(cond)
    if columns:
        df = df.select(*columns)
    return df


def read_partitioned(spark: SparkSession, path: str, filters=None, columns: Sequence[str] | None = None) -> DataFrame:
    """A hive-partitioned directory; filters on partition columns prune directories."""
    return read_parquet(spark, path, columns, filters)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per source file, from the hidden ``_metadata`` column (one scan)."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))


FOOTER_SCHEMA = ("path string, valid boolean, error string, num_rows bigint, num_columns int, "
                 "num_row_groups int, created_by string, schema string, size_bytes bigint, size_mb double")


def _footers(batches):
    import pandas as pd
    import pyarrow.parquet as pq
    for pdf in batches:
        rows = []
        for path, length in zip(pdf["path"], pdf["length"]):
            local = path[5:] if path.startswith("file:") else path
            try:
                md = pq.ParquetFile(local).metadata
                ok = md.num_rows >= 0 and md.num_columns >= 0
                rows.append((path, bool(ok), None, int(md.num_rows), int(md.num_columns), int(md.num_row_groups),
                             md.created_by, str(md.schema.to_arrow_schema()), int(length),
                             round(int(length) / (1024 * 1024), 6)))
            except Exception as e:  # one bad file must not fail the job
                rows.append((path, False, f"{type(e).__name__}: {e}", None, None, None, None, None,
                             int(length), round(int(length) / (1024 * 1024), 6)))
        yield pd.DataFrame(rows, columns=["path", "valid", "error", "num_rows", "num_columns", "num_row_groups",
                                          "created_by", "schema", "size_bytes", "size_mb"])


def parquet_metadata(spark: SparkSession, path: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """Footer facts per file as a distributed job.

    The listing comes from the ``binaryFile`` source with only path/length
    selected (file contents are never read); footers are read per task.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", str(recursive).lower()).load(path)
               .select("path", "length"))
    return listing.mapInPandas(_footers, FOOTER_SCHEMA)
