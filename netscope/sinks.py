"""Sinks and format dispatch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession


def write_dataset(df: DataFrame, out_dir: str, fmt: str = "parquet", stamp: bool = True,
                  mode: str = "errorifexists", max_records_per_file: int | None = None) -> str:
    """K1/K3: write Parquet (default) or CSV under a timestamped name; returns the path."""
    name = f"netscope_{time.strftime('%Y%m%d_%H%M%S')}" if stamp else "dataset"
    path = f"{out_dir.rstrip('/')}/{name}.{fmt}"
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    return path


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Choose the reader by suffix; a directory without suffix is read as CSV."""
    p = path.rstrip("/")
    if p.endswith(".parquet"):
        return spark.read.parquet(p)
    return spark.read.option("header", "true").option("inferSchema", "true").option("recursiveFileLookup", "true").csv(p)


def merge_csv_to_parquet(spark: SparkSession, csv_dir: str, out: str) -> str:
    """All CSVs under a folder -> one Parquet dataset."""
    read_any(spark, csv_dir).write.mode("errorifexists").parquet(out)
    return out


def write_report_json(df: DataFrame, path: str) -> None:
    """K6: report rows as JSON (one small file: the report is an aggregate)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def latest_file(spark: SparkSession, root: str, glob: str = "*") -> str | None:
    """Newest file under ``root`` by modification time (one aggregate over the listing)."""
    from pyspark.sql import functions as F

    from netscope.sources.listing import list_files
    lst = list_files(spark, root, glob).withColumnRenamed("modified", "modificationTime")
    row = lst.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row["p"] if row else None


def write_objects(df: DataFrame, root: str) -> int:
    """One file per row of ``(rel_path, text)`` under ``root``, written by the tasks; the number of files.

    A task that runs again writes the same names again, so a lost executor leaves no half or double file."""
    from netscope.sources.listing import open_store

    def write(batches):
        store, base, _ = open_store(root)
        for batch in batches:
            for rel, text in zip(batch["rel_path"], batch["text"]):
                path = f"{base}/{rel}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as f:
                    f.write((text or "").encode())
            yield batch[["rel_path"]]

    return df.select("rel_path", "text").mapInPandas(write, "rel_path string").count()


def clean_and_save(df: DataFrame, out_dir: str, sample_n: int = 1000, key: str | None = None, seed: int = 42) -> dict:
    """K2: CSV + Parquet of the prepared table, an exact-size sample and a summary,
    all written from one persisted DataFrame."""
    from netscope.operators.profile import dataset_overview
    from netscope.operators.sampling import sample_exact
    d = df.persist()
    try:
        out = {"parquet": write_dataset(d, out_dir, "parquet"), "csv": write_dataset(d, out_dir, "csv")}
        sample_exact(d, sample_n, key, seed).write.mode("errorifexists").option("header", "true").csv(
            f"{out_dir.rstrip('/')}/sample.csv")
        out["sample"] = f"{out_dir.rstrip('/')}/sample.csv"
        dataset_overview(d).write.mode("errorifexists").json(f"{out_dir.rstrip('/')}/summary.json")
        out["summary"] = f"{out_dir.rstrip('/')}/summary.json"
        return out
    finally:
        d.unpersist()
