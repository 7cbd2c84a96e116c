"""The experiment build as an incremental file stream.

New result files dropped under a root are picked up by a file-source stream,
flattened with the same transform as the batch path, and appended to a
Parquet sink.  ``trigger(availableNow=True)`` processes everything present and
stops, so the same code serves scheduled batch runs; the checkpoint (in the
shared folder) makes restarts exactly-once per file.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from netscope.sources.experiments import RAW_SCHEMA, flatten


def experiment_stream(spark: SparkSession, root: str, glob: str = "*_results.json", multiline: bool = True,
                      max_files_per_trigger: int | None = None):
    reader = (spark.readStream.schema(RAW_SCHEMA).option("multiLine", str(multiline).lower())
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("recursiveFileLookup", "true").option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.json(root).withColumn("source_path", F.col("_metadata.file_path"))
    return flatten(raw, root)


def run_available(spark: SparkSession, root: str, out: str, checkpoint: str, glob: str = "*_results.json",
                  multiline: bool = True):
    """Process all files present now into ``out`` (Parquet, append) and stop."""
    q = (experiment_stream(spark, root, glob, multiline).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
