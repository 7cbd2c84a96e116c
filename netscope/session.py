"""Session settings shared by every plan.

Only runtime SQL confs are touched on an existing session; nothing here starts a
server (the UI stays off for sessions we build ourselves).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime confs every plan relies on: UTC so epoch <-> timestamp is the same as
# pandas/DuckDB, AQE for runtime coalescing, skew-join splitting and broadcast
# conversion based on measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows that a Python worker holds at once: whole texts are kilobytes each
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, app: str = "netscope",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only set when given, so on a cluster the launcher's value wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RUNTIME_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    })
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    # Python workers import the package from where the driver found it (same path or an installed copy).
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on some deployments
            pass
    return spark


def shared_dir(spark: SparkSession, sub: str) -> str:
    """Folder for lineage cuts and derived files.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system) when the
    session names one.  Only where it is unset and all tasks run in this one process
    (master ``local`` or ``local[n]``) a fresh temporary folder takes its place; on a
    cluster that would be a folder which the executors can't see, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:
            base = None
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="netscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") + "/" + sub


def unique_subdir(spark: SparkSession, name: str) -> str:
    """A new, never reused path under the shared dir (one per run), deleted when the session's JVM ends."""
    import uuid
    out = shared_dir(spark, f"{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}")
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return out


def cut_to_table(df):
    """As ``cut_lineage``, by a Parquet table in the shared dir: many passes over a few plain columns read it several
    times faster than a checkpoint, whose rows are Java objects."""
    out = unique_subdir(df.sparkSession, "cut")
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def cut_lineage(df):
    """Materialise ``df`` with a reliable checkpoint in the shared checkpoint dir.

    Used where an iterative operator reads the same intermediate many times
    (so it is computed once), and to bound lineage for recovery after executor
    loss.  Never a local (executor-disk) checkpoint.
    """
    spark = df.sparkSession
    shared_dir(spark, "")
    return df.checkpoint(eager=True)
