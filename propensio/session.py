"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "propensio") -> SparkSession:
    """A local session for tests and the bench (the cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PROPENSIO_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from the session (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``). Only when none is named (a local test run) a
    scratch folder is chosen; on a cluster it must be shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    current = tempfile.mkdtemp(prefix="propensio-ckpt-", dir="/tmp")
    sc.setCheckpointDir(current)
    return current


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def write_work_table(df, name: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet under the shared checkpoint folder; return the path."""
    import uuid

    path = work_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps a columnar source: later
    plans get column pruning, pushed filters and (with ``partition_by``)
    partition pruning on the written table.
    """
    return df.sparkSession.read.parquet(write_work_table(df, name, partition_by))


def cut_lineage(df):
    """Reliable checkpoint into the session's shared checkpoint folder (eager)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
