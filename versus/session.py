"""Spark session helpers shared by tests, the bench and the driver entry."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job needs regardless of where it runs. Cluster sizing
# (executors, memory, shuffle partitions) is left to the deployment.
_JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # frames partitioned by group join on (group, side) as they lie; AQE splits what is skewed
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of lineage cuts are removed once their DataFrames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "versus") -> SparkSession:
    """Return the active session or build a local one for tests and the bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _JOB_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only when unset.

    On a cluster the directory must be shared storage (HDFS/S3/ABFS); the local
    fallback exists for tests on ``local[*]`` only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="versus-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def join_as_they_lie(spark: SparkSession) -> None:
    """Let frames partitioned by group meet on (group, side) without another shuffle, also in a session
    that ``get_spark`` did not build; a session that sets this itself keeps its own choice."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    if spark.conf.get(key) != _JOB_CONF[key] and not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, _JOB_CONF[key])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def cut_lineage(df):
    """Reliable checkpoint (eager) into the shared ``spark.checkpoint.dir``.

    Used wherever one input feeds several jobs; never ``localCheckpoint``, so a
    lost executor does not lose the materialized data.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_columns(df):
    """``df`` written once as Parquet into the shared ``spark.checkpoint.dir`` and read back.

    For wide frames that are kept for the application and read by several jobs: smaller than a
    checkpoint, and each job reads its own columns.  The files stay as long as the folder does.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
