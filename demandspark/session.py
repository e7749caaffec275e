"""Session construction and lineage cutting.

Library code never creates its own session; it takes the caller's. ``get_session`` is only for tests, the
bench and scripts. ``spark.checkpoint.dir`` is read from the session; a private folder is set only where the
cluster names none (as in local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators rely on. Shuffle partitions are sized per workload by the caller; AQE coalesces
# small shuffles and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster (applied by the cluster's submit configuration, not by library
# code): many shuffle partitions that AQE coalesces to ~256 MB, skew splitting on, scans split at 256 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, app: str = "demandspark", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a private one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="demandspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: survives executor loss, truncates the
    plan, and later steps read only the columns (and, with ``partition_by``, the part) they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application."""
    return spark.sparkContext.applicationId
