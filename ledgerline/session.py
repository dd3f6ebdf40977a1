"""Session construction and shared-storage paths.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a shared
folder; we only read it.  Tests and local runs get defaults where nothing is set.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings we want on every session.  AQE re-plans at runtime: it coalesces small
# shuffle partitions, splits skewed join partitions and turns a shuffle join into a
# broadcast join only after it has *measured* the small side.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No broadcast decided from (compressed) file-size guesses; AQE may still switch a
    # join to broadcast once it has measured the materialised side below this size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # reliable checkpoints of small key sets are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``driver_memory`` only matters in local mode (the driver JVM hosts the executors)
    and only takes effect if this call starts the JVM.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/ledgerline-checkpoints") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    ``fallback`` serves sessions whose executors are threads of this process (master
    ``local`` or ``local[n]``).  Any other master must name a folder that all executors share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or fallback)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh directory name under the shared checkpoint folder.

    Used for job outputs that must survive executor loss (snapshot tables, exported
    files, streaming checkpoints) - never a machine-local temp folder.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tail = "/".join(p.strip("/") for p in parts if p)
    name = f"{root}/ledgerline/{tail}" if tail else f"{root}/ledgerline"
    if unique:
        name = f"{name}-{uuid.uuid4().hex[:12]}"
    return name


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, through Hadoop's file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder of the shared storage."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
