"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as '2024-01' must come back as strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove reliable-checkpoint files once their DataFrame is out of scope.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tripmart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, local_dir: str | None = None) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session. Only a local
    session (tests, single-machine runs) gets a private temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    path = local_dir or tempfile.mkdtemp(prefix="tripmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024,
                   max_partitions: int = 65536) -> dict[str, str]:
    """Partition settings for a given input size and cluster size.

    Shuffles start with enough partitions for ~``target_partition_bytes`` each
    (at least two waves of tasks), capped at ``max_partitions`` because the
    driver tracks mappers x reducers map statuses; beyond the cap partitions
    grow (sort-based shuffles spill) and AQE still splits skewed ones and
    coalesces small ones. For 100 TB on 1000 executors x 8 cores: 65,536
    partitions of about 1.6 GB.
    """
    parts = min(max(2 * total_cores, -(-input_bytes // target_partition_bytes)), max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
