"""SparkSession settings shared by jobs, tests and the benchmark.

Everything runs in UTC with ANSI mode and adaptive query execution on.
The checkpoint folder is taken from ``spark.checkpoint.dir`` when the
cluster names one; only an unset value is filled in (tests, local runs).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "fanpulse",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (e.g. the driver's)."""
    for key, value in SESSION_CONF.items():
        if key == "spark.ui.enabled":
            continue
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if none is named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = tempfile.mkdtemp(prefix="fanpulse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run (e.g. 100 TB on 1000 executors).

    Initial shuffle partitions: about one per GB of input (shuffles carry a
    pruned, pre-aggregated fraction of the input), clamped to 2..20 waves of
    the cluster's task slots; AQE then coalesces to ~``target_partition_bytes``
    per reducer and splits skewed partitions at runtime. Scans read ~512 MB
    splits. Broadcasts stay behind AQE's runtime size check (the threshold is
    a byte bound, never a hint).
    """
    slots = executors * cores_per_executor
    partitions = min(max(2 * slots, -(-input_bytes // (1 << 30))), 20 * slots)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
