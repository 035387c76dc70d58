"""Session construction and the shared staging folder.

On a cluster the session comes from the launcher; ``cluster_conf`` lists the
settings the jobs assume.  Tests build a local session with ``local_session``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs rely on.  The shuffle width is an upper bound: AQE
# coalesces small partitions and splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # Window stages are CPU-bound: let AQE keep partitions down to 64 KiB on
    # small inputs; large inputs are sized by the advisory size anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Remove reliable-checkpoint files once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Column building without Python call-site capture (a stack walk per call).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def cluster_conf(total_input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict:
    """Sizing for a large run: about 256 MiB per shuffle partition, at least
    two partitions per core, read splits of 256 MiB."""
    target = 256 * 1024 * 1024
    parts = max(2 * executor_cores * executors, total_input_bytes // target)
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "barline",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # a core setting fixed at start-up
            pass
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints, as ``spark.checkpoint.dir``
    names it.  Unset, it is an error: a folder of this machine would be another
    folder on every executor.  Tests and the bench set their own."""
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([staging_root(spark), "barline", *parts])
