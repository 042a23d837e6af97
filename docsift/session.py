"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every plan in this package.  AQE re-plans joins
# and coalesces partitions at run time, and its skew-join rule splits a hot
# join partition; the session time zone is pinned so event-time windows and
# the SQL oracle agree.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "docsift", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster the master and most sizing come from spark-submit; the
    arguments here are for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there); only when it is unset and the session is local, as in tests, is
    a fresh scratch folder created and set.  On a cluster it must be named.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir: executors and driver need a folder that they share")
    if not root:
        root = tempfile.mkdtemp(prefix="docsift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def ship_package(spark: SparkSession) -> None:
    """Make ``docsift`` importable by Python workers of this session.

    Python workers merge the ``PYTHONPATH`` entry of the context environment
    into their path; on a cluster the package normally arrives through
    ``--py-files`` and this entry is harmless.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join(parts + [root])


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               executor_memory_gb: float = 16.0, target_partition_mb: int = 128) -> dict:
    """Sizing for a cluster run, from the input volume and the executors.

    * file splits of ``target_partition_mb`` so one task reads ~128 MB;
    * shuffle partitions so one reduce partition is ~``target_partition_mb``
      even for a full-size shuffle, and never fewer than 2 x total cores;
      AQE coalesces small ones at run time and splits skewed ones;
    * the per-task share of execution memory bounds the target size, so a
      partition (and its sort/aggregation buffers) fits without spilling
      heavily: memory per task ~ 0.6 x heap / cores.
    """
    cores = executors * cores_per_executor
    per_task_mb = executor_memory_gb * 1024 * 0.6 / cores_per_executor
    part_mb = int(max(32, min(target_partition_mb, per_task_mb / 4)))
    shuffle_parts = max(2 * cores, int(input_bytes / (part_mb * 1024 * 1024)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": f"{part_mb}m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{part_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * part_mb}m",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def reuse(df):
    """Materialise an intermediate that is read more than once.

    ``spark.docsift.reuse=checkpoint`` writes it with a reliable
    ``checkpoint()`` under ``spark.checkpoint.dir`` (cuts the lineage, so a
    lost executor does not trigger recomputation); the default keeps it
    with ``persist(MEMORY_AND_DISK)``.  Never a local checkpoint.
    """
    from pyspark import StorageLevel
    spark = df.sparkSession
    if spark.conf.get("spark.docsift.reuse", "persist") == "checkpoint":
        checkpoint_root(spark)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def stored(df, name: str, partition_by=None, compression: str | None = None):
    """``df`` written as Parquet to the session's part of the shared folder and
    read back: evaluated once, and read again (not computed again) when an
    executor is lost.  ``drop_stored`` removes the session's tables."""
    import uuid
    spark = df.sparkSession
    path = f"{_stored_root(spark)}/{name}-{uuid.uuid4().hex}"
    w = df.write.option("compression", compression) if compression else df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _stored_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/stored/{spark.sparkContext.applicationId}"


def drop_stored(spark: SparkSession) -> None:
    """Remove the tables that ``stored`` wrote in this session; frames over
    them cannot be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stored_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
