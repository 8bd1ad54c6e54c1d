"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def context_key(sc=None) -> str:
    """A key unique to one SparkContext object (ids can be reused after a stop)."""
    from pyspark import SparkContext
    sc = sc or SparkContext._active_spark_context
    if sc is None:
        return "none"
    key = getattr(sc, "_geoweave_key", None)
    if key is None:
        key = sc._geoweave_key = uuid.uuid4().hex
    return key


def get_session(master: str | None = None, app_name: str = "geoweave",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on.

    ``master`` is only for local runs; under ``spark-submit`` leave it None.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts and intermediate tables go here, never to a machine-local
    temp folder.  Only a local-mode session without the setting (tests) gets
    one made up, and it is then also registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
    d = tempfile.mkdtemp(prefix="geoweave-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one job's output."""
    return f"{shared_dir(spark)}/geoweave/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 << 20) -> dict:
    """Scan and shuffle sizing for a job reading ``input_bytes`` on a given cluster.

    Scans split at ``target_partition_bytes``; the initial shuffle partition
    count is an upper bound (input / target, at least 2x the cores) that AQE
    coalesces down to the advisory size after each map stage, and AQE splits
    a shuffle partition past twice that size in joins.  With the
    pre-aggregated shuffles of this library the real shuffle volume is far
    below the input size; the bound only has to keep a wide stage from
    producing oversized partitions.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # let the JIT compile large generated methods: a whole-stage method over
        # 8000 bytes of bytecode otherwise runs interpreted, ~10x slower.  Merge
        # with any JVM options already in use rather than replacing them.
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }
