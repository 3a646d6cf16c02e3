"""Session construction and cluster-aware settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Bytes of (compressed) input one shuffle partition should carry.  AQE
# coalesces small partitions at run time, so erring high on the count is
# cheap; erring low makes tasks spill.
_TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle partition count for ``input_bytes`` of input.

    At least one partition per core; otherwise roughly one per 128 MiB so a
    100 TB input gets ~800k partitions before AQE coalescing.
    """
    return max(cores, -(-input_bytes // _TARGET_PARTITION_BYTES))


def build_session(
    master: str | None = None,
    app_name: str = "cirrus",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
) -> SparkSession:
    """Return a session configured for the readings workloads.

    Only settings the library relies on are forced: UTC session time (all
    calendar logic is written against naive timestamps anyway), AQE with
    partition coalescing and skew-join splitting, and no UI server.

    ``input_bytes`` (+ ``cores``, the cluster's total) sizes the shuffles:
    the one wide shuffle of the analysis (the duplicate check, keyed by
    series and time) carries about the whole input, so it starts with one
    partition per ~128 MiB and AQE coalesces the small ones.
    """
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes, cores or 1)
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        # Remove checkpoint files of frames that are gone, so repeated runs do
        # not grow the shared checkpoint folder.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (local tests) a private temporary
    folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cirrus-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
