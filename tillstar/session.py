"""Session construction and shared-folder lookup."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; UTC keeps text <-> timestamp parsing free
# of daylight-saving gaps.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints (key numbering, sweeps, the SCD2 change set) are removed
    # from the shared folder once their DataFrames are garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "tillstar", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF`` applied (an existing one is reused)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``.  Where that is unset and Spark runs
    within one machine (master ``local...``), ``fallback``, or else a new
    temporary folder, is installed; on a cluster it is an error, since other
    machines would not see such a folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="tillstar-checkpoints-")
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


def scale_conf(input_bytes: int, target_partition_bytes: int = 128 << 20,
               max_partitions: int = 100_000) -> dict[str, str]:
    """Partition settings for a run over ``input_bytes`` of raw input.

    AQE coalesces shuffle partitions that are too small but does not split
    ones that are too large (except skewed join partitions), so the initial
    number must be sized from the input: ~``input / target`` partitions, of
    which AQE merges the small ones toward the advisory size.  Beyond
    ``max_partitions`` partitions grow instead (1 GB each at 100 TB; sorts
    and aggregations spill): a shuffle's blocks number map tasks times
    partitions, and the driver keeps a status of every map task for each.
    Scans use 256 MB splits.  Apply with ``spark.conf.set`` before building the plan.
    """
    n = max(200, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }
