"""Table scans that start with enough parallelism.

A file that cannot be split (one parquet row group, a gzip CSV) is read by a
single task, and every narrow step after the scan - parsing, formatting,
broadcast lookups - then runs in that one task.  ``spread`` redistributes
such a scan round-robin over the cluster's cores.  A scan that already has
at least that many partitions, the normal case for large tables, is
returned unchanged, so no shuffle is added where it is not needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` (default: the cores) only if it has fewer."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Spark Connect exposes no partition count
        return df
    return df.repartition(want) if have < want else df


def read_parquet(spark: SparkSession, path: str, spread_scan: bool = True) -> DataFrame:
    """Parquet scan, spread when it would start in fewer tasks than cores."""
    df = spark.read.parquet(path)
    return spread(df) if spread_scan else df
