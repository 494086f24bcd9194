"""More tasks for CPU-heavy work on inputs that come in few splits (one big row group, compressed text)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute a scan over all cores when it has fewer splits than the cluster has cores.

    With enough splits the frame is returned as it is, so large inputs pay no shuffle. Meant for plain
    scans in front of expensive per-row work; streams are left alone.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
