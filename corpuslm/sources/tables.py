"""Reading a file table so that its splits fill the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, *by: str) -> DataFrame:
    """Deal the rows of a plain file scan to all cores when it has fewer splits than cores.

    For heavy per-row work, such as tokenizing, over few or badly split files. A table that is large
    next to the cluster has more splits than cores and is read as it is, without a shuffle. Dealing
    by the post id also spares the later grouping by post.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *by)
