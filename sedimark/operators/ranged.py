"""Scans over globally range-partitioned, sorted rows.

A window function gathers each of its groups in one task.  Here rows are sorted
over all partitions instead, so that a group of any size spreads over as many
tasks as it needs; what a group brings along from earlier partitions is settled
afterwards from one summary row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PARTITION_BYTES = 128 << 20  # of stored input that one sorted partition stands for
UNKNOWN = 1 << 60  # the optimizer's size of what it knows nothing about is larger
EXPANSION = 3  # how much larger rows are than the compressed files they come from


def partitions_for(df: DataFrame) -> int:
    """Number of partitions to sort ``df`` in: what its files need, and no fewer than ``spark.sql.shuffle.partitions``.

    The sizes are those of the scans below ``df`` as the optimizer knows them; nothing is read.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    stored = 0
    for i in range(leaves.size()):
        size = int(leaves.apply(i).stats().sizeInBytes())
        stored += size if size < UNKNOWN else 0
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, min(-(-EXPANSION * stored // PARTITION_BYTES), 1_000_000))


def range_sorted(df: DataFrame, keys: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` range partitioned and sorted by ``keys``; partition p holds no row that sorts after one of p + 1."""
    return df.repartitionByRange(partitions or partitions_for(df), *keys).sortWithinPartitions(*keys)


def carried(summary: DataFrame, partition: str, first: list[str], last: list[str], value: Column) -> DataFrame:
    """What the first group of each partition inherits: ``value`` aggregated over earlier partitions that end in that group.

    ``summary`` has one row per non-empty partition.  As they are sorted, the partitions that end in a group follow each
    other, so what a partition inherits is the running ``value`` of the one before it, if that ends in its first group.
    Returns ``partition`` and ``carried``; partitions that inherit nothing are left out.
    """
    order = Window.orderBy(partition)  # as many rows as there are partitions
    running = summary.withColumn("__running", value.over(Window.partitionBy(*last).orderBy(partition)))
    before = running.withColumn("__carried", F.lag("__running").over(order))
    same = F.lit(True)
    for i, c in enumerate(last):
        before = before.withColumn(f"__l{i}", F.lag(c).over(order))
        same = same & (F.col(f"__l{i}") == F.col(first[i]))
    return before.where(same).select(partition, F.col("__carried").alias("carried"))


def carried_by_key(summary: DataFrame, partition: str, keys: list[str], value: Column) -> DataFrame:
    """``partition, keys, carried``: ``value`` aggregated over the rows of the same key of earlier partitions.

    ``summary`` has one row per partition and key.  Only keys that go on from one partition to the next are returned, at
    most one for each partition.
    """
    earlier = Window.partitionBy(*keys).orderBy(partition).rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumn("carried", value.over(earlier)).where("carried is not null").select(partition, *keys, "carried")
