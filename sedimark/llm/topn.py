"""The N highest-scoring items of every group, by one global sort.

Pairs are range partitioned and sorted by group, score and item over all
partitions, so a group of millions of items is cut into as many ranges as it
fills.  Each partition numbers its rows within their group and reports how many
rows its last group has; prefix sums of those counts over the partitions turn
the local numbers into exact positions, and positions up to N stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.operators.ranged import carried, range_sorted
from sedimark.storage import materialize


def _numbered(n: int):
    """Scan of one sorted partition: its rows numbered within their group up to ``n``, then its summary row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        schema = None
        first = last = None
        seen = 0  # rows of the current group so far in this partition
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            group = batch.column("g")
            schema = pa.schema([
                ("part", pa.int32()), ("open", pa.bool_()), ("position", pa.int64()), ("g", group.type), ("i", batch.column("i").type), ("s", pa.float64()),
                ("first", group.type), ("last", group.type), ("count", pa.int64()),
            ])
            begins, ends = group[0].as_py(), group[rows - 1].as_py()
            first = begins if first is None else first
            fresh = np.zeros(rows, bool)
            fresh[0] = begins != last
            if rows > 1:
                fresh[1:] = pc.not_equal(group.slice(1), group.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            index = np.arange(rows)
            start = np.maximum.accumulate(np.where(fresh, index, 0))
            position = index - start + 1
            segment = np.cumsum(fresh)
            if not fresh[0]:
                position[segment == 0] += seen
            keep = np.flatnonzero(position <= n)
            if len(keep):
                chosen = batch.take(pa.array(keep))
                opened = (segment[keep] == segment[0]) & (begins == first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(keep), part, np.int32)), pa.array(opened), pa.array(position[keep]), chosen.column("g"), chosen.column("i"),
                    chosen.column("s"), *[pa.nulls(len(keep), schema.field(c).type) for c in ("first", "last", "count")],
                ], schema=schema)
            seen, last = int(position[-1]), ends
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "last": last, "count": seen}], schema=schema)

    return scan


def top_n(df: DataFrame, group: str, item: str, score: str, n: int, partitions: int | None = None) -> DataFrame:
    """The best ``n`` distinct items of each group: ``<group>, <item>, <score>, position``, position from 1.

    * A row counts only with a group, an item (neither null nor blank) and a finite score.
    * A (group, item) pair counts once, with its highest score; repeated rows change nothing.
    * Higher scores come first, equal scores by item in ascending byte order, so the result is always the same.
    * Groups with fewer than ``n`` items give all of them; an empty table gives no rows.
    * Other columns, whatever their names, are not read.
    """
    finite = ~F.isnan("s") & (F.abs("s") != float("inf"))
    there = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    pairs = (
        df.select(F.col(group).alias("g"), F.col(item).alias("i"), (F.col(score).cast("double") + F.lit(0.0)).alias("s"))
        .where(there("g") & there("i") & finite)
        .groupBy("g", "i").agg(F.max("s").alias("s"))
    )
    kinds = dict(pairs.dtypes)
    schema = f"part int, open boolean, position bigint, g {kinds['g']}, i {kinds['i']}, s double, first {kinds['g']}, last {kinds['g']}, count bigint"
    ordered = range_sorted(pairs, [F.col("g"), F.col("s").desc(), F.col("i")], partitions)
    numbered = materialize(ordered.mapInArrow(_numbered(n), schema), "top-n")
    before = F.broadcast(carried(numbered.where(F.col("last").isNotNull()), "part", ["first"], ["last"], F.sum("count")))  # at most a row a partition
    position = F.col("position") + F.when(F.col("open"), F.coalesce("carried", F.lit(0))).otherwise(0)
    return (
        numbered.where(F.col("last").isNull()).join(before, "part", "left")
        .select(F.col("g").alias(group), F.col("i").alias(item), F.col("s").alias(score), position.alias("position"))
        .where(F.col("position") <= n)
    )
