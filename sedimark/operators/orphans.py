"""References to records that do not exist when they are made.

Every key is an integer (see ``functions.ids``).  Key and time together are one
longer integer, key first, in which a parent row occupies the contiguous run
from its loading to its retirement.  Parent runs and references are sorted
along that axis once, over all partitions; the scan merges runs that overlap or
touch, matches each reference to the preceding run start as of its own time and
reports it if it lies beyond the end of that run, or if no run of its key starts
before it.

The work per reference does not depend on how often its key occurs: a key that
holds a third of all references is cut into as many ranges as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.ids import is_blank
from sedimark.operators.ranged import carried, range_sorted
from sedimark.storage import materialize

NEVER = 2**63 - 1  # the end of a run that is still in force


class Target(NamedTuple):
    """A table that can be referred to: its rows, the integer key, and when a row comes and goes."""

    name: str
    rows: DataFrame
    key: Column
    since: str = "loaded_at"
    until: str = "retired_at"


class Reference(NamedTuple):
    """A column that refers to a target; ``key`` turns it into the target's integer key."""

    field: str
    target: str
    key: Column


class Referrer(NamedTuple):
    """A table whose rows refer to others."""

    name: str
    rows: DataFrame
    references: list[Reference]
    row_id: str = "row_id"
    at: str = "loaded_at"


EVENT = ("target", "key", "at", "is_reference", "until", "source", "row_id")
SCANNED = "part int, open boolean, source int, row_id bigint, at timestamp_ntz, micros bigint, first_target int, first_key binary, last_target int, last_key binary, reach bigint"
LEAST = np.iinfo(np.int64).min


def _micros(column: pa.Array, missing: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.timestamp("us")).cast(pa.int64()), missing).to_numpy(zero_copy_only=False)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """References of one sorted partition that lie beyond the run before them, then the partition's summary row.

    A reference whose key may continue from the partition before is ``open``: it stays undecided until the
    runs of earlier partitions are known.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([
        ("part", pa.int32()), ("open", pa.bool_()), ("source", pa.int32()), ("row_id", pa.int64()), ("at", pa.timestamp("us")), ("micros", pa.int64()),
        ("first_target", pa.int32()), ("first_key", pa.binary()), ("last_target", pa.int32()), ("last_key", pa.binary()), ("reach", pa.int64()),
    ])
    first = last = None
    reach = LEAST  # the furthest end of the runs of the current key so far
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        target, key = batch.column("target"), batch.column("key")
        begins, ends = [(target[i].as_py(), key[i].as_py()) for i in (0, n - 1)]
        first = first or begins
        fresh = np.zeros(n, bool)
        fresh[0] = begins != last
        if n > 1:
            changed = pc.or_(pc.not_equal(target.slice(1), target.slice(0, n - 1)), pc.not_equal(key.slice(1), key.slice(0, n - 1)))
            fresh[1:] = changed.to_numpy(zero_copy_only=False)
        segment = np.cumsum(fresh)
        reference = batch.column("is_reference").to_numpy(zero_copy_only=False)
        until = np.where(reference, LEAST, _micros(batch.column("until"), NEVER))
        # running maximum of the ends within each key: ranks make (key, end) one integer
        values, rank = np.unique(np.append(until, reach), return_inverse=True)
        code = segment * np.int64(len(values)) + rank[:-1]
        if not fresh[0]:
            code[0] = max(code[0], segment[0] * np.int64(len(values)) + rank[-1])
        running = values[np.maximum.accumulate(code) % len(values)]
        micros = _micros(batch.column("at"), 0)
        lost = np.flatnonzero(reference & (running <= micros))
        if len(lost):
            opened = (segment[lost] == segment[0]) & (begins == first)
            none = [pa.nulls(len(lost), schema.field(i).type) for i in range(6, 11)]
            chosen = batch.take(pa.array(lost))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(lost), part, np.int32)), pa.array(opened), chosen.column("source"), chosen.column("row_id"),
                chosen.column("at").cast(pa.timestamp("us")), pa.array(micros[lost]), *none,
            ], schema=schema)
        reach, last = int(running[-1]), ends
    if last is not None:
        yield pa.RecordBatch.from_pylist([{
            "part": part, "first_target": first[0], "first_key": first[1], "last_target": last[0], "last_key": last[1], "reach": reach,
        }], schema=schema)


def orphan_references(targets: list[Target], referrers: list[Referrer], partitions: int | None = None) -> DataFrame:
    """Every reference without a live target when its row was loaded: ``table_name, field_name, row_id, period``.

    A target is live at time t if one of its rows has ``since <= t`` and ``until`` null or ``> t``.

    * Null and blank references are none and do not count.
    * A reference that is not blank but holds no id has no target and is reported.
    * A referring row without a time is reported with a null period, as nothing is live at no time.
    * Parent rows without an id or a time never become live; repeated parent rows merge into one run.
    * A referring row that occurs twice is reported twice.  Empty tables give no rows.
    * Other columns of the tables, whatever their names, are not read.
    """
    number = {t.name: i for i, t in enumerate(targets)}
    sources: list[tuple[str, str]] = []
    time = lambda c: F.col(c).cast("timestamp_ntz")
    events = []
    for t in targets:
        events.append(t.rows.select(
            F.lit(number[t.name]).alias("target"), t.key.alias("key"), time(t.since).alias("at"), F.lit(False).alias("is_reference"),
            time(t.until).alias("until"), F.lit(None).cast("int").alias("source"), F.lit(None).cast("bigint").alias("row_id"),
        ).where("key is not null and at is not null"))
    nothing = F.lit(b"")  # sorts before every key, and no parent has it
    for r in referrers:
        fields = []
        for ref in r.references:
            key = F.when(time(r.at).isNotNull(), ref.key)
            fields.append(F.when(~is_blank(F.col(ref.field)), F.struct(
                F.lit(number[ref.target]).alias("target"), F.coalesce(key, nothing).alias("key"), F.lit(len(sources)).alias("source"))))
            sources.append((r.name, ref.field))
        events.append(r.rows.select(
            F.col(r.row_id).cast("bigint").alias("row_id"), time(r.at).alias("at"), F.explode(F.array_compact(F.array(*fields))).alias("ref"),
        ).select("ref.target", "ref.key", "at", F.lit(True).alias("is_reference"), F.lit(None).cast("timestamp_ntz").alias("until"), "ref.source", "row_id"))
    union = reduce(DataFrame.unionByName, [e.select(*EVENT) for e in events])
    order = [F.col(c) for c in EVENT[:4]]
    scanned = materialize(range_sorted(union, order, partitions).mapInArrow(_scan, SCANNED), "orphans")
    summary = scanned.where("last_key is not null")
    reach = F.broadcast(carried(summary, "part", ["first_target", "first_key"], ["last_target", "last_key"], F.max("reach")))  # at most a row a partition
    lost = scanned.where("last_key is null").join(reach, "part", "left").where(~F.col("open") | F.col("carried").isNull() | (F.col("carried") <= F.col("micros")))
    names = F.array(*[F.struct(F.lit(a).alias("t"), F.lit(b).alias("f")) for a, b in sources])
    return lost.select(
        names[F.col("source")]["t"].alias("table_name"), names[F.col("source")]["f"].alias("field_name"), "row_id",
        F.date_format("at", "yyyy-MM").alias("period"),
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Number of orphan references per table, field and period; counts are combined before they are shuffled."""
    return orphans.groupBy("table_name", "field_name", "period").agg(F.count(F.lit(1)).alias("orphans"))
