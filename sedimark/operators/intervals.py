"""Overlapping intervals: pairs, the greedy contest of overlapping hits, and collinear fragments."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.operators.ranged import carried_by_key, range_sorted
from sedimark.storage import materialize


def overlapping_pairs(df: DataFrame, keys: Sequence[str], row_id: str, start: str, end: str, width: int) -> DataFrame:
    """Pairs of rows of one key whose closed intervals overlap, once each: ``keys, left, right`` with left < right.

    Each interval is cut into the slices of length ``width`` it touches and joined per (key, slice), so a key with many
    intervals meets only its neighbours; a pair is taken in the first slice both touch.  Rows with a null in a key or an
    end, or with an end before its start, overlap nothing.
    """
    rows = df.select(*keys, F.col(row_id).alias("id"), F.col(start).alias("s"), F.col(end).alias("e")).where("s <= e")
    cut = lambda c: F.floor(F.col(c) / width)
    rows = rows.withColumn("__slice", F.explode(F.sequence(cut("s"), cut("e"))))
    a, b = rows.alias("a"), rows.alias("b")
    condition = (F.col("a.id") < F.col("b.id")) & (F.col("a.s") <= F.col("b.e")) & (F.col("b.s") <= F.col("a.e"))
    for k in (*keys, "__slice"):
        condition = condition & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    condition = condition & (F.col("a.__slice") == F.floor(F.greatest("a.s", "b.s") / width))
    return a.join(b, condition).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.id").alias("left"), F.col("b.id").alias("right"))


def islands(df: DataFrame, keys: Sequence[str], start: str, end: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``island``: the start of the chain of overlapping intervals a row belongs to.

    Intervals of different islands never overlap, so a contest can be settled island by island.  The rows are sorted
    over all partitions, and a key that fills many of them is never gathered: what it brings along from earlier
    partitions (how far its intervals reach, where its last island began) is a row for each of them.
    """
    part = "__part"
    rows = materialize(range_sorted(df, [*[F.col(k) for k in keys], F.col(start), F.col(end)], partitions).select("*", F.spark_partition_id().alias(part)), "islands")
    group = [part, *keys]
    inside = Window.partitionBy(*group).orderBy(start, end)

    def inherited(summary: DataFrame, value: Column, name: str) -> DataFrame:
        return F.broadcast(carried_by_key(summary, part, list(keys), value).withColumnRenamed("carried", name))  # at most a row a partition

    reach = rows.groupBy(*group).agg(F.max(end).alias("__reach"))
    known = rows.join(inherited(reach, F.max("__reach"), "__before"), group, "left")
    running = F.greatest(F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("__before"))
    marked = known.withColumn("__running", running).withColumn("__fresh", F.when(F.coalesce(F.col("__running") >= F.col(start), F.lit(False)), None).otherwise(F.col(start)))
    begun = marked.groupBy(*group).agg(F.max("__fresh").alias("__begun"))
    whole = marked.join(inherited(begun, F.max("__begun"), "__last"), group, "left")
    here = F.last("__fresh", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return whole.withColumn("island", F.coalesce(here, F.col("__last"))).select(*df.columns, "island")


class Contest(ValueError):
    """Hits that cannot be ranked against each other."""


def settle(hits: list[dict], rivals: frozenset[str] | None = None) -> list[dict]:
    """Greedy contest of one strand: hits in order of E-value, then score; a hit is dropped if it overlaps an accepted rival.

    A dropped hit blocks nobody.  ``rivals`` are the models that compete; overlapping hits of other models are an error,
    as are rivals that tie.  Without ``rivals`` all models compete and ties go to the earlier hit.
    """
    order = sorted(hits, key=lambda h: (h["e_value"], -h["bit_score"], h["start"], h["end"], h["model"], h["hit"]))
    accepted: list[dict] = []
    starts: list[int] = []  # of the accepted hits, in order, with the hits themselves beside them
    placed: list[dict] = []
    longest = 0
    for hit in order:
        # none that starts further before the hit than the longest is long can reach it
        low, high = bisect_left(starts, hit["start"] - longest), bisect_right(starts, hit["end"])
        over = [a for a in placed[low:high] if a["model"] != hit["model"] and hit["start"] <= a["end"]]
        if rivals is not None and any(hit["model"] not in rivals or a["model"] not in rivals for a in over):
            raise Contest(f"overlapping hits of models that do not compete: {hit}")
        if rivals is not None and any((a["e_value"], a["bit_score"]) == (hit["e_value"], hit["bit_score"]) for a in over):
            raise Contest(f"overlapping hits tie: {hit}")
        if not over:
            accepted.append(hit)
            at = bisect_right(starts, hit["start"])
            starts.insert(at, hit["start"])
            placed.insert(at, hit)
            longest = max(longest, hit["end"] - hit["start"])
    return accepted


def greedy_overlap(df: DataFrame, keys: Sequence[str], hit: str, model: str, start: str, end: str, e_value: Column, bit_score: Column, rivals: frozenset[str] | None = None, partitions: int | None = None) -> DataFrame:
    """``keys, hit`` of the hits that win the contest (see settle), island by island of each key."""
    rows = df.select(*keys, F.col(hit).alias("hit"), F.col(model).cast("string").alias("model"), F.col(start).cast("bigint").alias("start"),
                     F.col(end).cast("bigint").alias("end"), e_value.cast("double").alias("e_value"), bit_score.cast("double").alias("bit_score"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.select(*keys, "hit").dtypes)
    names = [*keys, "hit"]
    group = [*keys, "island"]

    def contest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Islands come one after the other, so only the one at hand is held."""
        island: list[dict] = []
        for batch in batches:
            won: list[dict] = []
            for row in batch.to_pylist():
                if island and any(row[k] != island[0][k] for k in group):
                    won += settle(island, rivals)
                    island = []
                island.append(row)
            if won:
                yield pa.RecordBatch.from_pylist(won, schema=pa.schema([batch.schema.field(n) for n in names]))
        if island:
            yield pa.RecordBatch.from_pylist(settle(island, rivals), schema=pa.schema([batch.schema.field(n) for n in names]))

    return islands(rows, keys, "start", "end", partitions).repartition(*group).sortWithinPartitions(*group, "start", "end").mapInArrow(contest, schema)


def collinear(fragments: Column, model_from: str = "model_from", model_to: str = "model_to", seq_from: str = "seq_from", seq_to: str = "seq_to", strand: str = "strand") -> Column:
    """Whether an array of fragments lies in the same order on model and sequence: one strand, distinct ends, equal order.

    Sequence positions count downwards on the minus strand.
    """
    sign = F.when(F.get(fragments, 0)[strand] == "-", -1).otherwise(1)
    ends = F.flatten(F.transform(fragments, lambda f, i: F.array(
        F.struct(f[model_from].cast("bigint").alias("m"), (f[seq_from] * sign).cast("bigint").alias("s"), (i * 2).alias("n")),
        F.struct(f[model_to].cast("bigint").alias("m"), (f[seq_to] * sign).cast("bigint").alias("s"), (i * 2 + 1).alias("n")))))
    one = F.size(F.array_distinct(F.transform(fragments, lambda f: f[strand]))) == 1
    distinct = lambda f: F.size(F.array_distinct(F.transform(ends, lambda x: x[f]))) == F.size(ends)
    along = lambda f: F.transform(F.array_sort(F.transform(ends, lambda x: F.struct(x[f].alias("v"), x["n"].alias("n")))), lambda x: x["n"])
    return one & distinct("m") & distinct("s") & (along("m") == along("s"))


def extraction_regions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Regions to cut out of each subject, from columns ``model_from, model_to, model_length, seq_from, seq_to, strand``.

    Every hit over the full model stands alone.  A single partial hit stands alone too; several that are jointly
    collinear make one assembled region from their least to their greatest position, whether or not there are full
    hits besides; otherwise each stands alone.  Gives ``keys, start, end, strand, kind`` with kind ``simple`` or
    ``assembled``.  Only the partial hits of a subject are gathered.
    """
    low, high = F.least("seq_from", "seq_to"), F.greatest("seq_from", "seq_to")
    whole = (F.least("model_from", "model_to") == 1) & (F.greatest("model_from", "model_to") == F.col("model_length"))
    alone = df.where(whole).select(*keys, low.alias("start"), high.alias("end"), "strand", F.lit("simple").alias("kind"))
    hit = F.struct("model_from", "model_to", "seq_from", "seq_to", "strand", low.alias("low"), high.alias("high"))
    grouped = df.where(~F.coalesce(whole, F.lit(False))).groupBy(*keys).agg(F.collect_list(hit).alias("h"))
    region = lambda s, e, strand, kind: F.struct(s.alias("start"), e.alias("end"), strand.alias("strand"), F.lit(kind).alias("kind"))
    each = F.transform("h", lambda h: region(h["low"], h["high"], h["strand"], "simple"))
    joined = F.array(region(F.array_min(F.transform("h", lambda h: h["low"])), F.array_max(F.transform("h", lambda h: h["high"])), F.get("h", 0)["strand"], "assembled"))
    parts = grouped.select(*keys, F.explode(F.when((F.size("h") > 1) & collinear(F.col("h")), joined).otherwise(each)).alias("r")).select(*keys, "r.*")
    return alone.unionByName(parts)
