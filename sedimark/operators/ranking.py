"""Ranks, ties, windows of candidates and evidence within groups.

Where the first rows of a group are wanted, a window function does it, and the filter on the rank lets Spark limit each
group before its shuffle.  What depends on a whole group (its best score, a threshold, the first row of a source) is
aggregated and joined back, so that no group has to be sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in ``order``; null keys form a group of their own."""
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def equal_best(df: DataFrame, keys: Sequence[str], score: str, limit: int) -> DataFrame:
    """Best score of each group, how many rows share it, and whether those are more than ``limit``.

    Rows are counted per (group, score) first, so no group is sorted or gathered.
    """
    counted = df.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("ties"))
    best = counted.groupBy(*keys).agg(F.max(F.struct(F.col(score), F.col("ties"))).alias("b"))
    return best.select(*keys, F.col(f"b.{score}").alias("best"), F.col("b.ties").alias("ties"), (F.col("b.ties") > limit).alias("truncated"))


def best_score_rows(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """The rows whose score equals the best of their group; scores that are null never do, nor do rows with a null key.

    The best scores are aggregated, and rows meet them by group and score, so a large group is spread by its scores.
    """
    best = df.groupBy(*keys).agg(F.max(score).alias(score))
    return df.join(best, [*keys, score], "left_semi").select(*df.columns)


def candidates(df: DataFrame, keys: Sequence[str], score: Column, order: Sequence[Column], fraction: str, eligible: Column, limit: int) -> DataFrame:
    """Eligible rows within ``fraction`` of the best eligible score of their group, compared as exact decimals.

    Adds ``threshold`` and ``truncated``: whether the group may have lost candidates, that is whether row ``limit + 1``
    of all its rows in ``order``, eligible or not, is still within the window.  ``limit`` places that row only; rows
    beyond it are candidates like any other.  Groups without an eligible row give none, nor do null keys.

    Each group is reduced to its bounds first (partial maxima; no more than ``limit + 1`` rows of a group leave a
    partition), and rows then meet their bounds in a join, which Spark splits where a key is skewed.
    """
    exact = score.cast("decimal(18,6)")
    best = df.groupBy(*keys).agg(F.max(F.when(eligible, exact)).alias("__best"))
    cut = first_rows(df.withColumn("__cut", exact), keys, order, limit + 1, rank="__n").where(F.col("__n") == limit + 1).select(*keys, "__cut")
    threshold = F.col("__best") * F.lit(fraction).cast("decimal(3,2)")
    bounds = best.where("__best is not null").join(cut, list(keys), "left").select(*keys, threshold.alias("threshold"), F.coalesce(F.col("__cut") >= threshold, F.lit(False)).alias("truncated"))
    return df.join(bounds, list(keys)).where(eligible & (exact >= F.col("threshold"))).select(*df.columns, "threshold", "truncated")


def top_with_evidence(df: DataFrame, keys: Sequence[str], order: Sequence[Column], score: str, sources: Column, names: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group, all as good as the best, and the first of each source: with ``rank`` and ``reasons``.

    ``order`` are values in ascending order, the first of them following ``score``; no two rows of a group may agree in
    all of them.  ``sources`` is the array of a row's sources, ``names`` those that count.  Reasons come in a fixed
    order: ``overall_top_n``, ``equal_best_assignment``, ``best_...`` for each name.

    Rows with a null key or score take no part in groups and are left out; an empty table gives none.

    Groups are not sorted: their bounds are aggregated, the rows within them picked, and where the first row of a source
    lies deep in its group, the rows before it are counted.
    """
    held = df.where(F.col(score).isNotNull()).withColumn("__o", F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)]))
    first = [F.min(F.when(F.array_contains(sources, name), F.col("__o"))).alias(f"__f{i}") for i, name in enumerate(names)]
    last = first_rows(held.select(*keys, "__o"), keys, [F.col("__o")], n).groupBy(*keys).agg(F.max("__o").alias("__last"))
    bounds = held.groupBy(*keys).agg(F.max(score).alias("__best"), *first).join(last, list(keys))
    joined = held.join(bounds, list(keys))
    before = joined.groupBy(*keys).agg(*[F.count_if(F.col("__o") < F.col(f"__f{i}")).alias(f"__n{i}") for i in range(len(names))])
    front = (F.col("__o") <= F.col("__last")) | (F.col(score) == F.col("__best"))
    reasons = F.concat_ws(
        "|", F.when(F.col("__o") <= F.col("__last"), "overall_top_n"), F.when(F.col(score) == F.col("__best"), "equal_best_assignment"),
        *[F.when(F.col("__o") == F.col(f"__f{i}"), f"best_{name}") for i, name in enumerate(names)])
    # nothing comes before a row of the front but other rows of the front, so its number among the picked rows is its rank
    picked = joined.withColumn("reasons", reasons).where("reasons <> ''").withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy("__o"))).join(before, list(keys))
    deep = F.coalesce(*[F.when(F.col("__o") == F.col(f"__f{i}"), F.col(f"__n{i}") + 1) for i in range(len(names))], F.col("__rank"))
    return picked.withColumn("rank", F.when(front, F.col("__rank")).otherwise(deep).cast("bigint")).select(*df.columns, "rank", "reasons")


def merged_ranking(df: DataFrame, keys: Sequence[str], item: str, order: Sequence[Column], n: int) -> DataFrame:
    """Several ranked lists merged: each item once per group at its best place, the first ``n`` of them."""
    once = first_rows(df, [*keys, item], order)
    return first_rows(once, keys, order, n, rank="rank")


def vote(df: DataFrame, keys: Sequence[str], item: str, choice: str, names: Sequence[str], order: Sequence[Column], score: str, n: int, preferred: Column | None = None) -> DataFrame:
    """What the first ``n`` of each group's merged ranking vote for: ``keys, votes_<name>, best_<name>, chosen, decision``.

    The most votes decide, then the best score of all rows of a name, then the ``preferred`` one, then the order of ``names``.
    """
    ranked = merged_ranking(df, keys, item, order, n).groupBy(*keys).agg(*[F.count_if(F.col(choice) == name).alias(f"votes_{name}") for name in names])
    best = df.groupBy(*keys).agg(*[F.max(F.when(F.col(choice) == name, F.col(score))).alias(f"best_{name}") for name in names], *([F.first(preferred, ignorenulls=True).alias("__preferred")] if preferred is not None else []))
    rows = ranked.join(best, list(keys))
    first = F.coalesce(F.col("__preferred"), F.lit("")) if preferred is not None else F.lit("")
    one = lambda i, name: F.struct(F.col(f"votes_{name}").alias("v"), F.coalesce(F.col(f"best_{name}").cast("double"), F.lit(float("-inf"))).alias("b"), (first == name).alias("p"), F.lit(-i).alias("i"), F.lit(name).alias("n"))
    sorted_ = F.sort_array(F.array(*[one(i, name) for i, name in enumerate(names)]), asc=False)
    top, second = F.get(sorted_, 0), F.get(sorted_, 1)
    decision = F.when(top["v"] != second["v"], "majority_global_top_hits").when(top["b"] != second["b"], "best_bitscore_tiebreak").otherwise("detected_model_tiebreak")
    return rows.withColumn("chosen", top["n"]).withColumn("decision", decision).drop("__preferred")


def nearest_with_ties(df: DataFrame, keys: Sequence[str], distance: str, order: Sequence[Column], k: int, tolerance: float = 1e-12) -> DataFrame:
    """The k nearest rows of each group and all rows as near as the last of them, up to a relative and absolute ``tolerance``."""
    d = F.col(distance)
    rows = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(d, *order)))
    rows = rows.withColumn("__b", F.max(F.when(F.col("__n") <= k, d)).over(Window.partitionBy(*keys)))
    b = F.col("__b")
    near = (d < b) | (F.abs(d - b) <= F.greatest(F.lit(tolerance) * F.greatest(F.abs(d), F.abs(b)), F.lit(tolerance)))
    return rows.where(near).drop("__n", "__b")


def nearest_vectors(rows: DataFrame, queries: DataFrame, item: str, vector: str, k: int, digits: int = 6, block: int = 1024) -> DataFrame:
    """``query, item, distance``: the k rows nearest to each query other than itself, and all as near as the last of them.

    Both tables have ``item`` and ``vector``; distances are Euclidean and rounded to ``digits`` places.  Rows and queries
    are packed into blocks of at most ``block`` vectors and every block meets every other.  A pair of blocks keeps per
    query only what may be among its nearest, so the pairs themselves are never shuffled.  Vectors that are null take no
    part; where a distance is not a number there is none.
    """
    kind = dict(rows.dtypes)[item]

    def packed(df: DataFrame, name: str) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    part = batch.slice(at, block)
                    columns = [pa.array([c.to_pylist()], pa.list_(c.type)) for c in part.columns]
                    yield pa.RecordBatch.from_arrays(columns, names=[f"{name}_ids", f"{name}_vectors"])

        held = df.select(F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v")).where("i is not null and v is not null")
        return held.mapInArrow(pack, f"{name}_ids array<{kind}>, {name}_vectors array<array<double>>")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1)
                query_ids, query_vectors, row_ids, row_vectors = (pair.column(n)[0].values for n in ("q_ids", "q_vectors", "r_ids", "r_vectors"))
                q, r = _matrix(query_vectors), _matrix(row_vectors)
                if q.shape[1] != r.shape[1]:
                    raise ValueError(f"vectors of {q.shape[1]} and {r.shape[1]} numbers")
                total = np.zeros((len(q), len(r)))
                for d in range(q.shape[1]):  # in the order of the numbers, so that the sum is the same everywhere
                    total += (q[:, d, None] - r[None, :, d]) ** 2
                far = np.sqrt(total)
                far[np.array(query_ids.to_pylist(), dtype=object)[:, None] == np.array(row_ids.to_pylist(), dtype=object)[None, :]] = np.nan
                ordered = np.where(np.isnan(far), np.inf, far)
                last = np.partition(ordered, k - 1, axis=1)[:, k - 1] if len(r) > k else np.full(len(q), np.inf)
                # what differs from the last by less than rounding and tolerance may still tie with it
                a, b = np.nonzero(far <= (last * (1 + 1e-9) + 2 * 10.0**-digits)[:, None])
                yield pa.RecordBatch.from_arrays([query_ids.take(pa.array(a)), row_ids.take(pa.array(b)), pa.array(far[a, b])], names=["query", "item", "distance"])

    pairs = packed(rows, "r").crossJoin(packed(queries, "q"))
    kept = pairs.mapInArrow(meet, f"query {kind}, item {kind}, distance double").withColumn("distance", F.round("distance", digits))
    return nearest_with_ties(kept, ["query"], "distance", [F.col("item")], k)


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """A list of equally long vectors as a matrix; null numbers are not a number."""
    lengths = set(vectors.value_lengths().to_pylist())
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), -1)


def chunk_bounds(df: DataFrame, position: str, chunks: int) -> DataFrame:
    """``df`` with ``chunk``: contiguous chunks by the order of ``position``, whose sizes differ by one at most, the first ones larger.

    A window without partitions would gather all rows in one task.  The rows are range partitioned instead; only
    the number of rows of each partition is needed to know every row's place, and it is a row a partition.
    """
    from sedimark.operators.ranged import range_sorted
    from sedimark.storage import materialize

    rows = materialize(range_sorted(df, [F.col(position)]).select("*", F.spark_partition_id().alias("__part")), "chunks")
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = counts.select("__part", (F.sum("__rows").over(Window.orderBy("__part")) - F.col("__rows")).alias("__before"), F.sum("__rows").over(Window.partitionBy(F.lit(0))).alias("__total"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(position)) + F.col("__before") - 1
    placed = rows.join(F.broadcast(before), "__part").withColumn("__i", place)
    size, extra = F.floor(F.col("__total") / chunks), F.col("__total") % chunks
    head = extra * (size + 1)
    chunk = F.when(F.col("__i") < head, F.floor(F.col("__i") / (size + 1))).otherwise(extra + F.floor((F.col("__i") - head) / F.greatest(size, F.lit(1)))) + 1
    return placed.select(*df.columns, chunk.cast("bigint").alias("chunk"))


def chunk_plan(df: DataFrame, position: str, chunks: int) -> DataFrame:
    """``chunk, size, first, last`` of chunk_bounds."""
    placed = chunk_bounds(df.select(F.col(position).alias("p")), "p", chunks)
    return placed.groupBy("chunk").agg(F.count(F.lit(1)).alias("size"), F.min("p").alias("first"), F.max("p").alias("last"))
