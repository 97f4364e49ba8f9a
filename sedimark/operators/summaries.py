"""Counts, matrices, resolution and calibration figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_distinct(column: Column, separator: str = "|") -> Column:
    """Aggregate: the distinct values that are not empty, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(column, F.lit("")))), separator)


def preview(column: Column, n: int = 5, separator: str = ", ") -> Column:
    """Aggregate: the first ``n`` values in order, joined."""
    return F.array_join(F.slice(F.array_sort(F.collect_list(column)), 1, n), separator)


def category_matrix(df: DataFrame, sample: str, category: str, items: Sequence[str], samples: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Distinct items per sample and category: a row for every sample and a column for every category, 0 where there are none.

    Items that are null in a column count as none.  Each (sample, category, item) is counted once, before the counts are spread.
    """
    once = df.where(F.col(category).isin(*categories)).dropna(subset=list(items)).select(sample, category, *items).distinct()
    counted = once.groupBy(sample).agg(*[F.count_if(F.col(category) == c).alias(c) for c in categories])
    return samples.select(sample).distinct().join(counted, sample, "left").na.fill(0, list(categories))


def composition(parts: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Counts by dimension in long form: ``dimension, category, rows``."""
    from functools import reduce

    counted = [df.groupBy(c.cast("string").alias("category")).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dimension"), "category", "rows") for name, (df, c) in parts.items()]
    return reduce(DataFrame.unionByName, counted)


# Taxa that resolve nothing.
UNRESOLVED = ("unclassified", "incertae sedis")


def is_resolved(value: Column) -> Column:
    """Whether a value names something: not null, empty, ``unclassified`` or ``incertae sedis``."""
    return F.coalesce((F.trim(value) != "") & ~F.lower(value).isin(*UNRESOLVED), F.lit(False))


def ordered_counts(df: DataFrame, keys: Sequence[str], place: Column, name: Column) -> DataFrame:
    """Rows per ``keys`` with ``place``, in the order of place, the most first, then by ``name``."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("place", place)
    return counted.orderBy("place", F.desc("rows"), name)


def resolution(df: DataFrame, group: str, value: Column, groups: DataFrame) -> DataFrame:
    """Resolved and unresolved rows per group with the percentage to three places; every group of ``groups`` is present.  See is_resolved."""
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if(is_resolved(value)).alias("resolved"))
    full = groups.select(group).distinct().join(counted, group, "left").na.fill(0, ["total", "resolved"])
    percent = F.when(F.col("total") == 0, "0.000").otherwise((F.lit(100).cast("decimal(20,0)") * F.col("resolved") / F.col("total")).cast("decimal(9,3)").cast("string"))
    return full.select(group, "resolved", (F.col("total") - F.col("resolved")).alias("unresolved"), percent.alias("percent"))


def wilson_lower_bound(successes: Column, total: Column, z: float = 1.959963984540054) -> Column:
    """Lower end of the 95 % Wilson interval; 0 without observations."""
    n = total.cast("double")
    p = successes / n
    centre = p + z * z / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(total == 0, 0.0).otherwise((centre - spread) / (1 + z * z / n))


def contiguous_cap(df: DataFrame, keys: Sequence[str], index: str, accepted: Column) -> DataFrame:
    """``keys, cap``: the greatest index up to which all are accepted, -1 if the first is not; indexes count from 0."""
    first_bad = F.min(F.when(~accepted, F.col(index)))
    return df.groupBy(*keys).agg(F.coalesce(first_bad - 1, F.max(index)).cast("bigint").alias("cap"))
