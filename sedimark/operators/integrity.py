"""Violations of keys and references, gathered before anything is raised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """Rows that break a rule."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def duplicate_texts(df: DataFrame, text: str) -> DataFrame:
    """Texts that occur more than once, with their number of rows: ``<text>, rows``.

    Only digests are shuffled, until the few texts that share one are compared themselves.
    """
    digests = df.select(F.unhex(F.sha2(F.col(text), 256)).alias("__d"))
    twice = digests.groupBy("__d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__d")
    held = df.select(text, F.unhex(F.sha2(F.col(text), 256)).alias("__d")).join(twice, "__d", "left_semi")
    return duplicate_keys(held, [text])


def with_defaults(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """``left`` with the columns of ``right``, which has a key once, and ``defaults`` where it lacks the key or a value."""
    return left.join(right, list(keys), "left").na.fill(defaults)


def missing_parents(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` does not have."""
    return child.select(*keys).distinct().join(parent.select(*keys), list(keys), "left_anti")


def full_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``keys, status`` of two tables with unique keys: missing, extra, changed or same."""
    a = left.select(*keys, F.struct(*fields).alias("__a"))
    b = right.select(*keys, F.struct(*fields).alias("__b"))
    status = F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "extra").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("changed")
    return a.join(b, list(keys), "full_outer").select(*keys, status.alias("status"))


def require(violations: dict[str, DataFrame], examples: int = 5) -> None:
    """Raise one IntegrityError that names every rule with rows, with at most ``examples`` of each."""
    said = []
    for rule, rows in violations.items():
        found = rows.limit(examples).collect()
        if found:
            said.append(f"{rule}: " + "; ".join(str(r.asDict()) for r in found))
    if said:
        raise IntegrityError("\n".join(said))
