"""Taxonomy paths: shared prefixes, common values and the preferred assignment of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.text import ascii_escaped

MIXED = "mixed"
AMBIGUOUS = "ambiguous"
UNCLASSIFIED = "Unclassified"


def path_ranks(path: Column) -> Column:
    """Ranks of a ``;``-joined path: trimmed, without empty ranks at the end; inner gaps stay; an empty path has none."""
    trimmed = F.regexp_replace(F.coalesce(path, F.lit("")), r"\A\s+|\s+\z|(?<=;)\s+|\s+(?=;)", "")
    joined = F.regexp_replace(trimmed, r";+\z", "")
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ";", -1))


def valid_path(path: Column) -> Column:
    """path_ranks of a path whose first rank is not empty; null for others, which take no part in an ancestor."""
    ranks = path_ranks(path)
    return F.when(F.coalesce(F.get(ranks, 0), F.lit("")) != "", ranks)


def shared_prefix(paths: Column) -> Column:
    """Longest prefix of an array of rank arrays, ending before the first gap; no paths share the empty one."""
    first = F.get(paths, 0)
    shortest = F.array_min(F.transform(paths, lambda p: F.size(p)))
    same = lambda i: (F.get(first, i - 1) != "") & F.forall(paths, lambda p: F.get(p, i - 1) == F.get(first, i - 1))
    depth = F.aggregate(F.sequence(F.lit(1), shortest), F.lit(0), lambda d, i: F.when((d == i - 1) & same(i), i).otherwise(d))
    none = F.array().cast("array<string>")
    return F.when((F.size(paths) > 0) & (shortest > 0), F.slice(first, F.lit(1), depth)).otherwise(none)


def _joined(low: str, high: str) -> Column:
    return F.coalesce(F.array_join(shared_prefix(F.array(low, high)), ";"), F.lit(""))


def lowest_common_ancestor(df: DataFrame, keys: Sequence[str], path: str, name: str = "lca") -> DataFrame:
    """``keys`` and the shared prefix of each group's paths as ``;``-joined text.

    Equal paths collapse on the map side.  The shared prefix of sorted paths is that of the least and the greatest,
    because ranks are compared one by one there too; so two paths per group are kept, not all of them.
    """
    ranks = valid_path(F.col(path))
    ends = df.select(*keys, ranks.alias("__p")).groupBy(*keys).agg(F.min("__p").alias("__a"), F.max("__p").alias("__b"))
    return ends.select(*keys, _joined("__a", "__b").alias(name))


def common_ancestors(members: DataFrame, item: str, paths: DataFrame, keys: Sequence[str], path: str, name: str = "lca") -> DataFrame:
    """lowest_common_ancestor of groups whose ``members`` name their paths by ``item``: paths are parsed once each, before they are joined.

    The distinct paths are exchanged, so that they are rows when they meet the members; a mere projection would be
    evaluated anew for every member.
    """
    parsed = paths.select(item, valid_path(F.col(path)).alias("__p")).distinct()
    ends = members.select(*keys, item).join(parsed, item).groupBy(*keys).agg(F.min("__p").alias("__a"), F.max("__p").alias("__b"))
    return ends.select(*keys, _joined("__a", "__b").alias(name))


def common_value(column: Column, conflict: str = MIXED) -> Column:
    """Aggregate: the one value that is not empty, ``conflict`` if there are several, empty if there is none."""
    held = F.nullif(column, F.lit(""))
    low, high = F.min(held), F.max(held)
    return F.when(low.isNull(), "").when(low == high, low).otherwise(conflict)


def concrete_domain(domain: Column) -> Column:
    """A domain that names one: not empty, ambiguous or unclassified."""
    return F.when(~domain.isin("", AMBIGUOUS, UNCLASSIFIED), domain)


CANDIDATE = ("assignment_method", "compartment", "domain", "taxonomy", "taxonomy_source")  # members of an alternative, in order
# What a row of evidence may have besides its path and domain, and what counts where it lacks a column.
EVIDENCE = {"cross_domain_conflict": "false", "compartment": "''", "assignment_method": "''", "taxonomy_source": "''", "reference_source": "''", "taxonomy_alternatives": "''"}


def merged_alternatives(df: DataFrame, keys: Sequence[str], checked: bool = True) -> DataFrame:
    """``keys, taxonomy_alternatives``: the distinct alternatives of each group as one JSON array, sorted, ``[]`` without any.

    A row's alternatives are the objects of its ``taxonomy_alternatives``, members in order, or where that is empty the
    row itself, if it has a taxonomy or a domain.  Text that is no JSON array of objects is an error, or counts as
    empty where it is not ``checked``.
    """
    text = F.coalesce(F.col("taxonomy_alternatives"), F.lit(""))
    objects = F.transform(F.from_json(text, "array<map<string,string>>"), lambda m: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m)))))
    filled = lambda c: F.coalesce(F.col(c), F.lit(""))
    none = F.array().cast("array<string>")
    own = F.when((filled("taxonomy") != "") | (filled("domain") != ""), F.array(F.to_json(F.struct(*[filled(c).alias(c) for c in CANDIDATE])))).otherwise(none)
    valid = F.col("__o").isNotNull() & text.rlike(r"\A\s*\[")
    wrong = F.raise_error(F.lit("taxonomy_alternatives must be a JSON array of objects")) if checked else own
    held = df.withColumn("__o", objects).select(*keys, F.explode_outer(F.when(text == "", own).when(valid, F.col("__o")).otherwise(wrong)).alias("__c"))
    return held.groupBy(*keys).agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_set(ascii_escaped(F.col("__c")))), ","), F.lit("]")).alias("taxonomy_alternatives"))


def assign_taxonomy(best: DataFrame, keys: Sequence[str], limit: int, alternatives: bool = False, checked: bool = True) -> DataFrame:
    """Assignment from the equally best rows of each key.

    ``best`` has ``taxonomy, domain`` and, where there are any, the columns of EVIDENCE.  Gives ``keys, domain, taxonomy,
    compartment, assignment_method, taxonomy_source, reference_source, ties, truncated`` and with ``alternatives`` also
    ``taxonomy_alternatives``.

    * Rows of several domains, and rows that are ambiguous or in conflict themselves, make the key ambiguous: no
      taxonomy, a mixed compartment, and the alternatives of all rows.
    * More than ``limit`` rows may be cut off, so only their domain is certain, and no compartment.
    * Otherwise the common ancestor of the valid paths is assigned; an empty one gives way to the domain or Unclassified.
    """
    rows = best.select(*keys, "taxonomy", F.coalesce("domain", F.lit("")).alias("domain"), *[(F.col(c) if c in best.columns else F.expr(d)).alias(c) for c, d in EVIDENCE.items()])
    held = concrete_domain(F.col("domain"))
    grouped = rows.withColumn("__p", valid_path(F.col("taxonomy"))).groupBy(*keys).agg(
        F.min("__p").alias("__a"), F.max("__p").alias("__b"), F.min(held).alias("__low"), F.max(held).alias("__high"), F.count(F.lit(1)).alias("ties"),
        F.bool_or(F.coalesce("cross_domain_conflict", F.lit(False)) | (F.col("domain") == AMBIGUOUS)).alias("__conflict"), F.min("assignment_method").alias("__method"),
        *[common_value(F.col(c)).alias(f"__{c}") for c in ("domain", "compartment", "assignment_method", "taxonomy_source", "reference_source", "taxonomy_alternatives")])
    ambiguous = F.col("__conflict") | F.coalesce(F.col("__low") != F.col("__high"), F.lit(False))
    truncated, one = F.col("ties") > limit, F.col("__domain")
    path = F.when(truncated, one).otherwise(_joined("__a", "__b"))
    method = (
        F.when(ambiguous & (F.col("ties") == 1), F.coalesce("__method", F.lit(""))).when(ambiguous, "cross_domain_ambiguous_equal_best")
        .when(truncated, "truncated_equal_best_lca").otherwise(F.col("__assignment_method")))
    assigned = grouped.select(
        *keys, F.when(ambiguous, AMBIGUOUS).otherwise(one).alias("domain"),
        F.when(ambiguous, "").when(path != "", path).when(one != "", one).otherwise(UNCLASSIFIED).alias("taxonomy"),
        F.when(ambiguous, MIXED).when(truncated, "").otherwise(F.col("__compartment")).alias("compartment"), method.alias("assignment_method"),
        F.col("__taxonomy_source").alias("taxonomy_source"), F.col("__reference_source").alias("reference_source"), "ties", truncated.alias("truncated"),
        F.col("__taxonomy_alternatives").alias("taxonomy_alternatives"))
    if not alternatives:
        return assigned.drop("taxonomy_alternatives")
    # only ambiguous keys are asked for their rows again
    several = merged_alternatives(rows.join(assigned.where(F.col("domain") == AMBIGUOUS).select(*keys), list(keys), "left_semi"), keys, checked)
    joined = assigned.join(several.withColumnRenamed("taxonomy_alternatives", "__merged"), list(keys), "left")
    return joined.withColumn("taxonomy_alternatives", F.when(F.col("domain") == AMBIGUOUS, F.coalesce("__merged", F.lit("[]"))).otherwise(F.col("taxonomy_alternatives"))).drop("__merged")


def preferred(df: DataFrame, keys: Sequence[str], priority: Column, domain: str, path: str, others: Sequence[Column] = ()) -> DataFrame:
    """The rows of least priority decide: ``keys, priority, domain, taxonomy, best_rows, paths, conflict`` and ``others``.

    Priority comes before conflict: a domain that only rows of a higher number name never conflicts.  ``paths`` says
    whether the paths differ; ``others`` are further aggregates of the deciding rows, with names of their own.
    """
    rows = df.withColumn("priority", priority)
    best = rows.join(rows.groupBy(*keys).agg(F.min("priority").alias("priority")), [*keys, "priority"], "left_semi")
    held = F.when(~F.col(domain).isin("", UNCLASSIFIED), F.col(domain))
    grouped = best.withColumn("__d", held).withColumn("__p", valid_path(F.col(path))).groupBy(*keys).agg(
        F.min("priority").cast("bigint").alias("priority"), F.min("__d").alias("__low"), F.max("__d").alias("__high"),
        F.min("__p").alias("__a"), F.max("__p").alias("__b"), F.count(F.lit(1)).alias("best_rows"), *others)
    conflict = F.coalesce(F.col("__low") != F.col("__high"), F.lit(False))
    return grouped.select(
        *keys, "priority", F.when(conflict, AMBIGUOUS).otherwise(F.coalesce("__low", F.lit(""))).alias("domain"),
        F.when(conflict, "").otherwise(_joined("__a", "__b")).alias("taxonomy"), "best_rows", F.coalesce(F.col("__a") != F.col("__b"), F.lit(False)).alias("paths"), conflict.alias("conflict"),
        *[c for c in grouped.columns if not c.startswith("__") and c not in (*keys, "priority", "best_rows")])
