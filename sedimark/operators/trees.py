"""Distances in phylogenetic trees given as Newick text, and what the nearest leaves say."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.operators.integrity import missing_parents
from sedimark.operators.lineage import AMBIGUOUS, UNCLASSIFIED, common_value, shared_prefix, valid_path
from sedimark.operators.ranking import nearest_with_ties


class Node:
    __slots__ = ("children", "length", "name", "parent")

    def __init__(self, parent: Node | None = None):
        self.parent, self.children, self.name, self.length = parent, [], "", 0.0


def read_newick(text: str) -> Node:
    """Root of a tree; names may be quoted, lengths and inner names may be missing."""
    node = root = Node()
    i, n, field = 0, len(text), "name"
    while i < n:
        c = text[i]
        if c == "(":
            node.children.append(child := Node(node))
            node, field = child, "name"
        elif c == ",":
            node.parent.children.append(child := Node(node.parent))
            node, field = child, "name"
        elif c == ")":
            node, field = node.parent, "name"
        elif c == ":":
            field = "length"
        elif c == ";":
            break
        elif c == "[":
            i = text.index("]", i)
        elif not c.isspace():
            if c == "'":
                end = text.index("'", i + 1)
                token, i = text[i + 1:end], end
            else:
                end = i
                while end < n and text[end] not in "(),:;[" and not text[end].isspace():
                    end += 1
                token, i = text[i:end], end - 1
            if field == "length":
                node.length = float(token)
            else:
                node.name = token
        i += 1
    return root


def distances_from(newick: str, query: str) -> list[tuple[str, float, str | None]]:
    """``(leaf, distance, support)`` of every leaf but ``query``; support is the name of the query's parent, none where that is the root."""
    root = read_newick(newick)
    start, stack = None, [root]
    while stack:
        node = stack.pop()
        if not node.children and node.name == query:
            start = node
        stack.extend(node.children)
    if start is None:
        raise ValueError(f"the tree has no leaf {query!r}")
    above = start.parent
    support = None if above is None or above.parent is None else above.name or None
    found, seen, stack = [], {id(start)}, [(start, 0.0)]
    while stack:
        node, far = stack.pop()
        if not node.children and node is not start:
            found.append((node.name, far, support))
        around = [(c, far + c.length) for c in node.children] + ([(node.parent, far + node.length)] if node.parent is not None else [])
        for other, d in around:
            if id(other) not in seen:
                seen.add(id(other))
                stack.append((other, d))
    return sorted(found, key=lambda x: (x[1], x[0]))


def leaf_distances(trees: DataFrame, tree: str, newick: str, query: str) -> DataFrame:
    """``tree, leaf, distance, support`` of every leaf but the query's; trees without text give no rows."""
    kind = dict(trees.dtypes)[tree]

    def scan(batches):
        for pdf in batches:
            rows = [(k, *d) for k, text, q in pdf.itertuples(index=False) if text for d in distances_from(text, q)]
            yield pd.DataFrame(rows, columns=["tree", "leaf", "distance", "support"])

    return trees.select(F.col(tree).alias("tree"), newick, query).mapInPandas(scan, f"tree {kind}, leaf string, distance double, support string")


def informative_lineage(taxonomy: Column, taxonomy_source: Column, domain: Column, centroid_taxonomy: Column, centroid_source: Column) -> Column:
    """``struct<path, source, basis>`` of a reference: the deeper of its own path and its centroid's, its own if both are as deep.

    Without either its domain alone counts (basis ``domain``); one that is ambiguous or unclassified has an empty path.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    none = F.array().cast("array<string>")

    def candidate(path: Column, source: Column, basis: str) -> Column:
        ranks = F.when(text(path) != UNCLASSIFIED, valid_path(path))
        return F.when(ranks.isNotNull(), F.struct(F.size(ranks).alias("depth"), F.lit(basis).alias("basis"), ranks.alias("path"), text(source).alias("source")))

    # preferred_taxonomy sorts after centroid_taxonomy, so it wins among equally deep paths
    best = F.array_max(F.array(candidate(taxonomy, taxonomy_source, "preferred_taxonomy"), candidate(centroid_taxonomy, centroid_source, "centroid_taxonomy")))
    found = lambda path, source, basis: F.struct(path.alias("path"), source.alias("source"), basis.alias("basis"))
    return (
        F.when(text(domain) == AMBIGUOUS, found(none, F.lit(""), F.lit("ambiguous"))).when(best.isNotNull(), found(best["path"], best["source"], best["basis"]))
        .when(~text(domain).isin("", UNCLASSIFIED), found(F.array(domain), text(taxonomy_source), F.lit("domain"))).otherwise(found(none, F.lit(""), F.lit("unclassified"))))


def ranked_neighbours(distances: DataFrame, references: DataFrame, k: int = 5) -> DataFrame:
    """Every leaf of each tree with ``neighbour_rank, used, path, source, basis``: nearest first, then by hit rank, then by name.

    ``distances`` is what leaf_distances gives; ``references`` has ``tree, leaf, hit_rank, taxonomy, taxonomy_source,
    taxonomy_domain, compartment, centroid_taxonomy, centroid_taxonomy_source``.  ``used`` are the k nearest leaves with a
    lineage and all as near as the last of them.
    """
    lineage = informative_lineage(*[F.col(c) for c in ("taxonomy", "taxonomy_source", "taxonomy_domain", "centroid_taxonomy", "centroid_taxonomy_source")])
    joined = distances.join(references, ["tree", "leaf"]).withColumn("__l", lineage).select("*", "__l.path", F.col("__l.source").alias("source"), "__l.basis").drop("__l")
    order = [F.col("hit_rank"), F.col("leaf")]
    used = nearest_with_ties(joined.where(F.size("path") > 0), ["tree"], "distance", order, k).select("tree", "leaf", F.lit(True).alias("used"))
    ranked = joined.withColumn("neighbour_rank", F.row_number().over(Window.partitionBy("tree").orderBy("distance", *order)).cast("bigint"))
    return ranked.join(used, ["tree", "leaf"], "left").withColumn("used", F.coalesce("used", F.lit(False)))


def classify_by_neighbours(ranked: DataFrame) -> DataFrame:
    """One row per tree of what ranked_neighbours gives: ``tree, lineage, domain, sources, compartment, method, neighbours, nearest, nearest_distance, support``.

    The lineage is what the used leaves share; trees without a used leaf are Unclassified by a method of their own.
    Compartments that differ are mixed.
    """
    used = lambda c: F.when(F.col("used"), c)
    grouped = ranked.groupBy("tree").agg(
        F.min(used(F.col("path"))).alias("a"), F.max(used(F.col("path"))).alias("b"), F.array_join(F.array_sort(F.collect_set(used(F.nullif("source", F.lit(""))))), "|").alias("sources"),
        common_value(used(F.col("compartment"))).alias("compartment"), F.count_if("used").alias("neighbours"), F.min_by("leaf", "neighbour_rank").alias("nearest"),
        F.min_by("distance", "neighbour_rank").alias("nearest_distance"), F.first("support", ignorenulls=True).alias("support"))
    shared = F.coalesce(shared_prefix(F.array("a", "b")), F.array().cast("array<string>"))
    return grouped.select(
        "tree", F.when(F.size(shared) > 0, F.array_join(shared, ";")).otherwise(UNCLASSIFIED).alias("lineage"), F.coalesce(F.get(shared, 0), F.lit(UNCLASSIFIED)).alias("domain"), "sources", "compartment",
        F.when(F.col("neighbours") > 0, "tree_nearest_named_lca").otherwise("tree_unclassified_no_named_neighbors").alias("method"), "neighbours", "nearest", "nearest_distance", "support")


def leaf_mismatches(distances: DataFrame, references: DataFrame) -> dict[str, DataFrame]:
    """Leaves that only the tree or only the references have."""
    keys = ["tree", "leaf"]
    return {"leaf without reference": missing_parents(distances, references, keys), "reference without leaf": missing_parents(references, distances, keys)}
