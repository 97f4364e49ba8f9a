"""From prepared source records to the tables of a release, and the rules they must keep."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark import storage
from sedimark.functions.sequences import content_id, coordinate, stable_id
from sedimark.functions.text import ascii_escaped
from sedimark.operators.integrity import IntegrityError, duplicate_keys, missing_parents, require
from sedimark.operators.lineage import AMBIGUOUS, CANDIDATE, MIXED, UNCLASSIFIED, common_value, path_ranks, preferred, shared_prefix, valid_path
from sedimark.sinks import files

# Priorities of assignments, compartments of the two native sources, methods of derived assignments, columns of locations.
NATIVE, UPDATED, OTHER = 0, 10, 20
ORGANELLES = ("nucleus", "nucleomorph", "plastid", "apicoplast", "chromatophore", "mitochondrion", "mitochondria")
COMPARTMENTS = ("", "mixed", "unknown", *ORGANELLES[:-1])
UPDATED_METHODS = ("updated_reference_cluster", "updated_reference_derived")
DERIVED_METHODS = (*UPDATED_METHODS, "updated_reference_unclassified")
CONFLICT_METHOD = "cross_domain_ambiguous_exact_sequence"
LOCATION = ("taxon_oid", "latitude", "longitude")
PRIVATE = ("email", "contact", "name", "comment", "address", "phone", "institution")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


# ---- tables ---------------------------------------------------------------------------------------------------------


def sequences(prepared: DataFrame) -> DataFrame:
    """Exact sequences once, under their content id, with their length, digest and sorted markers."""
    return prepared.groupBy(content_id(F.col("sequence")).alias("sequence_id")).agg(
        F.max(F.length("sequence")).cast("bigint").alias("length"), F.max(F.sha2("sequence", 256)).alias("sha256"), F.array_join(F.array_sort(F.collect_set("marker")), ";").alias("markers"))


RECORD = ("reference_source", "source_version", "source_identifier", "original_header", "marker")


def _identified(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn("source_record_id", stable_id("SRC_", [F.col(c) for c in RECORD])).withColumn("sequence_id", content_id(F.col("sequence")))


def source_records(prepared: DataFrame) -> DataFrame:
    """All source rows, each under an id made of RECORD; two rows with one id are an error of release_violations."""
    oid = F.col("taxon_oid") if "taxon_oid" in prepared.columns else F.lit("")
    return _identified(prepared).select("source_record_id", "sequence_id", *RECORD, F.coalesce(oid, F.lit("")).alias("taxon_oid"))


ASSIGNMENT = (
    "taxonomy_assignment_id", "source_record_id", "sequence_id", "taxonomy", "taxonomy_source", "domain", "compartment", "assignment_method", "evidence", "centroid_name", "centroid_taxonomy",
    "centroid_taxonomy_source")


def assignments(prepared: DataFrame) -> DataFrame:
    """The assignments that source rows bring along, each under an id made of its fields; rows without a path have none.

    ``taxonomy_source`` and ``evidence`` may be missing from ``prepared``: the source itself and empty text then.
    """
    rows = _identified(prepared).withColumn("__p", valid_path(F.col("taxonomy"))).where("__p is not null").withColumn("taxonomy", F.array_join("__p", ";"))
    rows = rows.withColumn("taxonomy_source", F.col("taxonomy_source") if "taxonomy_source" in prepared.columns else F.col("reference_source")).withColumn("evidence", _text("evidence") if "evidence" in prepared.columns else F.lit(""))
    rows = rows.withColumn("compartment", _text("compartment"))
    parts = [F.col(c) for c in ("source_record_id", "taxonomy", "taxonomy_source", "compartment", "assignment_method", "evidence")]
    rows = rows.withColumn("taxonomy_assignment_id", stable_id("TAX_", parts)).withColumn("domain", F.get("__p", 0))
    return rows.select(*[F.lit("").alias(c) if c.startswith("centroid") else F.col(c) for c in ASSIGNMENT])


def derived_violations(rows: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """Derived assignments (of clusters) that break a rule, by rule."""
    t = lambda c: F.trim(_text(c))
    path, above = path_ranks(F.col("taxonomy")), path_ranks(F.col("centroid_taxonomy"))
    cluster = t("assignment_method") == "updated_reference_cluster"
    known = records.where(F.upper("reference_source") == "IMG").select("source_identifier")
    of = lambda condition: rows.where(condition).select("source_identifier", "assignment_method")
    return {
        "unknown source identifier": missing_parents(rows.select(t("source_identifier").alias("source_identifier")), known, ["source_identifier"]),
        "no source, method or evidence": of((t("taxonomy_source") == "") | ~t("assignment_method").isin(*DERIVED_METHODS) | (t("evidence") == "")),
        "no taxonomy": of(F.coalesce(F.get(path, 0), F.lit("")) == ""),
        "invalid centroid name": of(t("centroid_name").rlike(r"[\r\n\t|]")),
        "no centroid evidence": of(cluster & ((t("centroid_name") == "") | (F.size(above) == 0) | (t("centroid_taxonomy_source") == ""))),
        "taxonomy beside its centroid's": of(cluster & (F.slice(above, F.lit(1), F.greatest(F.size(path), F.lit(1))) != path)),
        "no centroid name": of((t("assignment_method") == "updated_reference_unclassified") & (t("centroid_name") == "")),
    }


def derived_assignments(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Derived assignments spread to all source records of their identifier; derived_violations lists what may not come in."""
    t = lambda c: F.trim(_text(c)).alias(c)
    held = rows.select(t("source_identifier"), F.array_join(path_ranks(F.col("taxonomy")), ";").alias("taxonomy"), *[t(c) for c in ("taxonomy_source", "compartment", "assignment_method", "evidence", "centroid_name")],
                       F.array_join(path_ranks(F.col("centroid_taxonomy")), ";").alias("centroid_taxonomy"), t("centroid_taxonomy_source"))
    own = records.where(F.upper("reference_source") == "IMG").select("source_identifier", "source_record_id", "sequence_id")
    joined = held.join(own, "source_identifier")
    parts = ("source_record_id", "taxonomy", "taxonomy_source", "compartment", "assignment_method", "evidence", "centroid_name", "centroid_taxonomy", "centroid_taxonomy_source")
    return joined.withColumn("taxonomy_assignment_id", stable_id("TAX_", [F.col(c) for c in parts])).withColumn("domain", F.get(F.split("taxonomy", ";", -1), 0)).select(*ASSIGNMENT)


def with_assignments(held: DataFrame, more: DataFrame) -> DataFrame:
    """Assignments with others added to them; preferred_taxonomy of the result is that of the whole.  release_violations finds ids that are now there twice."""
    return held.unionByName(more)


def locations(rows: DataFrame, included: DataFrame | None = None) -> DataFrame:
    """``taxon_oid, latitude, longitude``, each taxon once; a pair with a coordinate out of range is dropped, not mended.

    ``rows`` has the three columns as text; what location_violations lists may not come in.  With ``included``, only
    taxa among its ``taxon_oid`` stay.
    """
    once = _pairs(rows).select(*LOCATION).distinct()
    return once if included is None else once.join(included.select("taxon_oid").distinct(), "taxon_oid", "left_semi")


def _pairs(rows: DataFrame) -> DataFrame:
    unexpected = sorted({c.strip().lower() for c in rows.columns} - set(LOCATION))
    if unexpected:
        private = [c for c in unexpected if set(PRIVATE) & set(_words(c))]
        raise IntegrityError(f"columns of persons: {private}" if private else f"columns beside {list(LOCATION)}: {unexpected}")
    text = {c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in LOCATION[1:]}
    missing = lambda c: text[c].isin("", "na", "n/a", "null")
    value = {"latitude": coordinate(F.col("latitude").cast("string"), 90.0), "longitude": coordinate(F.col("longitude").cast("string"), 180.0)}
    invalid = F.lit(False)
    for c, v in value.items():
        invalid = invalid | (~missing(c) & v.isNull())
    return rows.select(F.trim(F.coalesce("taxon_oid", F.lit(""))).alias("taxon_oid"), *[F.when(~invalid, v).alias(c) for c, v in value.items()], invalid.alias("invalid"))


def _words(name: str) -> list[str]:
    import re

    return re.split(r"[^a-z0-9]+", name)


def location_corrections(rows: DataFrame) -> DataFrame:
    """``taxon_oid, field, action, reason`` of the pairs that locations drops."""
    words = {"field": "latitude_longitude", "action": "dropped_invalid_pair", "reason": "invalid_or_out_of_range_coordinate"}
    return _pairs(rows).where("invalid").select("taxon_oid", *[F.lit(v).alias(c) for c, v in words.items()])


def location_violations(rows: DataFrame) -> dict[str, DataFrame]:
    """Taxa whose id is not digits, and taxa with two different locations."""
    pairs = _pairs(rows)
    return {"taxon_oid is not digits": pairs.where(~F.col("taxon_oid").rlike(r"\A[0-9]+\z")).select("taxon_oid"), "conflicting locations": duplicate_keys(pairs.select(*LOCATION).distinct(), ["taxon_oid"])}


# ---- preferred taxonomy ---------------------------------------------------------------------------------------------


def priority(method: str = "assignment_method", source: str = "taxonomy_source", domain: str = "domain", compartment: str = "compartment") -> Column:
    """0 for a native assignment by the source that is native to its domain or compartment, 10 for updated references, 20 for others; letter case of method, source and compartment does not count."""
    m, s, d, c = F.lower(_text(method)), F.upper(_text(source)), F.col(domain), F.lower(_text(compartment))
    native = (m == "native") & ((d.isin("Bacteria", "Archaea") & (s == "SILVA")) | (((d == "Eukaryota") | c.isin(*ORGANELLES)) & (s == "PR2")))
    return F.when(F.coalesce(native, F.lit(False)), NATIVE).when(m.isin(*UPDATED_METHODS), UPDATED).otherwise(OTHER)


def source_union(column: Column) -> Column:
    """Aggregate: the sources named in ``+``-joined texts, sorted, joined again."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(F.split(column, r"\+"))), lambda x: x != ""))), "+")


def centroid_columns() -> list[Column]:
    """Aggregates of assignments for centroids: ``names, low_centroid, high_centroid, centroid_sources``; only rows with a centroid's name count."""
    named = _text("centroid_name") != ""
    path = F.when(named, valid_path(F.col("centroid_taxonomy")))
    return [F.array_sort(F.collect_set(F.when(named, F.col("centroid_name")))).alias("names"), F.min(path).alias("low_centroid"), F.max(path).alias("high_centroid"), source_union(F.when(named, F.col("centroid_taxonomy_source"))).alias("centroid_sources")]


def centroid_values() -> list[Column]:
    """``centroid_names, centroid_taxonomy, centroid_taxonomy_source`` from centroid_columns: names as sorted JSON, sources only beside a taxonomy."""
    taxonomy = F.coalesce(F.array_join(shared_prefix(F.array("low_centroid", "high_centroid")), ";"), F.lit(""))
    return [F.when(F.size("names") > 0, ascii_escaped(F.to_json("names"))).otherwise("").alias("centroid_names"), taxonomy.alias("centroid_taxonomy"), F.when(taxonomy != "", F.col("centroid_sources")).otherwise("").alias("centroid_taxonomy_source")]


def centroid_summary(held: DataFrame, keys: Sequence[str] = ("sequence_id",)) -> DataFrame:
    """Per key what centroid_values gives of its assignments."""
    return held.groupBy(*keys).agg(*centroid_columns()).select(*keys, *centroid_values())


def preferred_taxonomy(held: DataFrame, checked: bool = True) -> DataFrame:
    """One row per sequence: the assignments of least priority, their conflict or their common ancestor.

    On a conflict of domains the taxonomy is empty, the domain ambiguous, the compartment mixed, and all deciding
    assignments are listed as JSON, ordered by source, path, compartment and record; otherwise the method is
    ``lowest_common_ancestor`` if the paths differ, else that of the first assignment by record.  Without conflict and
    without a common domain it is an error, or the taxonomy stays empty where it is not ``checked``.
    """
    native = F.lower(_text("assignment_method")) == "native"
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "+")
    chosen = preferred(held, ["sequence_id"], priority(), "domain", "taxonomy", [
        listed(_text("taxonomy_source")).alias("taxonomy_source"), listed(F.when(native, _text("taxonomy_source")).otherwise("IMG")).alias("reference"), common_value(F.col("compartment"), MIXED).alias("compartment"),
        F.min_by("assignment_method", F.struct("source_record_id", "assignment_method")).alias("method"), *centroid_columns()])
    # only the assignments of conflicts are gathered, as they are the result there
    least = chosen.where("conflict").select("sequence_id", F.col("priority").alias("least"))
    alternative = F.struct(
        _text("taxonomy_source").alias("a"), path_ranks(F.col("taxonomy")).alias("b"), _text("compartment").alias("c"), F.col("source_record_id").alias("d"),
        F.to_json(F.struct(*[(F.array_join(path_ranks(F.col(c)), ";") if c == "taxonomy" else _text(c)).alias(c) for c in CANDIDATE])).alias("json"))
    several = held.join(least, "sequence_id").where(priority() == F.col("least")).groupBy("sequence_id").agg(F.array_sort(F.collect_list(alternative)).alias("alternatives"))
    chosen = chosen.join(several, "sequence_id", "left")
    none = F.col("taxonomy") == ""
    path = F.when(none & ~F.col("conflict"), F.raise_error(F.concat(F.lit("no common taxonomy domain for "), "sequence_id"))).otherwise(F.col("taxonomy")) if checked else F.col("taxonomy")
    listing = F.concat(F.lit("["), F.array_join(F.transform("alternatives", lambda x: ascii_escaped(x["json"])), ","), F.lit("]"))
    return chosen.select(
        "sequence_id", F.when(F.col("conflict"), F.col("taxonomy_source")).otherwise(F.col("reference")).alias("reference_source"), path.alias("taxonomy"), "taxonomy_source",
        F.when(F.col("conflict"), AMBIGUOUS).otherwise(F.coalesce(F.get(F.split("taxonomy", ";", -1), 0), F.lit(""))).alias("domain"), F.when(F.col("conflict"), MIXED).otherwise(F.col("compartment")).alias("compartment"),
        F.when(F.col("conflict"), CONFLICT_METHOD).when(F.col("paths"), "lowest_common_ancestor").otherwise(F.col("method")).alias("assignment_method"), F.col("conflict").alias("cross_domain_conflict"),
        F.when(F.col("conflict"), listing).otherwise("").alias("taxonomy_alternatives"), *centroid_values())


# ---- rules ----------------------------------------------------------------------------------------------------------


def release_violations(seqs: DataFrame, records: DataFrame, held: DataFrame, chosen: DataFrame, places: DataFrame | None = None) -> dict[str, DataFrame]:
    """Rows that break the rules of a release, by rule; see ``operators.integrity.require``.

    ``seqs`` may bring ``sequence`` along; its content is then compared with its id.
    """
    owner = records.select("source_record_id", F.col("sequence_id").alias("owner"))
    markers = records.groupBy("sequence_id").agg(F.array_join(F.array_sort(F.collect_set("marker")), ";").alias("held"))
    above, path = path_ranks(F.col("centroid_taxonomy")), path_ranks(F.col("taxonomy"))
    named, cluster = _text("centroid_name") != "", F.col("assignment_method") == "updated_reference_cluster"
    suffix = F.exists(path, lambda x: F.contains(x, F.lit(":")))
    of = lambda condition: held.where(condition).select("taxonomy_assignment_id")
    row = lambda condition: chosen.where(condition).select("sequence_id")
    conflict = F.coalesce(F.col("cross_domain_conflict"), F.lit(False))
    settled = (F.col("domain") == AMBIGUOUS) & (_text("taxonomy") == "") & (F.col("compartment") == MIXED) & (F.col("assignment_method") == CONFLICT_METHOD) & (_text("taxonomy_alternatives") != "")
    names = F.from_json("centroid_names", "array<string>")
    listed = _text("centroid_names") != ""
    bad_names = names.isNull() | (F.size(names) == 0) | F.exists(names, lambda x: x.isNull() | (x == "") | x.rlike(r"[\r\n\t|]")) | (names != F.array_sort(F.array_distinct(names)))
    domain = F.get(path, 0)
    rules = {
        "sequence twice": duplicate_keys(seqs, ["sequence_id"]),
        "record twice": duplicate_keys(records, ["source_record_id"]),
        "assignment twice": duplicate_keys(held, ["taxonomy_assignment_id"]),
        "preferred twice": duplicate_keys(chosen, ["sequence_id"]),
        "record without sequence": missing_parents(records, seqs, ["sequence_id"]),
        "assignment without record": missing_parents(held, records, ["source_record_id"]),
        "assignment without sequence": missing_parents(held, seqs, ["sequence_id"]),
        "assignment of another sequence": held.join(owner, "source_record_id").where("owner <> sequence_id").select("source_record_id", "sequence_id", "owner"),
        "sequence without marker": seqs.where(_text("markers") == "").select("sequence_id"),
        "markers differ": seqs.join(markers, "sequence_id", "left").where(_text("markers") != _text("held")).select("sequence_id", "markers", "held"),
        "suffix of a compartment in an assignment": of((F.upper("taxonomy_source") == "PR2") & suffix),
        "invalid centroid name": of(F.col("centroid_name").rlike(r"[\r\n\t|]")),
        "invalid centroid evidence": of(named & cluster & ((F.size(above) == 0) | (_text("centroid_taxonomy_source") == "") | (F.slice(above, F.lit(1), F.greatest(F.size(path), F.lit(1))) != path))),
        "no centroid name": of(~named & F.col("assignment_method").isin("updated_reference_cluster", "updated_reference_unclassified")),
        "IMG record without taxonomy": missing_parents(records.where(F.upper("reference_source") == "IMG"), held, ["source_record_id"]),
        "sequence without preferred row": missing_parents(seqs, chosen, ["sequence_id"]),
        "preferred row without sequence": missing_parents(chosen, seqs, ["sequence_id"]),
        "invalid compartment": row(~_text("compartment").isin(*COMPARTMENTS)),
        "domain beside the taxonomy": row((_text("taxonomy") != "") & (domain != F.col("domain"))),
        "suffix of a compartment in a preferred row": row(F.array_contains(F.split(F.upper("taxonomy_source"), r"\+"), "PR2") & suffix),
        "unsettled conflict": row(conflict & ~settled),
        "invalid centroid names": row(listed & bad_names),
        "invalid centroid taxonomy": row(listed & (F.size(above) > 0) & ((_text("centroid_taxonomy_source") == "") | (~F.col("domain").isin(AMBIGUOUS, UNCLASSIFIED) & (F.get(above, 0) != F.col("domain"))))),
        "centroid taxonomy without names": row(~listed & ((_text("centroid_taxonomy") != "") | (_text("centroid_taxonomy_source") != ""))),
    }
    if "sequence" in seqs.columns:
        rules["id of another sequence"] = seqs.where(content_id(F.col("sequence")) != F.col("sequence_id")).select("sequence_id")
    if places is not None:
        rules["location twice"] = duplicate_keys(places, ["taxon_oid"])
        rules["location out of range"] = places.where(~F.col("latitude").between(-90, 90) | ~F.col("longitude").between(-180, 180)).select("taxon_oid")
    return rules


def build(prepared: DataFrame, folder: str, derived: DataFrame | None = None, places: DataFrame | None = None, single: bool = False) -> dict[str, DataFrame]:
    """A release from prepared records, derived assignments and location rows: checked, then written below ``folder``.

    The tables are staged, read back and checked against every rule, and only then put in place of what was there; a
    file that counts them is written last.  Gives the tables as they are read from ``folder``.
    """
    spark = prepared.sparkSession
    seqs, records = sequences(prepared), source_records(prepared)
    held = assignments(prepared)
    if derived is not None:
        require(derived_violations(derived, records))
        held = with_assignments(held, derived_assignments(derived, records))
    staging = f"{folder}.{uuid.uuid4().hex}.staging"
    tables = {"sequences": (seqs, "sequence_id"), "source_records": (records, "source_record_id"), "taxonomy_assignments": (held, "taxonomy_assignment_id")}
    if places is not None:
        require(location_violations(places))
        tables["img_location"] = (locations(places, records), "taxon_oid")
    for name, (df, key) in tables.items():
        files.parquet(df, f"{staging}/{name}", [key], single)
    read = lambda name, at: spark.read.parquet(f"{at}/{name}")
    files.parquet(preferred_taxonomy(read("taxonomy_assignments", staging)), f"{staging}/preferred_taxonomy", ["sequence_id"], single)
    names = [*tables, "preferred_taxonomy"]
    written = {name: read(name, staging) for name in names}
    try:
        require(release_violations(written["sequences"], written["source_records"], written["taxonomy_assignments"], written["preferred_taxonomy"], written.get("img_location")))
    except IntegrityError:
        storage.remove(spark, staging)
        raise
    counts = {name: df.count() for name, df in written.items()}
    storage.write_text(spark, f"{staging}/release.json", json.dumps({"rows": counts, "schema_version": 1}, sort_keys=True))
    storage.publish(spark, staging, folder)
    return {name: read(name, folder) for name in names}


def provenance_counts(records: DataFrame) -> DataFrame:
    """``reference_source, source_version, marker, rows`` of a release, and the same over all markers with an empty marker."""
    by = records.groupBy("reference_source", "source_version", "marker").agg(F.count(F.lit(1)).alias("rows"))
    whole = by.groupBy("reference_source", "source_version").agg(F.sum("rows").alias("rows")).withColumn("marker", F.lit(""))
    return by.unionByName(whole)
