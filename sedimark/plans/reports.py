"""Reports on the tables of a release: composition, resolution of lineages, coverage of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions.ids import canonical_sequence_id, canonical_taxon_oid
from sedimark.operators.lineage import lowest_common_ancestor, path_ranks
from sedimark.operators.summaries import is_resolved, ordered_counts, preview, resolution
from sedimark.plans.release import provenance_counts
from sedimark.storage import table

# Domains in the order of reports.
DOMAINS = ("Bacteria", "Archaea", "Eukaryota")


def release_composition(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by markers, by source and marker, by domain, in long form."""
    count = F.count(F.lit(1)).alias("rows")
    nothing = F.lit("")
    markers = table(spark, folder, "sequences").groupBy(F.coalesce("markers", nothing).alias("category")).agg(count).select(F.lit("markers").alias("dimension"), "category", nothing.alias("marker"), "rows")
    sources = table(spark, folder, "source_records").groupBy(F.coalesce("reference_source", nothing).alias("category"), F.coalesce("marker", nothing).alias("marker")).agg(count).select(F.lit("source").alias("dimension"), "category", "marker", "rows")
    domain = F.when(F.col("cross_domain_conflict"), "Ambiguous").otherwise(F.coalesce("domain", nothing))
    domains = table(spark, folder, "preferred_taxonomy").groupBy(domain.alias("category")).agg(count).select(F.lit("domain").alias("dimension"), "category", nothing.alias("marker"), "rows")
    return markers.unionByName(sources).unionByName(domains)


def preferred_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Per reference source: rows, rows with a taxonomy, with a compartment, in conflict, and distinct domains of those."""
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return table(spark, folder, "preferred_taxonomy").groupBy("reference_source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(filled("taxonomy")).alias("with_taxonomy"), F.count_if(filled("compartment")).alias("with_compartment"),
        F.count_if("cross_domain_conflict").alias("conflicts"), F.count_distinct(F.when(F.col("cross_domain_conflict"), F.col("domain"))).alias("conflict_domains"),
        F.count_distinct(F.struct("domain", "compartment")).alias("places"))


def _named_lineages(spark: SparkSession, folder: str) -> DataFrame:
    """``domain, lineage`` of preferred rows of the three domains: the second rank, null where the path has none."""
    rows = table(spark, folder, "preferred_taxonomy").where(F.col("domain").isin(*DOMAINS))
    return rows.select("domain", F.trim(F.get(F.split("taxonomy", ";", -1), 1)).alias("lineage"))


def taxonomy_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Per domain, all three always there: sequences, those whose second rank is named, the rest, percent, distinct lineages."""
    rows = _named_lineages(spark, folder)
    every = spark.createDataFrame([(d,) for d in DOMAINS], "domain string")
    lineages = rows.where(is_resolved(F.col("lineage"))).groupBy("domain").agg(F.count_distinct("lineage").alias("lineages"))
    return resolution(rows, "domain", F.col("lineage"), every).join(lineages, "domain", "left").na.fill(0, ["lineages"])


def lineage_report(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences per domain and second rank, in the order of the domains, the largest first."""
    rows = _named_lineages(spark, folder).where(is_resolved(F.col("lineage")))
    return ordered_counts(rows, ["domain", "lineage"], F.array_position(F.array(*[F.lit(d) for d in DOMAINS]), F.col("domain")), F.col("lineage"))


def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Per domain the resolved sequences of taxonomy_resolution beside the sum of lineage_report, which must agree."""
    listed = lineage_report(spark, folder).groupBy("domain").agg(F.sum("rows").alias("listed"), F.count(F.lit(1)).alias("listed_lineages"))
    joined = taxonomy_resolution(spark, folder).join(listed, "domain", "left").na.fill(0, ["listed", "listed_lineages"])
    return joined.select("domain", "resolved", "listed", "lineages", "listed_lineages", ((F.col("resolved") == F.col("listed")) & (F.col("lineages") == F.col("listed_lineages"))).alias("agree"))


def compartment_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Suffixes of compartments left at the second rank of eukaryotes; a release must have none."""
    rows = _named_lineages(spark, folder).where((F.col("domain") == "Eukaryota") & F.contains("lineage", F.lit(":")))
    return rows.select(F.regexp_extract("lineage", ":([^:]+)$", 1).alias("suffix")).distinct()


def _locations(spark: SparkSession, folder: str) -> DataFrame:
    """``oid, latitude, longitude``: of every taxon the first loaded row with both coordinates, nulls where no row has."""
    place = F.min(F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("row_id", "latitude", "longitude")))
    sites = table(spark, folder, "img_location").groupBy(canonical_taxon_oid(F.col("taxon_oid")).alias("oid")).agg(place.alias("p")).where("oid is not null")
    return sites.select("oid", "p.latitude", "p.longitude")


def located_taxa(spark: SparkSession, folder: str) -> DataFrame:
    """Every taxon of IMG records with its location, if it has one: records and distinct sequences per marker and the group of its markers."""
    records = table(spark, folder, "source_records").where("reference_source = 'IMG'")
    rows = records.select(canonical_taxon_oid(F.col("taxon_oid")).alias("oid"), canonical_sequence_id(F.col("sequence_id")).alias("sequence"), "marker").where("oid is not null")
    of = lambda m: F.col("marker") == m
    counted = rows.groupBy("oid").agg(
        F.count_if(of("16S")).alias("records_16s"), F.count_if(of("18S")).alias("records_18s"), F.count_distinct(F.when(of("16S"), F.col("sequence"))).alias("sequences_16s"),
        F.count_distinct(F.when(of("18S"), F.col("sequence"))).alias("sequences_18s"))
    has = lambda c: F.col(c) > 0
    group = (
        F.when(has("records_16s") & has("records_18s"), "16S + 18S").when(has("records_16s"), "16S only").when(has("records_18s"), "18S only").otherwise("No IMG SSU record"))
    return counted.withColumn("marker_group", group).join(_locations(spark, folder), "oid", "left")


def site_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Taxa, records per marker and a preview of five oids per pair of coordinates."""
    located = located_taxa(spark, folder).where("latitude is not null and longitude is not null")
    return located.groupBy("latitude", "longitude").agg(
        F.count(F.lit(1)).alias("taxa"), F.sum("records_16s").alias("records_16s"), F.sum("records_18s").alias("records_18s"), preview(F.col("oid")).alias("preview"))


def coverage_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row that reconciles: taxa of IMG records, those with a location row, with coordinates, distinct sites."""
    taxa = located_taxa(spark, folder)
    rows = table(spark, folder, "img_location").select(canonical_taxon_oid(F.col("taxon_oid")).alias("oid"), F.lit(True).alias("listed")).where("oid is not null").distinct()
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return taxa.join(rows, "oid", "left").agg(
        F.count(F.lit(1)).alias("taxa"), F.count_if("listed").alias("with_row"), F.count_if(F.col("listed").isNull()).alias("without_row"), F.count_if(both).alias("with_coordinates"),
        F.count_distinct(F.when(both, F.struct("latitude", "longitude"))).alias("sites"))


def unlocated_taxa(spark: SparkSession, folder: str) -> DataFrame:
    """Taxa of source records without any row in the location table."""
    records = table(spark, folder, "source_records").select(canonical_taxon_oid(F.col("taxon_oid")).alias("oid"), canonical_sequence_id(F.col("sequence_id")).alias("sequence"))
    taxa = records.where("oid is not null").groupBy("oid").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("sequence").alias("sequences"))
    sites = table(spark, folder, "img_location").select(canonical_taxon_oid(F.col("taxon_oid")).alias("oid")).distinct()
    return taxa.join(sites, "oid", "left_anti")


def source_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Records per source and version, by marker and (with an empty marker) altogether."""
    return provenance_counts(table(spark, folder, "source_records").select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("reference_source", "source_version", "marker")]))


def assignment_lca(spark: SparkSession, folder: str) -> DataFrame:
    """Common ancestor of all assignments of a sequence that have a path."""
    rows = table(spark, folder, "taxonomy_assignments").select(canonical_sequence_id(F.col("sequence_id")).alias("sequence_id"), F.array_join(path_ranks(F.col("taxonomy")), ";").alias("taxonomy"))
    return lowest_common_ancestor(rows.where("sequence_id is not null and taxonomy <> ''"), ["sequence_id"], "taxonomy")


QUERIES = {f.__name__: f for f in (
    release_composition, preferred_quality, taxonomy_resolution, lineage_report, reconciliation, located_taxa, site_coverage, coverage_totals, unlocated_taxa, source_totals, assignment_lca)}

_OID = "nullif(regexp_extract({0}, '(?:^|[^0-9])([0-9]{{10}})(?:[^0-9]|$)', 1), '')"
_SEQ = "'SSU_' || nullif(regexp_extract(sequence_id, '[Ss][Ss][Uu]_([A-Za-z0-9_-]{43})', 1), '')"
_TAXA = f"t AS (SELECT {_OID.format('taxon_oid')} AS oid, count(*) AS records, count(DISTINCT {_SEQ}) AS sequences FROM source_records WHERE {_OID.format('taxon_oid')} IS NOT NULL GROUP BY 1)"
_RANK = "(SELECT domain, trim(string_split(taxonomy, ';')[2]) AS lineage FROM preferred_taxonomy WHERE domain IN ('Bacteria', 'Archaea', 'Eukaryota'))"
_GOOD = "lineage IS NOT NULL AND lineage <> '' AND lower(lineage) NOT IN ('unclassified', 'incertae sedis')"
_IMG = (
    f"t AS (SELECT {_OID.format('taxon_oid')} AS oid, count(*) FILTER (WHERE marker = '16S') AS records_16s, count(*) FILTER (WHERE marker = '18S') AS records_18s, "
    f"count(DISTINCT {_SEQ}) FILTER (WHERE marker = '16S') AS sequences_16s, count(DISTINCT {_SEQ}) FILTER (WHERE marker = '18S') AS sequences_18s FROM source_records "
    f"WHERE reference_source = 'IMG' AND {_OID.format('taxon_oid')} IS NOT NULL GROUP BY 1), "
    f"w AS (SELECT {_OID.format('taxon_oid')} AS oid, latitude, longitude, row_number() OVER (PARTITION BY {_OID.format('taxon_oid')} ORDER BY row_id) AS n FROM img_location WHERE latitude IS NOT NULL AND longitude IS NOT NULL), "
    "l AS (SELECT * FROM w WHERE n = 1), "
    "j AS (SELECT t.*, CASE WHEN records_16s > 0 AND records_18s > 0 THEN '16S + 18S' WHEN records_16s > 0 THEN '16S only' WHEN records_18s > 0 THEN '18S only' ELSE 'No IMG SSU record' END AS marker_group, "
    "latitude, longitude FROM t LEFT JOIN l ON t.oid = l.oid)"
)

ORACLES = {
    "release_composition": "SELECT 'markers' AS dimension, coalesce(markers, '') AS category, '' AS marker, count(*) AS rows FROM sequences GROUP BY 2 UNION ALL "
    "SELECT 'source', coalesce(reference_source, ''), coalesce(marker, ''), count(*) FROM source_records GROUP BY 2, 3 UNION ALL "
    "SELECT 'domain', CASE WHEN cross_domain_conflict THEN 'Ambiguous' ELSE coalesce(domain, '') END, '', count(*) FROM preferred_taxonomy GROUP BY 2",
    "preferred_quality": "SELECT reference_source, count(*) AS rows, count(*) FILTER (WHERE trim(taxonomy) <> '') AS with_taxonomy, count(*) FILTER (WHERE trim(compartment) <> '') AS with_compartment, "
    "count(*) FILTER (WHERE cross_domain_conflict) AS conflicts, count(DISTINCT domain) FILTER (WHERE cross_domain_conflict) AS conflict_domains, count(DISTINCT (domain, compartment)) AS places FROM preferred_taxonomy GROUP BY 1",
    "taxonomy_resolution": f"WITH c AS (SELECT domain, count(*) AS total, count(*) FILTER (WHERE {_GOOD}) AS resolved, count(DISTINCT lineage) FILTER (WHERE {_GOOD}) AS lineages FROM {_RANK} GROUP BY 1), "
    "f AS (SELECT d.domain, coalesce(total, 0) AS total, coalesce(resolved, 0) AS resolved, coalesce(lineages, 0) AS lineages FROM (VALUES ('Bacteria'), ('Archaea'), ('Eukaryota')) d(domain) LEFT JOIN c ON c.domain = d.domain), "
    "h AS (SELECT *, CASE WHEN total = 0 THEN 0 ELSE (resolved * 200000 // total + 1) // 2 END AS h FROM f) "
    "SELECT domain, resolved, total - resolved AS unresolved, CAST(h // 1000 AS VARCHAR) || '.' || lpad(CAST(h % 1000 AS VARCHAR), 3, '0') AS percent, lineages FROM h",
    "lineage_report": f"SELECT domain, lineage, count(*) AS rows, CAST(CASE domain WHEN 'Bacteria' THEN 1 WHEN 'Archaea' THEN 2 ELSE 3 END AS BIGINT) AS place FROM {_RANK} WHERE {_GOOD} GROUP BY 1, 2",
    "reconciliation": f"SELECT d.domain, count(lineage) FILTER (WHERE {_GOOD}) AS resolved, count(lineage) FILTER (WHERE {_GOOD}) AS listed, count(DISTINCT lineage) FILTER (WHERE {_GOOD}) AS lineages, count(DISTINCT lineage) FILTER (WHERE {_GOOD}) AS listed_lineages, "
    f"true AS agree FROM (VALUES ('Bacteria'), ('Archaea'), ('Eukaryota')) d(domain) LEFT JOIN {_RANK} r ON r.domain = d.domain GROUP BY 1",
    "located_taxa": f"WITH {_IMG} SELECT * FROM j",
    "site_coverage": f"WITH {_IMG} SELECT latitude, longitude, count(*) AS taxa, CAST(sum(records_16s) AS BIGINT) AS records_16s, CAST(sum(records_18s) AS BIGINT) AS records_18s, "
    "array_to_string(list_slice(list(oid ORDER BY oid), 1, 5), ', ') AS preview FROM j WHERE latitude IS NOT NULL GROUP BY 1, 2",
    "coverage_totals": f"WITH {_IMG}, r AS (SELECT DISTINCT {_OID.format('taxon_oid')} AS o FROM img_location WHERE {_OID.format('taxon_oid')} IS NOT NULL) "
    "SELECT count(*) AS taxa, count(o) AS with_row, count(*) FILTER (WHERE o IS NULL) AS without_row, count(latitude) AS with_coordinates, count(DISTINCT (latitude, longitude)) FILTER (WHERE latitude IS NOT NULL) AS sites FROM j LEFT JOIN r ON oid = o",
    "source_totals": "WITH c AS (SELECT coalesce(reference_source, '') AS reference_source, coalesce(source_version, '') AS source_version, coalesce(marker, '') AS marker FROM source_records) "
    "SELECT *, count(*) AS rows FROM c GROUP BY ALL UNION ALL SELECT reference_source, source_version, '', count(*) FROM c GROUP BY 1, 2",
    "unlocated_taxa": f"WITH {_TAXA} SELECT * FROM t WHERE oid NOT IN (SELECT {_OID.format('taxon_oid')} FROM img_location)",
    "assignment_lca": f"WITH b AS (SELECT {_SEQ} AS k, rtrim(regexp_replace(trim(taxonomy), '\\s*;\\s*', ';', 'g'), ';') AS tax FROM taxonomy_assignments WHERE rtrim(regexp_replace(trim(taxonomy), '\\s*;\\s*', ';', 'g'), ';') <> ''), n AS (SELECT k, count(*) AS n FROM b GROUP BY k), "
    "e AS (SELECT k, string_split(tax, ';') AS p FROM b), x AS (SELECT k, i, array_to_string(p[1:i], ';') AS pre, len(list_filter(p[1:i], lambda z: z = '')) = 0 AS ok FROM e, (SELECT unnest(range(1, 12)) AS i) q WHERE i <= len(p)), "
    "c AS (SELECT k, i, count(DISTINCT pre) AS cd, count(*) AS c, bool_and(ok) AS ok, min(pre) AS pre FROM x GROUP BY k, i) "
    "SELECT n.k AS sequence_id, coalesce(max_by(pre, i) FILTER (WHERE cd = 1 AND ok AND c = n.n), '') AS lca FROM n LEFT JOIN c ON c.k = n.k WHERE n.k IS NOT NULL GROUP BY n.k",
}
