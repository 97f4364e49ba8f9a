"""Queries of the annotation, release and calibration plans over the release tables, each beside its SQL.

The tables hold repeated, untidy and orphaned rows, which a release must not have; each query states how it picks the
rows it takes, and the plan's own function does the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimark.functions.ids import canonical_record_id, canonical_sequence_id, canonical_taxon_oid
from sedimark.operators import ranking as R
from sedimark.operators.lineage import path_ranks
from sedimark.operators.trees import classify_by_neighbours, ranked_neighbours
from sedimark.plans import annotate, calibrate, release
from sedimark.storage import materialize, table

LIMIT = 20  # ties beyond which the assignment is cut off; the search keeps 500, of which these tables have none


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    """Hits with a query, a subject and finite figures."""
    hits = table(spark, folder, "blast_hits")
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = hits.where((F.trim("query") != "") & finite("bit_score") & finite("percent_identity"))
    return rows.withColumn("subject", canonical_sequence_id(F.col("subject"))).where("subject is not null").select(
        "query", "subject", "bit_score", "percent_identity", "alignment_length", "query_length", "subject_length", "query_coverage")


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair of the search once, as a table, because every plan on them reads them several times."""
    return materialize(annotate.best_pairs(_hits(spark, folder).select("query", "subject", "bit_score", "percent_identity", "alignment_length")), "pairs")


def _preferred(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of every sequence, with its id in one form; packed columns are left empty, as they are untidy here."""
    rows = table(spark, folder, "preferred_taxonomy").withColumn("sequence_id", canonical_sequence_id(F.col("sequence_id"))).where("sequence_id is not null")
    first = R.first_rows(rows, ["sequence_id"], [F.col("row_id")])
    return first.select("sequence_id", "reference_source", "taxonomy", "taxonomy_source", "domain", "compartment", "assignment_method", "cross_domain_conflict",
                        F.lit("").alias("taxonomy_alternatives"), F.lit("").alias("centroid_names"), "centroid_taxonomy", "centroid_taxonomy_source")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the source records whose fields are all there and hold no separator."""
    rows = table(spark, folder, "source_records").withColumn("sequence_id", canonical_sequence_id(F.col("sequence_id"))).where("sequence_id is not null")
    good = [F.coalesce((F.col(c) != "") & ~F.col(c).rlike(r"[\r\n\t|]"), F.lit(False)) for c in ("reference_source", "source_version", "source_identifier")]
    return annotate.reference_labels(rows.where(good[0] & good[1] & good[2]))


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    """Every query of the search with its best hit and assignment, also queries without a valid hit."""
    queries = table(spark, folder, "blast_hits").where(F.trim("query") != "").select(F.col("query").alias("name")).distinct()
    rows = annotate.annotated(queries, _pairs(spark, folder), annotate.taxonomy_records(_preferred(spark, folder)), _labels(spark, folder), LIMIT, checked=False)
    return rows.drop("centroid_names", "centroid_taxonomy", "centroid_taxonomy_source")


def top_hits(spark: SparkSession, folder: str) -> DataFrame:
    rows = annotate.top_hits(_pairs(spark, folder), annotate.taxonomy_records(_preferred(spark, folder)), _labels(spark, folder))
    return rows.select("query", "rank", "reasons", "subject", "bit_score", "percent_identity", "alignment_length", "identifiers", "versions", "reference_source", "taxonomy", "taxonomy_source", "domain", "compartment", "assignment_method")


def sample_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Contigs per sample and category of the golden annotations."""
    rows = table(spark, folder, "expected_annotations").withColumn("compartment", F.lit(""))
    return annotate.sample_categories(rows, rows.where("sample is not null").select("sample"))


def preferred_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """The preferred taxonomy of every sequence from all its assignments that have a path and a domain."""
    return release.preferred_taxonomy(_assignments(spark, folder), checked=False)


def _assignments(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "taxonomy_assignments").withColumn("sequence_id", canonical_sequence_id(F.col("sequence_id"))).where("sequence_id is not null")
    rows = rows.withColumn("taxonomy", F.array_join(path_ranks(F.col("taxonomy")), ";")).where((F.get(F.split("taxonomy", ";"), 0) != "") & (F.col("domain") != ""))
    return R.first_rows(rows.withColumn("source_record_id", F.coalesce(canonical_record_id(F.col("source_record_id")), F.lit(""))), ["taxonomy_assignment_id"], [F.col("row_id")])


def centroid_summary(spark: SparkSession, folder: str) -> DataFrame:
    return release.centroid_summary(_assignments(spark, folder)).where("centroid_names <> ''")


def release_rules(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows break each rule of a release: ``rule, rows``, with ids in one form."""
    of = lambda name: table(spark, folder, name)
    sequence = canonical_sequence_id(F.col("sequence_id"))
    seqs = of("sequences").withColumn("sequence_id", sequence)
    records = of("source_records").withColumn("sequence_id", sequence).withColumn("source_record_id", canonical_record_id(F.col("source_record_id")))
    held = of("taxonomy_assignments").withColumn("sequence_id", sequence).withColumn("source_record_id", canonical_record_id(F.col("source_record_id")))
    places = of("img_location").withColumn("taxon_oid", canonical_taxon_oid(F.col("taxon_oid")))
    rules = release.release_violations(seqs, records, held, of("preferred_taxonomy").withColumn("sequence_id", sequence), places)
    counted = [df.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("rows")) for rule, df in rules.items() if rule in RULES]
    whole = counted[0]
    for one in counted[1:]:
        whole = whole.unionByName(one)
    return whole


def _references(spark: SparkSession, folder: str) -> DataFrame:
    """Preferred rows that keep the rules of reference taxonomy: a source, a domain, and a path that begins with it unless in conflict."""
    conflict = F.coalesce(F.col("cross_domain_conflict"), F.lit(False))
    rows = _preferred(spark, folder).where((F.trim("taxonomy_source") != "") & (F.trim("domain") != ""))
    return rows.where(conflict | (F.get(path_ranks(F.col("taxonomy")), 0) == F.trim("domain")))


def _decimals(hits: DataFrame) -> DataFrame:
    return hits.select("query", "subject", *[F.col(c).cast("decimal(18,6)").alias(c) for c in ("bit_score", "percent_identity", "query_coverage")], "alignment_length", "query_length", "subject_length")


def _search(spark: SparkSession, folder: str) -> DataFrame:
    """As _pairs, with exact decimals and lengths."""
    return materialize(annotate.best_pairs(_decimals(_hits(spark, folder))), "search")


def classified_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Every query as the centroid of a cluster of its own, classified without calibration."""
    clusters = table(spark, folder, "blast_hits").where(F.trim("query") != "").select(F.col("query").alias("cluster_id")).distinct().withColumn("centroid", F.col("cluster_id")).withColumn("members", F.array("cluster_id"))
    rows = calibrate.classified_clusters(clusters, _search(spark, folder), _references(spark, folder))
    return rows.select("cluster_id", "returned_hits", "eligible_hits", "covered_too_little", "candidates", "status", "reason", "taxonomy", "taxonomy_source", "domain", "compartment", "truncated")


def classification_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of classified_clusters in long form."""
    clusters = table(spark, folder, "blast_hits").where(F.trim("query") != "").select(F.col("query").alias("cluster_id")).distinct().withColumn("centroid", F.col("cluster_id")).withColumn("members", F.array("cluster_id"))
    return calibrate.quality(calibrate.classified_clusters(clusters, _search(spark, folder), _references(spark, folder)))


def calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Leave-one-out figures where each query stands for its best subject, whose taxonomy is the truth; the first query of a subject counts."""
    hits = _search(spark, folder)
    best = R.first_rows(hits, ["query"], annotate.hit_order()).groupBy("subject").agg(F.min("query").alias("query")).withColumnRenamed("subject", "self")
    known = _references(spark, folder)
    own = hits.join(best, "query").drop("query").withColumnRenamed("self", "query").join(known.select(F.col("sequence_id").alias("subject")), "subject", "left_semi")
    truth = best.select(F.col("self").alias("query")).join(known.where("not coalesce(cross_domain_conflict, false) and taxonomy_source in ('SILVA', 'PR2')").select(
        F.col("sequence_id").alias("query"), F.lit("16S").alias("marker"), "taxonomy_source", F.trim("domain").alias("domain"), F.array_join(path_ranks(F.col("taxonomy")), ";").alias("taxonomy")), "query")
    figures = calibrate.calibration(calibrate.leave_one_out(own, known), truth)
    return figures.select(*calibrate.STRATUM, "rank_index", "rank", "sampled", "truth_available", "called", "correct", F.round("lower_bound", 9).alias("lower_bound"), "accepted")


def sampled_truth(spark: SparkSession, folder: str) -> DataFrame:
    """The first 50 sequences of every marker, source and domain."""
    seqs = table(spark, folder, "sequences").withColumn("sequence_id", canonical_sequence_id(F.col("sequence_id"))).where("sequence_id is not null and markers is not null")
    return calibrate.sample_truth(_preferred(spark, folder), seqs, 50)


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    """Hits with the marker of their subject: the first of the two that its sequence names; others are left out."""
    rows = table(spark, folder, "sequences").select(canonical_sequence_id(F.col("sequence_id")).alias("subject"), F.explode(F.regexp_extract_all("markers", F.lit("1[68]S"), 0)).alias("marker"))
    return _pairs(spark, folder).join(rows.where("subject is not null").groupBy("subject").agg(F.min("marker").alias("marker")), "subject")


def _detected(spark: SparkSession, folder: str) -> DataFrame:
    """Every query of the search, detected as 18S."""
    return table(spark, folder, "blast_hits").where(F.trim("query") != "").select("query", F.lit("18S").alias("detected")).distinct()


def routed_markers(spark: SparkSession, folder: str) -> DataFrame:
    """The marker of each query by the vote of its best hits."""
    return annotate.choose_marker(_detected(spark, folder), _marked(spark, folder))


def tree_references(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten references of each query's marker, for queries with three at least."""
    hits = _marked(spark, folder)
    markers = annotate.choose_marker(_detected(spark, folder), hits).select("query", "marker")
    return annotate.tree_tasks(hits, markers, 10)[0]


def nearest_lineages(spark: SparkSession, folder: str) -> DataFrame:
    """Every query classified by its five nearest subjects with a lineage, as leaves whose distance is what their identity lacks."""
    pairs = _pairs(spark, folder)
    distances = pairs.select(F.col("query").alias("tree"), F.col("subject").alias("leaf"), (100 - F.col("percent_identity")).alias("distance"), F.lit(None).cast("string").alias("support"))
    ranks = pairs.select(F.col("query").alias("tree"), F.col("subject").alias("leaf"), F.row_number().over(Window.partitionBy("query").orderBy(*annotate.hit_order())).alias("hit_rank"))
    known = _preferred(spark, folder).withColumnRenamed("sequence_id", "leaf").withColumnRenamed("domain", "taxonomy_domain")
    return classify_by_neighbours(ranked_neighbours(distances, ranks.join(known, "leaf"), 5)).drop("support")


# Rules whose SQL is below; release_violations has more.
RULES = (
    "sequence twice", "record twice", "assignment twice", "preferred twice", "record without sequence", "assignment without record", "assignment without sequence", "assignment of another sequence",
    "sequence without marker", "IMG record without taxonomy", "sequence without preferred row", "preferred row without sequence", "invalid compartment", "unsettled conflict", "no centroid name", "location twice",
    "location out of range",
)

QUERIES = {f.__name__: f for f in (
    annotated, top_hits, sample_categories, preferred_taxonomy, centroid_summary, release_rules, classified_clusters, classification_quality, calibration, sampled_truth,
    routed_markers, tree_references, nearest_lineages)}

_SEQ = "'SSU_' || nullif(regexp_extract({0}, '[Ss][Ss][Uu]_([A-Za-z0-9_-]{{43}})', 1), '')"
_SRC = "'SRC_' || nullif(lower(regexp_extract({0}, '[Ss][Rr][Cc]_([0-9a-fA-F]{{64}})', 1)), '')"
_OID = "nullif(regexp_extract({0}, '(?:^|[^0-9])([0-9]{{10}})(?:[^0-9]|$)', 1), '')"
_PATH = "rtrim(regexp_replace(trim({0}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s*;\\s*', ';', 'g'), ';')"
_HITS = (
    "h0 AS (SELECT query, " + _SEQ.format("subject") + " AS subject, bit_score, percent_identity, alignment_length, query_length, subject_length, query_coverage FROM blast_hits "
    "WHERE trim(query) <> '' AND isfinite(bit_score) AND isfinite(percent_identity)), "
    "h1 AS (SELECT *, row_number() OVER (PARTITION BY query, subject ORDER BY bit_score DESC, percent_identity DESC, alignment_length DESC) AS k FROM h0 WHERE subject IS NOT NULL), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bit_score DESC, percent_identity DESC, alignment_length DESC, subject) AS rank, max(bit_score) OVER (PARTITION BY query) AS best FROM h1 WHERE k = 1)"
)
_PREFERRED = (
    "p0 AS (SELECT *, " + _SEQ.format("sequence_id") + " AS id FROM preferred_taxonomy), p1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_id) AS k FROM p0 WHERE id IS NOT NULL), "
    "p AS (SELECT id, coalesce(reference_source, '') AS reference_source, coalesce(taxonomy, '') AS taxonomy, coalesce(taxonomy_source, '') AS taxonomy_source, coalesce(domain, '') AS domain, "
    "coalesce(compartment, '') AS compartment, coalesce(assignment_method, '') AS assignment_method, coalesce(cross_domain_conflict, false) AS conflict, " + _PATH.format("coalesce(taxonomy, '')") + " AS path FROM p1 WHERE k = 1)"
)
_LABELS = (
    "s0 AS (SELECT " + _SEQ.format("sequence_id") + " AS id, reference_source AS s, source_version AS v, source_identifier AS i FROM source_records "
    "WHERE reference_source <> '' AND source_version <> '' AND source_identifier <> '' AND NOT regexp_matches(reference_source || source_version || source_identifier, '[\\r\\n\\t|]')), "
    "l AS (SELECT id, array_to_string(list_sort(list(DISTINCT s || ':' || i)), '|') AS identifiers, array_to_string(list_sort(list(DISTINCT s || ':' || v)), '|') AS versions, list(DISTINCT s) AS sources FROM s0 WHERE id IS NOT NULL GROUP BY 1)"
)


def _lca(source: str, key: str, path: str, p: str = "") -> str:
    """CTEs that give ``lca(k, lca)``: the shared prefix of the paths of each key, those that begin with a gap left out; ``p`` begins their names."""
    return (
        f"{p}b AS (SELECT {key} AS k, {path} AS tax FROM {source} WHERE {path} <> '' AND NOT starts_with({path}, ';')), {p}n AS (SELECT k, count(*) AS n FROM {p}b GROUP BY k), {p}e AS (SELECT k, string_split(tax, ';') AS q FROM {p}b), "
        f"{p}x AS (SELECT k, i, array_to_string(q[1:i], ';') AS pre, len(list_filter(q[1:i], lambda z: z = '')) = 0 AS ok FROM {p}e, (SELECT unnest(range(1, 16)) AS i) r WHERE i <= len(q)), "
        f"{p}c AS (SELECT k, i, count(DISTINCT pre) AS cd, count(*) AS c, bool_and(ok) AS ok, min(pre) AS pre FROM {p}x GROUP BY k, i), "
        f"{p}lca AS (SELECT n.k, coalesce(max_by(pre, i) FILTER (WHERE cd = 1 AND ok AND c.c = n.n), '') AS lca FROM {p}n AS n LEFT JOIN {p}c AS c ON c.k = n.k GROUP BY n.k)")


def _common(column: str, conflict: str = "mixed") -> str:
    return f"CASE count(DISTINCT nullif({column}, '')) WHEN 0 THEN '' WHEN 1 THEN max(nullif({column}, '')) ELSE '{conflict}' END"


def _quoted(column: str) -> str:
    return f"'\"{column}\":' || to_json({column})"


_OBJECT = "'{' || " + " || ',' || ".join(_quoted(c) for c in ("assignment_method", "compartment", "domain", "taxonomy", "taxonomy_source")) + " || '}'"
_CONCRETE = "CASE WHEN domain NOT IN ('', 'ambiguous', 'Unclassified') THEN domain END"
_TIES = (
    "t AS (SELECT h.query, p.* FROM h JOIN p ON h.subject = p.id WHERE bit_score = best), d AS (SELECT query, count(*) AS tied FROM h WHERE bit_score = best GROUP BY 1), "
    + _lca("t", "query", "path") + ", g AS (SELECT query, count(*) AS records, count(DISTINCT " + _CONCRETE + ") > 1 OR bool_or(conflict OR domain = 'ambiguous') AS ambiguous, min(assignment_method) AS sole, "
    + ", ".join(f"{_common(c)} AS c_{c}" for c in ("domain", "compartment", "assignment_method", "taxonomy_source", "reference_source"))
    + ", '[' || array_to_string(list_sort(list(DISTINCT CASE WHEN taxonomy <> '' OR domain <> '' THEN " + _OBJECT + " END)), ',') || ']' AS objects FROM t GROUP BY 1), "
    f"o AS (SELECT g.*, records > {LIMIT} AS cut, CASE WHEN records > {LIMIT} THEN c_domain ELSE coalesce(lca, '') END AS path FROM g LEFT JOIN lca ON k = query)"
)
_REFERENCES = "f AS (SELECT * FROM p WHERE trim(taxonomy_source) <> '' AND trim(domain) <> '' AND (conflict OR split_part(path, ';', 1) = trim(domain)))"
_DECIMAL = "CAST({0} AS DECIMAL(18,6))"
_NEAR = (
    "w AS (SELECT *, max(CASE WHEN query_coverage >= 80 THEN CAST(bit_score AS DECIMAL(18,6)) END) OVER (PARTITION BY query) * CAST(0.98 AS DECIMAL(3,2)) AS threshold, "
    "max(CASE WHEN rank = 501 THEN CAST(bit_score AS DECIMAL(18,6)) END) OVER (PARTITION BY query) AS cut FROM {0}), "
    "z AS (SELECT query, subject, coalesce(cut >= threshold, false) AS truncated FROM w WHERE query_coverage >= 80 AND CAST(bit_score AS DECIMAL(18,6)) >= threshold), "
    "y AS (SELECT z.*, f.id, f.taxonomy_source, trim(f.domain) AS domain, trim(f.compartment) AS compartment, coalesce(f.conflict, false) AS conflict, CASE WHEN f.conflict THEN '' ELSE f.path END AS path FROM z LEFT JOIN f ON z.subject = f.id)"
)
_CLUSTERS = (
    "WITH " + _HITS + ", " + _PREFERRED + ", " + _REFERENCES + ", " + _NEAR.format("h") + ", " + _lca("y", "query", "path") + ", "
    "g AS (SELECT query, count(*) AS candidates, bool_or(truncated) AS truncated, bool_or(id IS NULL) AS missing, bool_or(conflict) AS ambiguous, bool_or(path = '') AS hole, count(DISTINCT nullif(domain, '')) AS domains, "
    "max(nullif(domain, '')) AS one, array_to_string(list_sort(list(DISTINCT taxonomy_source)), '+') AS sources, " + _common("compartment", "") + " AS compartment FROM y GROUP BY 1), "
    "q AS (SELECT DISTINCT query AS cluster_id FROM blast_hits WHERE trim(query) <> ''), v AS (SELECT query, count(*) AS returned_hits, count(*) FILTER (WHERE query_coverage >= 80) AS eligible_hits FROM h GROUP BY 1), "
    "r AS (SELECT cluster_id, coalesce(returned_hits, 0) AS returned_hits, coalesce(eligible_hits, 0) AS eligible_hits, coalesce(candidates, 0) AS candidates, coalesce(truncated, false) AS truncated, sources, compartment, "
    "missing, ambiguous, CASE WHEN truncated THEN CASE WHEN domains = 1 THEN one ELSE '' END WHEN hole THEN '' ELSE coalesce(lca, '') END AS path FROM q LEFT JOIN v ON v.query = cluster_id LEFT JOIN g ON g.query = cluster_id LEFT JOIN lca ON k = cluster_id), "
    "m AS (SELECT *, CASE WHEN returned_hits = 0 THEN 'no_hits' WHEN eligible_hits = 0 THEN 'no_hits_at_minimum_query_coverage' WHEN missing THEN 'missing_reference_taxonomy' WHEN ambiguous THEN 'ambiguous_reference_taxonomy' "
    "WHEN path = '' THEN 'no_common_domain' ELSE '' END AS reason FROM r), "
    "a AS (SELECT cluster_id, returned_hits, eligible_hits, returned_hits - eligible_hits AS covered_too_little, candidates, CASE WHEN reason = '' THEN 'classified' ELSE 'unclassified' END AS status, reason, "
    "CASE WHEN reason <> '' THEN '' WHEN sources = 'PR2' AND len(string_split(path, ';')) = 9 AND starts_with(path, 'Eukaryota;') THEN array_to_string(string_split(path, ';')[1:8], ';') ELSE path END AS taxonomy, "
    "CASE WHEN reason = '' THEN sources ELSE '' END AS taxonomy_source, CASE WHEN reason = '' THEN split_part(path, ';', 1) ELSE '' END AS domain, CASE WHEN reason = '' AND NOT truncated THEN compartment ELSE '' END AS compartment, truncated FROM m) "
)


def _sum(name: str, value: str) -> str:
    return f"SELECT '{name}' AS counter, CAST({value} AS BIGINT) AS value FROM a"


_RANKS = "(VALUES " + ", ".join(f"('{s}', {i}, '{r}')" for s, ranks in calibrate.CALLED.items() for i, r in enumerate(ranks)) + ") rk(source, i, rank)"
_WILSON = "round(CASE WHEN called = 0 THEN 0.0 ELSE (pr + z * z / (2 * called) - z * sqrt(pr * (1 - pr) / called + z * z / (4::DOUBLE * called * called))) / (1 + z * z / called) END, 9)"
_ASSIGNED = (
    "a0 AS (SELECT taxonomy_assignment_id, row_id, " + _SEQ.format("sequence_id") + " AS id, coalesce(" + _SRC.format("source_record_id") + ", '') AS record, " + _PATH.format("taxonomy") + " AS taxonomy, coalesce(taxonomy_source, '') AS taxonomy_source, "
    "domain, coalesce(compartment, '') AS compartment, assignment_method, centroid_name, centroid_taxonomy, centroid_taxonomy_source FROM taxonomy_assignments), "
    "a1 AS (SELECT *, row_number() OVER (PARTITION BY taxonomy_assignment_id ORDER BY row_id) AS k FROM a0 WHERE id IS NOT NULL AND taxonomy <> '' AND NOT starts_with(taxonomy, ';') AND domain <> ''), "
    "a2 AS (SELECT *, CASE WHEN lower(assignment_method) = 'native' AND ((domain IN ('Bacteria', 'Archaea') AND upper(taxonomy_source) = 'SILVA') OR ((domain = 'Eukaryota' OR lower(compartment) IN "
    "('nucleus', 'nucleomorph', 'plastid', 'apicoplast', 'chromatophore', 'mitochondrion', 'mitochondria')) AND upper(taxonomy_source) = 'PR2')) THEN 0 "
    "WHEN lower(assignment_method) IN ('updated_reference_cluster', 'updated_reference_derived') THEN 10 ELSE 20 END AS priority FROM a1 WHERE k = 1), "
    "a3 AS (SELECT *, min(priority) OVER (PARTITION BY id) AS least FROM a2), a AS (SELECT * FROM a3 WHERE priority = least)"
)
_CENTROIDS = (
    "cn AS (SELECT id, CAST(to_json(list_sort(list(DISTINCT centroid_name))) AS VARCHAR) AS centroid_names FROM a WHERE centroid_name <> '' GROUP BY 1), "
    "cs AS (SELECT id, array_to_string(list_sort(list(DISTINCT s)), '+') AS sources FROM (SELECT id, unnest(string_split(centroid_taxonomy_source, '+')) AS s FROM a WHERE centroid_name <> '') WHERE s <> '' GROUP BY 1), "
    "cb AS (SELECT id, " + _PATH.format("coalesce(centroid_taxonomy, '')") + " AS path FROM a WHERE centroid_name <> ''), " + _lca("cb", "id", "path", "v")
)
_CENTROID = "coalesce(centroid_names, '') AS centroid_names, coalesce(vlca.lca, '') AS centroid_taxonomy, CASE WHEN coalesce(vlca.lca, '') <> '' THEN coalesce(sources, '') ELSE '' END AS centroid_taxonomy_source"
_CENTROID_JOINS = "LEFT JOIN cn ON cn.id = g.id LEFT JOIN cs ON cs.id = g.id LEFT JOIN vlca ON vlca.k = g.id"
_RULES = {
    "sequence twice": "SELECT id FROM s GROUP BY 1 HAVING count(*) > 1", "record twice": "SELECT record FROM r GROUP BY 1 HAVING count(*) > 1", "assignment twice": "SELECT taxonomy_assignment_id FROM a GROUP BY 1 HAVING count(*) > 1",
    "preferred twice": "SELECT id FROM p GROUP BY 1 HAVING count(*) > 1", "record without sequence": "SELECT DISTINCT id FROM r WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = r.id)",
    "assignment without record": "SELECT DISTINCT record FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.record = a.record)", "assignment without sequence": "SELECT DISTINCT id FROM a WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = a.id)",
    "assignment of another sequence": "SELECT 1 FROM a JOIN r ON a.record = r.record WHERE a.id <> r.id", "sequence without marker": "SELECT 1 FROM s WHERE coalesce(markers, '') = ''",
    "IMG record without taxonomy": "SELECT DISTINCT record FROM r WHERE upper(reference_source) = 'IMG' AND NOT EXISTS (SELECT 1 FROM a WHERE a.record = r.record)",
    "sequence without preferred row": "SELECT DISTINCT id FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.id = s.id)", "preferred row without sequence": "SELECT DISTINCT id FROM p WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = p.id)",
    "invalid compartment": "SELECT 1 FROM p WHERE coalesce(compartment, '') NOT IN ('', 'mixed', 'unknown', 'nucleus', 'nucleomorph', 'plastid', 'apicoplast', 'chromatophore', 'mitochondrion')",
    "unsettled conflict": "SELECT 1 FROM p WHERE coalesce(cross_domain_conflict, false) AND NOT (domain = 'ambiguous' AND coalesce(taxonomy, '') = '' AND compartment = 'mixed' AND assignment_method = 'cross_domain_ambiguous_exact_sequence' AND coalesce(taxonomy_alternatives, '') <> '')",
    "no centroid name": "SELECT 1 FROM a WHERE coalesce(centroid_name, '') = '' AND assignment_method IN ('updated_reference_cluster', 'updated_reference_unclassified')",
    "location twice": "SELECT oid FROM l GROUP BY 1 HAVING count(*) > 1", "location out of range": "SELECT 1 FROM l WHERE NOT (latitude BETWEEN -90 AND 90) OR NOT (longitude BETWEEN -180 AND 180)",
}

_ROUTED = (
    "mk AS (SELECT " + _SEQ.format("sequence_id") + " AS id, min(m) AS marker FROM (SELECT sequence_id, unnest(regexp_extract_all(markers, '1[68]S')) AS m FROM sequences) GROUP BY 1), "
    "hm AS (SELECT h.*, marker FROM h JOIN mk ON mk.id = h.subject), "
    "rt AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bit_score DESC, percent_identity DESC, alignment_length DESC, marker <> '18S', marker, subject) AS n FROM hm), "
    "vt AS (SELECT query, count(*) FILTER (WHERE n <= 100 AND marker = '16S') AS a, count(*) FILTER (WHERE n <= 100 AND marker = '18S') AS b, max(bit_score) FILTER (WHERE marker = '16S') AS x, max(bit_score) FILTER (WHERE marker = '18S') AS y FROM rt GROUP BY 1), "
    "ch AS (SELECT q.query, CASE WHEN a > b THEN '16S' WHEN b > a THEN '18S' WHEN coalesce(x, '-infinity'::DOUBLE) > coalesce(y, '-infinity'::DOUBLE) THEN '16S' ELSE '18S' END AS marker, "
    "CASE WHEN a IS NULL THEN 'detected_model_no_blast_hits' WHEN a <> b THEN 'majority_global_top_hits' WHEN coalesce(x, '-infinity'::DOUBLE) <> coalesce(y, '-infinity'::DOUBLE) THEN 'best_bitscore_tiebreak' ELSE 'detected_model_tiebreak' END AS decision, "
    "coalesce(a, 0) AS votes_16S, coalesce(b, 0) AS votes_18S, x AS best_16S, y AS best_18S FROM (SELECT DISTINCT query FROM blast_hits WHERE trim(query) <> '') q LEFT JOIN vt ON vt.query = q.query)"
)
_NEAREST = (
    "ce AS (SELECT p.*, coalesce(centroid_taxonomy_source, '') AS cs, " + _PATH.format("coalesce(centroid_taxonomy, '')") + " AS cp FROM p JOIN p1 ON p1.id = p.id AND p1.k = 1), "
    "vp AS (SELECT id, compartment, domain, taxonomy_source, cs, cp, path, path <> '' AND NOT starts_with(path, ';') AND taxonomy <> 'Unclassified' AS own, cp <> '' AND NOT starts_with(cp, ';') AND cp <> 'Unclassified' AS other FROM ce), "
    "li AS (SELECT id, compartment, CASE WHEN domain = 'ambiguous' THEN '' WHEN own AND NOT (other AND len(string_split(cp, ';')) > len(string_split(path, ';'))) THEN path WHEN other THEN cp "
    "WHEN domain NOT IN ('', 'Unclassified') THEN domain ELSE '' END AS line, CASE WHEN domain = 'ambiguous' THEN '' WHEN own AND NOT (other AND len(string_split(cp, ';')) > len(string_split(path, ';'))) THEN taxonomy_source WHEN other THEN cs "
    "WHEN domain NOT IN ('', 'Unclassified') THEN taxonomy_source ELSE '' END AS source FROM vp), "
    "ds AS (SELECT query, subject, rank, 100 - percent_identity AS distance, compartment, line, source FROM h JOIN li ON li.id = subject), "
    "nn AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, rank, subject) AS n FROM ds WHERE line <> ''), "
    "fa AS (SELECT query, max(distance) AS far FROM nn WHERE n <= 5 GROUP BY 1), "
    "us AS (SELECT nn.* FROM nn JOIN fa ON fa.query = nn.query WHERE distance < far OR abs(distance - far) <= greatest(1e-12 * greatest(abs(distance), abs(far)), 1e-12)), "
    + _lca("us", "query", "line") + ", ag AS (SELECT query, coalesce(array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source <> '')), '|'), '') AS sources, " + _common("compartment") + " AS compartment, count(*) AS neighbours FROM us GROUP BY 1), "
    "ne AS (SELECT query, arg_min(subject, n) AS nearest, arg_min(distance, n) AS nearest_distance FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, rank, subject) AS n FROM ds) GROUP BY 1)"
)

ORACLES = {
    "routed_markers": "WITH " + _HITS + ", " + _ROUTED + " SELECT * FROM ch",
    "tree_references": "WITH " + _HITS + ", " + _ROUTED + ", ks AS (SELECT hm.query, hm.marker, subject, bit_score, row_number() OVER (PARTITION BY hm.query ORDER BY bit_score DESC, percent_identity DESC, alignment_length DESC, subject) AS rank, "
    "count(*) OVER (PARTITION BY hm.query) AS n FROM hm JOIN ch ON ch.query = hm.query AND ch.marker = hm.marker) "
    "SELECT query, marker, rank, 'REF' || lpad(CAST(rank AS VARCHAR), 4, '0') AS leaf, subject, bit_score FROM ks WHERE rank <= 10 AND n >= 3",
    "nearest_lineages": "WITH " + _HITS + ", " + _PREFERRED + ", " + _NEAREST + " SELECT ne.query AS tree, CASE WHEN coalesce(lca, '') = '' THEN 'Unclassified' ELSE lca END AS lineage, "
    "CASE WHEN coalesce(lca, '') = '' THEN 'Unclassified' ELSE split_part(lca, ';', 1) END AS domain, coalesce(sources, '') AS sources, coalesce(ag.compartment, '') AS compartment, "
    "CASE WHEN ag.query IS NULL THEN 'tree_unclassified_no_named_neighbors' ELSE 'tree_nearest_named_lca' END AS method, coalesce(neighbours, 0) AS neighbours, nearest, nearest_distance FROM ne LEFT JOIN ag ON ag.query = ne.query LEFT JOIN lca ON k = ne.query",
    "annotated": "WITH " + _HITS + ", " + _PREFERRED + ", " + _LABELS + ", " + _TIES + " SELECT q.name, coalesce(h.subject, '') AS subject, h.bit_score, h.percent_identity, h.alignment_length, "
    "CASE WHEN ambiguous THEN 'ambiguous' ELSE coalesce(c_domain, '') END AS domain, CASE WHEN ambiguous OR o.query IS NULL THEN '' WHEN path <> '' THEN path WHEN c_domain <> '' THEN c_domain ELSE 'Unclassified' END AS taxonomy, "
    "CASE WHEN ambiguous THEN 'mixed' WHEN cut THEN '' ELSE coalesce(c_compartment, '') END AS compartment, "
    "CASE WHEN ambiguous AND records = 1 THEN sole WHEN ambiguous THEN 'cross_domain_ambiguous_equal_best' WHEN cut THEN 'truncated_equal_best_lca' ELSE coalesce(c_assignment_method, '') END AS assignment_method, "
    "coalesce(c_taxonomy_source, '') AS taxonomy_source, coalesce(c_reference_source, '') AS reference_source, CASE WHEN ambiguous THEN objects ELSE '' END AS taxonomy_alternatives, "
    f"tied AS ties, tied > {LIMIT} AS truncated, coalesce(identifiers, h.subject, '') AS identifiers, coalesce(versions, '') AS versions "
    "FROM (SELECT DISTINCT query AS name FROM blast_hits WHERE trim(query) <> '') q LEFT JOIN h ON h.query = q.name AND h.rank = 1 LEFT JOIN d ON d.query = q.name LEFT JOIN o ON o.query = q.name LEFT JOIN l ON l.id = h.subject",
    "top_hits": "WITH " + _HITS + ", " + _PREFERRED + ", " + _LABELS + ", k AS (SELECT h.*, l.identifiers, l.versions, coalesce(l.sources, []) AS sources FROM h LEFT JOIN l ON l.id = h.subject), "
    "m AS (SELECT *, " + ", ".join(f"min(CASE WHEN list_contains(sources, '{s}') THEN rank END) OVER (PARTITION BY query) AS f_{s}" for s in annotate.SOURCES) + " FROM k), "
    "u AS (SELECT *, concat_ws('|', CASE WHEN rank <= 5 THEN 'overall_top_n' END, CASE WHEN bit_score = best THEN 'equal_best_assignment' END, " + ", ".join(f"CASE WHEN rank = f_{s} THEN 'best_{s}' END" for s in annotate.SOURCES) + ") AS reasons FROM m) "
    "SELECT query, rank, reasons, subject, bit_score, percent_identity, alignment_length, coalesce(identifiers, subject) AS identifiers, coalesce(versions, '') AS versions, coalesce(p.reference_source, '') AS reference_source, "
    "CASE WHEN p.id IS NULL THEN '' ELSE coalesce(nullif(p.taxonomy, ''), nullif(p.domain, ''), 'Unclassified') END AS taxonomy, coalesce(p.taxonomy_source, '') AS taxonomy_source, coalesce(p.domain, '') AS domain, "
    "coalesce(p.compartment, '') AS compartment, coalesce(p.assignment_method, '') AS assignment_method FROM u LEFT JOIN p ON p.id = u.subject WHERE reasons <> ''",
    "sample_categories": "WITH m(token, category) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in annotate.CATEGORIES.items()) + "), "
    "r AS (SELECT sample, contig_name, list_append(CASE WHEN coalesce(taxonomy, '') <> '' THEN string_split_regex(taxonomy, '[-_;]') ELSE string_split_regex(blast_sseqid, '[-_;|]') END, coalesce(taxonomy_domain, '')) AS tokens "
    "FROM expected_annotations WHERE blast_sseqid <> ''), t AS (SELECT sample, contig_name, unnest(tokens) AS token FROM r), "
    "d AS (SELECT DISTINCT sample, contig_name, category FROM t JOIN m ON m.token = t.token WHERE contig_name IS NOT NULL), s AS (SELECT DISTINCT sample FROM expected_annotations WHERE sample IS NOT NULL) "
    "SELECT s.sample, " + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in dict.fromkeys(annotate.CATEGORIES.values())) + " FROM s LEFT JOIN d ON d.sample = s.sample GROUP BY 1",
    "preferred_taxonomy": "WITH " + _ASSIGNED + ", " + _lca("a", "id", "taxonomy") + ", " + _CENTROIDS + ", "
    "g AS (SELECT id, count(DISTINCT nullif(domain, 'Unclassified')) > 1 AS conflict, count(DISTINCT taxonomy) > 1 AS paths, array_to_string(list_sort(list(DISTINCT taxonomy_source)), '+') AS taxonomy_source, "
    "array_to_string(list_sort(list(DISTINCT CASE WHEN lower(coalesce(assignment_method, '')) = 'native' THEN taxonomy_source ELSE 'IMG' END)), '+') AS reference, " + _common("compartment") + " AS compartment, "
    "(list(assignment_method ORDER BY record, assignment_method))[1] AS method, array_to_string(list(" + _OBJECT.replace("to_json(assignment_method)", "to_json(coalesce(assignment_method, ''))")
    + " ORDER BY taxonomy_source, string_split(taxonomy, ';'), compartment, record), ',') AS objects FROM a GROUP BY 1) "
    "SELECT g.id AS sequence_id, CASE WHEN conflict THEN taxonomy_source ELSE reference END AS reference_source, CASE WHEN conflict THEN '' ELSE coalesce(lca.lca, '') END AS taxonomy, taxonomy_source, "
    "CASE WHEN conflict THEN 'ambiguous' ELSE split_part(coalesce(lca.lca, ''), ';', 1) END AS domain, CASE WHEN conflict THEN 'mixed' ELSE compartment END AS compartment, "
    "CASE WHEN conflict THEN 'cross_domain_ambiguous_exact_sequence' WHEN paths THEN 'lowest_common_ancestor' ELSE method END AS assignment_method, conflict AS cross_domain_conflict, "
    "CASE WHEN conflict THEN '[' || objects || ']' ELSE '' END AS taxonomy_alternatives, " + _CENTROID + " FROM g LEFT JOIN lca ON lca.k = g.id " + _CENTROID_JOINS,
    "centroid_summary": "WITH " + _ASSIGNED.replace("a AS (SELECT * FROM a3 WHERE priority = least)", "a AS (SELECT * FROM a3)") + ", " + _CENTROIDS + ", g AS (SELECT DISTINCT id FROM a WHERE centroid_name <> '') "
    "SELECT g.id AS sequence_id, " + _CENTROID + " FROM g " + _CENTROID_JOINS,
    "release_rules": "WITH s AS (SELECT *, " + _SEQ.format("sequence_id") + " AS id FROM sequences), r AS (SELECT *, " + _SEQ.format("sequence_id") + " AS id, " + _SRC.format("source_record_id") + " AS record FROM source_records), "
    "a AS (SELECT *, " + _SEQ.format("sequence_id") + " AS id, " + _SRC.format("source_record_id") + " AS record FROM taxonomy_assignments), p AS (SELECT *, " + _SEQ.format("sequence_id") + " AS id FROM preferred_taxonomy), "
    "l AS (SELECT *, " + _OID.format("taxon_oid") + " AS oid FROM img_location) " + " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) AS rows FROM ({sql})" for rule, sql in _RULES.items()),
    "classified_clusters": _CLUSTERS + "SELECT * FROM a",
    "classification_quality": _CLUSTERS + " UNION ALL ".join([
        _sum("clusters_total", "count(*)"), _sum("img_members_total", "count(*)"), _sum("hits_total", "sum(returned_hits)"), _sum("coverage_filtered_hits", "sum(covered_too_little)"), _sum("eligible_hits", "sum(eligible_hits)"),
        _sum("candidate_hits", "sum(candidates)"), _sum("clusters_classified", "count(*) FILTER (WHERE status = 'classified')"), _sum("clusters_unclassified", "count(*) FILTER (WHERE status <> 'classified')"),
        _sum("clusters_truncated", "count(*) FILTER (WHERE status = 'classified' AND truncated)"), _sum("clusters_species_called", "count(*) FILTER (WHERE len(string_split(taxonomy, ';')) = 9 AND taxonomy_source = 'PR2')"), _sum("assignments_written", "count(*)"),
        "SELECT CASE WHEN status = 'classified' THEN 'classified_by_domain:' || domain ELSE 'unclassified_by_reason:' || reason END, count(*) FROM a GROUP BY 1"]),
    "calibration": "WITH " + _HITS + ", " + _PREFERRED + ", " + _REFERENCES + ", s AS (SELECT subject AS self, min(query) AS query FROM h WHERE rank = 1 GROUP BY 1), "
    "own AS (SELECT s.self AS query, h.subject, bit_score, query_coverage, row_number() OVER (PARTITION BY s.self ORDER BY bit_score DESC, percent_identity DESC, alignment_length DESC, subject) AS rank FROM h JOIN s ON s.query = h.query "
    "WHERE h.subject <> s.self AND h.subject IN (SELECT id FROM f)), " + _NEAR.format("own") + ", " + _lca("y", "query", "path") + ", "
    "g AS (SELECT query, bool_or(truncated) AS truncated, bool_or(conflict) AS conflict, bool_or(path = '') AS hole, count(DISTINCT domain) AS domains, max(domain) AS one FROM y GROUP BY 1), "
    "pr AS (SELECT query, CASE WHEN conflict THEN '' WHEN truncated THEN CASE WHEN domains = 1 THEN one ELSE '' END WHEN hole THEN '' ELSE coalesce(lca, '') END AS path FROM g LEFT JOIN lca ON k = query), "
    "tr AS (SELECT self AS query, '16S' AS marker, taxonomy_source, trim(domain) AS domain, path FROM s JOIN f ON f.id = self WHERE NOT conflict AND taxonomy_source IN ('SILVA', 'PR2')), "
    f"ex AS (SELECT marker, taxonomy_source, tr.domain, i, rank, string_split(tr.path, ';') AS t, string_split(coalesce(pr.path, ''), ';') AS q FROM tr LEFT JOIN pr ON pr.query = tr.query JOIN {_RANKS} ON source = taxonomy_source), "
    "ct AS (SELECT marker, taxonomy_source, domain, i AS rank_index, rank, count(*) AS sampled, count(*) FILTER (WHERE coalesce(t[i + 1], '') <> '') AS truth_available, count(*) FILTER (WHERE coalesce(t[i + 1], '') <> '' AND coalesce(q[i + 1], '') <> '') AS called, "
    "count(*) FILTER (WHERE coalesce(t[i + 1], '') <> '' AND coalesce(q[i + 1], '') <> '' AND t[1:i + 1] = q[1:i + 1]) AS correct FROM ex GROUP BY ALL), "
    f"wl AS (SELECT *, {_WILSON} AS lower_bound FROM (SELECT *, correct::DOUBLE / nullif(called, 0) AS pr, 1.959963984540054::DOUBLE AS z FROM ct)) "
    "SELECT marker, taxonomy_source, domain, CAST(rank_index AS INTEGER) AS rank_index, rank, sampled, truth_available, called, correct, lower_bound, called >= 100 AND lower_bound >= CASE WHEN rank = 'genus' THEN 0.98 ELSE 0.95 END AS accepted FROM wl",
    "sampled_truth": "WITH " + _PREFERRED + ", s AS (SELECT " + _SEQ.format("sequence_id") + " AS id, unnest(string_split(markers, ';')) AS marker FROM sequences WHERE markers IS NOT NULL), "
    "e AS (SELECT DISTINCT p.id AS query, trim(marker) AS marker, p.taxonomy_source, p.domain, p.taxonomy FROM p JOIN s ON s.id = p.id JOIN p1 ON p1.id = p.id AND p1.k = 1 WHERE p.taxonomy_source IN ('SILVA', 'PR2') AND p.domain IN ('Bacteria', 'Archaea', 'Eukaryota') "
    "AND trim(p.taxonomy) <> '' AND p1.cross_domain_conflict = false AND trim(marker) IN ('16S', '18S')), r AS (SELECT *, row_number() OVER (PARTITION BY marker, taxonomy_source, domain ORDER BY query) AS n FROM e) "
    "SELECT query, marker, taxonomy_source, domain, taxonomy FROM r WHERE n <= 50",
}
