"""From search hits to annotated queries, ranked evidence and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.sequences import interval, region_name, reverse_complement
from sedimark.functions.text import general_format, rounded_text
from sedimark.operators import integrity as I
from sedimark.operators import ranking as R
from sedimark.operators.intervals import extraction_regions, greedy_overlap
from sedimark.operators.lineage import UNCLASSIFIED, assign_taxonomy
from sedimark.operators.summaries import category_matrix
from sedimark.storage import materialize

# Models that compete for a locus, what counts as an extraction, columns of the reports, categories in their order.
MODELS = {"RF00177": "SSU_rRNA_bacteria", "RF01960": "SSU_rRNA_eukarya"}
RIVALS = frozenset(MODELS)
MARKERS = ("16S", "18S")
LEAST_LENGTH, TARGETS, TOP_HITS, ROUTE_HITS = 500, 500, 5, 100
SOURCES = ("IMG", "PR2", "SILVA")
HIT_FIELDS = ["name", "sample", "model", "length", "coordinates", "strand", "sequence_type", "contig_name", "is_assembled"]
TREE_FIELDS = [
    "tree_model", "tree_marker", "tree_route_decision", "tree_route_16s_votes", "tree_route_18s_votes", "tree_route_16s_best_bitscore", "tree_route_18s_best_bitscore",
    "tree_taxonomy", "tree_taxonomy_source", "tree_taxonomy_domain", "tree_compartment", "tree_assignment_method", "tree_basis_neighbors", "tree_nearest_sseqid",
    "tree_nearest_reference_identifiers", "tree_nearest_distance", "tree_query_edge_support", "tree_inference_model",
]
SUMMARY_FIELDS = [
    "name", "sample", "model", "length", "coordinates", "strand", "sequence_type", "contig_name", "blast_sseqid", "blast_pident", "blast_length", "blast_bitscore", "is_assembled",
    "reference_source", "taxonomy", "taxonomy_source", "taxonomy_domain", "compartment", "taxonomy_assignment_method", "taxonomy_alternatives", "blast_tied_subjects",
    "blast_ties_truncated", "centroid_names", "centroid_taxonomy", "centroid_taxonomy_source", "reference_identifiers", "reference_versions", "query_sequence",
    "taxonomy_mode", "blast_taxonomy", "blast_taxonomy_source", "blast_taxonomy_domain", "blast_compartment", "blast_taxonomy_assignment_method", "blast_taxonomy_alternatives",
    *TREE_FIELDS,
]
TOP_HIT_FIELDS = [
    "name", "sample", "model", "hit_rank", "selection_reason", "blast_sseqid", "reference_identifiers", "reference_versions", "reference_source", "taxonomy", "taxonomy_source",
    "taxonomy_domain", "compartment", "taxonomy_assignment_method", "taxonomy_alternatives", "centroid_names", "centroid_taxonomy", "centroid_taxonomy_source", "blast_pident",
    "blast_length", "blast_mismatch", "blast_gapopen", "blast_qstart", "blast_qend", "blast_sstart", "blast_send", "blast_evalue", "blast_bitscore", "query_length", "query_sequence",
]
REFERENCE_FIELDS = [
    "leaf_id", "blast_sseqid", "hit_rank", "reference_identifiers", "reference_versions", "reference_source", "taxonomy", "taxonomy_source", "taxonomy_domain", "compartment",
    "taxonomy_assignment_method", "centroid_names", "centroid_taxonomy", "centroid_taxonomy_source", "blast_pident", "blast_length", "blast_evalue", "blast_bitscore",
]
NEIGHBOUR_FIELDS = [
    "name", "sample", "model", "tree_model", "tree_marker", "tree_neighbor_rank", "tree_distance", "used_for_assignment", "tree_lineage", "tree_lineage_source", "tree_lineage_basis", *REFERENCE_FIELDS,
]
SKIPPED = "tree_skipped_insufficient_references"
CENTROID_FIELDS = ("centroid_names", "centroid_taxonomy", "centroid_taxonomy_source")
TAXONOMY_FIELDS = ("reference_source", "taxonomy", "taxonomy_source", "domain", "compartment", "assignment_method", "taxonomy_alternatives", *CENTROID_FIELDS)
CATEGORIES = {
    "Bacteria": "BacteriaSSU", "Mitochondria": "MitochondriaSSU", "Chloroplast": "PlastidSSU", "Holosporales": "HolosporalesSSU", "Patescibacteria": "PatescibacteriaSSU",
    "Legionellales": "LegionellalesSSU", "Rickettsiales": "RickettsialesSSU", "Dependentiae": "DependentiaeSSU", "Cyanobacteria": "CyanobacteriaSSU", "Archaea": "ArchaeaSSU",
    "Eukaryota": "EukaryotaSSU",
}
COMPARTMENT_CATEGORIES = {"mitochondrion": "MitochondriaSSU", "plastid": "PlastidSSU", "apicoplast": "PlastidSSU", "chromatophore": "PlastidSSU"}


def hit_order() -> list:
    return [F.desc("bit_score"), F.desc("percent_identity"), F.desc("alignment_length"), F.col("subject")]


# ---- extraction -----------------------------------------------------------------------------------------------------


def work_items(samples: DataFrame, models: DataFrame) -> DataFrame:
    """Every sample with every model, each with its own columns; the models are a configuration of a few rows."""
    return samples.crossJoin(models)


def accepted_hits(hits: DataFrame, rivals: frozenset[str] | None = RIVALS) -> DataFrame:
    """Included hits that win the contest of overlapping models, per sample, subject and strand."""
    rows = hits.where("included").withColumn("__hit", F.monotonically_increasing_id()).withColumn("__model", F.coalesce("model_accession", "model"))
    won = greedy_overlap(rows, ["sample", "subject", "strand"], "__hit", "__model", "start", "end", F.col("e_value"), F.col("bit_score"), rivals)
    names = [F.col(c) for c in hits.columns]
    joined = rows.alias("r").join(won.select("sample", "subject", "strand", F.col("hit").alias("__hit")), ["sample", "subject", "strand", "__hit"], "left_semi")
    return joined.select(*names)


def model_hits(hits: DataFrame, name: str, accession: str) -> DataFrame:
    """The hits of one model; a hit that agrees with it in only one of name and accession is an error."""
    by_name, by_accession = F.col("model") == name, F.coalesce(F.col("model_accession") == accession, F.lit(False))
    wrong = F.raise_error(F.concat(F.lit(f"hit disagrees with model {name}/{accession}: "), "model", F.lit("/"), F.coalesce("model_accession", F.lit("-"))))
    return hits.where(F.when(by_name != by_accession, wrong).otherwise(by_accession))


def _located(hits: DataFrame, contigs: DataFrame) -> DataFrame:
    rows = hits.select("sample", "model", "subject", "model_from", "model_to", "model_length", F.col("sequence_from").alias("seq_from"), F.col("sequence_to").alias("seq_to"), "strand")
    regions = extraction_regions(rows, ["sample", "model", "subject"])
    return regions.join(contigs.select("sample", F.col("id").alias("subject"), "sequence"), ["sample", "subject"], "left")


def extraction_violations(hits: DataFrame, contigs: DataFrame) -> dict[str, DataFrame]:
    """Contigs that are missing or there twice, and regions outside their contig; see ``operators.integrity.require``."""
    found = _located(hits, contigs)
    wanted = contigs.join(hits.select("sample", F.col("subject").alias("id")).distinct(), ["sample", "id"], "left_semi")
    return {
        "subject missing from FASTA": found.where("sequence is null").select("sample", "subject").distinct(),
        "duplicate FASTA identifier": I.duplicate_keys(wanted, ["sample", "id"]),
        "interval outside its sequence": found.where("start < 1 or end > length(sequence) or start > end").select("sample", "subject", "start", "end"),
    }


def extracted(hits: DataFrame, contigs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Sequences of the regions of accepted hits: ``sample, model, subject, start, end, strand, kind, name, sequence``.

    ``contigs`` has ``sample, id, sequence``; hits need ``model_length``.  Sequences shorter than ``least`` are left out;
    a region whose contig is missing, or that reaches beyond it, is an error (extraction_violations lists them).
    """
    found = _located(hits, contigs)
    at = F.concat("subject", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    outside = (F.col("start") < 1) | (F.col("end") > F.length("sequence")) | (F.col("start") > F.col("end"))
    piece = interval(F.col("sequence"), F.col("start"), F.col("end"))
    cut = (
        F.when(F.col("sequence").isNull(), F.raise_error(F.concat(F.lit("subject missing from FASTA: "), "subject")))
        .when(outside, F.raise_error(F.concat(F.lit("invalid interval "), at))).when(F.col("strand") == "-", reverse_complement(piece)).otherwise(piece))
    return found.withColumn("sequence", cut).where(F.length("sequence") >= least).withColumn("name", region_name(F.col("subject"), F.col("start"), F.col("end"), F.col("strand"), F.col("kind")))


def hit_table(records: DataFrame) -> DataFrame:
    """The table of extracted records in the columns of HIT_FIELDS, as text."""
    position = lambda c: F.col(c).cast("string")
    return records.select(
        "name", "sample", "model", F.length("sequence").cast("string").alias("length"), F.concat(position("start"), F.lit("-"), position("end")).alias("coordinates"), "strand",
        F.col("kind").alias("sequence_type"), F.col("subject").alias("contig_name"), F.when(F.col("kind") == "assembled", "true").otherwise("false").alias("is_assembled"))


# ---- annotation -----------------------------------------------------------------------------------------------------


def best_pairs(hits: DataFrame) -> DataFrame:
    """Each (query, subject) once, at its best place."""
    return R.first_rows(hits, ["query", "subject"], hit_order())


def centroid_label(names: Column) -> Column:
    """Centroid names, a JSON list, joined by ``|``; empty stays empty, anything else is an error."""
    parsed = F.from_json(names, "array<string>")
    wrong = parsed.isNull() | F.exists(parsed, lambda x: x.isNull() | (x == "") | F.contains(x, F.lit("|"))) | ~names.rlike(r"\A\s*\[")
    return F.when(F.coalesce(names, F.lit("")) == "", "").when(wrong, F.raise_error(F.concat(F.lit("invalid centroid_names: "), names))).otherwise(F.array_join(parsed, "|"))


def taxonomy_records(preferred: DataFrame) -> DataFrame:
    """Preferred rows as evidence: ``sequence_id``, TAXONOMY_FIELDS without nulls, ``cross_domain_conflict``; centroid columns all or none."""
    there = [c for c in CENTROID_FIELDS if c in preferred.columns]
    if there and len(there) < len(CENTROID_FIELDS):
        raise I.IntegrityError("an incomplete centroid schema")
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in preferred.columns else F.lit("")
    return preferred.select(
        "sequence_id", *[(centroid_label(text(c)) if c == "centroid_names" else text(c)).alias(c) for c in TAXONOMY_FIELDS], F.coalesce("cross_domain_conflict", F.lit(False)).alias("cross_domain_conflict"))


def reference_labels(records: DataFrame) -> DataFrame:
    """``subject, identifiers, versions, sources`` of every sequence with source records, all sorted, once each.

    A source, version or identifier that is empty or holds a separator is an error.
    """
    bad = lambda c: (F.coalesce(F.col(c), F.lit("")) == "") | F.col(c).rlike(r"[\r\n\t|]")
    source = F.col("reference_source")
    fields = ("reference_source", "source_version", "source_identifier")
    wrong = bad(fields[0]) | bad(fields[1]) | bad(fields[2])
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("invalid source label of "), "sequence_id"))).otherwise(source)
    listed = lambda c: F.array_sort(F.collect_set(c))
    return records.select("sequence_id", checked.alias("reference_source"), *fields[1:]).groupBy(F.col("sequence_id").alias("subject")).agg(
        F.array_join(listed(F.concat_ws(":", "reference_source", "source_identifier")), "|").alias("identifiers"),
        F.array_join(listed(F.concat_ws(":", "reference_source", "source_version")), "|").alias("versions"), listed(F.col("reference_source")).alias("sources"))


def annotation_violations(hits: DataFrame, preferred: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    """Subjects without taxonomy or source record, and subjects with two preferred rows."""
    subjects = hits.select(F.col("subject").alias("sequence_id")).distinct()
    return {
        "duplicate preferred taxonomy row": I.duplicate_keys(preferred.join(subjects, "sequence_id", "left_semi"), ["sequence_id"]),
        "missing taxonomy of a subject": I.missing_parents(subjects, preferred, ["sequence_id"]),
        "missing source record of a subject": I.missing_parents(subjects, records, ["sequence_id"]),
    }


def annotated(queries: DataFrame, hits: DataFrame, taxonomy: DataFrame, labels: DataFrame | None = None, limit: int = TARGETS, checked: bool = True) -> DataFrame:
    """One row per query, also without hits: its columns, the best hit and the assignment of all subjects as good.

    ``queries`` is keyed by ``name``; ``hits`` has one row per (query, subject), see best_pairs; ``taxonomy`` one row per
    ``sequence_id``, see taxonomy_records; ``labels`` is what reference_labels gives.  A subject among the best without
    taxonomy is an error, or counts for nothing where it is not ``checked``.  See lineage.assign_taxonomy for the
    assignment.  Adds ``subject, bit_score, percent_identity, alignment_length``, the assignment, the centroid columns
    of the best subject and its ``identifiers, versions``; texts of queries without hits are empty.
    """
    best = materialize(R.best_score_rows(hits, ["query"], "bit_score").select("query", "subject", "bit_score", "percent_identity", "alignment_length"), "best-hits")  # read three times
    first = R.first_rows(best, ["query"], hit_order())
    known = taxonomy.withColumnRenamed("sequence_id", "subject")
    tied = best.select("query", "subject").join(known.withColumn("__known", F.lit(True)), "subject", "left")
    if checked:
        tied = tied.withColumn("taxonomy", F.when(F.col("__known").isNull(), F.raise_error(F.concat(F.lit("missing taxonomy of "), "subject"))).otherwise(F.col("taxonomy")))
    assigned = assign_taxonomy(tied.where(F.coalesce("__known", F.lit(checked))), ["query"], limit, alternatives=True, checked=checked)
    counted = best.groupBy("query").agg(F.count(F.lit(1)).alias("tied"))
    joined = first.join(counted, "query").join(assigned, "query", "left").join(known.select("subject", *CENTROID_FIELDS), "subject", "left")
    if labels is not None:
        joined = joined.join(labels.select("subject", "identifiers", "versions"), "subject", "left")
    else:
        joined = joined.withColumn("identifiers", F.lit(None).cast("string")).withColumn("versions", F.lit(None).cast("string"))
    joined = joined.withColumn("identifiers", F.coalesce("identifiers", "subject")).withColumn("ties", F.col("tied")).withColumn("truncated", F.col("tied") > limit).drop("tied")
    text = ["subject", "taxonomy", "domain", "compartment", "assignment_method", "taxonomy_source", "reference_source", "taxonomy_alternatives", *CENTROID_FIELDS, "identifiers", "versions"]
    return queries.join(joined.withColumnRenamed("query", "name"), "name", "left").na.fill("", text)


def summary(rows: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """What annotated gives, with the columns of HIT_FIELDS, as the summary report: SUMMARY_FIELDS as text, tree columns empty."""
    if sequences is not None:
        rows = rows.join(sequences.select(F.col("id").alias("name"), F.col("sequence").alias("query_sequence")), "name", "left")
    held = F.col("subject") != ""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    of = {
        "blast_sseqid": F.col("subject"), "blast_pident": rounded_text(2)(F.col("percent_identity").cast("double")), "blast_length": text("alignment_length"),
        "blast_bitscore": general_format()(F.col("bit_score").cast("double")), "taxonomy_domain": F.col("domain"), "taxonomy_assignment_method": F.col("assignment_method"),
        "blast_tied_subjects": F.when(held, text("ties")).otherwise(""), "blast_ties_truncated": F.when(held, text("truncated")).otherwise(""),
        "reference_identifiers": F.col("identifiers"), "reference_versions": F.col("versions"), "taxonomy_mode": F.lit("blast"), "blast_taxonomy": F.col("taxonomy"),
        "blast_taxonomy_source": F.col("taxonomy_source"), "blast_taxonomy_domain": F.col("domain"), "blast_compartment": F.col("compartment"),
        "blast_taxonomy_assignment_method": F.col("assignment_method"), "blast_taxonomy_alternatives": F.col("taxonomy_alternatives"),
    }
    return rows.select(*[F.coalesce(of.get(c, text(c)), F.lit("")).alias(c) for c in SUMMARY_FIELDS])


def top_hits(hits: DataFrame, taxonomy: DataFrame, labels: DataFrame, n: int = TOP_HITS) -> DataFrame:
    """Ranked evidence: of each query the first ``n`` subjects, all as good as the best, and the first of each source, with reasons.

    Arguments as for annotated.  All columns of ``hits``, ``rank, reasons``, the subject's taxonomy with the domain or
    Unclassified for an empty one, and its ``identifiers, versions``; a subject without records stands for itself.
    """
    none = F.array().cast("array<string>")
    joined = hits.join(labels, "subject", "left").withColumn("sources", F.coalesce("sources", none))
    ranked = R.top_with_evidence(joined, ["query"], [-F.col("bit_score"), -F.col("percent_identity"), -F.col("alignment_length"), F.col("subject")], "bit_score", F.col("sources"), SOURCES, n).drop("sources")
    shown = ranked.join(taxonomy.withColumnRenamed("sequence_id", "subject").withColumn("__known", F.lit(True)), "subject", "left")
    path = F.when(F.col("__known"), F.coalesce(F.nullif("taxonomy", F.lit("")), F.nullif("domain", F.lit("")), F.lit(UNCLASSIFIED))).otherwise("")
    text = [c for c in TAXONOMY_FIELDS if c != "taxonomy"]
    return shown.withColumn("taxonomy", path).withColumn("identifiers", F.coalesce("identifiers", "subject")).na.fill("", ["versions", *text]).drop("__known", "cross_domain_conflict")


def top_hit_report(rows: DataFrame, queries: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """What top_hits gives for hits with all search columns as TOP_HIT_FIELDS, as text; ``queries`` has HIT_FIELDS."""
    joined = queries.select("name", "sample", "model", "length").join(rows.withColumnRenamed("query", "name"), "name")
    if sequences is not None:
        joined = joined.join(sequences.select(F.col("id").alias("name"), F.col("sequence").alias("query_sequence")), "name", "left")
    else:
        joined = joined.withColumn("query_sequence", F.lit(""))
    number = general_format()
    own = {"hit_rank": "rank", "selection_reason": "reasons", "blast_sseqid": "subject", "reference_identifiers": "identifiers", "reference_versions": "versions", "taxonomy_domain": "domain",
           "taxonomy_assignment_method": "assignment_method", "blast_length": "alignment_length", "blast_mismatch": "mismatches", "blast_gapopen": "gap_opens",
           "blast_qstart": "query_start", "blast_qend": "query_end", "blast_sstart": "subject_start", "blast_send": "subject_end"}
    made = {"blast_pident": number(F.col("percent_identity").cast("double")), "blast_evalue": number(F.col("e_value").cast("double")), "blast_bitscore": number(F.col("bit_score").cast("double")),
            "query_length": F.when(F.coalesce("query_sequence", F.lit("")) != "", F.length("query_sequence").cast("string")).otherwise(F.col("length"))}
    return joined.select(*[F.coalesce(made.get(c, F.col(own.get(c, c)).cast("string")), F.lit("")).alias(c) for c in TOP_HIT_FIELDS])


# ---- trees ----------------------------------------------------------------------------------------------------------


def choose_marker(queries: DataFrame, hits: DataFrame, n: int = ROUTE_HITS) -> DataFrame:
    """Marker of each query (``query, detected``) from its hits on all indexes (``query, subject, marker, bit_score, ...``).

    Gives ``query, marker, decision, votes_16S, votes_18S, best_16S, best_18S``.  Each subject counts once at its best
    place, the detected marker before others among equals; the majority of the first ``n`` decides, then the best score,
    then the detected marker, which also stands for queries without hits.
    """
    order = [F.desc("bit_score"), F.desc("percent_identity"), F.desc("alignment_length"), F.col("marker") != F.col("detected"), F.col("marker"), F.col("subject")]
    votes = R.vote(hits.join(queries.select("query", "detected"), "query"), ["query"], "subject", "marker", MARKERS, order, "bit_score", n, F.col("detected"))
    joined = queries.select("query", "detected").join(votes, "query", "left").na.fill(0, [f"votes_{m}" for m in MARKERS])
    return joined.select(
        "query", F.coalesce("chosen", "detected").alias("marker"), F.coalesce("decision", F.lit("detected_model_no_blast_hits")).alias("decision"), *[f"votes_{m}" for m in MARKERS], *[f"best_{m}" for m in MARKERS])


def tree_tasks(hits: DataFrame, markers: DataFrame, references: int = 100, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """The first ``references`` subjects of each query's chosen marker, named ``REF0001`` on, and the queries skipped for want of ``least``.

    ``hits`` has ``query, subject, marker, bit_score, percent_identity, alignment_length``, ``markers`` the chosen marker of each query.
    """
    chosen = hits.join(markers.select("query", "marker"), ["query", "marker"])
    ranked = R.first_rows(R.first_rows(chosen, ["query", "subject"], hit_order()), ["query"], hit_order(), references, rank="rank")
    counted = markers.select("query").join(ranked.groupBy("query").agg(F.count(F.lit(1)).alias("n")), "query", "left").na.fill(0, ["n"])
    enough = counted.where(F.col("n") >= least).select("query")
    tasks = ranked.join(enough, "query", "left_semi").select("query", "marker", "rank", F.format_string("REF%04d", "rank").alias("leaf"), "subject", "bit_score")
    return tasks, counted.where(F.col("n") < least).select("query", "n", F.lit("fewer_than_three_references").alias("reason"))


def task_key(sample: Column, model: Column, name: Column) -> Column:
    """The key of a query's tree: ``q_`` + 16 digits of the SHA-256 of sample, model and name."""
    return F.concat(F.lit("q_"), F.substring(F.sha2(F.concat_ws("\0", sample, model, name), 256), 1, 16))


def reference_rows(tasks: DataFrame, hits: DataFrame, taxonomy: DataFrame, labels: DataFrame) -> DataFrame:
    """``query`` and REFERENCE_FIELDS, as text, of the references that tree_tasks picked; ``hits`` with all search columns, the rest as for annotated."""
    picked = tasks.select("query", "subject", "marker", "rank", "leaf").join(hits.drop("rank"), ["query", "subject", "marker"])
    joined = picked.join(labels, "subject", "left").join(taxonomy.withColumnRenamed("sequence_id", "subject"), "subject", "left")
    number = general_format()
    made = {"leaf_id": F.col("leaf"), "blast_sseqid": F.col("subject"), "hit_rank": F.col("rank").cast("string"), "reference_identifiers": F.coalesce("identifiers", "subject"), "reference_versions": F.col("versions"),
            "taxonomy_domain": F.col("domain"), "taxonomy_assignment_method": F.col("assignment_method"), "blast_length": F.col("alignment_length").cast("string"),
            "blast_pident": number(F.col("percent_identity").cast("double")), "blast_evalue": number(F.col("e_value").cast("double")), "blast_bitscore": number(F.col("bit_score").cast("double"))}
    return joined.select("query", *[F.coalesce(made.get(c, F.col(c)), F.lit("")).alias(c) for c in REFERENCE_FIELDS])


def tree_assignments(queries: DataFrame, routes: DataFrame, classified: DataFrame, references: DataFrame, models: dict[str, str], inference: str = "GTR+F+R4") -> DataFrame:
    """``sample, model, name`` and TREE_FIELDS, as text, of every query: what its tree says, or that it was skipped.

    ``queries`` has ``sample, model, name, tree`` (see task_key); ``routes`` is what choose_marker gives and
    ``references`` what reference_rows gives, by ``query`` = tree; ``classified`` is what trees.classify_by_neighbours
    gives; ``models`` names the model of each marker.
    """
    number = general_format(10)
    model = F.create_map(*[F.lit(x) for pair in models.items() for x in pair])
    nearest = references.select(F.col("query").alias("tree"), F.col("leaf_id").alias("nearest"), "blast_sseqid", "reference_identifiers")
    rows = queries.join(routes.withColumnRenamed("query", "tree"), "tree").join(classified, "tree", "left").join(nearest, ["tree", "nearest"], "left")
    there = F.col("method").isNotNull()
    text = lambda c: F.col(c).cast("string")
    made = {
        "tree_model": F.try_element_at(model, F.col("marker")), "tree_marker": F.col("marker"), "tree_route_decision": F.col("decision"), "tree_route_16s_votes": text("votes_16S"), "tree_route_18s_votes": text("votes_18S"),
        "tree_route_16s_best_bitscore": number(F.col("best_16S").cast("double")), "tree_route_18s_best_bitscore": number(F.col("best_18S").cast("double")), "tree_taxonomy": F.col("lineage"), "tree_taxonomy_source": F.col("sources"),
        "tree_taxonomy_domain": F.col("domain"), "tree_compartment": F.col("compartment"), "tree_assignment_method": F.coalesce("method", F.lit(SKIPPED)), "tree_basis_neighbors": F.coalesce(text("neighbours"), F.lit("0")),
        "tree_nearest_sseqid": F.col("blast_sseqid"), "tree_nearest_reference_identifiers": F.col("reference_identifiers"), "tree_nearest_distance": number(F.col("nearest_distance")),
        "tree_query_edge_support": number(F.col("support").try_cast("double")), "tree_inference_model": F.when(there, inference),
    }
    return rows.select("sample", "model", "name", *[F.coalesce(made[c], F.lit("")).alias(c) for c in TREE_FIELDS])


def tree_neighbours(queries: DataFrame, routes: DataFrame, ranked: DataFrame, references: DataFrame, models: dict[str, str]) -> DataFrame:
    """NEIGHBOUR_FIELDS, as text, of every leaf of every tree, in order; arguments as for tree_assignments, ``ranked`` is what trees.ranked_neighbours gives."""
    model = F.create_map(*[F.lit(x) for pair in models.items() for x in pair])
    said = references.withColumnRenamed("query", "tree").withColumnRenamed("leaf_id", "leaf")
    rows = ranked.select("tree", "leaf", "distance", "neighbour_rank", "used", "path", "source", "basis").join(said, ["tree", "leaf"]).join(queries.select("tree", "sample", "model", "name"), "tree").join(
        routes.select(F.col("query").alias("tree"), "marker"), "tree")
    made = {"tree_model": F.try_element_at(model, F.col("marker")), "tree_marker": F.col("marker"), "tree_neighbor_rank": F.col("neighbour_rank").cast("string"), "tree_distance": general_format(10)(F.col("distance")),
            "used_for_assignment": F.col("used").cast("string"), "tree_lineage": F.array_join("path", ";"), "tree_lineage_source": F.col("source"), "tree_lineage_basis": F.col("basis"), "leaf_id": F.col("leaf")}
    out = rows.orderBy("sample", "model", "name", "neighbour_rank", "leaf")
    return out.select(*[F.coalesce(made.get(c, F.col(c)), F.lit("")).alias(c) for c in NEIGHBOUR_FIELDS])


def with_trees(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """Summary rows with the columns of their tree assignments (TREE_FIELDS, keyed by ``sample, model, name``).

    Where the tree was not skipped its assignment takes the place of the search's.  The assignments must match the rows
    exactly; tree_mismatches lists what does not, and a row without one is an error here.
    """
    keys = ["sample", "model", "name"]
    new = assignments.select(*keys, *[F.col(f).alias(f"__{f}") for f in TREE_FIELDS])
    method = F.when(F.col("__tree_assignment_method").isNull(), F.raise_error(F.concat(F.lit("no tree assignment of "), "name"))).otherwise(F.col("__tree_assignment_method"))
    joined = rows.join(new, keys, "left").withColumn("__tree_assignment_method", method)
    use = ~F.startswith("__tree_assignment_method", F.lit("tree_skipped_"))
    instead = {"taxonomy_mode": F.lit("tree"), "taxonomy": F.col("__tree_taxonomy"), "taxonomy_source": F.col("__tree_taxonomy_source"), "taxonomy_domain": F.col("__tree_taxonomy_domain"),
               "compartment": F.col("__tree_compartment"), "taxonomy_assignment_method": F.col("__tree_assignment_method"), "taxonomy_alternatives": F.lit("")}
    return joined.select(*[
        F.when(use, instead[c]).otherwise(F.lit("blast") if c == "taxonomy_mode" else F.col(c)).alias(c) if c in instead
        else F.col(f"__{c}").alias(c) if c in TREE_FIELDS else F.col(c) for c in rows.columns])


def tree_mismatches(rows: DataFrame, assignments: DataFrame) -> dict[str, DataFrame]:
    """Queries without a tree assignment, assignments without a query, and queries with two."""
    keys = ["sample", "model", "name"]
    return {"missing tree assignment": I.missing_parents(rows, assignments, keys), "extra tree assignment": I.missing_parents(assignments, rows, keys),
            "duplicate tree assignment": I.duplicate_keys(assignments, keys)}


# ---- samples --------------------------------------------------------------------------------------------------------


def ordered_summary(rows: DataFrame) -> DataFrame:
    """Summary rows by sample, model, contig, both ends of the coordinates as numbers, and strand."""
    end = lambda i: F.get(F.split("coordinates", "-", 2), i).cast("bigint")
    return rows.orderBy("sample", "model", "contig_name", end(0), end(1), "strand")


def ordered_top_hits(rows: DataFrame) -> DataFrame:
    return rows.orderBy("sample", "model", "name", F.col("hit_rank").cast("bigint"), "blast_sseqid")


def row_categories() -> Column:
    """Categories of a row with ``blast_sseqid, taxonomy, taxonomy_domain, compartment``: of its tokens, its domain and its compartment.

    Tokens are those of the taxonomy, or of the subject's name where there is none.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    tokens = F.when(text("taxonomy") != "", F.split("taxonomy", "[-_;]", -1)).otherwise(F.split("blast_sseqid", "[-_;|]", -1))
    of = lambda mapping: F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    named = F.transform(F.concat(tokens, F.array(text("taxonomy_domain"))), lambda t: F.try_element_at(of(CATEGORIES), t))
    return F.array_distinct(F.array_compact(F.concat(named, F.array(F.try_element_at(of(COMPARTMENT_CATEGORIES), text("compartment"))))))


def sample_categories(rows: DataFrame, samples: DataFrame, categories: Sequence[str] = tuple(dict.fromkeys(CATEGORIES.values()))) -> DataFrame:
    """Contigs per sample and category: a row for every sample, a column for every category, each contig once in each of its categories.

    Only rows with a hit (``blast_sseqid`` neither null nor empty) count; a contig has the categories of all its rows.
    """
    hit = rows.where(F.coalesce(F.col("blast_sseqid"), F.lit("")) != "")
    each = hit.select("sample", "contig_name", F.explode(row_categories()).alias("category"))
    return category_matrix(each, "sample", "category", ["contig_name"], samples, list(categories))
