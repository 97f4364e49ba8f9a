"""Assignments of cluster centroids, leave-one-out calibration of their depth, and propagation to members."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions.sequences import plain_decimal
from sedimark.operators import integrity as I
from sedimark.operators import ranking as R
from sedimark.operators.lineage import common_value, path_ranks, shared_prefix
from sedimark.operators.summaries import contiguous_cap, wilson_lower_bound

# Thresholds of candidates and of calibration, ranks of the sources, names of outcomes.
LEAST_COVERAGE, FRACTION, TARGETS = 80, "0.98", 500
LEAST_CALLS, PRECISION, GENUS_PRECISION = 100, 0.95, 0.98
RANKS = {
    "SILVA": ("domain", "phylum", "class", "order", "family", "genus"),
    "PR2": ("domain", "supergroup", "division", "subdivision", "class", "order", "family", "genus", "species"),
}
CALLED = {"SILVA": RANKS["SILVA"], "PR2": RANKS["PR2"][:-1]}  # a species is never calibrated, only called where the match is exact
STRATUM = ["marker", "taxonomy_source", "domain"]
SOURCES, DOMAINS, MARKERS = ("SILVA", "PR2"), ("Bacteria", "Archaea", "Eukaryota"), ("16S", "18S")
CLUSTER_METHOD, NO_METHOD, BOTH = "updated_reference_cluster", "updated_reference_unclassified", "SILVA+PR2"


def _order() -> list[Column]:
    return [F.desc("bit_score"), F.desc("percent_identity"), F.desc("alignment_length"), F.col("subject")]


def candidates(hits: DataFrame, targets: int = TARGETS) -> DataFrame:
    """Hits within the window of the best well-covered hit; see ranking.candidates."""
    return R.candidates(hits, ["query"], F.col("bit_score"), _order(), FRACTION, F.col("query_coverage") >= LEAST_COVERAGE, targets)


def reference_violations(taxonomy: DataFrame) -> dict[str, DataFrame]:
    """Rules of reference taxonomy (``sequence_id, taxonomy, taxonomy_source, domain, cross_domain_conflict, taxonomy_alternatives``)."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    conflict = F.coalesce(F.col("cross_domain_conflict"), F.lit(False))
    first = F.coalesce(F.get(path_ranks(F.col("taxonomy")), 0), F.lit(""))
    alternatives = F.from_json("taxonomy_alternatives", "array<map<string,string>>")
    return {
        "duplicate reference taxonomy row": I.duplicate_keys(taxonomy, ["sequence_id"]),
        "row without source or domain": taxonomy.where((text("taxonomy_source") == "") | (text("domain") == "")).select("sequence_id"),
        "conflict without alternatives": taxonomy.where(conflict & ((text("domain") != "ambiguous") | alternatives.isNull() | (F.size(alternatives) == 0))).select("sequence_id"),
        "taxonomy without its domain": taxonomy.where(~conflict & ((first == "") | (first != text("domain")))).select("sequence_id", "taxonomy", "domain"),
    }


def sample_truth(preferred: DataFrame, sequences: DataFrame, per_stratum: int) -> DataFrame:
    """The first ``per_stratum`` sequences of every marker, source and domain: ``query, marker, taxonomy_source, domain, taxonomy``."""
    tokens = sequences.select("sequence_id", F.explode(F.split("markers", ";")).alias("marker")).select("sequence_id", F.trim("marker").alias("marker"))
    kept = preferred.where(
        F.col("taxonomy_source").isin(*SOURCES) & F.col("domain").isin(*DOMAINS) & (F.trim("taxonomy") != "") & ~F.coalesce("cross_domain_conflict", F.lit(True)))
    rows = kept.join(tokens.where(F.col("marker").isin(*MARKERS)), "sequence_id").select(F.col("sequence_id").alias("query"), *STRATUM, "taxonomy").distinct()
    return R.first_rows(rows, STRATUM, [F.col("query")], per_stratum)


def search_violations(hits: DataFrame, truth: DataFrame) -> dict[str, DataFrame]:
    """Sampled queries that the search lacks or does not find themselves, and queries that were not sampled."""
    wanted, found = truth.select("query"), hits.select("query")
    return {"missing query": I.missing_parents(wanted, found, ["query"]), "extra query": I.missing_parents(found, wanted, ["query"]),
            "no self hit": I.missing_parents(wanted, hits.where("subject = query").select("query"), ["query"])}


def _with_records(near: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Candidates with the taxonomy of their subject: ``path`` (empty in a conflict), ``reference_domain``, ``known`` and the rest."""
    conflict = F.coalesce(F.col("cross_domain_conflict"), F.lit(False))
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) if c in taxonomy.columns else F.lit("")
    none = F.array().cast("array<string>")
    records = taxonomy.select(
        F.col("sequence_id").alias("subject"), F.when(conflict, none).otherwise(path_ranks(F.col("taxonomy"))).alias("path"), text("domain").alias("reference_domain"),
        text("taxonomy_source").alias("taxonomy_source"), text("compartment").alias("compartment"), conflict.alias("conflict"), F.lit(True).alias("known"))
    return near.join(records, "subject", "left")


def _shared(truncated: Column) -> Column:
    """The assigned ranks of a group: of a cut-off one the domain if there is one only, else the shared prefix of all paths."""
    none = F.array().cast("array<string>")
    one = F.when((F.col("low") == F.col("high")) & (F.col("low") != ""), F.array("low")).otherwise(none)
    return F.when(truncated, one).otherwise(F.coalesce(shared_prefix(F.array("a", "b")), none))


def leave_one_out(hits: DataFrame, taxonomy: DataFrame, targets: int = TARGETS) -> DataFrame:
    """Predicted ranks of each query from its hits other than itself: ``query, predicted``.

    A candidate without taxonomy is an error; one in conflict leaves the query without a prediction.
    """
    near = _with_records(candidates(hits.where("subject <> query"), targets), taxonomy)
    path = F.when(F.col("known").isNull(), F.raise_error(F.concat(F.lit("taxonomy is missing for "), "subject"))).otherwise(F.col("path"))
    grouped = near.withColumn("path", path).groupBy("query").agg(
        F.bool_or("truncated").alias("truncated"), F.bool_or("conflict").alias("conflict"), F.min("path").alias("a"), F.max("path").alias("b"), F.min("reference_domain").alias("low"), F.max("reference_domain").alias("high"))
    return grouped.select("query", F.when(F.col("conflict"), F.array().cast("array<string>")).otherwise(_shared(F.col("truncated"))).alias("predicted"))


def calibration(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Figures of every stratum and rank: ``marker, taxonomy_source, domain, rank_index, rank, sampled, truth_available, called, correct, call_rate, precision, lower_bound, required, accepted``.

    ``truth`` has ``query, marker, taxonomy_source, domain, taxonomy``.  A rank counts only where the truth has it; it is
    called if the prediction has it too and correct if both agree up to it.  The species of PR2 is left out, and a genus
    needs more precision.
    """
    source = F.create_map(*[x for name, ranks in CALLED.items() for x in (F.lit(name), F.array(*[F.lit(r) for r in ranks]))])
    rows = truth.join(predictions, "query", "left").withColumn("p", F.coalesce("predicted", F.array().cast("array<string>"))).withColumn("t", F.split("taxonomy", ";", -1))
    at = lambda ranks, i: F.coalesce(F.get(ranks, i), F.lit(""))

    def judged(rank: Column, i: Column) -> Column:
        have, called = at(F.col("t"), i) != "", at(F.col("p"), i) != ""
        agree = F.slice("p", F.lit(1), i + 1) == F.slice("t", F.lit(1), i + 1)
        return F.struct(i.alias("rank_index"), rank.alias("rank"), have.alias("have"), (have & called).alias("called"), (have & called & agree).alias("correct"))

    each = rows.select(*STRATUM, F.explode(F.transform(F.try_element_at(source, F.col("taxonomy_source")), judged)).alias("r"))
    counted = each.groupBy(*STRATUM, "r.rank_index", "r.rank").agg(
        F.count(F.lit(1)).alias("sampled"), F.count_if("r.have").alias("truth_available"), F.count_if("r.called").alias("called"), F.count_if("r.correct").alias("correct"))
    share = lambda a, b: F.when(F.col(b) == 0, 0.0).otherwise(F.col(a) / F.col(b))
    rows = counted.withColumn("call_rate", share("called", "truth_available")).withColumn("precision", share("correct", "called")).withColumn("lower_bound", wilson_lower_bound(F.col("correct"), F.col("called")))
    rows = rows.withColumn("required", F.when(F.col("rank") == "genus", GENUS_PRECISION).otherwise(PRECISION))
    return rows.withColumn("accepted", (F.col("called") >= LEAST_CALLS) & (F.col("lower_bound") >= F.col("required")))


def strata(calibrated: DataFrame) -> DataFrame:
    """``marker, taxonomy_source, domain, status, rank_cap, reason``: the deepest rank up to which all are accepted, or why there is none."""
    caps = contiguous_cap(calibrated, STRATUM, "rank_index", F.col("accepted"))
    first = calibrated.where("rank_index = 0").select(*STRATUM, (F.col("called") >= LEAST_CALLS).alias("enough"), (F.col("lower_bound") >= PRECISION).alias("precise"))
    failed = F.col("cap") < 0
    reason = (
        F.when(~failed, "").when(~F.col("enough") & ~F.col("precise"), "insufficient_domain_calls_and_precision_below_threshold")
        .when(~F.col("enough"), "insufficient_domain_calls").otherwise("domain_precision_below_threshold"))
    return caps.join(first, STRATUM).select(*STRATUM, F.when(failed, "failed").otherwise("calibrated").alias("status"), F.when(~failed, F.col("cap").cast("int")).alias("rank_cap"), reason.alias("reason"))


def read_calibration(spark: SparkSession, text: str) -> DataFrame:
    """The strata of a calibration file, as strata gives them; its two parts must agree.

    The file is a configuration of a few entries and is read in the driver.
    """
    data = json.loads(text)
    if not isinstance(data, dict) or data.get("schema_version") != 2:
        raise I.IntegrityError("calibration schema_version must be 2")
    caps, held = data.get("rank_caps"), data.get("strata")
    if not isinstance(caps, dict) or not isinstance(held, dict) or not held:
        raise I.IntegrityError("calibration needs rank_caps and strata")
    rows, calibrated = [], {}
    for key, one in held.items():
        if not isinstance(one, dict) or len(key.split("|")) != 3:
            raise I.IntegrityError(f"stratum {key!r}")
        status, cap, reason = one.get("status"), one.get("rank_cap"), one.get("reason")
        good = type(cap) is int and cap >= 0 and reason == "" if status == "calibrated" else status == "failed" and cap is None and isinstance(reason, str) and reason != ""
        if not good:
            raise I.IntegrityError(f"stratum {key!r} has status {status!r}, cap {cap!r}, reason {reason!r}")
        if status == "calibrated":
            calibrated[key] = cap
        rows.append((*key.split("|"), status, cap, reason))
    if calibrated != caps or any(type(c) is not int for c in caps.values()):
        raise I.IntegrityError("rank_caps differ from the calibrated strata")
    return spark.createDataFrame(rows, "marker string, taxonomy_source string, domain string, status string, rank_cap int, reason string")


def alias_violations(clusters: DataFrame, hits: DataFrame) -> dict[str, DataFrame]:
    """Names that stand for several clusters, searches of no cluster, and clusters searched under both their names."""
    names = _aliases(clusters)
    searched = hits.select(F.col("query").alias("alias")).distinct().join(names, "alias")
    return {
        "ambiguous alias": I.duplicate_keys(names, ["alias"]),
        "query of no cluster": I.missing_parents(hits.select(F.col("query").alias("alias")), names, ["alias"]),
        "hits under both names": I.duplicate_keys(searched, ["cluster_id"]),
    }


def _aliases(clusters: DataFrame) -> DataFrame:
    return clusters.select(F.explode(F.array_distinct(F.array("cluster_id", "centroid"))).alias("alias"), "cluster_id")


def species_path(path: Column, only_pr2: Column) -> Column:
    """Whether a path names a species: nine ranks of an eukaryote that PR2 alone supports."""
    return (F.size(path) == len(RANKS["PR2"])) & (F.get(path, 0) == "Eukaryota") & only_pr2


def classified_clusters(clusters: DataFrame, hits: DataFrame, taxonomy: DataFrame, calibrated: DataFrame | None = None, marker: str = "", targets: int = TARGETS, propagation_cap: int | None = None) -> DataFrame:
    """One row per cluster: its counts, its status with the first reason against an assignment, and the assignment.

    ``clusters`` has ``cluster_id, centroid, members``, and hits may name either of the first two; ``calibrated`` is what
    strata gives.  The path shared by all candidates loses its species unless all of them are exact and agree; it is
    cut at the least cap of the strata of all sources of the candidates, unless it still names a species; members get
    it cut at ``propagation_cap`` too.  A stratum that was never calibrated is an error.
    """
    found = hits.withColumnRenamed("query", "alias").join(_aliases(clusters), "alias").drop("alias").withColumnRenamed("cluster_id", "query")
    covered = F.col("query_coverage") >= LEAST_COVERAGE
    every = found.groupBy("query").agg(F.count(F.lit(1)).alias("returned_hits"), F.count_if(covered).alias("eligible_hits"))
    near = _with_records(candidates(found, targets), taxonomy)
    exact = (F.col("percent_identity") == 100) & (F.col("query_coverage") == 100) & (F.col("alignment_length") == F.col("query_length")) & (F.col("query_length") == F.col("subject_length"))
    grouped = near.withColumn("held", F.when(F.col("reference_domain") != "", F.col("reference_domain"))).groupBy("query").agg(
        F.bool_or("truncated").alias("truncated"), F.count(F.lit(1)).alias("candidates"), F.bool_or(F.col("known").isNull()).alias("missing"), F.bool_or(F.coalesce("conflict", F.lit(False))).alias("ambiguous"),
        F.min("path").alias("a"), F.max("path").alias("b"), F.min("held").alias("low"), F.max("held").alias("high"), F.bool_and(F.coalesce(exact, F.lit(False))).alias("exact"),
        F.max("threshold").alias("threshold"), F.max("bit_score").alias("best_bit_score"), F.array_sort(F.collect_set("taxonomy_source")).alias("sources"), common_value(F.col("compartment"), "").alias("compartment"))
    shared = grouped.withColumn("shared", _shared(F.col("truncated"))).withColumn("unanimous", F.col("exact") & (F.col("a") == F.col("b"))).withColumn("only_pr2", F.col("sources") == F.array(F.lit("PR2")))
    guarded = species_path(F.col("shared"), F.col("only_pr2")) & ~F.col("unanimous")
    shared = shared.withColumn("guarded", guarded).withColumn("path", F.when(guarded, F.slice("shared", 1, len(RANKS["PR2"]) - 1)).otherwise(F.col("shared")))
    rows = clusters.join(every.withColumnRenamed("query", "cluster_id"), "cluster_id", "left").join(shared.withColumnRenamed("query", "cluster_id"), "cluster_id", "left").na.fill(0, ["returned_hits", "eligible_hits", "candidates"])
    if calibrated is not None:
        needed = rows.where(~F.col("missing") & ~F.col("ambiguous") & (F.size("path") > 0)).select("cluster_id", F.explode("sources").alias("taxonomy_source"), F.get("path", 0).alias("domain"))
        own = calibrated.where(F.col("marker") == marker).drop("marker")
        key = F.concat_ws("|", F.lit(marker), "taxonomy_source", "domain")
        status = F.when(F.col("status").isNull(), F.raise_error(F.concat(F.lit("calibration lacks stratum "), key))).otherwise(F.col("status"))
        caps = needed.join(own, ["taxonomy_source", "domain"], "left").select("cluster_id", status.alias("status"), "rank_cap").groupBy("cluster_id").agg(
            F.bool_or(F.col("status") == "failed").alias("failed"), F.min("rank_cap").alias("rank_cap"))
        rows = rows.join(caps, "cluster_id", "left")
    else:
        rows = rows.withColumn("failed", F.lit(False)).withColumn("rank_cap", F.lit(None).cast("int"))
    reason = (
        F.when(F.size("members") == 0, "no_img_members").when(F.col("returned_hits") == 0, "no_hits").when(F.col("eligible_hits") == 0, "no_hits_at_minimum_query_coverage")
        .when(F.col("missing"), "missing_reference_taxonomy").when(F.col("ambiguous"), "ambiguous_reference_taxonomy").when(F.size("path") == 0, "no_common_domain")
        .when(F.col("failed"), "calibration_stratum_failed").otherwise(""))
    done = F.col("reason") == ""
    named = species_path(F.col("path"), F.col("only_pr2")) & F.col("unanimous")
    deep = F.when(F.col("rank_cap").isNotNull() & ~named, F.slice("path", F.lit(1), F.col("rank_cap") + 1)).otherwise(F.col("path"))
    member = deep if propagation_cap is None else F.slice(deep, 1, propagation_cap + 1)
    rows = rows.withColumn("reason", reason).withColumn("deep", deep).withColumn("member", member)
    text = lambda c: F.when(done, c).otherwise("")
    sources = text(F.array_join("sources", "+"))
    return rows.select(
        "cluster_id", "centroid", "members", F.size("members").alias("member_count"), "returned_hits", "eligible_hits", (F.col("returned_hits") - F.col("eligible_hits")).alias("covered_too_little"), "candidates",
        plain_decimal(F.col("best_bit_score")).alias("best_bit_score"), plain_decimal(F.col("threshold")).alias("threshold"), F.when(done, "classified").otherwise("unclassified").alias("status"), "reason",
        text(F.array_join("member", ";")).alias("taxonomy"), sources.alias("taxonomy_source"), text(F.array_join("deep", ";")).alias("centroid_taxonomy"), sources.alias("centroid_taxonomy_source"),
        text(F.get("path", 0)).alias("domain"), text(F.when(F.col("truncated"), "").otherwise(F.col("compartment"))).alias("compartment"), text(F.lit(CLUSTER_METHOD)).alias("assignment_method"),
        F.coalesce("truncated", F.lit(False)).alias("truncated"), (done & F.coalesce("guarded", F.lit(False))).alias("species_guarded"), F.coalesce(done & species_path(F.col("member"), F.col("only_pr2")), F.lit(False)).alias("species_called"),
        "rank_cap", F.lit(propagation_cap).cast("int").alias("propagation_cap"))


def outcome_violations(outcomes: DataFrame, calibrated: DataFrame, marker: str, propagation_cap: int = 0) -> dict[str, DataFrame]:
    """Outcomes (see classified_clusters) that do not fit their calibration, by rule.

    A classified one must have strata that all passed, their least cap, and a member taxonomy within ``propagation_cap``;
    one whose strata failed must have a failed stratum.
    """
    held = outcomes.where((F.col("status") == "classified") | (F.col("reason") == "calibration_stratum_failed"))
    named = held.where("status = 'classified'").select("cluster_id", F.explode(F.split("taxonomy_source", r"\+")).alias("taxonomy_source"), "domain")
    own = calibrated.where(F.col("marker") == marker).drop("marker")
    strata_of = named.join(own, ["taxonomy_source", "domain"], "left")
    least = strata_of.groupBy("cluster_id").agg(F.min("rank_cap").alias("least"))
    done = outcomes.where("status = 'classified'")
    depth = lambda c: F.size(F.split(c, ";"))
    return {
        "no cluster or centroid": outcomes.where((F.trim(F.coalesce("cluster_id", F.lit(""))) == "") | (F.trim(F.coalesce("centroid", F.lit(""))) == "")).select("cluster_id"),
        "classified with a reason": done.where("reason <> ''").select("cluster_id", "reason"),
        "missing stratum": strata_of.where("status is null").select("cluster_id", "taxonomy_source", "domain"),
        "failed stratum of a classified outcome": strata_of.where("status = 'failed'").select("cluster_id", "taxonomy_source", "domain"),
        "wrong calibration cap": done.join(least, "cluster_id").where(~F.col("rank_cap").eqNullSafe(F.col("least"))).select("cluster_id", "rank_cap", "least"),
        "wrong propagation cap": done.where(~F.col("propagation_cap").eqNullSafe(F.lit(propagation_cap))).select("cluster_id", "propagation_cap"),
        "member taxonomy beyond its cap": done.where((depth("taxonomy") > propagation_cap + 1) | (F.get(F.split("taxonomy", ";"), 0) != F.col("domain"))).select("cluster_id", "taxonomy"),
        "centroid taxonomy of another domain": done.where((F.get(F.split("centroid_taxonomy", ";"), 0) != F.col("domain")) | (F.col("centroid_taxonomy_source") != F.col("taxonomy_source"))).select("cluster_id", "centroid_taxonomy"),
    }


# What evidence shows, by the columns it comes from; nothing else leaves an outcome.
EVIDENCE = {
    "classification_status": "status", "reason": "reason", "returned_hit_count": "returned_hits", "eligible_hit_count": "eligible_hits", "coverage_filtered_hit_count": "covered_too_little",
    "best_bit_score": "best_bit_score", "candidate_bit_score_threshold": "threshold", "candidate_count": "candidates", "candidates": "evidence", "missing_taxonomy_subjects": "missing_subjects",
    "ambiguous_taxonomy_subjects": "ambiguous_subjects", "truncated": "truncated", "taxonomy": "taxonomy", "taxonomy_source": "taxonomy_source", "centroid_taxonomy": "centroid_taxonomy",
    "centroid_taxonomy_source": "centroid_taxonomy_source", "domain": "domain", "compartment": "compartment", "assignment_method": "assignment_method", "species_guard_applied": "species_guarded",
    "species_called": "species_called", "calibration_rank_cap": "rank_cap", "propagation_rank_cap": "propagation_cap",
}


def candidate_evidence(clusters: DataFrame, hits: DataFrame, taxonomy: DataFrame, targets: int = TARGETS) -> DataFrame:
    """``cluster_id, evidence, missing_subjects, ambiguous_subjects``: the candidates of each cluster in order, with what their reference says.

    They are the evidence itself, so a cluster's are gathered, however many they are.
    """
    found = hits.withColumnRenamed("query", "alias").join(_aliases(clusters), "alias").drop("alias").withColumnRenamed("cluster_id", "query")
    near = _with_records(candidates(found, targets), taxonomy).join(taxonomy.select(F.col("sequence_id").alias("subject"), "taxonomy_alternatives"), "subject", "left")
    shown = F.struct(
        F.col("alignment_length"), plain_decimal(F.col("bit_score")).alias("bit_score"), F.coalesce("conflict", F.lit(False)).alias("cross_domain_conflict"), plain_decimal(F.col("percent_identity")).alias("percent_identity"),
        plain_decimal(F.col("query_coverage")).alias("query_coverage"), "query_length", "subject", "subject_length", F.coalesce(F.array_join("path", ";"), F.lit("")).alias("taxonomy"),
        F.coalesce(F.from_json("taxonomy_alternatives", "array<map<string,string>>"), F.array().cast("array<map<string,string>>")).alias("taxonomy_alternatives"), F.coalesce("taxonomy_source", F.lit("")).alias("taxonomy_source"))
    place = F.struct((-F.col("bit_score")).alias("a"), (-F.col("percent_identity")).alias("b"), (-F.col("alignment_length")).alias("c"), F.col("subject").alias("d"))
    # maps cannot be sorted, so the place of a candidate is, and it is taken out again
    listed = F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), F.to_json(shown).alias("shown")))), lambda x: x["shown"])
    names = lambda condition: F.array_sort(F.collect_set(F.when(condition, F.col("subject"))))
    return near.groupBy(F.col("query").alias("cluster_id")).agg(
        listed.alias("evidence"), names(F.col("known").isNull()).alias("missing_subjects"), names(F.coalesce("conflict", F.lit(False))).alias("ambiguous_subjects"))


def decision(outcomes: DataFrame, marker: str) -> Column:
    """What evidence shows of an outcome, as canonical JSON: the columns of EVIDENCE, the marker and the version, sorted, without nulls and empty lists.

    A name of an IMG record in it is an error.
    """
    lists = {"evidence", "missing_subjects", "ambiguous_subjects"}
    members = {name: (F.when(F.size(c) > 0, F.col(c)) if c in lists else F.col(c)) for name, c in EVIDENCE.items() if c in outcomes.columns}
    members |= {"marker": F.lit(marker), "schema_version": F.lit(1)}
    text = F.to_json(F.struct(*[members[name].alias(name) for name in sorted(members)]))
    if "evidence" in outcomes.columns:  # its entries are objects already
        raw = F.concat(F.lit('"candidates":['), F.array_join("evidence", ","), F.lit("]"))
        quoted = F.concat(F.lit('"candidates":'), F.to_json("evidence"))
        text = F.when(F.size("evidence") > 0, F.replace(text, quoted, raw)).otherwise(text)
    return F.when(F.contains(text, F.lit("IMG_")), F.raise_error(F.lit("evidence contains the name of an IMG record"))).otherwise(text)


def with_evidence(outcomes: DataFrame, marker: str = "", details: DataFrame | None = None) -> DataFrame:
    """``outcomes`` with ``decision``, see there, and ``evidence_id``: ``IMGEV_`` + the SHA-256 of it; ``details`` is what candidate_evidence gives."""
    rows = outcomes if details is None else outcomes.join(details, "cluster_id", "left")
    shown = rows.withColumn("decision", decision(rows, marker)).select(*outcomes.columns, "decision")
    return shown.withColumn("evidence_id", F.concat(F.lit("IMGEV_"), F.sha2("decision", 256)))


def evidence_catalog(outcomes: DataFrame) -> DataFrame:
    """``evidence_id, decision`` of what with_evidence gives, each decision once."""
    return outcomes.groupBy("evidence_id").agg(F.min("decision").alias("decision"))


def centroid_name(centroid: Column) -> Column:
    """The name of a centroid without a lineage behind it; one that is empty or holds a separator is an error."""
    trimmed = F.trim(centroid)
    name = F.when(F.startswith(trimmed, F.lit("REF_SILVA_")), F.get(F.split(trimmed, ";", 2), 0)).otherwise(trimmed)
    return F.when((name == "") | name.rlike(r"[\r\n\t|]"), F.raise_error(F.concat(F.lit("invalid centroid name: "), centroid))).otherwise(name)


def member_assignments(outcomes: DataFrame) -> DataFrame:
    """Every member of a cluster with the outcome of its cluster, as with_evidence gives them."""
    done = F.col("status") == "classified"
    pick = lambda c, other: F.when(done, F.col(c)).otherwise(other).alias(c)
    evidence = F.when(done, F.concat(
        F.lit("centroid_blast_lca evidence_id="), "evidence_id", F.lit(" candidates="), F.col("candidates").cast("string"), F.lit(" best_bitscore="), "best_bit_score", F.lit(" truncated="), F.col("truncated").cast("string"),
    )).otherwise(F.concat(F.lit("centroid_blast_unclassified evidence_id="), "evidence_id", F.lit(" reason="), "reason"))
    return outcomes.select(
        F.explode("members").alias("source_identifier"), pick("taxonomy", "Unclassified"), pick("taxonomy_source", BOTH), pick("assignment_method", NO_METHOD), evidence.alias("evidence"), pick("compartment", ""),
        "cluster_id", "centroid", centroid_name(F.col("centroid")).alias("centroid_name"), pick("centroid_taxonomy", ""), pick("centroid_taxonomy_source", ""), "evidence_id")


def remapped_evidence(assignments: DataFrame, mapping: DataFrame) -> DataFrame:
    """Assignments with the evidence ids of ``mapping`` (``evidence_id, new_id`` and the fields an assignment must share with its evidence).

    An id that does not resolve, a field that differs, or a text that does not name its evidence is an error.
    """
    fields = [c for c in mapping.columns if c not in ("evidence_id", "new_id")]
    joined = assignments.join(mapping.select("evidence_id", "new_id", *[F.col(c).alias(f"__{c}") for c in fields]), "evidence_id", "left")
    wrong = (
        F.when(F.coalesce("evidence_id", F.lit("")) == "", "no evidence id").when(F.col("new_id").isNull(), "evidence id does not resolve")
        .when(~F.contains("evidence", F.col("evidence_id")), "text without its evidence id"))
    for c in fields:
        wrong = wrong.when(~F.trim(F.coalesce(c, F.lit(""))).eqNullSafe(F.col(f"__{c}")), f"{c} does not match its evidence")
    new = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.lit(": "), F.coalesce("evidence_id", F.lit(""))))).otherwise(F.col("new_id"))
    checked = {"evidence": F.replace("evidence", F.col("evidence_id"), new), "evidence_id": new}
    return joined.select(*[checked.get(c, F.col(c)).alias(c) for c in assignments.columns])


def quality(outcomes: DataFrame) -> DataFrame:
    """Counters of a classification in long form: ``counter, value``."""
    big = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    done = F.col("status") == "classified"
    counters = {
        "clusters_total": F.count(F.lit(1)), "img_members_total": big("member_count"), "hits_total": big("returned_hits"), "coverage_filtered_hits": big("covered_too_little"), "eligible_hits": big("eligible_hits"),
        "candidate_hits": big("candidates"), "clusters_classified": F.count_if(done), "clusters_unclassified": F.count_if(~done), "clusters_truncated": F.count_if(done & F.col("truncated")),
        "clusters_species_called": F.count_if("species_called"), "assignments_written": big("member_count"),
    }
    once = outcomes.agg(*[c.alias(name) for name, c in counters.items()])
    long = once.select(F.inline(F.array(*[F.struct(F.lit(name).alias("counter"), F.col(name).alias("value")) for name in counters])))
    kind = F.when(done, F.concat(F.lit("classified_by_domain:"), "domain")).otherwise(F.concat(F.lit("unclassified_by_reason:"), "reason"))
    return long.unionByName(outcomes.groupBy(kind.alias("counter")).agg(F.count(F.lit(1)).alias("value")))
