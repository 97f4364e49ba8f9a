"""Adapters from FASTA records of the three reference sources to prepared source records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.functions.sequences import content_id, normal_sequence
from sedimark.operators.rejects import parsed_header

# Compartments and the taxon suffixes that name them.
COMPARTMENTS = {"nucleus": "nucleus", "nucleomorph": "nucleomorph", "plastid": "plastid", "apicoplast": "apicoplast", "chromatophore": "chromatophore", "mitochondrion": "mitochondrion", "mitochondria": "mitochondrion"}
SUFFIXES = {"apic": "apicoplast", "chro": "chromatophore", "chrom": "chromatophore", "mito": "mitochondrion", "nucl": "nucleomorph", "plas": "plastid"}
GENES = {"16S_rRNA": "16S", "18S_rRNA": "18S"}
PROKARYOTES = ("Bacteria", "Archaea")
SILVA_RANKS = ("domain", "phylum", "class", "order", "family", "genus")


def _mapped(column, mapping: dict[str, str]):
    return F.get(F.array(*[F.lit(v) for v in mapping.values()]), (F.array_position(F.array(*[F.lit(k) for k in mapping]), column) - 1).cast("int"))


def _base(records: DataFrame, source: str) -> DataFrame:
    sequence = normal_sequence(F.col("sequence"))
    return records.select(F.col("header"), sequence.alias("sequence"), content_id(sequence).alias("sequence_id"), parsed_header(F.col("header"), F.lit(source)).alias("h")).where("h.reason is null")


def header_violations(records: DataFrame, source: str) -> DataFrame:
    """``file, header, reason`` of records whose header breaks the format of ``source``; the adapters leave them out."""
    return records.select("file", "header", parsed_header(F.col("header"), F.lit(source))["reason"].alias("reason")).where("reason is not null")


def silva_lineages(lineages: DataFrame, ranks: DataFrame) -> DataFrame:
    """``lineage, taxonomy`` of distinct ``;``-joined lineages of prokaryotes: their path on the six fixed ranks, gaps empty.

    Every prefix of a lineage is looked up in the rank table; the first taxon of a rank wins.  A lineage whose domain
    the table does not know is an error.
    """
    parts = lineages.select("lineage").distinct().withColumn("r", F.split("lineage", ";"))
    prefix = F.transform(F.sequence(F.lit(1), F.size("r")), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice("r", F.lit(1), i), ";").alias("path"), F.get("r", i - 1).alias("taxon")))
    named = parts.select("lineage", F.inline(prefix)).join(ranks.select("path", "rank"), "path", "left")
    slot = lambda r: F.coalesce(F.min_by("taxon", F.when(F.col("rank") == r, F.col("depth"))), F.lit("")).alias(r)
    grouped = named.groupBy("lineage").agg(*[slot(r) for r in SILVA_RANKS])
    domain = F.when(F.col("domain") == "", F.raise_error(F.concat(F.lit("rank table without the domain of "), "lineage"))).otherwise(F.col("domain"))
    return grouped.select("lineage", F.regexp_replace(F.concat_ws(";", domain, *SILVA_RANKS[1:]), ";+$", "").alias("taxonomy"))


def silva_records(records: DataFrame, ranks: DataFrame, version: str) -> DataFrame:
    """SILVA records of prokaryotes, repeated ones too, with their path projected by silva_lineages.

    Only distinct lineages are projected; sequences are not shuffled for it.
    """
    base = _base(records, "SILVA").withColumn("lineage", F.col("h.taxonomy")).where(F.get(F.split("lineage", ";"), 0).isin(*PROKARYOTES))
    named = base.join(silva_lineages(base, ranks), "lineage")
    return named.select(F.lit("SILVA").alias("reference_source"), F.lit(version).alias("source_version"), F.col("h.identifier").alias("source_identifier"), F.col("header").alias("original_header"),
                        F.lit("16S").alias("marker"), "sequence_id", "sequence", "taxonomy", F.lit("").alias("compartment"), F.lit("native").alias("assignment_method"))


def pr2_records(records: DataFrame, version: str) -> DataFrame:
    """PR2 records of eukaryotes and organelles, with suffixes taken off their taxa and ``problem`` where those disagree."""
    base = _base(records, "PR2").withColumn("fields", F.split("header", r"\|", -1))
    raw = F.lower(F.trim(F.get("fields", 2)))
    compartment = F.when(raw == "", "unknown").otherwise(F.coalesce(_mapped(raw, COMPARTMENTS), raw))
    taxa = F.split("h.taxonomy", ";", -1)
    pattern = r"^(.*):(" + "|".join(sorted(SUFFIXES, key=len, reverse=True)) + ")$"
    suffixes = F.array_distinct(F.filter(F.transform(taxa, lambda x: F.regexp_extract(x, pattern, 2)), lambda x: x != ""))
    bare = F.transform(taxa, lambda x: F.regexp_replace(x, pattern, "$1"))
    problem = (
        F.when(F.exists(bare, lambda x: F.contains(x, F.lit(":"))), "unknown_suffix").when(F.size(suffixes) > 1, "mixed_suffixes")
        .when((F.size(suffixes) == 1) & (_mapped(F.get(suffixes, 0), SUFFIXES) != compartment), "suffix_of_other_compartment"))
    kept = base.where((F.get(taxa, 0) == "Eukaryota") | raw.isin(*COMPARTMENTS))
    return kept.select(F.lit("PR2").alias("reference_source"), F.lit(version).alias("source_version"), F.col("h.identifier").alias("source_identifier"), F.col("header").alias("original_header"),
                       _mapped(F.get("fields", 1), GENES).alias("marker"), "sequence_id", "sequence", F.regexp_replace(F.array_join(bare, ";"), ";+$", "").alias("taxonomy"),
                       compartment.alias("compartment"), F.lit("native").alias("assignment_method"), problem.alias("problem"))


def img_records(records: DataFrame, marker: str, version: str) -> DataFrame:
    """IMG records, which bring no taxonomy, with the taxon oid of their identifier."""
    base = _base(records.where(F.startswith("header", F.lit("IMG_"))), "IMG")
    oid = F.regexp_extract("h.identifier", r"\AIMG_([0-9]+)", 1)
    return base.select(F.lit("IMG").alias("reference_source"), F.lit(version).alias("source_version"), F.col("h.identifier").alias("source_identifier"), F.col("header").alias("original_header"),
                       F.lit(marker).alias("marker"), oid.alias("taxon_oid"), "sequence_id", "sequence")
