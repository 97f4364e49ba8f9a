"""Scalar functions on sequences, identifiers and numbers as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Nucleotide codes and their complements, gap characters of alignments.
CODES = "ACGTURYSWKMBDHVNacgturyswkmbdhvn"
COMPLEMENTS = "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"
GAPS = "-.~_"
NUCLEOTIDES = r"\A[ACGTURYSWKMBDHVN]+\z"
MISSING_COORDINATES = ("", "na", "n/a", "null")


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, r"[ \t\r\n\f]+", "")


def ascii_upper(text: Column) -> Column:
    """Upper case of ASCII letters only, the same in every locale."""
    return F.translate(text, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def normal_sequence(sequence: Column) -> Column:
    """A nucleotide sequence without white space, in upper case, with T for U."""
    return F.replace(F.upper(F.regexp_replace(sequence, r"\s+", "")), F.lit("U"), F.lit("T"))


def is_nucleotide(sequence: Column) -> Column:
    """Not empty and nothing but nucleotide codes."""
    return F.coalesce(sequence.rlike(NUCLEOTIDES), F.lit(False))


def content_id(text: Column, prefix: str = "SSU_") -> Column:
    """``prefix`` + the SHA-256 of the text in unpadded base64url."""
    digest = F.translate(F.base64(F.unhex(F.sha2(text, 256))), "+/", "-_")
    return F.concat(F.lit(prefix), F.rtrim(digest, F.lit("=")))


def stable_id(prefix: str, parts: Sequence[Column], separator: str = "\0") -> Column:
    """``prefix`` + the SHA-256 of the joined parts; a null part counts as empty."""
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws(separator, *[F.coalesce(p, F.lit("")) for p in parts]), 256))


def interval(sequence: Column, start: Column, end: Column) -> Column:
    """Positions ``start`` to ``end``, from 1, both included."""
    return F.substring(sequence, start, end - start + 1)


def reverse_complement(sequence: Column, codes: str = CODES, complements: str = COMPLEMENTS) -> Column:
    return F.reverse(F.translate(sequence, codes, complements))


def region_name(subject: Column, start: Column, end: Column, strand: Column, kind: Column) -> Column:
    """``subject|start-end|strand_X|kind``."""
    return F.concat(subject, F.lit("|"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("|strand_"), strand, F.lit("|"), kind)


def tokens(text: Column, separators: str = r"[-_;]") -> Column:
    return F.split(text, separators, -1)


def wrapped(sequence: Column, width: int) -> Column:
    """Lines of ``width`` characters, without an end of line after the last."""
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def normal_alignment(row: Column) -> Column:
    """One gap character, upper case, T for U."""
    return F.upper(F.translate(row, ".~_Uu", "---Tt"))


def alignment_columns(rows: DataFrame, row: str) -> DataFrame:
    """Per column: ``pos, rows, gaps, inserted``; counts are combined before they are shuffled.

    Rows may differ in length: ``rows`` counts those that reach the column, so null and empty rows count in none.
    """
    cells = rows.select(F.posexplode(F.split(F.col(row), "")).alias("pos", "c")).where("c <> ''")
    return cells.groupBy((F.col("pos") + 1).cast("bigint").alias("pos")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("c").isin(*GAPS)).alias("gaps"),
        F.bool_or((F.col("c") == ".") | F.col("c").rlike("[a-z]")).alias("inserted"))


def trimmed_alignment(rows: DataFrame, row_id: str, row: str, gap_fraction: float) -> DataFrame:
    """Rows without insertion columns and without columns whose share of gaps exceeds ``gap_fraction``.

    The kept columns are a list as long as the alignment is wide, so they are broadcast; rows are not shuffled.
    """
    kept = alignment_columns(rows, row).where(~F.col("inserted") & (F.col("gaps") <= F.col("rows") * gap_fraction))
    positions = F.broadcast(kept.agg(F.array_sort(F.collect_list("pos")).alias("__kept")))
    piece = F.array_join(F.transform("__kept", lambda p: F.substring(F.col(row), p.cast("int"), F.lit(1))), "")
    return rows.crossJoin(positions).select(row_id, normal_alignment(piece).alias(row))


def alignment_violations(rows: DataFrame, row_id: str, row: str, query: str = "QUERY", least: int = 4) -> dict[str, DataFrame]:
    """What keeps an alignment from being trimmed: too few rows, rows twice, no query, unequal lengths, characters that code nothing."""
    from sedimark.operators.integrity import duplicate_keys

    counted = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(row_id) == query).alias("queries"), F.coalesce(F.min(F.length(row)), F.lit(0)).alias("shortest"), F.coalesce(F.max(F.length(row)), F.lit(0)).alias("longest"))
    return {
        "too few rows": counted.where(F.col("rows") < least), "duplicate leaf": duplicate_keys(rows, [row_id]), "no query": counted.where("queries = 0"), "unequal lengths": counted.where("shortest <> longest"),
        "empty alignment": counted.where("longest = 0"), "unexpected character": rows.where(~normal_alignment(F.col(row)).rlike(r"\A[ACGTRYSWKMBDHVN-]*\z")).select(row_id),
    }


def alignment_quality(rows: DataFrame, row_id: str, row: str, gap_fraction: float, query: str = "QUERY") -> DataFrame:
    """One row on trimmed_alignment: ``input_columns, retained_columns, removed_insert_columns, removed_high_gap_columns, query_residue_columns``."""
    columns = alignment_columns(rows, row)
    keep = ~F.col("inserted") & (F.col("gaps") <= F.col("rows") * gap_fraction)
    counted = columns.agg(F.count(F.lit(1)).alias("input_columns"), F.count_if(keep).alias("retained_columns"), F.count_if("inserted").alias("removed_insert_columns"))
    residues = trimmed_alignment(rows, row_id, row, gap_fraction).where(F.col(row_id) == query).agg(F.coalesce(F.sum(F.length(F.replace(row, F.lit("-"), F.lit("")))), F.lit(0)).alias("query_residue_columns"))
    return counted.crossJoin(residues).withColumn("removed_high_gap_columns", F.col("input_columns") - F.col("removed_insert_columns") - F.col("retained_columns"))


def coordinate(text: Column, limit: float) -> Column:
    """A finite coordinate within plus or minus ``limit``, else null."""
    value = F.when(~F.lower(F.trim(text)).isin(*MISSING_COORDINATES), F.trim(text).try_cast("double"))
    return F.when(~F.isnan(value) & value.between(-limit, limit), value)


def accession_parts(identifier: Column) -> Column:
    """``struct<accession, start, end>`` of ``accession.start.end``; start and end null for other identifiers."""
    pattern = r"\A(.*)\.([0-9]+)\.([0-9]+)\z"
    whole = identifier.rlike(pattern)
    part = lambda i: F.when(whole, F.regexp_extract(identifier, pattern, i))
    return F.struct(F.coalesce(part(1), identifier).alias("accession"), part(2).cast("bigint").alias("start"), part(3).cast("bigint").alias("end"))


def plain_decimal(value: Column) -> Column:
    """A decimal as text without zeros at its end."""
    text = value.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def version_key(version: Column) -> Column:
    """A dotted version as an array of integers, for comparison."""
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))
