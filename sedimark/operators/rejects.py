"""Rows that fail to parse.

Lines are read permissively under an explicit schema that keeps the raw text of
records Spark calls corrupt.  Each row is then classified again: by the number
of fields, by quoting (which the permissive reader forgives), and by casts and
formats of the values, so that every rejected row carries one reason and every
other row its parsed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimark.functions.ids import is_blank

# The formats of the three sources and of the dump.
DUMP_FIELDS = ("source_identifier", "source_version", "marker", "length", "original_header")
PR2_FIELDS = 13
PR2_IDENTIFIER = r"\A(?s:.+)\.[0-9]+\.[0-9]+_(?s:.+)\z"
PR2_GENES = ("16S_rRNA", "18S_rRNA")
IMG_TOKEN = r"\A\s*IMG_([0-9]+)(?:[._|]|\s|\z)"
VERSION = r"\A[0-9]+(?:\.[0-9]+)*\z"
MARKERS = ("16S", "18S")
LENGTH = r"\A0*[1-9][0-9]*\z"
_QUOTED = r'"(?:[^"]|"")*"'
_STRICT = rf'\A(?:(?:{_QUOTED}|[^",]*),)*(?:{_QUOTED}|[^",]*)\z'


def parsed_header(header: Column, source: Column) -> Column:
    """``struct<reason, identifier, taxonomy>`` of a header; reason is null for a valid one.

    A leading ``>`` is no part of the header.  Null and blank headers are invalid (``empty_header``), a source
    other than SILVA, PR2 and IMG too (``unknown_source``).
    """
    text = F.regexp_replace(header, r"\A>", "")
    fields = F.split(text, r"\|", -1)
    space = F.instr(text, " ")
    lineage = F.substring(text, space + 1, F.length(text))
    ranks = F.filter(F.transform(F.split(lineage, ";", -1), lambda x: F.trim(x)), lambda x: ~is_blank(x))
    pr2 = (
        F.when(F.size(fields) != PR2_FIELDS, "field_count")
        .when(~F.get(fields, 0).rlike(PR2_IDENTIFIER), "identifier")
        .when(~F.get(fields, 1).isin(*PR2_GENES), "gene")
        .when(is_blank(F.get(fields, 4)), "domain")
    )
    silva = F.when((space < 2) | is_blank(F.substring(text, F.lit(1), space - 1)), "identifier").when(F.size(ranks) == 0, "lineage")
    img = F.when(~text.rlike(IMG_TOKEN), "identifier")
    reason = (
        F.when(is_blank(text), "empty_header")
        .when(source == "PR2", pr2).when(source == "SILVA", silva).when(source == "IMG", img)
        .otherwise("unknown_source")
    )
    identifier = (
        F.when(source == "PR2", F.get(fields, 0)).when(source == "SILVA", F.substring(text, F.lit(1), space - 1))
        .otherwise(F.regexp_extract(text, r"\A\s*(\S+)", 1))
    )
    taxonomy = F.when(source == "PR2", F.array_join(F.transform(F.slice(fields, 5, 9), lambda x: F.trim(x)), ";")).when(source == "SILVA", F.array_join(ranks, ";"))
    return F.struct(reason.alias("reason"), identifier.alias("identifier"), taxonomy.alias("taxonomy"))


def classified_headers(df: DataFrame, header: str = "original_header", source: str = "reference_source", row_id: str = "row_id") -> DataFrame:
    """``row_id, reason, identifier, taxonomy``: reason null for valid headers, identifier and taxonomy null for others."""
    return df.select(F.col(row_id).alias("row_id"), parsed_header(F.col(header), F.col(source)).alias("h")).select(
        "row_id", "h.reason", F.when(F.col("h.reason").isNull(), F.col("h.identifier")).alias("identifier"),
        F.when(F.col("h.reason").isNull(), F.col("h.taxonomy")).alias("taxonomy"))


def classified_lines(df: DataFrame, line: str = "line", source: str = "reference_source", row_id: str = "row_id") -> DataFrame:
    """Lines of a comma-separated dump: ``row_id, reason``, the parsed values of valid ones, and the ``raw`` text of others.

    Reasons, the first that holds: ``empty_line`` (null or blank), ``quoting``, ``field_count``, ``version``,
    ``marker``, ``length``, ``header:...`` (see parsed_header), ``identifier_mismatch``.
    """
    schema = ", ".join(f"{c} string" for c in DUMP_FIELDS) + ", corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    read = df.select(F.col(row_id).alias("row_id"), F.col(line).alias("raw"), F.col(source).alias("source"), F.from_csv(F.col(line), schema, options).alias("r"))
    count = F.size(F.split(F.regexp_replace("raw", _QUOTED, "q"), ",", -1))
    value = {c: F.coalesce(F.col(f"r.{c}"), F.lit("")) for c in DUMP_FIELDS}
    rows = read.select(
        "row_id", "raw", F.col("r.corrupt").isNotNull().alias("corrupt"), is_blank(F.col("raw")).alias("blank"),
        F.col("raw").rlike(_STRICT).alias("strict"), count.alias("fields"), *[v.alias(c) for c, v in value.items()],
        parsed_header(F.col("r.original_header"), F.col("source")).alias("h"))
    reason = (
        F.when(F.col("blank"), "empty_line")
        .when(~F.col("strict"), "quoting")
        .when(F.col("fields") != len(DUMP_FIELDS), "field_count")
        .when(~F.col("source_version").rlike(VERSION), "version")
        .when(~F.col("marker").isin(*MARKERS), "marker")
        .when(~F.col("length").rlike(LENGTH), "length")
        .when(F.col("h.reason").isNotNull(), F.concat(F.lit("header:"), F.col("h.reason")))
        .when(F.col("h.identifier") != F.col("source_identifier"), "identifier_mismatch")
        .when(F.col("corrupt"), "corrupt")
    )
    rows = rows.withColumn("reason", reason)
    valid = F.col("reason").isNull()
    keep = lambda c, name: F.when(valid, c).alias(name)
    return rows.select(
        "row_id", "reason", *[keep(F.col(c), c) for c in DUMP_FIELDS[:3]], keep(F.expr("try_cast(length as bigint)"), "length"),
        keep(F.col("h.identifier"), "identifier"), keep(F.col("h.taxonomy"), "taxonomy"), F.when(~valid, F.col("raw")).alias("raw"))
