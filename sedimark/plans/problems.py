"""Queries of the general data problems over the release tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions import ids
from sedimark.operators.orphans import Reference, Referrer, Target, orphan_references, orphan_report
from sedimark.operators.packed import PackedField, unpack
from sedimark.operators.rejects import classified_headers, classified_lines
from sedimark.storage import table

SEQUENCE_FIELDS = [PackedField("markers", blank_separates=True)]
PREFERRED_FIELDS = [
    PackedField("taxonomy"),
    PackedField("taxonomy_alternatives", kept=";", member="taxonomy"),
    PackedField("centroid_names", blank_separates=True),
]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return unpack(table(spark, folder, "sequences"), SEQUENCE_FIELDS).unionByName(unpack(table(spark, folder, "preferred_taxonomy"), PREFERRED_FIELDS))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    of = lambda name: table(spark, folder, name)
    sequence = lambda c: Reference(c, "sequences", ids.sequence_key(F.col(c)))
    return orphan_references(
        [
            Target("sequences", of("sequences"), ids.sequence_key(F.col("sequence_id"))),
            Target("source_records", of("source_records"), ids.record_key(F.col("source_record_id"))),
            Target("img_location", of("img_location"), ids.taxon_key(F.col("taxon_oid"))),
        ],
        [
            Referrer("source_records", of("source_records"), [sequence("sequence_id"), Reference("taxon_oid", "img_location", ids.taxon_key(F.col("taxon_oid")))]),
            Referrer("taxonomy_assignments", of("taxonomy_assignments"), [
                sequence("sequence_id"), Reference("source_record_id", "source_records", ids.record_key(F.col("source_record_id")))]),
            Referrer("preferred_taxonomy", of("preferred_taxonomy"), [sequence("sequence_id")]),
            Referrer("expected_annotations", of("expected_annotations"), [sequence("blast_sseqid")]),
        ],
    )


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(p3_found(spark, folder))


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of both tables, classified, with the same columns."""
    headers = classified_headers(table(spark, folder, "source_records")).select(F.lit("source_records").alias("table_name"), "row_id", "reason", "identifier", "taxonomy")
    lines = classified_lines(table(spark, folder, "raw_headers")).select(F.lit("raw_headers").alias("table_name"), "row_id", "reason", "identifier", "taxonomy")
    return headers.unionByName(lines)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(spark, folder).where("reason is not null").select("table_name", "row_id")


def p4_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(spark, folder).where("reason is not null").select("table_name", "row_id", "reason")


def p4_valid(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(spark, folder).where("reason is null").select("table_name", "row_id", "identifier", "taxonomy")


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_report, p4_found, p4_rejects, p4_valid)}

_SEQ = "'SSU_' || nullif(regexp_extract({0}, '[Ss][Ss][Uu]_([A-Za-z0-9_-]{{43}})', 1), '')"
_SRC = "nullif(lower(regexp_extract({0}, '[Ss][Rr][Cc]_([0-9a-fA-F]{{64}})', 1)), '')"
_OID = "nullif(regexp_extract({0}, '(?:^|[^0-9])([0-9]{{10}})(?:[^0-9]|$)', 1), '')"
_REFS = [
    ("source_records", "sequence_id", "s", _SEQ), ("source_records", "taxon_oid", "i", _OID),
    ("taxonomy_assignments", "sequence_id", "s", _SEQ), ("taxonomy_assignments", "source_record_id", "r", _SRC),
    ("preferred_taxonomy", "sequence_id", "s", _SEQ), ("expected_annotations", "blast_sseqid", "s", _SEQ),
]
_ORPHANS = (
    "WITH t AS (SELECT 's' k, " + _SEQ.format("sequence_id") + " id, loaded_at a, retired_at b FROM sequences UNION ALL SELECT 'r', "
    + _SRC.format("source_record_id") + ", loaded_at, retired_at FROM source_records UNION ALL SELECT 'i', " + _OID.format("taxon_oid") + ", loaded_at, retired_at FROM img_location), "
    "f AS (" + " UNION ALL ".join(
        f"SELECT '{t}' table_name, '{c}' field_name, '{k}' k, row_id, loaded_at ts, {p.format(c)} id FROM {t} WHERE regexp_matches({c}, '\\S')" for t, c, k, p in _REFS)
    + "), o AS (SELECT table_name, field_name, row_id, strftime(ts, '%Y-%m') period FROM f WHERE NOT EXISTS "
    "(SELECT 1 FROM t WHERE t.k = f.k AND t.id = f.id AND t.a <= f.ts AND (t.b IS NULL OR t.b > f.ts))) "
)
_GENE = "split_part(h, '|', 2) IN ('16S_rRNA', '18S_rRNA')"
_HEADER_OK = (
    "CASE WHEN h IS NULL OR NOT regexp_matches(h, '\\S') THEN false "
    "WHEN src = 'PR2' THEN len(string_split(h, '|')) = 13 AND regexp_full_match(split_part(h, '|', 1), '.+\\.[0-9]+\\.[0-9]+_.+', 's') AND " + _GENE + " AND regexp_matches(split_part(h, '|', 5), '\\S') "
    "WHEN src = 'SILVA' THEN instr(h, ' ') > 1 AND regexp_matches(substr(h, instr(h, ' ') + 1), '[^\\s;]') "
    "WHEN src = 'IMG' THEN regexp_matches(h, '^\\s*IMG_[0-9]+(?:[._|]|\\s|$)') ELSE false END"
)
_FIELD = '(?:"(?:[^"]|"")*"|[^",]*)'
_BAD = (
    "WITH l AS (SELECT row_id, reference_source src, regexp_full_match(line, '(?:" + _FIELD + ",){4}" + _FIELD + "', 's') ok, "
    + ", ".join(f"regexp_extract(line, '^(?s:" + ",".join("(" + _FIELD + ")" for _ in range(5)) + f")$', {i}) f{i}" for i in range(1, 6)) + " FROM raw_headers), "
    "u AS (SELECT row_id, src, ok, " + ", ".join(f"CASE WHEN starts_with(f{i}, '\"') THEN replace(substr(f{i}, 2, length(f{i}) - 2), '\"\"', '\"') ELSE f{i} END f{i}" for i in range(1, 6)) + " FROM l), "
    "v AS (SELECT *, CASE WHEN starts_with(f5, '>') THEN substr(f5, 2) ELSE f5 END h FROM u), "
    "raw AS (SELECT row_id, coalesce(ok, false) AND regexp_full_match(f2, '[0-9]+(\\.[0-9]+)*') AND f3 IN ('16S', '18S') AND regexp_full_match(f4, '0*[1-9][0-9]*') AND " + _HEADER_OK
    + " AND f1 = CASE src WHEN 'PR2' THEN split_part(h, '|', 1) ELSE split_part(h, ' ', 1) END good FROM v), "
    "rec AS (SELECT row_id, " + _HEADER_OK + " good FROM (SELECT row_id, reference_source src, CASE WHEN starts_with(original_header, '>') THEN substr(original_header, 2) ELSE original_header END h FROM source_records)) "
    "SELECT 'raw_headers' AS table_name, row_id FROM raw WHERE NOT coalesce(good, false) UNION ALL SELECT 'source_records', row_id FROM rec WHERE NOT coalesce(good, false)"
)

_REASON = (
    "CASE WHEN h IS NULL OR NOT regexp_matches(h, '\\S') THEN 'empty_header' "
    "WHEN src = 'PR2' THEN CASE WHEN len(string_split(h, '|')) <> 13 THEN 'field_count' WHEN NOT regexp_full_match(split_part(h, '|', 1), '.+\\.[0-9]+\\.[0-9]+_.+', 's') THEN 'identifier' "
    "WHEN NOT (" + _GENE + ") THEN 'gene' WHEN NOT regexp_matches(split_part(h, '|', 5), '\\S') THEN 'domain' END "
    "WHEN src = 'SILVA' THEN CASE WHEN instr(h, ' ') < 2 OR NOT regexp_matches(substr(h, 1, instr(h, ' ') - 1), '\\S') THEN 'identifier' WHEN NOT regexp_matches(substr(h, instr(h, ' ') + 1), '[^\\s;]') THEN 'lineage' END "
    "WHEN src = 'IMG' THEN CASE WHEN NOT regexp_matches(h, '^\\s*IMG_[0-9]+(?:[._|]|\\s|$)') THEN 'identifier' END ELSE 'unknown_source' END"
)
_IDENTIFIER = "CASE src WHEN 'PR2' THEN split_part(h, '|', 1) WHEN 'SILVA' THEN split_part(h, ' ', 1) ELSE regexp_extract(h, '^\\s*(\\S+)', 1) END"
_TAXONOMY = (
    "CASE src WHEN 'PR2' THEN array_to_string(list_transform(string_split(h, '|')[5:13], lambda x: trim(x)), ';') "
    "WHEN 'SILVA' THEN array_to_string(list_filter(list_transform(string_split(substr(h, instr(h, ' ') + 1), ';'), lambda x: trim(x)), lambda x: regexp_matches(x, '\\S')), ';') END"
)
_CLASSIFIED = (
    _BAD[:_BAD.index("raw AS (")]
    + "g AS (SELECT v.*, line, NOT coalesce(regexp_matches(line, '\\S'), false) AS blank, regexp_full_match(line, '(?:" + _FIELD + ",)*" + _FIELD + "', 's') AS strict, "
    "len(string_split(regexp_replace(line, '\"(?:[^\"]|\"\")*\"', 'q', 'g'), ',')) AS fields, " + _REASON + " AS wrong FROM v JOIN raw_headers USING (row_id)), "
    "k AS (SELECT 'raw_headers' AS table_name, row_id, CASE WHEN blank THEN 'empty_line' WHEN NOT strict THEN 'quoting' WHEN fields <> 5 THEN 'field_count' WHEN NOT regexp_full_match(f2, '[0-9]+(\\.[0-9]+)*') THEN 'version' "
    "WHEN f3 NOT IN ('16S', '18S') THEN 'marker' WHEN NOT regexp_full_match(f4, '0*[1-9][0-9]*') THEN 'length' WHEN wrong IS NOT NULL THEN 'header:' || wrong WHEN f1 <> " + _IDENTIFIER + " THEN 'identifier_mismatch' END AS reason, "
    + _IDENTIFIER + " AS identifier, " + _TAXONOMY + " AS taxonomy FROM g UNION ALL "
    "SELECT 'source_records', row_id, " + _REASON + ", " + _IDENTIFIER + ", " + _TAXONOMY + " FROM (SELECT row_id, reference_source AS src, CASE WHEN starts_with(original_header, '>') THEN substr(original_header, 2) ELSE original_header END AS h FROM source_records)) "
)

ORACLES = {
    "p4_rejects": _CLASSIFIED + "SELECT table_name, row_id, reason FROM k WHERE reason IS NOT NULL",
    "p4_valid": _CLASSIFIED + "SELECT table_name, row_id, identifier, taxonomy FROM k WHERE reason IS NULL",
    "p3_found": _ORPHANS + "SELECT * FROM o",
    "p3_report": _ORPHANS + "SELECT table_name, field_name, period, count(*) AS orphans FROM o GROUP BY ALL",
    "p4_found": _BAD,
}
