"""Queries of the training-data problems, with their SQL where SQL can say it over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimark.functions.ids import sequence_id_of, sequence_key
from sedimark.llm.bpe import decode_ids, encode_corpus
from sedimark.llm.leakage import leaked_passages, without_leaks
from sedimark.llm.split import split_oversized
from sedimark.llm.survivors import Field, all_records, merged_records, survivors
from sedimark.llm.topn import top_n
from sedimark.llm.vocabulary import FOLDER
from sedimark.storage import table

TOP = 5
LEAST_WORDS = 12
LIMIT, OVERLAP = 512, 64
VOCABULARY = os.path.join(FOLDER, "byte_bpe_50k.tiktoken")

# What counts as a value, and the order of trust.
SOURCES = r"(?:silva|pr2)(?:[^a-z0-9]+(?:silva|pr2))*"
METHODS = ("native", "lowest_common_ancestor", "updated_reference_cluster", "cross_domain_ambiguous_exact_sequence")
TRUSTED = METHODS[:3]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return top_n(table(spark, folder, "blast_hits"), "query", "subject", "bit_score", TOP).select("query", "subject")


def p1_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return top_n(table(spark, folder, "blast_hits"), "query", "subject", "bit_score", TOP)


def _tidy(column: str):
    return F.lower(F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", ""))


def _among(column: str, values: tuple[str, ...]):
    return F.when(_tidy(column).isin(*values), _tidy(column))


def _like(column: str, pattern: str):
    return F.when(_tidy(column).rlike(rf"\A{pattern}\z"), _tidy(column))


SURVIVOR_FIELDS = ["taxonomy_source", "assignment_method", "cross_domain_conflict"]


def _trust() -> list:
    rank = F.coalesce(F.array_position(F.array(*[F.lit(m) for m in TRUSTED]), _tidy("assignment_method")), F.lit(0))
    age = F.timestamp_diff("MICROSECOND", F.col("loaded_at").cast("timestamp_ntz"), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))  # smaller is later
    return [F.when(rank == 0, len(TRUSTED) + 1).otherwise(rank).cast("int"), F.coalesce(age, F.lit(2**62))]


def _survivors(spark: SparkSession, folder: str, operator=survivors) -> DataFrame:
    return operator(
        table(spark, folder, "preferred_taxonomy"),
        sequence_key(F.col("sequence_id")),
        [
            Field("taxonomy_source", _like("taxonomy_source", SOURCES)),
            Field("assignment_method", _among("assignment_method", METHODS)),
            Field("cross_domain_conflict", F.col("cross_domain_conflict").cast("string")),
        ],
        _trust(),
    )


def _sequence_id():
    return sequence_id_of(F.col("key")).alias("sequence_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _survivors(spark, folder).select(_sequence_id(), "field_name", "row_id")


def p5_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return merged_records(_survivors(spark, folder), SURVIVOR_FIELDS).select(_sequence_id(), *SURVIVOR_FIELDS)


def p5_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row for every sequence_id; p5_survivors has only those of two or more rows and some value."""
    return _survivors(spark, folder, all_records).select(_sequence_id(), *SURVIVOR_FIELDS)


def p5_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """The taxonomy path closest to the consensus of each sequence_id with two or more rows, every row with one vote; not SQL."""
    path = F.when(F.col("taxonomy").rlike(r"(?U)\S"), F.trim("taxonomy"))
    chosen = survivors(table(spark, folder, "preferred_taxonomy"), sequence_key(F.col("sequence_id")), [Field("taxonomy", path)], _trust(), vote="rows")
    return chosen.select(_sequence_id(), "field_name", "row_id", "value")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), VOCABULARY)


def p6_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document decoded again from its token ids."""
    return p6_ids(spark, folder).select("doc_id", decode_ids(F.col("ids"), VOCABULARY).alias("text"))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items"), LEAST_WORDS)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder).select("doc_id", "item_id").distinct()


def p7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return _leaks(spark, folder)


def p7_clean(spark: SparkSession, folder: str) -> DataFrame:
    return without_leaks(table(spark, folder, "documents"), _leaks(spark, folder)).select("doc_id", "text")


def p8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split_oversized(table(spark, folder, "documents"), VOCABULARY, LIMIT, OVERLAP)


def p8_joined(spark: SparkSession, folder: str) -> DataFrame:
    """Every text put together again from its pieces without what they share with the piece before."""
    pieces = p8_pieces(spark, folder)
    before = F.coalesce(F.lag("end").over(Window.partitionBy("doc_id").orderBy("piece")), F.lit(0))
    own = pieces.select("doc_id", "piece", F.substring("text", before - F.col("start") + 1, F.length("text")).alias("own"))
    parts = F.array_sort(F.collect_list(F.struct("piece", "own")))  # the pieces of one text
    return own.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["own"]), "").alias("text"))


def p8_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many pieces are within the limit, how many begin anew, and how near the overlaps come to the one wanted."""
    pieces = p8_pieces(spark, folder)
    kind = F.when(F.col("piece") == 1, "first").when(F.col("overlap") == 0, "none").when(F.abs(F.col("overlap") - OVERLAP) <= OVERLAP // 4, "near").otherwise("far")
    return pieces.groupBy(kind.alias("overlap")).agg(F.count(F.lit(1)).alias("pieces"), F.count_if(F.col("tokens") > LIMIT).alias("above_limit"), F.min("overlap").alias("least"), F.max("overlap").alias("most"))


QUERIES = {f.__name__: f for f in (p1_found, p1_ranked, p5_found, p5_survivors, p5_records, p5_consensus, p6_ids, p6_round_trip, p7_found, p7_passages, p7_clean, p8_pieces, p8_joined, p8_sizes)}

_RANKED = (
    "WITH p AS (SELECT query, subject, max(bit_score) AS bit_score FROM blast_hits WHERE trim(query) <> '' AND trim(subject) <> '' AND isfinite(bit_score) GROUP BY query, subject), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bit_score DESC, subject) AS position FROM p) "
)
_METHOD = "lower(regexp_replace(assignment_method, '^\\s+|\\s+$', '', 'g'))"
_SOURCE = "lower(regexp_replace(taxonomy_source, '^\\s+|\\s+$', '', 'g'))"
_CHOSEN = (
    "WITH t AS (SELECT 'SSU_' || nullif(regexp_extract(sequence_id, '[Ss][Ss][Uu]_([A-Za-z0-9_-]{43})', 1), '') AS sequence_id, row_id, loaded_at, "
    f"CASE {_METHOD} WHEN 'native' THEN 1 WHEN 'lowest_common_ancestor' THEN 2 WHEN 'updated_reference_cluster' THEN 3 ELSE 4 END AS trust, "
    f"CASE WHEN regexp_full_match({_SOURCE}, '{SOURCES}') THEN {_SOURCE} END AS a, CASE WHEN {_METHOD} IN {METHODS} THEN {_METHOD} END AS b, CAST(cross_domain_conflict AS VARCHAR) AS c FROM preferred_taxonomy), "
    "g AS (SELECT * FROM t WHERE sequence_id IN (SELECT sequence_id FROM t GROUP BY sequence_id HAVING count(*) > 1)), "
    "u AS (SELECT sequence_id, 'taxonomy_source' AS field_name, a AS value, trust, loaded_at, row_id FROM g UNION ALL SELECT sequence_id, 'assignment_method', b, trust, loaded_at, row_id FROM g "
    "UNION ALL SELECT sequence_id, 'cross_domain_conflict', c, trust, loaded_at, row_id FROM g), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY sequence_id, field_name ORDER BY trust, loaded_at DESC NULLS LAST, row_id) AS k FROM u WHERE value IS NOT NULL) "
)
_EVERY = _CHOSEN.replace("sequence_id IN (SELECT sequence_id FROM t GROUP BY sequence_id HAVING count(*) > 1)", "sequence_id IS NOT NULL")

ORACLES = {
    "p1_found": _RANKED + "SELECT query, subject FROM r WHERE position <= 5",
    "p1_ranked": _RANKED + "SELECT query, subject, bit_score, position FROM r WHERE position <= 5",
    "p5_found": _CHOSEN + "SELECT sequence_id, field_name, row_id FROM w WHERE k = 1",
    "p5_survivors": _CHOSEN + "SELECT sequence_id, max(CASE WHEN field_name = 'taxonomy_source' THEN value END) AS taxonomy_source, max(CASE WHEN field_name = 'assignment_method' THEN value END) AS assignment_method, "
    "max(CASE WHEN field_name = 'cross_domain_conflict' THEN value END) AS cross_domain_conflict FROM w WHERE k = 1 GROUP BY sequence_id",
    "p5_records": _EVERY + "SELECT s.sequence_id, max(CASE WHEN field_name = 'taxonomy_source' THEN value END) AS taxonomy_source, max(CASE WHEN field_name = 'assignment_method' THEN value END) AS assignment_method, "
    "max(CASE WHEN field_name = 'cross_domain_conflict' THEN value END) AS cross_domain_conflict FROM (SELECT DISTINCT sequence_id FROM g) s LEFT JOIN (SELECT * FROM w WHERE k = 1) v ON v.sequence_id = s.sequence_id GROUP BY s.sequence_id",
    "p8_joined": "SELECT doc_id, text FROM documents WHERE text IS NOT NULL",
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
