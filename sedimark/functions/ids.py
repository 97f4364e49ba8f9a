"""Canonical forms of the identifiers that tie the release tables together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id grammars of the release format.
SEQUENCE_PATTERN = r"(?i:SSU_)([A-Za-z0-9_-]{43})"
RECORD_PATTERN = r"(?i)SRC_([0-9a-f]{64})"
TAXON_PATTERN = r"(?<![0-9])([0-9]{10})(?![0-9])"


def _found(column: Column, pattern: str) -> Column:
    part = F.regexp_extract(column, pattern, 1)
    return F.when(part != "", part)


def canonical_sequence_id(column: Column) -> Column:
    """``SSU_`` + 43 case-sensitive characters, whatever stands around them; null without such an id."""
    return F.concat(F.lit("SSU_"), _found(column, SEQUENCE_PATTERN))


def canonical_record_id(column: Column) -> Column:
    """``SRC_`` + 64 lower-case hexadecimal digits; null without such an id."""
    return F.concat(F.lit("SRC_"), F.lower(_found(column, RECORD_PATTERN)))


def canonical_taxon_oid(column: Column) -> Column:
    """The ten digits; null without a run of exactly ten."""
    return _found(column, TAXON_PATTERN)


def sequence_key(column: Column) -> Column:
    """The sequence id as a big-endian integer of 33 bytes, ordered as integers are and equal only for equal ids.

    43 base64url digits hold 258 bits, two more than 32 bytes; the last digit is appended so that nothing is lost.
    """
    digits = _found(column, SEQUENCE_PATTERN)
    return F.concat(
        F.unbase64(F.concat(F.translate(digits, "-_", "+/"), F.lit("="))),
        F.encode(F.substring(digits, 43, 1), "utf-8"),
    )


def sequence_id_of(key: Column) -> Column:
    """The canonical sequence id whose sequence_key is ``key``."""
    digits = F.substring(F.translate(F.base64(F.substring(key, 1, 32)), "+/", "-_"), 1, 42)
    return F.concat(F.lit("SSU_"), digits, F.decode(F.substring(key, 33, 1), "utf-8"))


def record_key(column: Column) -> Column:
    """The record id as a big-endian integer of 32 bytes."""
    return F.unhex(_found(column, RECORD_PATTERN))


def taxon_key(column: Column) -> Column:
    """The taxon oid as a big-endian integer of 8 bytes."""
    return F.unhex(F.lpad(F.hex(canonical_taxon_oid(column).cast("bigint")), 16, "0"))


def is_blank(column: Column) -> Column:
    """Null, empty or nothing but white space."""
    return F.coalesce(~column.rlike(r"(?U)\S"), F.lit(True))
