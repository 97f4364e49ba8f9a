"""Several values packed in one field.

Spans that are quoted or escaped are replaced by placeholders that carry their
index, the rest is split at the delimiters, and the spans come back through an
array lookup.  A placeholder mark that happens to occur in the text is itself
treated as a span, so that no placeholder can be mistaken.  Everything is one
JVM expression per field; a table is read once for all of its fields.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "", ""
MARK = f"{OPEN}([0-9]+){CLOSE}"
BLANK = r"[\p{Z}\s]"
# A quote opens a span only where a value can start, an escape anywhere.
SPAN = (
    r"(?s)(?<![\p{L}\p{N}_.()-])\"(?:[^\"\\]|\\.|\"\")*\""
    r"|(?<![\p{L}\p{N}_.()-])'(?:[^'\\]|\\.|'')*'"
    rf"|\\.|[{OPEN}{CLOSE}]"
)
# What never separates, and line breaks that count once.
_NEVER = rf"-_.:()'\"\\\\{OPEN}{CLOSE}"
_NAMED_NULL = r"^(?:null|None)$"


class PackedField(NamedTuple):
    """How a field is packed: whether a blank alone separates, which further characters belong to values, and, where entries are objects, the member that is the value."""

    name: str
    blank_separates: bool = False
    kept: str = ""
    member: str | None = None

    @property
    def separator(self) -> str:
        symbol = rf"(?:\r\n|[\p{{P}}\p{{S}}\t\n\x0b\f\r\x85  &&[^{_NEVER}{self.kept}]])"
        blank = r"[\p{Zs}]"
        return rf"{blank}*{symbol}{blank}*" + (rf"|{blank}+" if self.blank_separates else "")


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+\z", "")


def _content(span: Column) -> Column:
    """A span without its quotes and escapes."""
    quote = F.substring(span, 1, 1)
    inner = F.substring(span, F.lit(2), F.length(span) - 2)
    plain = lambda doubled: F.regexp_replace(F.regexp_replace(inner, doubled * 2, doubled), r"(?s)\\(.)", "$1")
    json = F.get(F.from_json(F.concat(F.lit("["), span, F.lit("]")), "array<string>"), 0)
    return (
        F.when((quote == '"') & span.rlike(r"\\[bfnrtu]"), F.coalesce(json, plain('"')))
        .when(quote == '"', plain('"'))
        .when(quote == "'", plain("'"))
        .when(quote == "\\", F.substring(span, F.lit(2), F.length(span)))
        .otherwise(span)
    )


def _restored(part: Column, contents: Column) -> Column:
    """A part with the contents of its placeholders in place."""
    pieces = F.split(part, f"[{OPEN}{CLOSE}]", -1)  # text, index, text, index, ..., text
    whole = F.array_join(F.transform(pieces, lambda x, i: F.when(i % 2 == 1, F.get(contents, x.try_cast("int"))).otherwise(x)), "")
    return _trim(F.when(F.contains(part, F.lit(OPEN)), whole).otherwise(part))


def packed_values(text: Column, field: PackedField) -> Column:
    """The values of one packed text: an array of ``struct<pos int, value string>``, pos from 1.

    * Null, empty and blank texts hold no values: an empty array.
    * A text with no delimiter holds one value at position 1.
    * An empty place (two delimiters in a row, an empty entry or a bare null in a bracketed list) gives no
      value but counts in pos; so does an object without the wanted member.
    * Quoted or escaped delimiters belong to the value; values come without outer blanks, quotes, escapes.
    * A quote that is never closed is an ordinary character.
    """
    with_spans = lambda raw, spans: F.array_join(F.transform(
        F.split(raw, SPAN, -1), lambda x, i: F.when(i < F.size(spans), F.concat(x, F.lit(OPEN), i.cast("string"), F.lit(CLOSE))).otherwise(x)), "")

    def values(marked: Column, contents: Column) -> Column:
        listed = marked.rlike(r"(?s)\A\[.*\]\z")
        inner = F.when(listed, F.substring(marked, F.lit(2), F.length(marked) - 2)).otherwise(marked)
        entry = lambda x: F.when(listed & _trim(x).rlike(_NAMED_NULL), F.lit("")).otherwise(_restored(x, contents))
        plain = F.transform(
            F.split(_trim(inner) if field.blank_separates else inner, field.separator, -1),
            lambda x, i: F.struct((i + 1).alias("pos"), entry(x).alias("value")))
        if field.member is None:
            return plain
        pair = rf"{MARK}\s*:\s*{MARK}"

        def member(entry: Column) -> Column:
            names, held = (F.regexp_extract_all(entry, F.lit(pair), g) for g in (1, 2))
            at = F.array_position(F.transform(names, lambda k: F.get(contents, k.cast("int"))), field.member)
            return _trim(F.coalesce(F.get(contents, F.get(held, (at - 1).cast("int")).cast("int")), F.lit("")))

        objects = F.transform(F.split(inner, r",(?![^{}]*\})", -1), lambda x, i: F.struct(
            (i + 1).alias("pos"), F.when(F.contains(x, F.lit("{")), member(x)).otherwise(entry(x)).alias("value")))
        return F.when(marked.rlike(r"(?s)\A\[?[^\[{]*\{"), objects).otherwise(plain)

    # let raw, spans, contents be evaluated once each
    raw = F.transform(F.array(_trim(text)), lambda t: F.struct(t.alias("raw"), F.regexp_extract_all(t, F.lit(SPAN), 0).alias("spans")))
    prepared = F.transform(raw, lambda s: F.struct(
        F.when(F.size(s["spans"]) == 0, s["raw"]).otherwise(with_spans(s["raw"], s["spans"])).alias("marked"), F.transform(s["spans"], _content).alias("contents")))
    result = F.flatten(F.transform(prepared, lambda s: values(s["marked"], s["contents"])))
    return F.filter(F.coalesce(result, F.array()), lambda v: v["value"] != "")


def unpack(df: DataFrame, fields: list[PackedField], row_id: str = "row_id") -> DataFrame:
    """One row per value: ``field_name, row_id, pos, value``, from one scan of ``df`` for all ``fields``; see packed_values.

    Rows that occur twice give their values twice; other columns, whatever their names, are not read.
    """
    named = lambda name: lambda v: F.struct(F.lit(name).alias("field_name"), v["pos"].alias("pos"), v["value"].alias("value"))
    each = [F.transform(packed_values(F.col(f.name), f), named(f.name)) for f in fields]
    return df.select(F.col(row_id).alias("__row"), F.explode(F.concat(*each)).alias("__v")).select(
        F.col("__v.field_name").alias("field_name"), F.col("__row").alias("row_id"), F.col("__v.pos").alias("pos"), F.col("__v.value").alias("value"))
