"""Text as sinks and identities need it: JSON in ASCII, numbers as printf and round write them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_escaped(json: Column) -> Column:
    """JSON text with every character beyond ASCII as ``\\uXXXX``, two of them beyond the basic plane."""
    def unit(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))

    def escaped(c: Column) -> Column:
        code = F.ascii(c)
        beyond = code - 0x10000
        pair = F.concat(unit(F.shiftright(beyond, 10) + 0xD800), unit(beyond.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
        return F.when(code < 128, c).when(code < 0x10000, unit(code)).otherwise(pair)

    characters = F.regexp_extract_all(json, F.lit("(?s)."), 0)
    return F.when(json.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(characters, escaped), "")).otherwise(json)


def general_format(digits: int = 6):
    """A function from double to text as printf ``%g`` writes it with ``digits`` digits, null as empty text; for text sinks only."""
    def formatted(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "" if v is None or v != v else format(v, f".{digits}g")).astype("string")

    return F.pandas_udf(formatted, "string")


def rounded_text(digits: int = 2):
    """A function from double to the shortest text of the number rounded to ``digits`` places, half to even of its exact binary value; for text sinks only."""
    def formatted(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "" if v is None or v != v else str(round(float(v), digits))).astype("string")

    return F.pandas_udf(formatted, "string")
