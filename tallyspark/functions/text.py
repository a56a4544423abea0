"""Column expressions for typed-by-people text: blanks, null tokens, ids and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for "no value".
NULL_TOKENS = ("", "-", "NULL", "null", "None", "Not Reported", "N/A", "NR")

BLANKS = " \t\r\n\f\x0b\u00a0"


def strip_blanks(value: Column | str) -> Column:
    """Blanks of any kind cut from both ends."""
    return F.trim(F.col(value) if isinstance(value, str) else value, F.lit(BLANKS))


def valued(value: Column | str) -> Column:
    """The stripped text, or null where the text is a null token."""
    stripped = strip_blanks(value)
    return F.when(~stripped.isin(*NULL_TOKENS), stripped)


def id_key(value: Column | str) -> Column:
    """An id as it is compared: no blanks around it, one letter case, null tokens null."""
    return F.upper(valued(value))


def name_key(value: Column | str) -> Column:
    """Name match key: all white space cut from the ends, lower case."""
    return F.lower(strip_blanks(F.col(value).cast("string") if isinstance(value, str) else value.cast("string")))


def blank_to_null(value: Column | str) -> Column:
    stripped = strip_blanks(F.col(value).cast("string") if isinstance(value, str) else value.cast("string"))
    return F.when(stripped != "", stripped)


def safe_number(value: Column | str, kind: str = "bigint") -> Column:
    """A text as a number; null where it isn't one, whatever it is."""
    return strip_blanks(value).try_cast(kind)


def preview(value: Column | str, width: int = 240) -> Column:
    """White space collapsed, cut at ``width`` characters with an ellipsis."""
    col = F.col(value) if isinstance(value, str) else value
    flat = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.when(F.length(flat) > width, F.concat(F.substring(flat, 1, width - 3), F.lit("..."))).otherwise(flat)
