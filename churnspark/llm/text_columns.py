"""Column expressions on text shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words and is stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does it where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def word_list(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    stripped = strip_blanks(F.coalesce(text, F.lit("")))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, BLANK_RUN))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
