"""Column helpers shared by the operators: the word rule and ASCII lower case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: words are maximal runs of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Array of words; empty for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def n_words(c: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")
