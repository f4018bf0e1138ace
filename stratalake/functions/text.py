"""Tokenising on Unicode white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: runs of the characters Python's str.split() treats as white space.
WHITE_SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]+"


def tokens(text: Column) -> Column:
    """Array of words; text that starts or ends with white space adds an empty word."""
    return F.split(text, WHITE_SPACE)
