"""Strict ISO dates from text."""

from __future__ import annotations


def iso_date(column: str) -> str:
    """SQL expression: ``yyyy-MM-dd`` text as a date, anything else as NULL.

    Equal to ``try_to_date(column, 'yyyy-MM-dd')``, which raises and catches an
    exception for every bad value. Those cost several times a good one, and a
    single source with another date format can be a large share of all rows. So
    ten-byte dates go through the exception-free cast (which by itself would
    also take a one-digit day before a blank), and the formatter is left with
    signed years, which the pattern admits too.
    """
    plain = (
        f"octet_length({column}) = 10 AND substr({column}, 5, 1) = '-'"
        f" AND substr({column}, 8, 1) = '-' AND substr({column}, 10, 1) BETWEEN '0' AND '9'"
    )
    signed = f"{column} RLIKE '^[+-][0-9]{{4,}}-[0-9]{{2}}-[0-9]{{2}}$'"
    return (
        f"CASE WHEN {plain} THEN try_cast({column} AS date)"
        f" WHEN {signed} THEN try_to_date({column}, 'yyyy-MM-dd') END"
    )
