"""Silver rules: validity filter, tidy-up, derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.tables import TableSpec, spec_for


def valid_rows(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Rows that meet every validity rule; a rule that is NULL is not met.

    The rules are one filter on plain landing columns, so it reaches the scan.
    """
    return df.where(" AND ".join(f"({rule})" for rule in spec_for(table).valid))


def tidied(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Normalise text, dates and defaults in place."""
    rules = spec_for(table).tidy
    return df.withColumns({name: F.expr(rule) for name, rule in rules.items()})


def derived(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Append the computed columns to tidied rows."""
    rules = spec_for(table).derived
    return df.withColumns({name: F.expr(rule) for name, rule in rules.items()})


def apply_rules(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """All row-wise rules of a table; Catalyst merges them into one stage."""
    return derived(tidied(valid_rows(df, table), table), table)
