"""Emptying tables while keeping their schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewinnow.profile import DATA_TABLES, DEPENDENT_TABLES


def without_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


def empty_tables(
    tables: Mapping[str, DataFrame], names: Iterable[str] = DATA_TABLES
) -> dict[str, DataFrame]:
    """All tables, those named without their rows. Names not present are skipped."""
    emptied = set(names)
    return {name: without_rows(df) if name in emptied else df for name, df in tables.items()}


def clear_dependents(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Empty the audit, message and comment tables rules start from."""
    return empty_tables(tables, DEPENDENT_TABLES)
