"""Expressions over arrays held in one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unique_by_field(items: Column, field: str = "id") -> Column:
    """Keep the first struct for each value of ``field``, in order."""

    def add(seen: Column, item: Column) -> Column:
        known = F.exists(seen, lambda s: s[field].eqNullSafe(item[field]))
        return F.when(known, seen).otherwise(F.concat(seen, F.array(item)))

    nothing = F.filter(items, lambda _: F.lit(False))
    return F.aggregate(items, nothing, add)


def array_minus(items: Column, removed: Column) -> Column:
    """``items`` without those in ``removed``; order and repeats are kept."""
    return F.filter(items, lambda item: ~F.exists(removed, lambda r: r.eqNullSafe(item)))
