"""Materialised paths such as ``/R1/N6/C42``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def proper_prefixes(path: Column) -> Column:
    """Array of every prefix of ``path`` that ends just before a ``/``.

    ``/A/B/C`` gives ``''``, ``/A`` and ``/A/B``. A path lies below an anchor
    exactly when the anchor's path is one of them, which turns the prefix test
    into an equi-join. Null for a null path, empty for a path without ``/``.
    """
    parts = F.split(path, "/", -1)
    depth = F.size(parts)
    # sequence(1, 0) counts downwards, hence the guard.
    lengths = F.when(depth > 1, F.sequence(F.lit(1), depth - 1)).otherwise(
        F.array().cast("array<int>")
    )
    prefixes = F.transform(lengths, lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(path.isNotNull(), prefixes)
