"""Digests of tables, to tell whether a copy is complete.

A digest does not depend on the order of rows or on partitions, and counts repeated rows as
often as they occur: the number of rows and the sums of two hashes of each. It is one
aggregate, so it can be observed while the rows are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARTS = ("row_count", "first_sum", "second_sum")


@dataclass(frozen=True)
class Digest:
    row_count: int
    first_sum: int
    second_sum: int


def _hashable(field: T.StructField) -> Column:
    """Maps and variants have no hash; their text stands for them."""
    column = F.col(f"`{field.name}`")
    if _has_no_hash(field.dataType):
        return F.to_json(F.struct(column))
    return column


def _has_no_hash(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_no_hash(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_no_hash(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def digest_columns(df: DataFrame) -> list[Column]:
    """The aggregates of a digest. A hash passes over nulls, so which columns are null is
    hashed too; sums are wide enough for any number of rows."""
    columns = [_hashable(f) for f in df.schema.fields]
    nulls = F.concat(F.lit(""), *[F.isnull(c).cast("int").cast("string") for c in columns])
    hashes = (F.xxhash64(nulls, *columns), F.xxhash64(F.lit("second"), nulls, *columns))
    sums = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for h in hashes]
    return [c.alias(n) for c, n in zip([F.count(F.lit(1)), *sums], _PARTS, strict=True)]


def _of(values: dict) -> Digest:
    return Digest(*[int(values[n]) for n in _PARTS])


def digest(df: DataFrame) -> Digest:
    return _of(df.agg(*digest_columns(df)).first().asDict())


class Observed:
    """The digest of rows, taken when they are next written."""

    def __init__(self, df: DataFrame):
        self._observation = Observation()
        self.frame = df.observe(self._observation, *digest_columns(df))

    @property
    def digest(self) -> Digest:
        return _of(self._observation.get)
