"""Resolving uids to surrogate keys, and org units to what lies below them.

Pruning marks keys with the rules that select them; here the same marks are made
for a single selection, and only the keys are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from tablewinnow.operators.marks import element_marks, place_marks, stage_marks
from tablewinnow.plans.rules import DATASETS, EVENTS, Removal
from tablewinnow.profile import HEALTH_RECORDS, Profile

Tables = Mapping[str, DataFrame]


def pick(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns)


def stages_of_programs(
    tables: Tables, uids: Iterable[str], profile: Profile = HEALTH_RECORDS
) -> DataFrame:
    marks = stage_marks(tables, [Removal(0, EVENTS, tuple(uids))], profile)
    return marks.select(profile.stage_key)


def elements_of_datasets(
    tables: Tables, uids: Iterable[str], profile: Profile = HEALTH_RECORDS
) -> DataFrame:
    """Data elements that belong to any of the data sets."""
    marks = element_marks(tables, [Removal(0, DATASETS, tuple(uids))], profile)
    return marks.select(profile.element.key)


def elements_by_uid(
    tables: Tables,
    uids: Iterable[str],
    within: Iterable[str],
    profile: Profile = HEALTH_RECORDS,
) -> DataFrame:
    """Named data elements, as far as they belong to one of the data sets ``within``;
    none for an empty list."""
    uids = tuple(uids)
    scope = tuple(within) if uids else ()
    marks = element_marks(tables, [Removal(0, DATASETS, scope, elements=uids)], profile)
    return marks.select(profile.element.key)


def _places(tables: Tables, removals: list[Removal], profile: Profile) -> DataFrame:
    marks = place_marks(tables, removals, profile)
    key = profile.org_unit.key
    return tables[profile.org_unit.table].select(key).limit(0) if marks is None else marks.select(key)


def org_units(
    tables: Tables, uids: Iterable[str], profile: Profile = HEALTH_RECORDS
) -> DataFrame:
    return _places(tables, [Removal(0, EVENTS, (), units=tuple(uids))], profile)


def org_unit_descendants(
    tables: Tables,
    uids: Iterable[str],
    include_self: bool = False,
    profile: Profile = HEALTH_RECORDS,
) -> DataFrame:
    """Units that lie strictly below any of the named ones.

    ``/AB`` does not lie below ``/A``, and a unit without a path lies below
    nothing and has nothing below it.
    """
    uids = tuple(uids)
    removals = [Removal(0, EVENTS, (), units_below=uids)]
    if include_self:
        removals.append(Removal(1, EVENTS, (), units=uids))
    return _places(tables, removals, profile)
