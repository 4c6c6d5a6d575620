"""Removing one selection of records from a table set.

Each function returns a plan whose ``table(name)`` is the retained rows of a
table and whose ``tables()`` is the whole set. They are the single-rule forms of
``PrunePlan``, which applies many rules in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tablewinnow.plans.prune_plan import PrunePlan
from tablewinnow.plans.rules import (
    DATASETS,
    EVENTS,
    REMOVE,
    TRACKERS,
    Department,
    Removal,
    Rule,
    RuleError,
    route_rule,
)
from tablewinnow.profile import HEALTH_RECORDS, Profile

Tables = Mapping[str, DataFrame]
Uids = Sequence[str]


def _prune(tables: Tables, profile: Profile, *removals: Removal) -> PrunePlan:
    return PrunePlan(tables, removals, profile)


def _narrowed(removal: Removal) -> Removal:
    if removal.full:
        raise RuleError("nothing is selected: use the full form to remove the whole scope")
    return removal


def prune_datasets_full(
    tables: Tables, scope: Uids, profile: Profile = HEALTH_RECORDS
) -> PrunePlan:
    """Values and value audits of every element of the data sets in ``scope``."""
    return _prune(tables, profile, Removal(0, DATASETS, tuple(scope)))


def prune_datasets_scoped(
    tables: Tables,
    scope: Uids,
    datasets: Uids = (),
    elements: Uids = (),
    units: Uids = (),
    units_below: Uids = (),
    profile: Profile = HEALTH_RECORDS,
) -> PrunePlan:
    """Values within ``scope`` that meet all the given selections."""
    removal = Removal(
        0, DATASETS, tuple(scope), tuple(datasets), tuple(elements), tuple(units),
        tuple(units_below),
    )
    return _prune(tables, profile, _narrowed(removal))


def prune_events_full(
    tables: Tables, programs: Uids, profile: Profile = HEALTH_RECORDS
) -> PrunePlan:
    """Events of the programs with their value audits and comments."""
    return _prune(tables, profile, Removal(0, EVENTS, tuple(programs)))


def prune_events_scoped(
    tables: Tables,
    scope: Uids,
    programs: Uids = (),
    units: Uids = (),
    units_below: Uids = (),
    profile: Profile = HEALTH_RECORDS,
) -> PrunePlan:
    """Events of ``programs``, or of ``scope`` when none are given, at the units."""
    removal = Removal(
        0, EVENTS, tuple(scope), tuple(programs), (), tuple(units), tuple(units_below)
    )
    return _prune(tables, profile, _narrowed(removal))


def strip_event_keys(
    tables: Tables,
    scope: Uids,
    elements: Uids,
    programs: Uids = (),
    units: Uids = (),
    units_below: Uids = (),
    profile: Profile = HEALTH_RECORDS,
) -> PrunePlan:
    """Take the keys ``elements`` out of the documents of matching events."""
    removal = Removal(
        0, EVENTS, tuple(scope), tuple(programs), tuple(elements), tuple(units),
        tuple(units_below),
    )
    return _prune(tables, profile, _narrowed(removal))


def prune_trackers_full(
    tables: Tables, programs: Uids, profile: Profile = HEALTH_RECORDS
) -> PrunePlan:
    """Everything about the tracker programs: their events with audits and
    comments, their enrolments, and the enrolled entities with their attributes,
    ownership and all their other enrolments."""
    return _prune(tables, profile, Removal(0, TRACKERS, tuple(programs)))


def prune_trackers_scoped(
    tables: Tables,
    scope: Uids,
    trackers: Uids = (),
    units: Uids = (),
    units_below: Uids = (),
    profile: Profile = HEALTH_RECORDS,
) -> PrunePlan:
    """Events of the scoped tracker programs that meet all selections;
    enrolments and entities stay."""
    removal = Removal(
        0, TRACKERS, tuple(scope), tuple(trackers), (), tuple(units), tuple(units_below)
    )
    return _prune(tables, profile, _narrowed(removal))


def strip_tracker_keys(
    tables: Tables,
    scope: Uids,
    elements: Uids,
    trackers: Uids = (),
    units: Uids = (),
    units_below: Uids = (),
    profile: Profile = HEALTH_RECORDS,
) -> PrunePlan:
    """Take the keys ``elements`` out of the documents of matching tracker events."""
    removal = Removal(
        0, TRACKERS, tuple(scope), tuple(trackers), tuple(elements), tuple(units),
        tuple(units_below),
    )
    return _prune(tables, profile, _narrowed(removal))


def prune_department(
    tables: Tables, department: Department, profile: Profile = HEALTH_RECORDS
) -> PrunePlan:
    """Everything of every family a department lists."""
    whole = Rule(position=0, department=department.key, action=REMOVE)
    return _prune(tables, profile, *route_rule(department, whole))
