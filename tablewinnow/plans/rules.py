"""Rule files: reading them, binding them to departments, and deciding which
family of records a rule removes from."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

DATASETS = "datasets"
EVENTS = "events"
TRACKERS = "trackers"

# Spellings used in rule files. They are compared without regard
# to case.
TYPE_NAMES = {
    "dataSets": DATASETS,
    "eventPrograms": EVENTS,
    "trackerPrograms": TRACKERS,
}
DEPARTMENT_KEY = "selectDepartament"
TYPE_KEYS = ("selectMetadataType", "selectMDType")
SELECTION_KEYS = {
    "selectDatasets": DATASETS,
    "selectEventProgram": EVENTS,
    "selectEventPrograms": EVENTS,
    "selectTrackerProgram": TRACKERS,
    "selectTrackerPrograms": TRACKERS,
}
ELEMENTS_KEY = "selectDataElements"
UNITS_KEY = "selectOrgUnits"
DESCENDANTS_KEY = "selectOrgUnitAndDescendants"
ACTION_KEY = "action"
REMOVE = "removeData"

_TYPES = {name.lower(): family for name, family in TYPE_NAMES.items()}
_SELECTIONS = {name.lower(): family for name, family in SELECTION_KEYS.items()}
_LISTS = {ELEMENTS_KEY.lower(), UNITS_KEY.lower(), DESCENDANTS_KEY.lower()}
_TYPE_LISTS = {name.lower() for name in TYPE_KEYS}


class RuleError(ValueError):
    """A rule that cannot be applied without guessing what it should remove."""


@dataclass(frozen=True)
class Department:
    key: str
    scopes: Mapping[str, tuple[str, ...]]

    def scope(self, family: str) -> tuple[str, ...]:
        """The department's own uids; with no explicit selection they are the
        scope of a rule. Empty when it lists none of the family."""
        return self.scopes.get(family, ())


@dataclass(frozen=True)
class Rule:
    position: int
    department: str
    action: str
    types: tuple[str, ...] = ()
    selected: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    elements: tuple[str, ...] = ()
    units: tuple[str, ...] = ()
    units_below: tuple[str, ...] = ()


@dataclass(frozen=True)
class Removal:
    """One rule as it bears on one family of records."""

    rule: int
    family: str
    scope: tuple[str, ...]
    selected: tuple[str, ...] = ()
    elements: tuple[str, ...] = ()
    units: tuple[str, ...] = ()
    units_below: tuple[str, ...] = ()

    @property
    def full(self) -> bool:
        """Not narrowed: dependents go too, not only the fact rows."""
        return not (self.selected or self.elements or self.units or self.units_below)

    @property
    def strips(self) -> bool:
        """Selected data elements of events are keys to take out of the event's
        document; the event itself stays."""
        return self.family != DATASETS and bool(self.elements)

    @property
    def programs(self) -> tuple[str, ...]:
        """Programs concerned. A selection replaces the department's programs,
        except that deleting tracker events stays within them, and that a department
        without programs of the family has none to replace: nothing is removed."""
        if not self.selected or not self.scope:
            return self.scope
        if self.family == TRACKERS and not self.strips:
            return tuple(uid for uid in self.selected if uid in set(self.scope))
        return self.selected


def load_config(spark: SparkSession, path: str) -> dict:
    """Read a JSON configuration from wherever the session can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_rules(spark: SparkSession, path: str) -> tuple[list[Department], list[Rule]]:
    config = load_config(spark, path)
    return (
        read_departments(config.get("departments", {})),
        read_rules(config.get("preprocess", [])),
    )


def _uids(name: str, value: str | Iterable[str]) -> tuple[str, ...]:
    values = [value] if isinstance(value, str) else list(value)
    if not values:
        raise RuleError(f"{name} is empty: leave it out or list what it should select")
    return tuple(dict.fromkeys(values))


def read_departments(departments: Mapping[str, Mapping]) -> list[Department]:
    result = []
    for key, lists in departments.items():
        scopes: dict[str, tuple[str, ...]] = {}
        for name, uids in lists.items():
            family = _TYPES.get(name.lower())
            if family is None:
                raise RuleError(f"department {key}: unknown key {name}")
            # An empty list is a department without that family.
            listed = (uids,) if isinstance(uids, str) else tuple(uids)
            scopes[family] = scopes.get(family, ()) + listed
        result.append(Department(key, scopes))
    return result


def read_rule(position: int, entry: Mapping) -> Rule:
    """Check one entry and bring it into a uniform shape. What entries with
    another action hold is not looked at."""
    values = {name.lower(): value for name, value in entry.items()}
    try:
        department, action = values.pop(DEPARTMENT_KEY.lower()), values.pop(ACTION_KEY)
    except KeyError as missing:
        raise RuleError(f"rule {position}: {missing} is required") from None
    if action != REMOVE:
        return Rule(position, department, action)

    types: tuple[str, ...] = ()
    selected: dict[str, tuple[str, ...]] = {}
    lists: dict[str, tuple[str, ...]] = {}
    for name, value in values.items():
        uids = _uids(f"rule {position}: {name}", value)
        if name in _TYPE_LISTS:
            unknown = [t for t in uids if t.lower() not in _TYPES]
            if unknown:
                raise RuleError(f"rule {position}: unknown metadata type {unknown}")
            types += tuple(_TYPES[t.lower()] for t in uids)
        elif name in _SELECTIONS:
            family = _SELECTIONS[name]
            selected[family] = selected.get(family, ()) + uids
        elif name in _LISTS:
            lists[name] = uids
        else:
            raise RuleError(f"rule {position}: unknown key {name}")
    return Rule(
        position=position,
        department=department,
        action=action,
        types=types,
        selected=selected,
        elements=lists.get(ELEMENTS_KEY.lower(), ()),
        units=lists.get(UNITS_KEY.lower(), ()),
        units_below=lists.get(DESCENDANTS_KEY.lower(), ()),
    )


def read_rules(entries: Iterable[Mapping]) -> list[Rule]:
    return [read_rule(position, entry) for position, entry in enumerate(entries)]


def bind_rules(
    rules: Iterable[Rule], departments: Iterable[Department]
) -> tuple[list[tuple[Department, Rule]], list[Rule]]:
    """Pair each rule with its department, whatever the case of the name. Pairs
    follow the order of departments, then of rules; rules of an unknown
    department are returned apart and are not applied."""
    rules, departments = list(rules), list(departments)
    pairs = [
        (department, rule)
        for department in departments
        for rule in rules
        if rule.department.upper() == department.key.upper()
    ]
    known = {department.key.upper() for department in departments}
    return pairs, [rule for rule in rules if rule.department.upper() not in known]


def route_rule(department: Department, rule: Rule) -> list[Removal]:
    """The removals a rule stands for, one per family it bears on."""
    if rule.action != REMOVE:
        return []
    narrowed = bool(rule.elements or rule.units or rule.units_below)
    families = [f for f in TYPE_NAMES.values() if f in rule.types or f in rule.selected]
    if not families:
        if narrowed:
            raise RuleError(
                f"rule {rule.position}: data elements or org units are selected, but not the "
                "metadata type they narrow; applied as it stands it would remove everything"
            )
        return [
            Removal(rule.position, family, department.scope(family))
            for family in TYPE_NAMES.values()
            if department.scope(family)
        ]
    return [
        Removal(
            rule=rule.position,
            family=family,
            scope=department.scope(family),
            selected=rule.selected.get(family, ()),
            elements=rule.elements,
            units=rule.units,
            units_below=rule.units_below,
        )
        for family in families
    ]


def plan_removals(
    departments: Iterable[Department], rules: Iterable[Rule]
) -> tuple[list[Removal], list[Rule]]:
    pairs, unmatched = bind_rules(rules, departments)
    removals = [removal for pair in pairs for removal in route_rule(*pair)]
    return removals, unmatched
