import json

import pytest

from tablewinnow.plans.rules import (
    DATASETS,
    EVENTS,
    TRACKERS,
    RuleError,
    load_rules,
    plan_removals,
    read_departments,
    read_rule,
    read_rules,
    route_rule,
)

DEPARTMENTS = {
    "Dep": {"dataSets": ["d1"], "eventPrograms": ["e1"], "trackerPrograms": ["t1"]},
    "Other": {"datasets": ["d2"]},
}


def routed(entry, department="Dep"):
    departments = {d.key: d for d in read_departments(DEPARTMENTS)}
    entry = {"selectDepartament": department, "action": "removeData", **entry}
    return route_rule(departments[department], read_rule(0, entry))


def families(entry, department="Dep"):
    return [removal.family for removal in routed(entry, department)]


def test_types_match_whatever_their_case():
    assert families({"selectMetadataType": ["DATASETS"]}) == [DATASETS]
    assert families({"selectMDType": ["eventprograms", "dataSets"]}) == [DATASETS, EVENTS]


def test_selection_implies_its_type():
    assert families({"selectDatasets": ["x"]}) == [DATASETS]
    assert families({"selectdataSets": ["x"]}) == [DATASETS]
    assert families({"selectMetadataType": ["dataSets"], "selectEventProgram": ["x"]}) == [
        DATASETS,
        EVENTS,
    ]
    assert families({"selectTrackerProgram": ["x"]}) == [TRACKERS]


def test_no_type_means_the_whole_department():
    removals = routed({})
    assert [r.family for r in removals] == [DATASETS, EVENTS, TRACKERS]
    assert all(r.full for r in removals)
    assert families({}, "Other") == [DATASETS]


def test_narrowing_without_a_type_is_refused():
    for key in ("selectOrgUnits", "selectOrgUnitAndDescendants", "selectDataElements"):
        with pytest.raises(RuleError):
            routed({key: ["x"]})


def test_a_type_the_department_lacks_has_an_empty_scope():
    (removal,) = routed({"selectMetadataType": ["trackerPrograms"]}, "Other")
    assert removal.scope == () and removal.full


@pytest.mark.parametrize(
    "entry",
    [
        {"selectMetadataType": ["events"]},
        {"selectUnknown": ["x"]},
        {"selectDatasets": []},
        {"selectMetadataType": []},
    ],
)
def test_doubtful_rules_are_refused(entry):
    with pytest.raises(RuleError):
        routed(entry)


def test_rule_needs_department_and_action():
    with pytest.raises(RuleError):
        read_rule(0, {"selectDepartament": "Dep"})
    with pytest.raises(RuleError):
        read_rule(0, {"action": "removeData"})
    with pytest.raises(RuleError):
        read_departments({"Dep": {"programs": ["x"]}})


def test_scope_and_selection():
    (values,) = routed({"selectDatasets": ["x", "y", "x"]})
    assert values.selected == ("x", "y") and not values.full
    (events,) = routed({"selectEventProgram": "x"})
    assert events.programs == ("x",)
    (trackers,) = routed({"selectTrackerProgram": ["x", "t1"]})
    assert trackers.programs == ("t1",)
    (stripped,) = routed({"selectTrackerProgram": ["x"], "selectDataElements": ["k"]})
    assert stripped.strips and stripped.programs == ("x",)
    (named,) = routed({"selectMetadataType": ["dataSets"], "selectDataElements": ["k"]})
    assert not named.strips


def test_binding_follows_departments_then_rules():
    entries = [
        {"selectDepartament": "OTHER", "action": "removeData"},
        {"selectDepartament": "dep", "selectMetadataType": ["dataSets"], "action": "removeData"},
        {"selectDepartament": "NOPE", "action": "removeData"},
        {"selectDepartament": "dep", "action": "somethingElse", "itsOwnKey": []},
        {"selectDepartament": "DEP", "selectDatasets": ["x"], "action": "removeData"},
    ]
    removals, unmatched = plan_removals(read_departments(DEPARTMENTS), read_rules(entries))
    assert [r.rule for r in removals] == [1, 4, 0]
    assert [rule.department for rule in unmatched] == ["NOPE"]


def test_load_rules(spark, tmp_path):
    path = tmp_path / "config.json"
    entry = {"selectDepartament": "dep", "action": "removeData"}
    path.write_text(json.dumps({"departments": DEPARTMENTS, "preprocess": [entry]}, indent=1))
    departments, rules = load_rules(spark, str(path))
    assert [d.key for d in departments] == ["Dep", "Other"]
    assert departments[1].scope(DATASETS) == ("d2",)
    assert [r.position for r in rules] == [0]


def test_a_list_given_as_text_is_one_uid():
    (department,) = read_departments({"D": {"dataSets": "abc"}})
    assert department.scope(DATASETS) == ("abc",)


def test_a_selection_does_not_widen_an_empty_scope():
    for types, key in (("eventPrograms", "selectEventProgram"),
                       ("trackerPrograms", "selectTrackerProgram")):
        (removal,) = routed({"selectMetadataType": [types], key: ["p"]}, "Other")
        assert removal.programs == ()
        entry = {"selectMetadataType": [types], key: ["p"], "selectDataElements": ["k"]}
        assert routed(entry, "Other")[0].programs == ()
