import random

import pytest
from conftest import rows
from model import Model, database, frames
from pyspark.sql import Observation

from tablewinnow.operators import prune
from tablewinnow.plans.prune_plan import PrunePlan, apply_rules
from tablewinnow.plans.rules import (
    DATASETS,
    EVENTS,
    TRACKERS,
    Department,
    Removal,
    RuleError,
    read_departments,
    read_rules,
)
from tablewinnow.profile import DEPENDENT_TABLES


def check(plan, model, *tables):
    for table in tables or model.tables:
        assert rows(plan.table(table)) == model.rows(table), table


@pytest.fixture(scope="module")
def small(spark):
    content = database(1)
    return content, frames(spark, content)


def test_datasets_full(join_path, small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, DATASETS, ("DS1", "DS3")))
    check(prune.prune_datasets_full(tables, ["DS1", "DS3"]), model, "datavalue", "datavalueaudit")


@pytest.mark.parametrize(
    "selection",
    [
        {"datasets": ["DS2"]},
        {"datasets": ["DS2", "DS4"], "units": ["A", "B"]},
        {"elements": ["DE2", "DE3", "DE7"]},
        {"elements": ["DE2"], "datasets": ["DS1"], "units_below": ["A", "AB"]},
        {"units": ["B", "D"], "units_below": ["A"]},
        {"units": ["E"]},
        {"units_below": ["E"]},
        {"units_below": ["no such unit"]},
    ],
)
def test_datasets_scoped(small, selection):
    content, tables = small
    scope = ["DS1", "DS2", "DS3"]
    model = Model(content)
    model.apply(
        Removal(
            0,
            DATASETS,
            tuple(scope),
            tuple(selection.get("datasets", ())),
            tuple(selection.get("elements", ())),
            tuple(selection.get("units", ())),
            tuple(selection.get("units_below", ())),
        )
    )
    plan = prune.prune_datasets_scoped(tables, scope, **selection)
    # A narrowed rule leaves the audit alone.
    check(plan, model, "datavalue", "datavalueaudit")


def test_events_full_with_dependents(join_path, small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, EVENTS, ("P1",)))
    check(
        prune.prune_events_full(tables, ["P1"]),
        model,
        "programstageinstance",
        "trackedentitydatavalueaudit",
        "programstageinstancecomments",
    )


def test_selected_event_programs_replace_the_scope(small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, EVENTS, ("P1",), ("P2",), (), (), ("A",)))
    plan = prune.prune_events_scoped(tables, ["P1"], programs=["P2"], units_below=["A"])
    check(plan, model, "programstageinstance", "programstageinstancecomments")


def test_selected_trackers_stay_within_the_scope(small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, TRACKERS, ("T1",), ("T1", "T2")))
    plan = prune.prune_trackers_scoped(tables, ["T1"], trackers=["T1", "T2"])
    check(plan, model)


def test_keys_are_stripped_and_no_event_is_removed(small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, EVENTS, ("P1", "P2"), (), ("x", "z"), (), ("A",)))
    plan = prune.strip_event_keys(tables, ["P1", "P2"], ["x", "z"], units_below=["A"])
    check(plan, model, "programstageinstance")
    model = Model(content)
    model.apply(Removal(0, TRACKERS, ("T1",), ("T2",), ("y",)))
    plan = prune.strip_tracker_keys(tables, ["T1"], ["y"], trackers=["T2"])
    check(plan, model, "programstageinstance")
    assert plan.table("programstageinstance").count() == len(content["programstageinstance"])


def test_trackers_full(join_path, small):
    content, tables = small
    model = Model(content)
    model.apply(Removal(0, TRACKERS, ("T1",)))
    plan = prune.prune_trackers_full(tables, ["T1"])
    check(plan, model)
    assert set(plan.tables()) == set(content)


def test_whole_department(small):
    content, tables = small
    model = Model(content)
    department = Department("D", {DATASETS: ("DS2",), EVENTS: ("P2",), TRACKERS: ("T2",)})
    for removal in (
        Removal(0, DATASETS, ("DS2",)),
        Removal(0, EVENTS, ("P2",)),
        Removal(0, TRACKERS, ("T2",)),
    ):
        model.apply(removal)
    check(prune.prune_department(tables, department), model)


def test_empty_scope_removes_nothing(small):
    content, tables = small
    untouched = Model(content)
    check(prune.prune_datasets_full(tables, []), untouched, "datavalue", "datavalueaudit")
    check(prune.prune_trackers_full(tables, []), untouched)
    plan = prune.prune_trackers_scoped(tables, ["T1"], trackers=["T2"])
    check(plan, untouched, "programstageinstance")


def test_a_scoped_form_needs_a_selection(small):
    with pytest.raises(RuleError):
        prune.prune_events_scoped(small[1], ["P1"])


def test_documents_that_are_not_json_pass_unchanged(spark, small):
    content, _ = small
    content = {**content, "programstageinstance": [
        {"programstageinstanceid": i, "programstageid": 10, "organisationunitid": 1,
         "eventdatavalues": document}
        for i, document in enumerate(['{"x":', "", '{ "a" : 1.50 }', '{"x":1,"a":1}', None])
    ]}
    plan = prune.strip_event_keys(frames(spark, content), ["P1"], ["x"])
    assert [r[3] for r in rows(plan.table("programstageinstance"))] == [
        '{"x":', "", '{ "a" : 1.50 }', '{"a":1}', None,
    ]


def random_removals(seed, count):
    rnd = random.Random(seed)

    def some(values, most):
        return tuple(rnd.sample(values, rnd.randint(1, most))) if rnd.random() < 0.5 else ()

    units = ["A", "B", "C", "AB", "D", "E", "F"]
    pools = {
        DATASETS: (["DS1", "DS2", "DS3", "DS4"], ["DE1", "DE2", "DE3", "DE5", "DE8"]),
        EVENTS: (["P1", "P2"], ["x", "y", "z"]),
        TRACKERS: (["T1", "T2", "T3"], ["x", "y", "z"]),
    }
    result = []
    for i in range(count):
        family = rnd.choice([DATASETS, EVENTS, TRACKERS])
        uids, elements = pools[family]
        scope = tuple(rnd.sample(uids, rnd.randint(1, 2)))
        result.append(
            Removal(
                i, family, scope, some(uids, 2), some(elements, 2), some(units, 3), some(units, 2)
            )
        )
    return result


@pytest.mark.parametrize("seed", range(6))
def test_fused_rules_equal_one_by_one_in_any_order(spark, seed):
    content = database(seed)
    removals = random_removals(seed, 5)
    plan = PrunePlan(frames(spark, content), removals)
    for order in range(3):
        model = Model(content)
        shuffled = removals[:]
        random.Random(order).shuffle(shuffled)
        for removal in shuffled:
            model.apply(removal)
        if order == 0:
            check(plan, model)
        else:
            first = Model(content)
            for removal in removals:
                first.apply(removal)
            assert all(model.rows(t) == first.rows(t) for t in content)


def test_fused_rules_without_broadcast(spark, join_path):
    content = database(11)
    removals = random_removals(11, 6)
    model = Model(content)
    for removal in removals:
        model.apply(removal)
    check(PrunePlan(frames(spark, content), removals), model, "datavalue", "programstageinstance")


def test_more_rules_than_bits_in_a_word(spark):
    content = database(3)
    removals = [
        r
        for r in random_removals(5, 240)
        if r.family == DATASETS and r.units and not r.units_below
    ]
    single = Removal(999, DATASETS, ("DS4",), (), (), ("C",), ())
    filler = [Removal(i, DATASETS, ("none",), (), (), ("A",), ()) for i in range(120)]
    for chosen in (filler + [single], [single] + filler, removals[:3] + filler + [single]):
        model = Model(content)
        for removal in chosen:
            model.apply(removal)
        check(PrunePlan(frames(spark, content), chosen), model, "datavalue")


def test_rows_are_conserved_and_counted(spark, small):
    content, tables = small
    removals = [
        Removal(0, DATASETS, ("DS1",)),
        Removal(1, DATASETS, ("DS2", "DS3"), (), (), ("A", "B", "C")),
        Removal(2, EVENTS, ("P1", "P2"), (), ("x",)),
        Removal(3, EVENTS, ("P2",), (), (), (), ("A",)),
    ]
    plan = PrunePlan(tables, removals)
    expected = {}
    for removal in removals:
        model = Model(content)
        model.apply(removal)
        fact = "datavalue" if removal.family == DATASETS else "programstageinstance"
        before = Model(content).rows(fact)
        after = model.rows(fact)
        if removal.strips:
            expected[removal.rule] = sum(a != b for a, b in zip(before, after))
        else:
            expected[removal.rule] = len(before) - len(after)
    totals = rows(plan.values.rule_counts()) + rows(plan.events.rule_counts())
    counted = {rule: matched for rule, _, matched in totals}
    assert counted == expected

    observation = Observation()
    retained = plan.table("datavalue", observation).collect()
    assert set(observation.get.values()) == {expected[0], expected[1]}
    assert set(map(tuple, retained)) <= set(Model(content).rows("datavalue"))


RULES = [
    {"selectDepartament": "dep1", "selectMDType": ["datasets"], "action": "removeData"},
    {"selectDepartament": "DEP2", "selectTrackerProgram": ["T1"],
     "selectOrgUnitAndDescendants": ["A"], "action": "removeData"},
    {"selectDepartament": "DEP2", "selectMetadataType": ["eventPrograms"], "action": "removeData"},
    {"selectDepartament": "DEP2", "selectMetadataType": ["dataSets"], "action": "keepData"},
    {"selectDepartament": "NOPE", "action": "removeData"},
]


def test_apply_rules(spark, small):
    content, tables = small
    departments = read_departments(
        {
            "DEP1": {"datasets": ["DS1"]},
            "DEP2": {"dataSets": ["DS2"], "eventPrograms": ["P1"], "trackerPrograms": ["T1"]},
            "DEP3": {"dataSets": ["DS3"]},
        }
    )
    plan, unmatched = apply_rules(tables, departments, read_rules(RULES))
    assert [rule.department for rule in unmatched] == ["NOPE"]
    model = Model(content)
    model.apply(Removal(0, DATASETS, ("DS1",)))
    model.apply(Removal(1, TRACKERS, ("T1",), ("T1",), (), (), ("A",)))
    model.apply(Removal(2, EVENTS, ("P1",)))
    for table in set(DEPENDENT_TABLES) & set(content):
        model.tables[table] = []
    check(plan, model)


def test_inputs_are_not_looked_up_before_they_are_needed(small):
    _, tables = small
    wanted = {k: v for k, v in tables.items() if k in ("dataset", "datasetelement", "datavalue")}
    plan = prune.prune_datasets_full(wanted, ["DS1"])
    assert plan.table("datavalue").columns == wanted["datavalue"].columns
    # A table set need not be complete.
    whole = PrunePlan(wanted, [Removal(0, DATASETS, ("DS1",)), Removal(1, TRACKERS, ("T1",))])
    assert set(whole.tables()) == set(wanted)


