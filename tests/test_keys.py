import time

import pytest
from conftest import rows
from model import database, frames

from tablewinnow.operators import keys, marks


@pytest.fixture(scope="module")
def tables(spark):
    return frames(spark, database(0))


def test_stages_of_programs(tables):
    found = keys.stages_of_programs(tables, ["P1", "T2", "no"])
    assert rows(found) == [(10,), (11,), (120,)]


def test_elements_shared_by_datasets_are_found_once(tables):
    found = keys.elements_of_datasets(tables, ["DS1", "DS2"])
    assert rows(found.dropna()) == [(1,), (2,), (3,)]


def test_elements_must_belong_to_the_datasets(tables):
    found = keys.elements_by_uid(
        tables,
        ["DE2", "DE4", "DE8"],
        ["DS1", "DS2"],
    )
    assert rows(found) == [(2,)]


def test_empty_lists_select_nothing(tables):
    assert rows(keys.stages_of_programs(tables, [])) == []
    assert rows(keys.elements_of_datasets(tables, [])) == []
    assert rows(keys.elements_by_uid(tables, [], ["DS1"])) == []
    assert rows(keys.org_units(tables, [])) == []
    assert rows(keys.org_unit_descendants(tables, [])) == []


def test_org_units_are_exact(tables):
    assert rows(keys.org_units(tables, ["A", "E", "no"])) == [(1,), (6,)]


def test_descendants(join_path, tables):
    assert rows(keys.org_unit_descendants(tables, ["A"])) == [(2,), (3,), (7,)]
    assert rows(keys.org_unit_descendants(tables, ["A", "B", "AB"])) == [(2,), (3,), (5,), (7,)]
    assert rows(keys.org_unit_descendants(tables, ["B"], include_self=True)) == [(2,), (3,)]
    # A unit without a path has nothing below it.
    assert rows(keys.org_unit_descendants(tables, ["E"])) == []


def test_wildcards_in_paths_are_literal(spark):
    units = spark.createDataFrame(
        [(1, "a", "/x_"), (2, "b", "/xy/z"), (3, "c", "/x_/z"), (4, "d", "rel"), (5, "e", "rel/q")],
        "organisationunitid long, uid string, path string",
    )
    assert rows(keys.org_unit_descendants({"organisationunit": units}, ["a"])) == [(3,)]
    assert rows(keys.org_unit_descendants({"organisationunit": units}, ["d"])) == [(5,)]


def test_pick(tables):
    assert keys.pick(tables["dataset"], ["uid"]).columns == ["uid"]


def test_long_lists_of_uids_are_joined(join_path, tables, monkeypatch):
    """The same rows as with uids written into the plan."""
    found = {}
    for limit in (1000, 0):
        monkeypatch.setattr(marks, "LITERAL_UIDS", limit)
        found[limit] = [
            rows(keys.stages_of_programs(tables, ["P1", "T2", "no"])),
            rows(keys.elements_by_uid(tables, ["DE2", "DE4", "DE8"], ["DS1", "DS2"])),
            rows(keys.org_units(tables, ["A", "E", "no"])),
            rows(keys.org_unit_descendants(tables, ["A", "B"], include_self=True)),
        ]
    assert found[0] == found[1000]


def test_a_hundred_thousand_uids(tables):
    start = time.monotonic()
    found = keys.org_units(tables, ["A", "E", *(f"no{i}" for i in range(100_000))])
    assert rows(found) == [(1,), (6,)]
    assert time.monotonic() - start < 30
