"""How often a plan reads its large table when no key set is small."""

import pytest
from conftest import rows
from model import Model, database, frames

from tablewinnow.operators import prune
from tablewinnow.operators.merge import merge_metadata
from tablewinnow.plans.access_plan import AccessState, apply_access_rules
from tablewinnow.plans.prune_plan import apply_rules
from tablewinnow.plans.rules import TRACKERS, Removal, read_departments, read_rules
from tablewinnow.settings import broadcast_up_to
from tablewinnow.sources.tableset import Folder, write_tables

CONTENT = database(11)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("scans") / "tables")
    source = Folder(spark, write_tables(frames(spark, CONTENT), folder))
    return {name: source.read(name) for name in source.names()}


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and f"/{table}]" in line for line in plan.splitlines())


def plans(tables):
    departments = read_departments({"D": {"dataSets": ["DS1", "DS2"], "trackerPrograms": ["T1"]}})
    rules = read_rules(
        [
            {"selectDepartament": "D", "selectMetadataType": ["dataSets"],
             "selectOrgUnitAndDescendants": ["A"], "action": "removeData"},
            {"selectDepartament": "D", "selectMetadataType": ["trackerPrograms"],
             "action": "removeData"},
        ]
    )
    return {
        "datavalue": (
            apply_rules(tables, departments, rules)[0],
            prune.prune_datasets_scoped(tables, ["DS1"], datasets=["DS1"], units_below=["A"]),
        ),
        "programstageinstance": (apply_rules(tables, departments, rules)[0],),
        "programinstance": (prune.prune_trackers_full(tables, ["T1"]),),
    }


@pytest.mark.parametrize("table", ["datavalue", "programstageinstance", "programinstance"])
def test_one_scan_however_large_the_key_sets(stored, table):
    with broadcast_up_to(0):
        for plan in plans(stored)[table]:
            df = plan.table(table)
            assert scans(df, table) == 1
            assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_the_limit_holds_only_inside_and_changes_no_rows(stored):
    removal = Model(CONTENT)
    removal.apply(Removal(0, TRACKERS, ("T1",)))
    with broadcast_up_to(0):
        shuffled = prune.prune_trackers_full(stored, ["T1"]).table("programinstance")
    broadcast = prune.prune_trackers_full(stored, ["T1"]).table("programinstance")
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert rows(shuffled) == rows(broadcast) == removal.rows("programinstance")


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_imports_in_a_row_read_the_target_once(spark, tmp_path, limit):
    folder = write_tables({"things": spark.range(50).selectExpr("id", "'old' AS name")}, str(tmp_path / "t"))
    target = Folder(spark, folder).read("things")
    files = {
        f"{n}.json": {"things": spark.createDataFrame([(n, f"v{n}"), (100 + n, "new")], target.schema)}
        for n in range(3)
    }
    empty = spark.range(0)
    state = AccessState(empty, empty, empty, empty, {"things": target})
    with broadcast_up_to(limit):
        entry = {"selectFiles": list(files), "action": "import"}
        after = apply_access_rules(state, [entry], "admin", files)
    merged = after.metadata["things"]
    # Nothing but the target comes from files.
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    expected = target
    for tables in files.values():
        expected = merge_metadata(expected, tables["things"])
    assert rows(merged) == rows(expected) and merged.count() == 53
    assert [counts["created"] for _, _, counts in after.imports] == [1, 1, 1]
