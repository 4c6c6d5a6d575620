import json

import pytest
from conftest import rows
from model import Model, database, frames

from tablewinnow.plans.refresh import refresh
from tablewinnow.plans.rules import DATASETS, TRACKERS, Removal
from tablewinnow.profile import DEPENDENT_TABLES
from tablewinnow.sources.tableset import Folder, Frames, write_tables

CONFIG = {
    "departments": {"D": {"dataSets": ["DS1"], "trackerPrograms": ["T1"]}},
    "preprocess": [
        {"selectDepartament": "d", "selectMetadataType": ["dataSets"],
         "selectOrgUnitAndDescendants": ["A"], "action": "removeData"},
        {"selectDepartament": "D", "selectMetadataType": ["trackerPrograms"],
         "action": "removeData"},
        {"selectDepartament": "NOPE", "action": "removeData"},
    ],
    "postprocess": [
        {"selectUsernames": ["ann"], "action": "activate"},
        {"selectFiles": ["import.json"], "action": "import"},
    ],
}


def test_refresh(spark, tmp_path):
    content = database(7)
    tables = frames(spark, content)
    tables |= {
        "analytics_2024": spark.range(3),
        "things": spark.createDataFrame([(1, "old")], "id long, name string"),
        "users": spark.createDataFrame(
            [("u1", "ann", True)], "id string, username string, disabled boolean"
        ),
        "usergroupmembers": spark.createDataFrame([], "group_name string, user_id string"),
        "userroles": spark.createDataFrame([], "id string, name string"),
        "userrolemembers": spark.createDataFrame([], "user_id string, role_id string"),
    }
    document = {"things": [{"id": 1, "name": "new"}, {"id": 2, "name": "two"}], "date": "2024"}
    (tmp_path / "import.json").write_text(json.dumps(document))
    config = tmp_path / "config.json"
    config.write_text(json.dumps(CONFIG))
    source = Folder(spark, write_tables(tables, str(tmp_path / "source")))

    outcome = refresh(
        spark,
        str(config),
        source,
        str(tmp_path / "clone"),
        operator_user="admin",
        import_folder=str(tmp_path),
    )

    model = Model(content)
    model.apply(Removal(0, DATASETS, ("DS1",), (), (), (), ("A",)))
    matched = len(content["datavalue"]) - len(model.tables["datavalue"])
    model.apply(Removal(1, TRACKERS, ("T1",)))
    removed = len(content["programstageinstance"]) - len(model.tables["programstageinstance"])
    for table in set(DEPENDENT_TABLES) & set(content):
        model.tables[table] = []

    clone = Folder(spark, outcome.folder)
    assert set(clone.names()) == set(tables) - {"analytics_2024"}
    for table in content:
        assert rows(clone.read(table)) == model.rows(table), table
    assert rows(clone.read("users")) == [("u1", "ann", False)]
    assert rows(clone.read("things")) == [(1, "new"), (2, "two")]
    assert [rule.department for rule in outcome.unmatched] == ["NOPE"]
    assert outcome.matched_rows == {"rule_0_datasets_0": matched, "rule_1_trackers_0": removed}


def test_refresh_without_rules_or_entries_is_a_clone(spark, tmp_path):
    config = tmp_path / "config.json"
    config.write_text("{}")
    source = Frames({"datavalue": spark.range(2), "programinstance": spark.range(3)})
    outcome = refresh(spark, str(config), source, str(tmp_path / "clone"), "admin")
    clone = Folder(spark, outcome.folder)
    assert {n: clone.read(n).count() for n in clone.names()} == {
        "datavalue": 2, "programinstance": 3,
    }


ACCESS = {
    "users": ([("u1", "ann", True)], "id string, username string, disabled boolean"),
    "usergroupmembers": ([("g", "u1")], "group_name string, user_id string"),
    "userroles": ([("r1", "Reader")], "id string, name string"),
    "userrolemembers": ([("u1", "r1")], "user_id string, role_id string"),
}


def run(spark, tmp_path, settings, without=(), documents=None, **more):
    tmp_path.mkdir(exist_ok=True)
    config = tmp_path / "config.json"
    config.write_text(json.dumps(settings))
    for name, document in (documents or {}).items():
        (tmp_path / name).write_text(json.dumps(document))
    tables = {n: spark.createDataFrame(*t) for n, t in ACCESS.items() if n not in without}
    tables["messageconversation"] = spark.range(2)
    tables["dataelement"] = spark.createDataFrame(
        [(1, "e1", "one"), (2, "e2", "two")], "dataelementid long, uid string, name string"
    )
    folder = str(tmp_path / "clone")
    outcome = refresh(spark, str(config), Frames(tables), folder, "admin", **more)
    return outcome, Folder(spark, folder)


def test_nothing_is_emptied_without_rules(spark, tmp_path):
    entry = {"selectUsernames": ["ann"], "action": "activate"}
    _, clone = run(spark, tmp_path, {"postprocess": [entry]})
    assert clone.read("messageconversation").count() == 2
    assert rows(clone.read("users")) == [("u1", "ann", False)]


def test_dependents_are_emptied_with_rules(spark, tmp_path):
    _, clone = run(spark, tmp_path, {"departments": {}, "preprocess": []})
    assert clone.read("messageconversation").count() == 0


def test_imports_reach_the_tables_they_describe(spark, tmp_path):
    document = {
        "users": [
            {"id": "u1", "userCredentials": {"username": "anna"}},
            {"id": "u2", "userCredentials": {"username": "bob"}},
        ],
        "userRoles": [{"id": "r2", "name": "Writer"}],
        "dataElements": [{"id": "e2", "name": "second"}, {"id": "e3", "name": "three"}],
    }
    entries = [
        {"selectFiles": "a.json", "action": "import"},
        {"selectUsernames": ["bob"], "action": "addRoles", "addRoles": ["Writer"]},
    ]
    outcome, clone = run(
        spark, tmp_path, {"postprocess": entries}, documents={"a.json": document},
        import_folder=str(tmp_path),
    )
    assert rows(clone.read("users")) == [("u1", "anna", True), ("u2", "bob", None)]
    assert rows(clone.read("userrolemembers")) == [("u1", "r1"), ("u2", "r2")]
    assert rows(clone.read("dataelement")) == [
        (1, "e1", "one"), (2, "e2", "second"), (None, "e3", "three"),
    ]
    assert "dataElements" not in clone.names()
    counts = {table: (c["created"], c["updated"]) for _, table, c in outcome.imports}
    assert counts == {"users": (1, 1), "userroles": (1, 0), "dataelement": (1, 1)}


def test_missing_tables_are_refused_where_they_are_needed(spark, tmp_path):
    entries = [{"selectUsernames": ["ann"], "action": "activate"}]
    _, clone = run(spark, tmp_path, {"postprocess": entries}, without=("userroles",))
    assert "userroles" not in clone.names()
    entries = [{"selectUsernames": ["ann"], "action": "deleteOthers"}]
    with pytest.raises(ValueError, match="userrolemembers"):
        run(spark, tmp_path / "x", {"postprocess": entries}, without=("userrolemembers",))


@pytest.mark.parametrize(
    "entry", [{"selectUsername": ["ann"], "action": "activate"},
              {"selectFiles": ["a.json"], "action": "import"}]
)
def test_entries_that_cannot_be_applied_are_refused(spark, tmp_path, entry):
    with pytest.raises(ValueError):
        run(spark, tmp_path, {"postprocess": [entry]})


def test_skipped_entries_are_reported(spark, tmp_path):
    entries = ["https://example.org/more", {"action": "activate"}]
    outcome, _ = run(spark, tmp_path, {"postprocess": entries})
    assert list(outcome.skipped) == entries
