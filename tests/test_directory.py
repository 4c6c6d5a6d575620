import json

from conftest import rows

from tablewinnow.sources.directory import (
    flat_users,
    group_members,
    read_metadata,
    role_links,
    username_of,
)

USERS = [
    {"id": "u1", "username": "flat1", "userCredentials": {"username": "ann", "disabled": True,
     "userRoles": [{"id": "r1", "name": "R1"}, {"id": "r2", "name": "R2"}]}},
    {"id": "u2", "username": "bob", "userCredentials": None},
]
SCHEMA = (
    "id string, username string, userCredentials struct<username: string, disabled: boolean, "
    "userRoles: array<struct<id: string, name: string>>>"
)


def test_users(spark):
    users = spark.createDataFrame(USERS, SCHEMA)
    assert rows(flat_users(users)) == [("u1", "ann", True), ("u2", "bob", None)]
    assert rows(role_links(users)) == [("u1", "r1"), ("u1", "r2")]
    flat = spark.createDataFrame([("u3", "cat")], "id string, username string")
    assert rows(flat.select(username_of(flat))) == [("cat",)]


def test_groups(spark):
    groups = spark.createDataFrame(
        [("g1", "one", [{"id": "u1"}, {"id": "u2"}]), ("g2", "two", [])],
        "id string, name string, users array<struct<id: string>>",
    )
    assert rows(group_members(groups)) == [("one", "u1"), ("one", "u2")]


def test_metadata_documents(spark, tmp_path):
    document = {
        "system": {"version": "2"},
        "dataElements": [{"id": "a", "name": "A"}, {"id": "b", "name": None}],
        "dataSets": [{"id": "c", "name": "C"}],
        "date": "2024",
    }
    (tmp_path / "users.json").write_text(json.dumps(document, indent=2))
    tables = read_metadata(spark, str(tmp_path / "users.json"))
    assert set(tables) == {"dataElements", "dataSets"}
    assert rows(tables["dataElements"], "id", "name") == [("a", "A"), ("b", None)]
