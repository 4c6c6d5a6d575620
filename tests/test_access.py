import random

import pytest
from conftest import rows

from tablewinnow.operators import access
from tablewinnow.plans import access_plan
from tablewinnow.plans.access_plan import AccessState, apply_access_rules, load_entries

USERS = [
    ("u1", "ann", True),
    ("u2", "bob", True),
    ("u3", "cat", False),
    ("u4", "dan", True),
    ("u5", None, True),
    ("u6", "admin", False),
]
MEMBERS = [("g1", "u1"), ("g1", "u2"), ("g2", "u2"), ("g2", "u4"), ("g2", "gone"), (None, "u3")]
ROLES = [("r1", "Reader"), ("r2", "Writer"), ("r3", "Admin")]
LINKS = [("u1", "r1"), ("u2", "r2"), ("u2", "r2"), ("u3", "r3"), ("u3", "r1"), ("u3", "r1")]


@pytest.fixture(scope="module")
def state(spark):
    return AccessState(
        users=spark.createDataFrame(USERS, "id string, username string, disabled boolean"),
        members=spark.createDataFrame(MEMBERS, "group_name string, user_id string"),
        roles=spark.createDataFrame(ROLES, "id string, name string"),
        links=spark.createDataFrame(LINKS, "user_id string, role_id string"),
        metadata={},
    )


def select(state, names=(), groups=()):
    return access.selected_ids(state.users, state.members, names, groups)


def test_nothing_selected_by_empty_lists(state):
    assert rows(access.users_by_username(state.users, [])) == []
    assert rows(access.users_by_group(state.users, state.members, [])) == []
    assert rows(access.select_users(state.users, state.members)) == []
    assert select(state).empty


def test_select_by_name_and_group_is_unique(join_path, state):
    chosen = access.select_users(state.users, state.members, ["cat", "bob"], ["g1", "g2"])
    assert rows(chosen, "id") == [("u1",), ("u2",), ("u3",), ("u4",)]
    assert chosen.columns == state.users.columns
    assert rows(access.users_by_group(state.users, state.members, ["g2"]), "id") == [
        ("u2",),
        ("u4",),
    ]
    assert rows(select(state, ["cat", "bob"], ["g1", "g2"]).frame) == [
        ("u1",), ("u2",), ("u3",), ("u4",),
    ]


def test_rows_found_by_name_come_first(spark, state):
    repeated = state.users.union(
        spark.createDataFrame([("u4", "aaa", False)], state.users.schema)
    )
    chosen = access.select_users(repeated, state.members, ["dan"], ["g2"])
    assert ("u4", "dan", True) in rows(chosen) and chosen.count() == 2


def test_activate(join_path, state):
    enabled = access.activate(state.users, select(state, ["ann"], ["g2"]))
    expected = [(i, n, d and i not in ("u1", "u2", "u4")) for i, n, d in USERS]
    assert rows(enabled) == sorted(expected, key=repr)


def test_keep_only(join_path, state):
    selected = select(state, ["ann"])
    kept = access.keep_only(state.users, selected, "admin")
    # A user without a username is never removed.
    assert rows(kept, "id") == [("u1",), ("u5",), ("u6",)]
    removed = access.removed_by_keep_only(state.users, selected, "admin")
    assert rows(removed, "id") == [("u2",), ("u3",), ("u4",)]


def test_keep_only_of_nobody_is_a_no_op(state):
    nobody = select(state, ["zoe"])
    assert rows(access.keep_only(state.users, nobody, "admin")) == rows(state.users)
    assert rows(access.removed_by_keep_only(state.users, nobody, "admin")) == []


def test_add_roles(join_path, state):
    roles = access.roles_named(state.roles, ["Reader", "Admin", "no such role"])
    links = access.add_roles(state.links, select(state, ["ann", "bob"]), roles)
    assert rows(links) == [
        ("u1", "r1"), ("u1", "r3"), ("u2", "r1"), ("u2", "r2"), ("u2", "r3"),
        ("u3", "r1"), ("u3", "r1"), ("u3", "r3"),
    ]


def test_a_plain_dataframe_is_a_selection_too(spark, state):
    chosen = spark.createDataFrame([("u1",), ("u1",), (None,)], "user_id string")
    roles = access.roles_named(state.roles, ["Writer"])
    links = access.add_roles(state.links, chosen, roles)
    assert rows(links.filter("user_id = 'u1'")) == [("u1", "r1"), ("u1", "r2")]


def test_add_roles_from_template(join_path, state):
    links = access.add_roles_from_template(
        state.links, state.users, select(state, ["ann", "dan"]), "cat"
    )
    assert rows(links.filter("user_id != 'u3'").distinct()) == [
        ("u1", "r1"), ("u1", "r3"), ("u2", "r2"), ("u4", "r1"), ("u4", "r3"),
    ]


def test_missing_template_is_an_error(state):
    with pytest.raises(ValueError, match="template"):
        access.add_roles_from_template(state.links, state.users, select(state, ["ann"]), "zoe")


def test_granting_makes_no_cross_join(state):
    roles = access.roles_named(state.roles, ["Reader", "Admin"])
    links = access.add_roles(state.links, select(state, ["ann", "bob"]), roles)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_chain_of_grants_reads_the_links_once(spark, state, tmp_path):
    state.links.write.parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    for name in ("Reader", "Writer", "Admin"):
        links = access.add_roles(
            links, select(state, ["ann"]), access.roles_named(state.roles, [name])
        )
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows(links.filter("user_id = 'u1'")) == [("u1", "r1"), ("u1", "r2"), ("u1", "r3")]


def test_remove_from_groups(join_path, state):
    selected = select(state, ["cat"], ["g1"])
    members = access.remove_from_groups(state.members, selected, ["g2", "g3"])
    assert rows(members) == sorted(
        [m for m in MEMBERS if m != ("g2", "u2")], key=repr
    )
    assert rows(access.remove_from_groups(state.members, selected, [])) == rows(state.members)


def test_entries_see_what_earlier_ones_left(state, monkeypatch):
    monkeypatch.setattr(access_plan, "ENTRIES_PER_CHECKPOINT", 2)
    entries = [
        {"selectUsernames": ["bob"], "action": "removeFromGroups", "removeFromGroups": ["g2"]},
        {"selectFromGroups": ["g2"], "action": "activate"},
        {"selectUsernames": ["ann"], "action": "addRolesFromTemplate",
         "addRolesFromTemplate": "cat"},
        {"selectUsernames": ["dan"], "action": "addRolesFromTemplate",
         "addRolesFromTemplate": "ann"},
        {"selectUsernames": ["dan", "ann"], "action": "deleteOthers"},
        {"selectUsernames": ["dan"], "action": "addRoles", "addRoles": ["Writer"]},
        {"selectUsernames": ["bob"], "action": "activate"},
        {"action": "activate"},
        {},
        "https://example.org/more-entries.json",
    ]
    after = apply_access_rules(state, entries, "admin")
    assert rows(after.users) == [
        ("u1", "ann", True), ("u4", "dan", False), ("u5", None, True), ("u6", "admin", False),
    ]
    assert rows(after.members.filter("user_id != 'gone'")) == [("g1", "u1"), ("g2", "u4")]
    assert rows(after.links) == [
        ("u1", "r1"), ("u1", "r3"), ("u4", "r1"), ("u4", "r2"), ("u4", "r3"),
    ]


def test_every_entry_is_counted(join_path, state):
    entries = [
        {"selectFromGroups": ["g1"], "action": "activate"},
        {"selectUsernames": ["zoe"], "action": "activate"},
        {"selectUsernames": ["ann", "dan"], "action": "addRoles", "addRoles": ["Reader", "Admin", "x"]},
        {"selectUsernames": ["bob"], "action": "addRolesFromTemplate", "addRolesFromTemplate": "cat"},
        {"selectFromGroups": ["g2"], "action": "removeFromGroups", "removeFromGroups": ["g1", "g2"]},
        {"action": "activate"},
        {"selectUsernames": ["ann", "bob"], "action": "deleteOthers"},
        {"selectUsernames": ["dan"], "action": "activate"},
    ]
    assert apply_access_rules(state, entries, "admin").counts == (
        (0, "activate", {"selected": 2}),
        (1, "activate", {"selected": 0}),
        (2, "addRoles", {"selected": 2, "roles": 2}),
        (3, "addRolesFromTemplate", {"selected": 1, "roles": 2}),
        (4, "removeFromGroups", {"selected": 2, "groups": 2}),
        (6, "deleteOthers", {"selected": 2, "deleted": 2}),
        (7, "activate", {"selected": 0}),
    )


def random_entries(seed, n):
    draw = random.Random(seed)
    result = []
    for _ in range(n):
        entry = {}
        if draw.random() < 0.7:
            entry["selectUsernames"] = draw.sample(["ann", "bob", "cat", "dan", "admin", "zoe"], draw.randrange(3))
        if draw.random() < 0.6:
            entry["selectFromGroups"] = draw.sample(["g1", "g2", "g3"], draw.randrange(3))
        action = draw.choices(
            ["activate", "addRoles", "addRolesFromTemplate", "removeFromGroups", "deleteOthers"], [4, 4, 2, 4, 0.3]
        )[0]
        entry["action"] = action
        if action == "addRoles":
            entry[action] = draw.sample(["Reader", "Writer", "Admin", "none"], draw.randrange(4))
        if action == "addRolesFromTemplate":
            entry[action] = draw.choice(["admin", "admin", "cat"] if seed % 2 else ["admin"])
        if action == "removeFromGroups":
            entry[action] = draw.sample(["g1", "g2", "g3"], draw.randrange(3))
        result.append(entry)
    return result


def outcome(state, entries):
    try:
        after = apply_access_rules(state, entries, "admin")
    except ValueError as error:
        return str(error)
    return rows(after.users), rows(after.members), rows(after.links), after.counts


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_entries_equal_one_by_one(state, monkeypatch, seed):
    entries = random_entries(seed, 14)
    if seed == 2:
        monkeypatch.setattr(access_plan.marks, "LITERAL_UIDS", 0)
    if seed == 3:
        monkeypatch.setattr(access_plan.marks, "WORD_BITS", 3)
    runs = access_plan.runs_of(entries)
    assert [p for run in runs for p in run] == list(enumerate(entries)) and len(runs) < len(entries)
    together = outcome(state, entries)
    monkeypatch.setattr(access_plan, "runs_of", lambda e: [[p] for p in enumerate(e)])
    assert together == outcome(state, entries)


def test_what_ends_a_run():
    activate = {"selectFromGroups": ["g1"], "action": "activate"}
    leave = {"selectUsernames": ["ann"], "action": "removeFromGroups", "removeFromGroups": ["g1"]}
    grant = {"selectUsernames": ["ann"], "action": "addRoles", "addRoles": ["Reader"]}
    copy = {"selectUsernames": ["ann"], "action": "addRolesFromTemplate", "addRolesFromTemplate": "bob"}
    delete = {"selectUsernames": ["ann"], "action": "deleteOthers"}

    def sizes(*entries):
        return [len(run) for run in access_plan.runs_of(entries)]

    assert sizes(activate, grant, copy) == [2, 1]  # the template's roles may be new
    assert sizes(copy, grant, grant, activate, leave, grant) == [6]
    assert sizes(leave, activate) == [1, 1]  # the group has fewer members
    assert sizes(leave, leave, grant) == [3]
    assert sizes(grant, delete, grant) == [1, 1, 1]
    assert sizes(grant, {}, "https://example.org", grant) == [1, 1, 1, 1]


def test_forty_entries_read_each_table_a_few_times(spark, state):
    reads = {}

    def counted(df, name):
        reads[name] = spark.sparkContext.accumulator(0)
        counter = reads[name]

        def pass_on(batches):
            counter.add(1)
            yield from batches

        return df.coalesce(1).mapInArrow(pass_on, df.schema)

    watched = AccessState(
        counted(state.users, "users"), counted(state.members, "members"),
        counted(state.roles, "roles"), counted(state.links, "links"), {},
    )
    entries = [
        {"selectFromGroups": [f"g{i % 3}"], "selectUsernames": ["ann", "bob"][: i % 3], "action": action,
         **({action: ["Reader", "Writer"][: 1 + i % 2]} if action == "addRoles" else {})}
        for i, action in enumerate(["activate", "addRoles"] * 20)
    ]
    after = apply_access_rules(watched, entries, "admin")
    for df in (after.users, after.members, after.links):
        df.write.format("noop").mode("overwrite").save()
    # To select, and to change; of the links those of selected users and of others.
    assert {name: n.value for name, n in reads.items()} == {"users": 2, "members": 2, "roles": 1, "links": 2}
    assert len(after.counts) == 40


def test_unknown_action_is_an_error(state):
    for entry in (
        {"selectUsernames": ["ann"], "action": "promote"},
        {"selectUsernames": ["ann"], "action": "import"},
        {"selectFiles": ["x"], "action": "activate"},
    ):
        with pytest.raises(ValueError, match="unknown action"):
            apply_access_rules(state, [entry], "admin")
    # With nobody selected the action is not looked at.
    unknown = {"selectUsernames": ["zoe"], "action": "promote"}
    after = apply_access_rules(state, [unknown], "admin")
    assert after.users is state.users and after.counts == ((0, "promote", {"selected": 0}),)


def test_import_entry(spark, state):
    target = spark.createDataFrame([(1, "old"), (2, "two")], "id long, name string")
    source = spark.createDataFrame([(1, "new"), (3, "three")], "id long, name string")
    entry = {"selectFiles": ["a.json"], "action": "import"}
    start = AccessState(state.users, state.members, state.roles, state.links, {"things": target})
    sources = {"a.json": {"things": source, "others": source.union(source)}}
    after = apply_access_rules(start, [entry], "admin", sources)
    assert rows(after.metadata["things"]) == [(1, "new"), (2, "two"), (3, "three")]
    assert rows(after.metadata["others"]) == [(1, "new"), (3, "three")]


def test_import_of_one_table_under_two_keys(spark, state):
    """Lists that name a table directly match by id, others by uid; order is kept."""
    target = spark.createDataFrame([(1, "x", "old")], "id long, uid string, name string")
    start = AccessState(state.users, state.members, state.roles, state.links, {"dataelement": target})
    by_uid = spark.createDataFrame([("x", "by uid"), ("y", "new")], "uid string, name string")
    by_id = spark.createDataFrame([(1, "by id")], "id long, name string")
    files = {"a": {"dataElements": by_uid}, "b": {"dataelement": by_id}, "c": {"dataElements": by_uid}}
    after = apply_access_rules(start, [{"selectFiles": ["a", "b", "c"], "action": "import"}], "admin", files)
    assert rows(after.metadata["dataelement"]) == [(1, "x", "by uid"), (None, "y", "new")]
    assert [(f, c["created"], c["updated"]) for f, _, c in after.imports] == [
        ("a", 1, 1), ("b", 0, 1), ("c", 0, 2),
    ]


def test_load_entries(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"postprocess": [{"selectUsernames": ["a"], "action": "activate"}]}')
    assert load_entries(spark, str(path)) == [{"selectUsernames": ["a"], "action": "activate"}]
