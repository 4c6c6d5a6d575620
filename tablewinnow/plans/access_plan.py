"""Access entries: a list of selections and actions, applied in order.

Entries that follow each other share their passes over the tables as far as none of them reads what
an earlier one of them writes: activations, grants and removals from groups are given a bit
each, users are marked with the bits of the entries that select them, and each table is then
changed once for all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tablewinnow.operators import access, marks
from tablewinnow.operators.matching import KeySet, attach, drop_matching, key_set
from tablewinnow.operators.merge import merge_all
from tablewinnow.plans.rules import load_config
from tablewinnow.profile import ACCESS_TABLES, IMPORT_TABLES
from tablewinnow.settings import materialise
from tablewinnow.sources.directory import CREDENTIALS, flat_users, read_metadata

# Spellings used in access entries.
USERNAMES_KEY = "selectUsernames"
GROUPS_KEY = "selectFromGroups"
FILES_KEY = "selectFiles"
ACTIVATE = "activate"
DELETE_OTHERS = "deleteOthers"
ADD_ROLES = "addRoles"
ADD_ROLES_FROM_TEMPLATE = "addRolesFromTemplate"
REMOVE_FROM_GROUPS = "removeFromGroups"
IMPORT = "import"
ENTRY_KEYS = {
    "action",
    USERNAMES_KEY,
    GROUPS_KEY,
    FILES_KEY,
    ADD_ROLES,
    ADD_ROLES_FROM_TEMPLATE,
    REMOVE_FROM_GROUPS,
    IMPORT,
}

# Each entry reads what earlier ones left, so lineage grows with the list. It is
# cut after this many entries that changed something.
ENTRIES_PER_CHECKPOINT = 8


@dataclass(frozen=True)
class AccessState:
    """Users, groups and roles, and the metadata tables imports go to."""

    users: DataFrame
    members: DataFrame
    roles: DataFrame
    links: DataFrame
    metadata: Mapping[str, DataFrame]
    pending: int = 0
    # What each import did: (file, table, counts).
    imports: tuple[tuple[str, str, Mapping[str, int]], ...] = ()
    # What each other entry did: (its place in the list, action, counts).
    counts: tuple[tuple[int, str, Mapping[str, int]], ...] = ()

    def changed(self, **tables: DataFrame) -> AccessState:
        return replace(self, pending=self.pending + 1, **tables)

    def materialised(self, since: AccessState) -> AccessState:
        """The same state, with what changed since ``since`` kept as it is now."""

        def keep(df: DataFrame, before: DataFrame | None) -> DataFrame:
            return df if df is before else materialise(df)

        return replace(
            self,
            users=keep(self.users, since.users),
            members=keep(self.members, since.members),
            links=keep(self.links, since.links),
            metadata={n: keep(df, since.metadata.get(n)) for n, df in self.metadata.items()},
            pending=0,
        )


def load_entries(spark: SparkSession, path: str) -> list[Mapping | str]:
    return load_config(spark, path).get("postprocess", [])


def read_imports(
    spark: SparkSession, entries: Iterable[Mapping | str], folder: str
) -> dict[str, dict[str, DataFrame]]:
    """The tables of every metadata document the entries import from ``folder``."""
    files = []
    for entry in entries:
        named = entry.get(FILES_KEY, ()) if isinstance(entry, Mapping) else ()
        files += [named] if isinstance(named, str) else named
    return {file: read_metadata(spark, f"{folder}/{file}") for file in dict.fromkeys(files)}


def apply_entry(
    state: AccessState,
    entry: Mapping | str,
    operator_user: str,
    sources: Mapping[str, Mapping[str, DataFrame]],
    place: int = 0,
) -> AccessState:
    """The state after one entry. Without a selector, or with one that finds
    nobody, nothing changes; an unknown action is an error. Addresses of further
    entries are not followed. Users selected and deleted, roles granted and groups left are
    counted under ``place``; an entry that finds nobody counts none selected."""
    if not isinstance(entry, Mapping):
        return state
    unknown = sorted(set(entry) - ENTRY_KEYS)
    if unknown:
        raise ValueError(f"access entry with unknown keys {unknown}")
    action = entry.get("action")
    if USERNAMES_KEY in entry or GROUPS_KEY in entry:
        selected = access.selected_ids(
            state.users, state.members, entry.get(USERNAMES_KEY, ()), entry.get(GROUPS_KEY, ())
        )
        counts = {"selected": selected.rows}
        after = None
        if selected.empty:
            after = state
        elif action == ACTIVATE:
            after = state.changed(users=access.activate(state.users, selected))
        elif action == DELETE_OTHERS:
            after, counts["deleted"] = _delete_others(state, selected, operator_user)
        elif action in (ADD_ROLES, ADD_ROLES_FROM_TEMPLATE):
            if action == ADD_ROLES:
                roles = access.role_ids(access.roles_named(state.roles, entry.get(ADD_ROLES, ())))
            else:
                template = entry[ADD_ROLES_FROM_TEMPLATE]
                roles = access.roles_of_user(state.links, state.users, template)
            counts["roles"] = roles.rows
            after = state.changed(links=access.add_roles(state.links, selected, roles))
        elif action == REMOVE_FROM_GROUPS:
            groups = entry.get(REMOVE_FROM_GROUPS, ())
            counts["groups"] = len(set(groups))
            members = access.remove_from_groups(state.members, selected, groups)
            after = state.changed(members=members)
        if after is not None:
            return replace(after, counts=(*after.counts, (place, str(action), counts)))
    elif FILES_KEY in entry:
        if action == IMPORT:
            return import_metadata(state, entry[FILES_KEY], sources)
    else:
        return state
    raise ValueError(f"unknown action: {action}")


def _delete_others(
    state: AccessState, selected: KeySet, operator_user: str
) -> tuple[AccessState, int]:
    """A deleted user leaves their groups and gives up their roles. Also tells how many go."""
    removed = access.removed_by_keep_only(state.users, selected, operator_user)
    ids = key_set(removed, "id")
    gone = ids.renamed("id", "user_id")
    after = state.changed(
        users=drop_matching(state.users, ids, "id"),
        members=drop_matching(state.members, gone, "user_id"),
        links=drop_matching(state.links, gone, "user_id"),
    )
    return after, ids.rows


def import_metadata(
    state: AccessState,
    files: Iterable[str],
    sources: Mapping[str, Mapping[str, DataFrame]],
) -> AccessState:
    """Merge each list of objects of the files, in order, into the table it describes, all
    lists of a table in one upsert: the one ``IMPORT_TABLES`` names, else the one of the list's name, which is made if
    there is none. Imported users and roles are those later entries see."""
    # Lists of a table that follow each other make one upsert, in as far as they share a key.
    described: list[tuple[str, str]] = []
    upserts: list[tuple[str, str, list[tuple[str, str, DataFrame]]]] = []
    for file in [files] if isinstance(files, str) else files:
        if file not in sources:
            raise ValueError(f"import document {file} was not read: name the folder it is in")
        for name, source in sources[file].items():
            table, key = IMPORT_TABLES.get(name, (name, "id"))
            described.append((file, table))
            last = next((u for u in reversed(upserts) if u[0] == table), None)
            if last is None or last[1] != key:
                last = (table, key, [])
                upserts.append(last)
            last[2].append((file, name, source))
    found: dict[tuple[str, str], list[Mapping[str, int]]] = {}
    for table, key, given in upserts:
        state, counts = _imported(state, table, key, given)
        for (file, _, _), count in zip(given, counts, strict=True):
            found.setdefault((file, table), []).append(count)
    # In the order of the files, whatever the order the tables were merged in.
    told = [(file, table, found[file, table].pop(0)) for file, table in described]
    return replace(state, imports=(*state.imports, *told), pending=state.pending + 1)


def _imported(
    state: AccessState, table: str, key: str, given: Sequence[tuple[str, str, DataFrame]]
) -> tuple[AccessState, list[dict[str, int]]]:
    """One table after the lists of objects that describe it, from several files in turn."""
    sources = [_shaped(table, key, source) for _, _, source in given]
    part = next((p for p, t in ACCESS_TABLES.items() if t == table), None)
    target = getattr(state, part) if part else state.metadata.get(table, sources[0].limit(0))
    for (file, name, _), source in zip(given, sources, strict=True):
        if key not in source.columns or key not in target.columns:
            raise ValueError(f"{file}: {name} and {table} have no key {key} in common")
    merged, counts = merge_all(target, sources, key)
    if part:
        return replace(state, **{part: merged}), counts
    return replace(state, metadata={**state.metadata, table: merged}), counts


def _shaped(table: str, key: str, source: DataFrame) -> DataFrame:
    if table == ACCESS_TABLES["users"] and CREDENTIALS in source.columns:
        source = flat_users(source)
    if key not in source.columns and "id" in source.columns:
        source = source.withColumnRenamed("id", key)
    return source


def skipped_entries(entries: Iterable[Mapping | str]) -> list[Mapping | str]:
    """Entries that do nothing: addresses of further entries, which are not followed, and
    entries without a selector."""
    selectors = {USERNAMES_KEY, GROUPS_KEY, FILES_KEY}
    return [e for e in entries if not isinstance(e, Mapping) or not selectors & set(e)]


def needed_tables(entries: Iterable[Mapping | str]) -> set[str]:
    """The flat tables that the entries read or change."""
    needed: set[str] = set()
    for entry in entries:
        if isinstance(entry, Mapping) and {USERNAMES_KEY, GROUPS_KEY} & set(entry):
            parts = {"users", "members"}
            if entry.get("action") == ADD_ROLES:
                parts |= {"roles", "links"}
            if entry.get("action") in (ADD_ROLES_FROM_TEMPLATE, DELETE_OTHERS):
                parts |= {"links"}
            needed |= {ACCESS_TABLES[part] for part in parts}
    return needed


# What the entries that can share a pass read beside users and, by groups, members; and what they
# write. That a user is not disabled is read by none of them.
_READS = {ACTIVATE: set(), REMOVE_FROM_GROUPS: set(), ADD_ROLES: set(), ADD_ROLES_FROM_TEMPLATE: {"links"}}
_WRITES = {
    ACTIVATE: set(),
    REMOVE_FROM_GROUPS: {"members"},
    ADD_ROLES: {"links"},
    ADD_ROLES_FROM_TEMPLATE: {"links"},
}
_ENTRY = "_tw_entry"

Placed = tuple[int, Mapping]


def _listed(entry: Mapping, key: str) -> list[str]:
    return list(entry.get(key, ()))


def runs_of(entries: Iterable[Mapping | str]) -> list[list[Placed]]:
    """The entries with their places, those that can share their passes together. Entries that
    do nothing, or that are to be refused, are by themselves, as are imports and deletions."""
    runs: list[list[Placed]] = []
    written: set[str] | None = None
    for place, entry in enumerate(entries):
        action = entry.get("action") if isinstance(entry, Mapping) else None
        selects = isinstance(entry, Mapping) and {USERNAMES_KEY, GROUPS_KEY} & set(entry)
        if not selects or action not in _WRITES or set(entry) - ENTRY_KEYS:
            runs.append([(place, entry)])
            written = None
            continue
        reads = _READS[action] | ({"members"} if GROUPS_KEY in entry else set())
        if written is None or reads & written:
            runs.append([])
            written = set()
        runs[-1].append((place, entry))
        written |= _WRITES[action]
    return runs


def _by_text(run: Sequence[Placed], key: str) -> dict[str, set[int]]:
    bits: dict[str, set[int]] = {}
    for index, (_, entry) in enumerate(run):
        for text in _listed(entry, key):
            bits.setdefault(text, set()).add(index)
    return bits


def _selected_by(state: AccessState, run: Sequence[Placed]) -> KeySet:
    """user_id and the bits of the entries that select the user, one row per user."""
    n = len(run)
    users = marks.looked_up(
        state.users.select("id", "username"), "username", _by_text(run, USERNAMES_KEY), "named", n
    )
    groups = _by_text(run, GROUPS_KEY)
    if groups:
        grouped = marks.looked_up(state.members, "group_name", groups, "grouped", n)
        grouped = grouped.filter(marks.any_among("grouped", range(n), n)).groupBy("user_id")
        bits = [F.bit_or(c).alias(c) for c in marks.names("grouped", n)]
        users = attach(users, KeySet(grouped.agg(*bits).withColumnRenamed("user_id", "id")), "id")
    else:
        users = users.select("*", *[F.lit(0).cast("long").alias(c) for c in marks.names("grouped", n)])
    sides = zip(marks.names("named", n), marks.names("grouped", n), marks.names("chosen", n))
    both = [
        F.col(a).bitwiseOR(F.coalesce(F.col(b), F.lit(0).cast("long"))).alias(c) for a, b, c in sides
    ]
    found = users.select(F.col("id").alias("user_id"), *both).dropna(subset=["user_id"])
    found = found.filter(marks.any_among("chosen", range(n), n))
    return KeySet(found.groupBy("user_id").agg(*[F.bit_or(c).alias(c) for c in marks.names("chosen", n)]))


def _counted(marked: KeySet, prefix: str, n: int) -> list[int]:
    """How many rows have each bit."""
    columns = marks.names(prefix, n)
    sums = [
        F.count_if(marks.bit(F.col(columns[i // marks.WORD_BITS]), i)).alias(f"n{i}") for i in range(n)
    ]
    return list(marked.frame.agg(*sums).first())


def _roles_granted(state: AccessState, run: Sequence[Placed], selected: Sequence[int]) -> KeySet | None:
    """role_id and the bits of the entries that grant the role; None if no entry grants any."""
    n = len(run)
    named: dict[str, set[int]] = {}
    templates: dict[str, set[int]] = {}
    for index, (_, entry) in enumerate(run):
        if selected[index] and entry["action"] == ADD_ROLES:
            for name in _listed(entry, ADD_ROLES):
                named.setdefault(name, set()).add(index)
        if selected[index] and entry["action"] == ADD_ROLES_FROM_TEMPLATE:
            templates.setdefault(entry[ADD_ROLES_FROM_TEMPLATE], set()).add(index)
    columns, found = marks.names("granted", n), []
    if named:
        roles = marks.looked_up(state.roles, "name", named, "granted", n)
        found.append(roles.select(F.col("id").alias("role_id"), *columns))
    if templates:
        users = marks.looked_up(state.users, "username", templates, "granted", n)
        users = users.filter(marks.any_among("granted", range(n), n))
        known = KeySet(users.select("username", F.col("id").alias("user_id"), *columns))
        present = {r[0] for r in known.frame.select("username").distinct().collect()}
        for missing in sorted(set(templates) - present):
            raise ValueError(f"template user not found: {missing}")
        bits = [F.bit_or(c).alias(c) for c in columns]
        held = attach(state.links, KeySet(known.frame.groupBy("user_id").agg(*bits)), "user_id")
        found.append(held.select("role_id", *columns))
    if not found:
        return None
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    every = every.dropna(subset=["role_id"]).filter(marks.any_among("granted", range(n), n))
    return KeySet(every.groupBy("role_id").agg(*[F.bit_or(c).alias(c) for c in columns]))


def _by_entry(marked: KeySet, key: str, prefix: str, indexes: Sequence[int], n: int) -> KeySet:
    """A row for each key and each of the bits it has."""
    columns = marks.names(prefix, n)
    had = [F.when(marks.bit(F.col(columns[i // marks.WORD_BITS]), i), F.lit(i)) for i in indexes]
    each = marked.frame.select(key, F.explode(F.array(*had)).alias(_ENTRY))
    return KeySet(each.filter(F.col(_ENTRY).isNotNull()))


def _apply_run(state: AccessState, run: Sequence[Placed]) -> AccessState:
    """The state after entries of which none reads what an earlier one writes."""
    n = len(run)
    chosen = _selected_by(state, run)
    selected = _counted(chosen, "chosen", n)
    counts = [{"selected": s} for s in selected]
    acting = {
        action: [i for i, (_, e) in enumerate(run) if e["action"] == action and selected[i]]
        for action in _WRITES
    }
    changed: dict[str, DataFrame] = {}
    if acting[ACTIVATE]:
        users = attach(state.users, chosen.renamed("user_id", "id"), "id")
        enabled = F.when(marks.any_among("chosen", acting[ACTIVATE], n), F.lit(False))
        changed["users"] = users.withColumn("disabled", enabled.otherwise(F.col("disabled"))).select(
            *state.users.columns
        )
    if acting[REMOVE_FROM_GROUPS]:
        left: dict[str, set[int]] = {}
        for i in acting[REMOVE_FROM_GROUPS]:
            groups = set(_listed(run[i][1], REMOVE_FROM_GROUPS))
            counts[i]["groups"] = len(groups)
            for group in groups:
                left.setdefault(group, set()).add(i)
        members = marks.looked_up(state.members, "group_name", left, "left", n)
        members = attach(members, chosen, "user_id")
        changed["members"] = members.filter(~marks.any_of_both("chosen", "left", n)).select(
            *state.members.columns
        )
    granting = sorted(acting[ADD_ROLES] + acting[ADD_ROLES_FROM_TEMPLATE])
    if granting:
        roles = _roles_granted(state, run, selected)
        granted = _counted(roles, "granted", n) if roles else [0] * n
        for i in granting:
            counts[i]["roles"] = granted[i]
        users = _by_entry(chosen, "user_id", "chosen", granting, n)
        # Users are granted nothing if there is no such role; what they hold is held once all the same.
        given = roles or KeySet(state.links.limit(0).select("role_id"))
        each = _by_entry(given, "role_id", "granted", granting, n) if roles else KeySet(
            given.frame.withColumn(_ENTRY, F.lit(0))
        )
        changed["links"] = access.grant_by(state.links, users, each, _ENTRY)
    told = [(place, e["action"], c) for (place, e), c in zip(run, counts, strict=True)]
    after = state.changed(**changed) if changed else state
    return replace(after, counts=(*after.counts, *told))


def apply_access_rules(
    state: AccessState,
    entries: Iterable[Mapping | str],
    operator_user: str,
    sources: Mapping[str, Mapping[str, DataFrame]] | None = None,
) -> AccessState:
    """Fold the entries over the state. ``sources`` maps the file names that import
    entries mention to the tables read from them, see ``read_imports``."""
    kept = state
    for run in runs_of(entries):
        if len(run) > 1:
            state = _apply_run(state, run)
        else:
            ((place, entry),) = run
            state = apply_entry(state, entry, operator_user, sources or {}, place)
        if state.pending >= ENTRIES_PER_CHECKPOINT:
            state = kept = state.materialised(kept)
    return state
