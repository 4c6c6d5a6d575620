"""Selecting users and changing what they may do.

Users, groups and roles are flat tables:

* ``users``: id, username, disabled
* ``usergroupmembers``: group_name, user_id
* ``userroles``: id, name
* ``userrolemembers``: user_id, role_id

A selection is a ``KeySet`` of ``user_id``, or a DataFrame with that column.
Names come from the rule file and are written into the plan; everything else is
matched by measured joins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewinnow.operators.matching import (
    KeySet,
    drop_matching,
    flag_matching,
    keep_matching,
    key_set,
)
from tablewinnow.settings import broadcast_limit, materialise

_SELECTED = "_tw_selected"
_SHARD = "_tw_shard"
_SALT = "_tw_salt"
# Shards of roles that are broadcast, and the least bytes of a shard of others.
_FEW = 4
_LEAST_SHARD = 1 << 20

Selection = KeySet | DataFrame


def users_by_username(users: DataFrame, names: Iterable[str]) -> DataFrame:
    """Users with one of the names; nobody for an empty list."""
    return users.filter(F.col("username").isin(list(names)))


def users_by_group(users: DataFrame, members: DataFrame, groups: Iterable[str]) -> DataFrame:
    """Members of any of the groups, each once; nobody for an empty list."""
    return keep_matching(users, _members_of(members, groups), "id")


def _members_of(members: DataFrame, groups: Iterable[str]) -> KeySet:
    chosen = members.filter(F.col("group_name").isin(list(groups)))
    return key_set(chosen.select(F.col("user_id").alias("id")), "id")


def _found(
    users: DataFrame, members: DataFrame, names: Iterable[str], groups: Iterable[str]
) -> DataFrame:
    """Users selected by name or by group, and whether it was by name. One pass
    over ``users`` answers both, so nobody is found twice."""
    groups = list(groups)
    by_name = F.coalesce(F.col("username").isin(list(names)), F.lit(False))
    if not groups:
        return users.filter(by_name).withColumn(_SELECTED, by_name)
    marked = flag_matching(users, _members_of(members, groups), "id", _SELECTED)
    return marked.filter(by_name | F.col(_SELECTED)).withColumn(_SELECTED, by_name)


def select_users(
    users: DataFrame,
    members: DataFrame,
    names: Iterable[str] = (),
    groups: Iterable[str] = (),
) -> DataFrame:
    """Users selected by name or by group, unique by id. Should ids repeat in
    ``users``, rows found by name come first."""
    row = F.struct(*users.columns)
    found = _found(users, members, names, groups).groupBy("id")
    first = found.agg(F.min_by(row, F.struct(~F.col(_SELECTED), row)).alias("user"))
    return first.select("user.*")


def selected_ids(
    users: DataFrame,
    members: DataFrame,
    names: Iterable[str] = (),
    groups: Iterable[str] = (),
) -> KeySet:
    """Ids of the selected users, computed once for all that is done to them."""
    found = _found(users, members, names, groups)
    return key_set(found.select(F.col("id").alias("user_id")), "user_id")


def _ids(selected: Selection) -> KeySet:
    return selected if isinstance(selected, KeySet) else key_set(selected, "user_id")


def activate(users: DataFrame, selected: Selection) -> DataFrame:
    """All users, the selected ones not disabled."""
    marked = flag_matching(users, _ids(selected).renamed("user_id", "id"), "id", _SELECTED)
    enabled = F.when(F.col(_SELECTED), F.lit(False)).otherwise(F.col("disabled"))
    return marked.withColumn("disabled", enabled).drop(_SELECTED)


def _split_by_kept(users: DataFrame, selected: KeySet, operator_user: str) -> DataFrame:
    """Users flagged by whether their username is selected or the operator's."""
    chosen = keep_matching(users, selected.renamed("user_id", "id"), "id")
    marked = flag_matching(users, key_set(chosen, "username"), "username", _SELECTED)
    name = F.col("username")
    kept = F.col(_SELECTED) | name.isNull() | (name == operator_user)
    return marked.withColumn(_SELECTED, kept)


def keep_only(users: DataFrame, selected: Selection, operator_user: str) -> DataFrame:
    """Only the selected users and the operator's own account. Nobody is removed
    when the selection is empty; a user without a username is never removed."""
    selected = _ids(selected)
    if selected.empty:
        return users
    return _split_by_kept(users, selected, operator_user).filter(_SELECTED).drop(_SELECTED)


def removed_by_keep_only(
    users: DataFrame, selected: Selection, operator_user: str
) -> DataFrame:
    """The users ``keep_only`` removes."""
    selected = _ids(selected)
    if selected.empty:
        return users.filter(F.lit(False))
    marked = _split_by_kept(users, selected, operator_user)
    return marked.filter(~F.col(_SELECTED)).drop(_SELECTED)


def roles_named(roles: DataFrame, names: Iterable[str]) -> DataFrame:
    return roles.filter(F.col("name").isin(list(names)))


def _every_pair(selected: KeySet, roles: KeySet, *by: str) -> DataFrame:
    """(user_id, role_id) for every selected user and every role, as an equi-join; with ``by``,
    of those that agree in these columns.

    The pairs are the result itself. Roles that were measured to be few are broadcast.
    Otherwise users and roles are dealt over a grid, so that no task holds all of
    either; it has as many shards of roles as their size calls for, and each user is
    repeated once per shard.
    """
    spark = roles.frame.sparkSession
    if roles.small:
        shards, salts = _FEW, 1
    else:
        most = max(broadcast_limit(spark), _LEAST_SHARD)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = -(-roles.size // most)
        salts = max(-(-selected.size // most), -(-tasks // shards))

    def dealt(key: str, count: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(count)).cast("int")

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    granted = roles.frame.withColumn(_SHARD, dealt("role_id", shards))
    granted = granted.withColumn(_SALT, each(salts))
    users = selected.frame.withColumn(_SALT, dealt("user_id", salts))
    users = users.withColumn(_SHARD, each(shards))
    pairs = users.join(F.broadcast(granted) if roles.small else granted, [*by, _SHARD, _SALT])
    return pairs.select("user_id", "role_id")


def grant_by(links: DataFrame, selected: KeySet, roles: KeySet, by: str) -> DataFrame:
    """Role links after giving users (user_id, ``by``) the roles (role_id, ``by``) that agree in
    ``by``; a user or role may be in several rows."""
    return _grant(links, key_set(selected.frame, "user_id"), _every_pair(selected, roles, by))


def _grant(links: DataFrame, selected: KeySet, roles: KeySet | DataFrame) -> DataFrame:
    marked = flag_matching(links, selected, "user_id", _SELECTED)
    others = marked.filter(~F.col(_SELECTED)).select("user_id", "role_id")
    own = marked.filter(F.col(_SELECTED)).select("user_id", "role_id")
    # The selected users' links are kept apart, so that the result refers to
    # ``links`` once: a chain of grants grows by one step each, not twofold.
    pairs = roles if isinstance(roles, DataFrame) else _every_pair(selected, roles)
    granted = materialise(own.unionByName(pairs).distinct())
    return others.unionByName(granted)


def role_ids(roles: DataFrame) -> KeySet:
    """The ids of ``roles`` (a DataFrame with ``id``), to be granted."""
    return key_set(roles.select(F.col("id").alias("role_id")), "role_id")


def add_roles(links: DataFrame, selected: Selection, roles: KeySet | DataFrame) -> DataFrame:
    """Role links after giving ``roles`` (a DataFrame with ``id``, or a ``KeySet`` of ``role_id``)
    to the selected users. Each of their roles is held once; links of other users are untouched
    and are not shuffled."""
    granted = roles if isinstance(roles, KeySet) else role_ids(roles)
    return _grant(links, _ids(selected), granted)


def roles_of_user(links: DataFrame, users: DataFrame, template: str) -> KeySet:
    """The ids of the roles that the user ``template`` has."""
    source = key_set(
        users_by_username(users, [template]).select(F.col("id").alias("user_id")), "user_id"
    )
    if source.empty:
        raise ValueError(f"template user not found: {template}")
    return key_set(keep_matching(links, source, "user_id"), "role_id")


def add_roles_from_template(
    links: DataFrame, users: DataFrame, selected: Selection, template: str
) -> DataFrame:
    """Give the roles of the user ``template`` to the selected users."""
    return _grant(links, _ids(selected), roles_of_user(links, users, template))


def remove_from_groups(
    members: DataFrame, selected: Selection, groups: Iterable[str]
) -> DataFrame:
    """Group members without the selected users in the named groups."""
    # A null key matches nothing: members of other groups pass by the join.
    key = F.when(F.col("group_name").isin(list(groups)), F.col("user_id"))
    keyed = members.withColumn(_SELECTED, key)
    kept = drop_matching(keyed, _ids(selected).renamed("user_id", _SELECTED), _SELECTED)
    return kept.select(*members.columns)
