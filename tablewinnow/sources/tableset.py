"""Table sets: listing, copying, replacing and writing whole databases.

A table set is a mapping from table names to DataFrames. Copies are one
distributed job per table; the driver only handles names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from fnmatch import fnmatchcase
from functools import partial
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.functions.text import view_name
from tablewinnow.operators.digest import Digest, Observed, digest
from tablewinnow.profile import PROTECTED_TABLES
from tablewinnow.settings import concurrently

# Derived tables and the schema a clone leaves out.
DERIVED_TABLES = ("aggregated*", "analytics*", "completeness*")
SYSTEM_SCHEMAS = ("sys",)
# Fixed value: the schema that names without one, and patterns, stand for.
DEFAULT_SCHEMA = "public"

# Fixed value: minute-grained stamp in the name of a snapshot.
STAMP = "%Y-%m-%d_%H%M"

# Begins the names of copies that are not in their place yet.
STAGED = "_tw_staged_"

# Begins the name of the table that tells what a replacement has still to do.
JOURNAL = "_tw_journal_"

# Lists the tables of a folder and is written last, so a folder without it is
# incomplete. The dot keeps it apart from table names.
MANIFEST = "table.manifest"


def selected_names(
    names: Iterable[str],
    exclude: Iterable[str] = DERIVED_TABLES,
    exclude_schemas: Iterable[str] = SYSTEM_SCHEMAS,
) -> list[str]:
    """Names, optionally qualified by a schema, that no pattern leaves out.

    Case matters: a table whose name needs quotes is not the derived one. Patterns are
    about the default schema; tables of other schemas stay unless their schema goes.
    """
    patterns, schemas = list(exclude), set(exclude_schemas)
    kept = []
    for name in names:
        schema, _, table = name.rpartition(".")
        derived = schema in ("", DEFAULT_SCHEMA) and any(fnmatchcase(table, p) for p in patterns)
        if schema not in schemas and not derived:
            kept.append(name)
    return kept


def select_tables(
    tables: Mapping[str, DataFrame],
    exclude: Iterable[str] = DERIVED_TABLES,
    exclude_schemas: Iterable[str] = SYSTEM_SCHEMAS,
) -> dict[str, DataFrame]:
    return {name: tables[name] for name in selected_names(tables, exclude, exclude_schemas)}


class TableSource(Protocol):
    def names(self) -> list[str]: ...

    def read(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class Frames:
    """A table set already at hand, as a source."""

    tables: Mapping[str, DataFrame]

    def names(self) -> list[str]:
        return list(self.tables)

    def read(self, name: str) -> DataFrame:
        return self.tables[name]


@dataclass(frozen=True)
class Folder:
    """Tables written by ``write_tables``."""

    spark: SparkSession
    path: str
    format: str = "parquet"

    def names(self) -> list[str]:
        manifest = self.spark.read.json(f"{self.path}/{MANIFEST}", schema="name string")
        return sorted(row["name"] for row in manifest.collect())

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.format).load(f"{self.path}/{name}")


@dataclass(frozen=True)
class Database:
    """A database of the session catalog, as a source or a target.

    ``buckets`` maps table names to (column, number of buckets). A fact table that
    is bucketed by the key its dependents share is not shuffled when it is matched
    against a key set too large to broadcast.
    """

    spark: SparkSession
    name: str
    buckets: Mapping[str, tuple[str, int]] = field(default_factory=dict)

    def _list(self, views: bool) -> list[str]:
        return [
            table.name
            for table in self.spark.catalog.listTables(self.name)
            if not table.isTemporary and (table.tableType == "VIEW") == views
        ]

    def names(self) -> list[str]:
        return [name for name in self._list(views=False) if not name.startswith(JOURNAL)]

    def views(self) -> list[str]:
        return self._list(views=True)

    def _quoted(self, table: str) -> str:
        return ".".join("`" + part.replace("`", "``") + "`" for part in (self.name, table))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._quoted(name))

    def write(self, name: str, df: DataFrame, staged: bool = False) -> None:
        """A new table; ``staged`` gives it a name of its own until ``publish``."""
        writer = df.write.mode("errorifexists")
        if name in self.buckets:
            column, count = self.buckets[name]
            # A task writes whole buckets, so that there are few files. Adaptive
            # execution splits a bucket that a hot key makes too large for one task.
            gathered = df.hint("rebalance", count, F.col(column))
            writer = gathered.write.mode("errorifexists").bucketBy(count, column).sortBy(column)
        writer.saveAsTable(self._quoted(STAGED + name if staged else name))

    def publish(self, names: Iterable[str]) -> None:
        """Give staged tables their names, which must be free."""
        for name in names:
            old, new = self._quoted(STAGED + name), self._quoted(name)
            self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def replace_by_staged(self, names: Iterable[str], protected: Iterable[str]) -> None:
        """Drop what is not protected and publish the staged tables, by a journal: from the
        moment it is written, the replacement will be completed, by ``recover`` if not now."""
        names = list(names)
        staged = {(STAGED + name).lower() for name in names}
        kept = {name.lower() for name in protected} | staged
        steps = [("view", name) for name in self.views() if name.lower() not in kept]
        steps += [("table", name) for name in self.names() if name.lower() not in kept]
        steps += [("publish", name) for name in names]
        if steps:
            rows = [(place, *step) for place, step in enumerate(steps)]
            journal = self.spark.createDataFrame(rows, "place int, action string, name string")
            # A table is in the catalog only when all of it is written.
            own = self._quoted(JOURNAL + uuid.uuid4().hex)
            journal.coalesce(1).write.mode("errorifexists").saveAsTable(own)
        self.recover()

    def recover(self) -> bool:
        """Complete a replacement that was interrupted; whether there was one. Every step can be
        taken again, so it does not matter where it stopped."""
        journals = [name for name in self._list(views=False) if name.startswith(JOURNAL)]
        for journal in journals:
            steps = self.read(journal).orderBy("place").collect()
            for step in steps:
                self._take(step["action"], step["name"])
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(journal)}")
        return bool(journals)

    def _take(self, action: str, name: str) -> None:
        """One step of a journal. A staged table that is gone has its name already, and the
        table of that name is then the new one."""
        present = {n.lower() for n in self._list(views=False)}
        if action == "view":
            self.drop_view(name)
        elif action == "publish":
            if (STAGED + name).lower() in present:
                self.publish([name])
        elif (STAGED + name).lower() in present or not self._published(name):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(name)}")

    def _published(self, name: str) -> bool:
        """Whether a journal that is not done yet publishes this name."""
        return any(
            self.read(journal).filter((F.col("action") == "publish") & (F.lower("name") == name.lower())).count()
            for journal in self._list(views=False)
            if journal.startswith(JOURNAL)
        )

    def drop_staged(self, names: Iterable[str]) -> None:
        """Drop what an interrupted copy of these tables left."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(STAGED + name)}")

    def drop_view(self, name: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self._quoted(name)}")

    def clear(self, protected: Iterable[str] = PROTECTED_TABLES) -> list[str]:
        """Drop every view, then every table, that is not protected."""
        kept = {name.lower() for name in protected}
        views = [name for name in self.views() if name.lower() not in kept]
        tables = [name for name in self.names() if name.lower() not in kept]
        for name in views:
            self.drop_view(name)
        for name in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._quoted(name)}")
        return views + tables


@dataclass(frozen=True)
class Jdbc:
    """A live database behind a JDBC driver on the classpath.

    Tables need ``partitioning``: table name -> (numeric column, number of
    partitions). Its bounds are asked from the database, and each partition is
    read by its own task. A table read by a single task must be named in ``small``;
    others are refused, as one task could not read a large one.
    """

    spark: SparkSession
    url: str
    schema: str = "public"
    properties: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    small: Iterable[str] = ()

    def _query(self, text: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, f"({text}) q", properties=dict(self.properties))

    def names(self) -> list[str]:
        listing = self._query("SELECT table_schema, table_name FROM information_schema.tables")
        rows = listing.filter(F.col("table_schema") == self.schema).select("table_name")
        return sorted(row[0] for row in rows.collect())

    def read(self, name: str) -> DataFrame:
        table, properties = f"{self.schema}.{name}", dict(self.properties)
        if name not in self.partitioning:
            if name not in self.small:
                raise ValueError(f"{name}: give its partitioning, or name it as small")
            return self.spark.read.jdbc(self.url, table, properties=properties)
        column, partitions = self.partitioning[name]
        low, high = self._query(f"SELECT min({column}), max({column}) FROM {table}").first()
        return self.spark.read.jdbc(
            self.url,
            table,
            column=column,
            lowerBound=low or 0,
            upperBound=high or 0,
            numPartitions=partitions,
            properties=properties,
        )


class IncompleteCopy(RuntimeError):
    """A copy that does not have the rows of its source."""


def check_copy(name: str, source: DataFrame, copy: DataFrame, written: Digest | None = None) -> None:
    """Refuse a copy whose digest is not the source's, which may have been taken while writing.
    A task that ran twice may have counted its rows twice; then the source is read again."""
    found = digest(copy)
    if found != written and found != digest(source):
        raise IncompleteCopy(f"the copy of {name} differs from its source")


def _copy(source: TableSource, target: Database, staged: bool, verify: bool, name: str) -> None:
    df = source.read(name)
    if not verify:
        target.write(name, df, staged)
        return
    observed = Observed(df)
    target.write(name, observed.frame, staged)
    copy = target.read(STAGED + name if staged else name)
    check_copy(name, df, copy, observed.digest)


def clone_tables(
    source: TableSource,
    target: Database,
    exclude: Iterable[str] = DERIVED_TABLES,
    exclude_schemas: Iterable[str] = SYSTEM_SCHEMAS,
    replace: bool = False,
    protected: Iterable[str] = PROTECTED_TABLES,
    snapshot: str | None = None,
    verify: bool = False,
) -> list[str]:
    """Copy the selected tables.

    With ``replace`` the target's other tables and views go, but for protected ones,
    which are then not copied either. They go only when all copies are complete, so a
    source that cannot be read, or that reads from the target, costs nothing. A folder
    named by ``snapshot`` receives a stamped copy of the target's tables before. With
    ``verify`` every copy is read again, and nothing is replaced by one that differs from its
    source (see ``digest``). A replacement that died between clearing and publishing is
    completed first.
    """
    names = selected_names(source.names(), exclude, exclude_schemas)
    if isinstance(source, Database) and source.name.lower() == target.name.lower():
        raise ValueError(f"source and target are the same database: {target.name}")
    target.recover()
    if replace:
        kept = {name.lower() for name in protected} & {name.lower() for name in target.names()}
        names = [name for name in names if name.lower() not in kept]
        target.drop_staged(names)
    if snapshot is not None:
        present = {name: target.read(name) for name in target.names()}
        snapshot_tables(present, snapshot, target.name, verify=verify)
    concurrently(*[partial(_copy, source, target, replace, verify, name) for name in names])
    if replace:
        target.replace_by_staged(names, protected)
    return names


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, format: str = "parquet", verify: bool = False
) -> str:
    """Write each table below a new folder, and the manifest when all are there, and, with
    ``verify``, when all were read again and found to be what was written.

    Nothing is overwritten: the folder must be new, so that a table can be
    written from a plan that still reads the old one.
    """

    def write(name: str) -> None:
        df, place = tables[name], f"{folder}/{name}"
        observed = Observed(df) if verify else None
        rows = observed.frame if observed else df
        rows.write.format(format).mode("errorifexists").save(place)
        if observed:
            copy = df.sparkSession.read.format(format).schema(df.schema).load(place)
            check_copy(name, df, copy, observed.digest)

    concurrently(*[partial(write, name) for name in tables])
    if tables:
        spark = next(iter(tables.values())).sparkSession
        manifest = spark.createDataFrame([(name,) for name in tables], "name string")
        manifest.coalesce(1).write.mode("errorifexists").json(f"{folder}/{MANIFEST}")
    return folder


def snapshot_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    name: str,
    stamp: str | None = None,
    exclude_schemas: Iterable[str] = SYSTEM_SCHEMAS,
    verify: bool = False,
) -> str:
    """A full, time-stamped copy: system schemas are left out, derived tables not."""
    stamp = stamp or datetime.now().strftime(STAMP)
    chosen = select_tables(tables, exclude=(), exclude_schemas=exclude_schemas)
    return write_tables(chosen, f"{folder}/{name}_{stamp}", verify=verify)


def derived_view_names(sqlview: DataFrame) -> DataFrame:
    """Names of the views generated for stored queries of type VIEW."""
    return sqlview.filter(F.col("type") == "VIEW").select(view_name(F.col("name")).alias("name"))


def drop_derived_views(target: Database, sqlview: DataFrame) -> list[str]:
    """Drop the generated views that exist; at most as many names as the catalog
    has views reach the driver."""
    existing = target.views()
    named = derived_view_names(sqlview).filter(F.col("name").isin(existing)).distinct()
    dropped = sorted(row["name"] for row in named.collect())
    for name in dropped:
        target.drop_view(name)
    return dropped
