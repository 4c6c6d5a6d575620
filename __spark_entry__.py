"""Registered queries and, for each, the SQL that must give the same rows.

The SQL is written in the nested ``IN (SELECT ...)`` form of the task, one
condition per rule; the queries use marks and joins, so that the two sides have
nothing in common but the views over the generated tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow import fixtures
from tablewinnow.functions import (
    array_minus,
    last_segment,
    redact_credentials,
    stamp,
    unique_by_field,
    without_keys,
)
from tablewinnow.operators import access, keys, prune
from tablewinnow.operators.digest import digest
from tablewinnow.operators.empty import clear_dependents, empty_tables
from tablewinnow.operators.merge import merge_all, merge_metadata, merge_summary
from tablewinnow.plans.access_plan import AccessState, apply_access_rules
from tablewinnow.plans.prune_plan import PrunePlan, apply_rules
from tablewinnow.plans.refresh import Outcome, refresh
from tablewinnow.plans.rules import read_departments, read_rules
from tablewinnow.profile import DATA_TABLES, DEPENDENT_TABLES
from tablewinnow.settings import broadcast_up_to, ensure_checkpoint_dir
from tablewinnow.sources.directory import flat_users, group_members, read_metadata, role_links
from tablewinnow.sources.dumps import Dump, write_dump
from tablewinnow.sources.tableset import (
    Database,
    Folder,
    Frames,
    clone_tables,
    derived_view_names,
    select_tables,
    snapshot_tables,
)

try:
    from tablewinnow.llm import registry as llm
except ModuleNotFoundError as missing:
    # The package and the pipeline built on it may be left out, together.
    if missing.name not in ("tablewinnow.llm", "corpus_pipeline"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# One rule per way a rule can work; departments differ in what they list and overlap.
DEPARTMENTS = {
    "Supply": {"dataSets": ["Brand#2", "Brand#5"], "trackerPrograms": "TP4"},
    "Clinic": {
        "trackerPrograms": ["TP1", "TP3"],
        "eventPrograms": ["signup", "purchase"],
        "dataSets": ["Brand#1"],
    },
    "Audit": {"eventPrograms": ["signup", "error"]},
    "Empty": {"dataSets": []},
}
RULES = [
    # Values: a selection that leaves the scope, at exact units that are also below others.
    {"selectDepartament": "SUPPLY", "action": "removeData",
     "selectMetadataType": ["dataSets"], "selectDatasets": ["Brand#5", "Brand#3"],
     "selectOrgUnits": ["S1", "S2", "S3", "S5", "S8", "S13"],
     "selectOrgUnitAndDescendants": ["R0", "R1", "R3"]},
    # Two families at once, narrowed by descendants.
    {"selectDepartament": "Clinic", "action": "removeData",
     "selectMetadataType": ["trackerPrograms", "eventPrograms"],
     "selectOrgUnitAndDescendants": ["N7", "N20"]},
    # Keys taken out of tracker events, of programs that replace the department's.
    {"selectDepartament": "clinic", "action": "removeData",
     "selectMDType": "trackerPrograms", "selectTrackerPrograms": ["TP5", "TP3"],
     "selectDataElements": ["k", "de4"]},
    # A selection of events where the department has none: nothing.
    {"selectDepartament": "Supply", "action": "removeData",
     "selectMetadataType": ["eventPrograms"], "selectEventProgram": ["click"]},
    # No type: all that the department lists, with what depends on it.
    {"selectDepartament": "Supply", "action": "removeData"},
    # Events of one program of two, at exact units.
    {"selectDepartament": "Audit", "action": "removeData",
     "selectMetadataType": ["eventPrograms"], "selectEventProgram": ["error"],
     "selectOrgUnits": ["C3", "C11", "C20"]},
    {"selectDepartament": "Empty", "selectMetadataType": ["dataSets"], "action": "removeData"},
    {"selectDepartament": "Audit", "action": "keepData"},
    {"selectDepartament": "Unheard of", "action": "removeData"},
]
PRUNED_TABLES = (
    "datavalue",
    "programstageinstance",
    "programstageinstancecomments",
    "programinstance",
    "trackedentityinstance",
    "trackedentityattributevalue",
    "trackedentityprogramowner",
)
TRACKER_TABLES = (
    "programstageinstance",
    "programstageinstancecomments",
    "trackedentitydatavalueaudit",
    "programinstance",
    "trackedentityinstance",
    "trackedentityattributevalue",
    "trackedentityattributevalueaudit",
    "trackedentityprogramowner",
)

ACCESS_VIEWS = ("users", "usergroupmembers", "userroles", "userrolemembers")
OPERATOR_USER = "Customer#000000007"
TEMPLATE_USER = "Customer#000000010"
NAMES = ["Customer#000000001", "Customer#000000008"]
GROUPS = ["BUILDING", "NATION_3"]
NEW_ROLES = ["1-URGENT", "5-LOW"]
ACCESS_ENTRIES = [
    {"selectUsernames": ["Customer#000000008"], "selectFromGroups": ["FURNITURE"],
     "action": "activate"},
    {"selectFromGroups": GROUPS, "action": "addRoles", "addRoles": NEW_ROLES},
    {"selectFromGroups": ["NATION_5"], "action": "addRolesFromTemplate",
     "addRolesFromTemplate": TEMPLATE_USER},
    {"selectUsernames": ["Customer#000000003"], "selectFromGroups": ["NATION_4"],
     "action": "removeFromGroups", "removeFromGroups": ["BUILDING", "MACHINERY"]},
    {"selectFromGroups": ["BUILDING", "FURNITURE"], "action": "deleteOthers"},
]

# Source names of a clone, with the view each stands for.
CLONE_SOURCE = {
    "datavalue": "datavalue",
    "organisationunit": "organisationunit",
    "analytics_2024": "programstageinstance",
    "aggregateddatavalue": "datavalueaudit",
    "Completeness_a": "programinstance",
    "sys.job": "connection_log",
    "public.sqlview": "sqlview",
}

# What a refresh starts from, and its configuration.
REFRESHED = (
    "organisationunit",
    "dataset",
    "dataelement",
    "datasetelement",
    "datavalue",
    "datavalueaudit",
    *ACCESS_VIEWS,
)
REFRESH_CONFIG = {
    "departments": {"Supply": {"dataSets": ["Brand#2", "Brand#5"]}},
    "preprocess": [
        {"selectDepartament": "supply", "action": "removeData",
         "selectMetadataType": ["dataSets"], "selectOrgUnitAndDescendants": ["R0", "R1"]},
        {"selectDepartament": "Unheard of", "action": "removeData"},
    ],
    "postprocess": [
        {"selectFiles": ["people.json"], "action": "import"},
        {"selectUsernames": ["AFRICA", "Customer#000000008"], "selectFromGroups": ["FURNITURE"],
         "action": "activate"},
        {"selectFromGroups": ["BUILDING"], "action": "addRoles", "addRoles": NEW_ROLES},
        {"selectUsernames": ["AFRICA"], "selectFromGroups": ["BUILDING", "FURNITURE"],
         "action": "deleteOthers"},
    ],
}

MERGE_COUNTS = ("total", "created", "updated", "deleted", "ignored")

Query = Callable[[SparkSession, str], DataFrame]


def _on(*views: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Turn a function of the named views into a function of (spark, sf_dir)."""

    def decorate(build: Callable[..., DataFrame]) -> Query:
        return lambda spark, sf_dir: build(*fixtures.Views(spark, sf_dir, views).values())

    return decorate


def _pruned(table: str, plan: Callable[[Mapping[str, DataFrame]], PrunePlan]) -> Query:
    return lambda spark, sf_dir: plan(fixtures.Views(spark, sf_dir)).table(table)


def _shuffled(query: Query) -> Query:
    """The query with no key set small enough to be broadcast."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with broadcast_up_to(0):
            return query(spark, sf_dir)

    return run


# Queries whose key sets are ids of facts, and a limit that refuses them as rows at sf0.01 and
# above, but not as bits.
BY_BITMAP = (
    "prune_events_full_programstageinstancecomments",
    "prune_trackers_full_programinstance",
    "prune_trackers_full_trackedentitydatavalueaudit",
    "apply_rules_programstageinstancecomments",
)
BITMAP_LIMIT = 40_000


def _by_bitmap(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with broadcast_up_to(BITMAP_LIMIT):
            return query(spark, sf_dir)

    return run


def _with_skewed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = fixtures.Views(spark, sf_dir, (*fixtures.DATABASE, "skewedvalue"))
    return _rule_plan({**views, "datavalue": views["skewedvalue"]}).table("datavalue")


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _new_database(spark: SparkSession) -> Database:
    name = f"tw_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{_new_folder(spark, name)}'")
    return Database(spark, name)


def _clone_source(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    views = fixtures.Views(spark, sf_dir, (*CLONE_SOURCE.values(), "spatial_ref_sys"))
    names = ("datavalue", "organisationunit", "analytics_2024", "sys.job")
    return {n: views[CLONE_SOURCE[n]] for n in names} | {"spatial_ref_sys": views["spatial_ref_sys"]}


def _cloned(spark: SparkSession, sf_dir: str) -> Database:
    target = _new_database(spark)
    clone_tables(Frames(_clone_source(spark, sf_dir)), target)
    return target


def _to_be_replaced(spark: SparkSession, sf_dir: str) -> Database:
    """A database with a table that goes and a protected one that stays."""
    target, views = _new_database(spark), fixtures.Views(spark, sf_dir)
    target.write("datavalue", views["dataset"])
    target.write("spatial_ref_sys", views["program"])
    target.write("old", views["program"])
    return target


def _replaced(spark: SparkSession, sf_dir: str, verify: bool = False) -> Database:
    target = _to_be_replaced(spark, sf_dir)
    clone_tables(Frames(_clone_source(spark, sf_dir)), target, replace=True, verify=verify)
    return target


class _Stopping(Database):
    """Stops in the middle of a replacement, after its first step."""

    def _take(self, action: str, name: str) -> None:
        super()._take(action, name)
        raise InterruptedError


def _resumed(spark: SparkSession, sf_dir: str) -> Database:
    target = _to_be_replaced(spark, sf_dir)
    try:
        clone_tables(Frames(_clone_source(spark, sf_dir)), _Stopping(spark, target.name), replace=True)
    except InterruptedError:
        target.recover()
    return target


def _copy_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of tables, and whether their copies, whole and damaged, have the same digest."""
    source, target = _clone_source(spark, sf_dir), _cloned(spark, sf_dir)
    found = []
    for name in ("datavalue", "organisationunit"):
        own, copy = digest(source[name]), target.read(name)
        first = copy.columns[0]
        damaged = {
            "whole": copy,
            "a row twice": copy.unionByName(copy.limit(1)),
            "a value changed": copy.withColumn(first, F.col(first) + 1),
        }
        found += [(name, kind, own.row_count, digest(df) == own) for kind, df in damaged.items()]
    return spark.createDataFrame(found, "table_name string, copy string, row_count long, same boolean")


# Tables that are written as a dump and read back, the last of them compressed.
DUMPED = ("datavalue", "programstageinstance", "users", "sqlview")


def _dumped(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = fixtures.Views(spark, sf_dir, (name, "program"))
        folder = write_dump(tables, _new_folder(spark, "dump"), compress=name == DUMPED[-1])
        return Dump(spark, folder).read(name)

    return run


def _stored(tables: Database | Folder) -> dict[str, DataFrame]:
    return {name: tables.read(name) for name in tables.names()}


def _write_text(frame: DataFrame, path: str) -> None:
    frame.coalesce(1).write.text(path)


def _refreshed(spark: SparkSession, sf_dir: str) -> Outcome:
    folder = _new_folder(spark, "refresh")
    config = spark.createDataFrame([(json.dumps(REFRESH_CONFIG),)], "value string")
    _write_text(config, f"{folder}/config.json")
    lists = fixtures.Views(spark, sf_dir, ("imported_users", "imported_elements"))
    credentials = F.struct("username", "disabled").alias("userCredentials")
    people = lists["imported_users"].select(F.struct("id", credentials).alias("person"))
    elements = lists["imported_elements"].select(F.struct("id").alias("element"))
    # The document of an import is one value by its nature; regions and nations are few.
    document = people.unionByName(elements, allowMissingColumns=True).agg(
        F.to_json(
            F.struct(
                F.collect_list("person").alias("users"),
                F.collect_list("element").alias("dataElements"),
            )
        ).alias("value")
    )
    _write_text(document, f"{folder}/imports/people.json")
    return refresh(
        spark,
        f"{folder}/config.json",
        Frames(fixtures.Views(spark, sf_dir, REFRESHED)),
        f"{folder}/tables",
        OPERATOR_USER,
        import_folder=f"{folder}/imports",
    )


def _refreshed_table(name: str) -> Query:
    return lambda spark, sf_dir: Folder(spark, _refreshed(spark, sf_dir).folder).read(name)


def _refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh tells about itself: rows matched, imports, rules not applied."""
    outcome = _refreshed(spark, sf_dir)
    found = [(name, n) for name, n in outcome.matched_rows.items()]
    for file, table, counts in outcome.imports:
        found += [(f"{file} {table} {name}", n) for name, n in counts.items()]
    for place, action, counts in outcome.entries:
        found += [(f"entry {place} {action} {name}", n) for name, n in counts.items()]
    found += [(f"unmatched {rule.department}", 1) for rule in outcome.unmatched]
    return spark.createDataFrame(found, "name string, n long")


def _nested_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as groups of two users each."""

    def member(key):
        return F.struct(F.concat(F.lit("U"), F.col(key)).alias("id"))

    return fixtures.base_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.array(member("c_custkey"), member("c_nationkey")).alias("users")
    )


def _three_files(source: DataFrame) -> list[DataFrame]:
    """A file, one that has half of its keys with other sizes, and one with other keys."""
    half = source.filter("id % 2 = 0").select("id", (F.col("size") + 1).alias("size"))
    return [source, half, source.withColumn("id", F.col("id") + 7)]


def _merged_files(target: DataFrame, source: DataFrame) -> DataFrame:
    return merge_all(target, _three_files(source))[0]


def _file_counts(target: DataFrame, source: DataFrame) -> DataFrame:
    counts = merge_all(target, _three_files(source))[1]
    rows = [(n, *(c[k] for k in MERGE_COUNTS)) for n, c in enumerate(counts)]
    return target.sparkSession.createDataFrame(
        rows, "file int, " + ", ".join(f"{k} long" for k in MERGE_COUNTS)
    )


def _rule_plan(tables: Mapping[str, DataFrame]) -> PrunePlan:
    plan, _ = apply_rules(tables, read_departments(DEPARTMENTS), read_rules(RULES))
    return plan


def _department_plan(tables: Mapping[str, DataFrame]) -> PrunePlan:
    department = next(d for d in read_departments(DEPARTMENTS) if d.key == "Clinic")
    return prune.prune_department(tables, department)


def _row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _access_state(spark: SparkSession, sf_dir: str) -> AccessState:
    users, members, roles, links = fixtures.Views(spark, sf_dir, ACCESS_VIEWS).values()
    return AccessState(users, members, roles, links, {})


def _after_access_rules(part: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        state = _access_state(spark, sf_dir)
        return getattr(apply_access_rules(state, ACCESS_ENTRIES, OPERATOR_USER), part)

    return query


def _order_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fixtures.base_table(spark, sf_dir, "orders")

    def item(name):
        return F.struct(name.alias("id"))

    own = F.array(item(F.substring("o_orderpriority", 1, 1)), item(F.col("o_orderstatus")))
    added = F.array(item(F.lit("F")), item(F.lit("1")))
    held = unique_by_field(F.concat(own, added))
    return orders.select(
        "o_orderkey",
        F.array_join(held["id"], ",").alias("held"),
        F.array_join(array_minus(F.concat(own, added), added)["id"], ",").alias("remaining"),
    )


# Keys taken out of documents that have an entry for each event of a stage and a long string.
WIDE_KEYS = ["note", "e1", "e2", "e8", "e9", "e4001"]
# Up to the third digit of an entry's key.
PART_CHARS = 5


def _wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    (events,) = fixtures.Views(spark, sf_dir, ("programstageinstance",)).values()
    entry = F.concat(
        F.lit('"e'), "programstageinstanceid", F.lit('": {"at":[{"unit":'), "organisationunitid", F.lit("}]}")
    )
    # Entries are sorted and joined by how they begin, in many tasks; a document is made of few parts.
    parts = (
        events.select("programstageid", entry.alias("entry"))
        .groupBy("programstageid", F.left("entry", F.lit(PART_CHARS)).alias("part"))
        .agg(F.array_join(F.array_sort(F.collect_list("entry")), ",").alias("entries"))
    )
    # Events without a unit have no entry.
    part = F.when(F.col("part").isNotNull(), F.struct("part", "entries"))
    in_order = F.transform(F.array_sort(F.collect_list(part)), lambda p: p["entries"])
    entries = F.array_join(in_order, ",")
    document = F.concat(
        F.lit('\n{"note":"'), F.repeat(F.lit("n\\n"), F.lit(400_000)), F.lit('",'), entries, F.lit("}\n")
    )
    kept = without_keys(F.col("document"), F.array(*map(F.lit, WIDE_KEYS)))
    return (
        parts.groupBy("programstageid")
        .agg(document.alias("document"))
        .withColumn("document", kept)
        .select("programstageid", F.length("document").cast("long").alias("n_chars"), F.md5("document").alias("digest"))
    )


def _nested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as user objects, some without credentials."""
    credentials = F.struct(
        F.concat(F.lit("c"), "c_custkey").alias("username"),
        (F.col("c_acctbal") < 1000).alias("disabled"),
        F.array(
            F.struct(F.col("c_mktsegment").alias("id")),
            F.struct(F.concat(F.lit("NATION_"), "c_nationkey").alias("id")),
        ).alias("userRoles"),
    )
    return fixtures.base_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), "c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") >= 0, credentials).alias("userCredentials"),
    )


def _document_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as one metadata document, read back in small ranges."""
    folder = _new_folder(spark, "document")
    nested = F.struct(*_nested_users(spark, sf_dir).columns)
    # One value by its nature, as a server sends it.
    document = _nested_users(spark, sf_dir).agg(
        F.to_json(F.struct(F.collect_list(nested).alias("users"))).alias("value")
    )
    _write_text(document, folder)
    return flat_users(read_metadata(spark, folder, whole_bytes=0, range_bytes=100_000)["users"])


def entry(spark: SparkSession) -> DataFrame:
    """The rule file applied to the fact table of data values."""
    return queries()["apply_rules_datavalue"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return table_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return table_sql() | (llm.oracle_sql() if llm else {})


def table_queries() -> dict[str, Query]:
    """Queries over table sets, rules, users and metadata."""
    result: dict[str, Query] = {}

    # Table sets.
    def clone_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = fixtures.Views(spark, sf_dir, CLONE_SOURCE.values())
        return _row_counts(select_tables({n: views[v] for n, v in CLONE_SOURCE.items()}))

    result["clone_selected"] = clone_selected
    result["clone_tables"] = lambda spark, sf_dir: _row_counts(_stored(_cloned(spark, sf_dir)))
    result["clone_tables_organisationunit"] = lambda spark, sf_dir: _cloned(spark, sf_dir).read(
        "organisationunit"
    )
    result["clone_replaced"] = lambda spark, sf_dir: _row_counts(_stored(_replaced(spark, sf_dir)))
    result["clone_verified"] = lambda spark, sf_dir: _row_counts(
        _stored(_replaced(spark, sf_dir, verify=True))
    )
    result["clone_resumed"] = lambda spark, sf_dir: _row_counts(_stored(_resumed(spark, sf_dir)))
    result["copy_digests"] = _copy_digests
    result["snapshot_tables"] = lambda spark, sf_dir: _row_counts(
        _stored(
            Folder(
                spark,
                snapshot_tables(
                    _clone_source(spark, sf_dir), _new_folder(spark, "snapshots"), "TRAINING"
                ),
            )
        )
    )
    for name in DUMPED:
        result[f"dump_{name}"] = _dumped(name)
    result["empty_data"] = lambda spark, sf_dir: _row_counts(
        empty_tables(fixtures.Views(spark, sf_dir))
    )
    result["clear_dependents"] = lambda spark, sf_dir: _row_counts(
        clear_dependents(fixtures.Views(spark, sf_dir))
    )
    result["view_names"] = _on("sqlview")(derived_view_names)

    # Keys.
    def on_database(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(fixtures.Views(spark, sf_dir))

    result["program_stages"] = on_database(
        lambda t: keys.stages_of_programs(t, ["click", "error", "TP2"])
    )
    result["dataset_elements"] = on_database(
        lambda t: keys.elements_of_datasets(t, ["Brand#2", "Brand#4"])
    )
    result["elements_in_datasets"] = on_database(
        lambda t: keys.elements_by_uid(t, [f"DE{n}" for n in range(100)], ["Brand#2", "Brand#3"])
    )
    result["org_unit_exact"] = on_database(lambda t: keys.org_units(t, ["R1", "N2", "C8", "S3"]))
    result["org_unit_descendants"] = on_database(
        lambda t: keys.org_unit_descendants(t, ["N2", "R3", "C1"])
    )

    # Removing records.
    for table in ("datavalue", "datavalueaudit"):
        suffix = "" if table == "datavalue" else f"_{table}"
        result[f"prune_datasets_full{suffix}"] = _pruned(
            table, lambda t: prune.prune_datasets_full(t, ["Brand#1", "Brand#2"])
        )
    result["prune_datasets_scoped"] = _pruned(
        "datavalue",
        lambda t: prune.prune_datasets_scoped(
            t, ["Brand#1", "Brand#2"], datasets=["Brand#2"], units_below=["N2", "R1"]
        ),
    )
    result["prune_datasets_scoped_elements"] = _pruned(
        "datavalue",
        lambda t: prune.prune_datasets_scoped(
            t,
            ["Brand#4", "Brand#5"],
            elements=[f"DE{n}" for n in range(200)],
            units=["S1", "S2", "S3", "S4", "S5", "S6"],
            units_below=["R0", "R1", "R2"],
        ),
    )
    for table in (
        "programstageinstance",
        "trackedentitydatavalueaudit",
        "programstageinstancecomments",
    ):
        suffix = "" if table == "programstageinstance" else f"_{table}"
        result[f"prune_events_full{suffix}"] = _pruned(
            table, lambda t: prune.prune_events_full(t, ["click", "view"])
        )
    result["prune_events_scoped"] = _pruned(
        "programstageinstance",
        lambda t: prune.prune_events_scoped(
            t, ["view", "error"], units=["C8", "C9", "C46"], units_below=["R0", "R2", "N1", "N13"]
        ),
    )
    result["prune_events_scoped_programs"] = _pruned(
        "programstageinstance",
        lambda t: prune.prune_events_scoped(t, ["view"], programs=["signup"], units_below=["R0"]),
    )
    result["strip_event_keys"] = _pruned(
        "programstageinstance",
        lambda t: prune.strip_event_keys(
            t, ["view", "error"], ["de1", "de2", "k"], units_below=["R0", "R1", "R2"]
        ),
    )
    result["strip_wide_documents"] = _wide_documents
    for table in TRACKER_TABLES:
        result[f"prune_trackers_full_{table}"] = _pruned(
            table, lambda t: prune.prune_trackers_full(t, ["TP1"])
        )
    result["prune_trackers_scoped"] = _pruned(
        "programstageinstance",
        lambda t: prune.prune_trackers_scoped(
            t, ["TP1", "TP2"], trackers=["TP2", "TP3"], units_below=["R1"]
        ),
    )
    result["strip_tracker_keys"] = _pruned(
        "programstageinstance",
        lambda t: prune.strip_tracker_keys(
            t, ["TP1"], ["k", "de3"], trackers=["TP2", "TP3"], units_below=["R1", "R4"]
        ),
    )
    for table in ("datavalue", "programstageinstance", "programinstance"):
        result[f"prune_department_{table}"] = _pruned(table, _department_plan)
    for table in PRUNED_TABLES:
        result[f"apply_rules_{table}"] = _pruned(table, _rule_plan)
    result["apply_rules_counts_datavalue"] = lambda spark, sf_dir: _rule_plan(
        fixtures.Views(spark, sf_dir)
    ).values.rule_counts()
    result["apply_rules_counts_programstageinstance"] = lambda spark, sf_dir: _rule_plan(
        fixtures.Views(spark, sf_dir)
    ).events.rule_counts()

    for name in (
        "apply_rules_datavalue",
        "apply_rules_programstageinstance",
        "prune_trackers_full_programinstance",
        "prune_trackers_full_programstageinstancecomments",
    ):
        result[f"{name}_shuffled"] = _shuffled(result[name])
    for name in BY_BITMAP:
        result[f"{name}_bitmap"] = _by_bitmap(result[name])
    result["apply_rules_skewed"] = _with_skewed_values
    result["apply_rules_skewed_shuffled"] = _shuffled(_with_skewed_values)

    # Access.
    on_users = _on("users", "usergroupmembers")
    result["users_by_username"] = _on("users")(lambda u: access.users_by_username(u, NAMES))
    result["users_by_group"] = on_users(lambda u, m: access.users_by_group(u, m, GROUPS))
    result["select_users"] = on_users(lambda u, m: access.select_users(u, m, NAMES, GROUPS))
    result["activate_users"] = on_users(
        lambda u, m: access.activate(u, access.selected_ids(u, m, NAMES, GROUPS))
    )
    result["keep_only_users"] = on_users(
        lambda u, m: access.keep_only(u, access.selected_ids(u, m, NAMES, GROUPS), OPERATOR_USER)
    )
    result["removed_users"] = on_users(
        lambda u, m: access.removed_by_keep_only(
            u, access.selected_ids(u, m, NAMES, GROUPS), OPERATOR_USER
        )
    )
    result["add_roles"] = _on("users", "usergroupmembers", "userroles", "userrolemembers")(
        lambda u, m, r, links: access.add_roles(
            links, access.selected_ids(u, m, NAMES, GROUPS), access.roles_named(r, NEW_ROLES)
        )
    )
    result["add_roles_from_template"] = _on("users", "usergroupmembers", "userrolemembers")(
        lambda u, m, links: access.add_roles_from_template(
            links, u, access.selected_ids(u, m, NAMES, GROUPS), TEMPLATE_USER
        )
    )
    result["remove_from_groups"] = on_users(
        lambda u, m: access.remove_from_groups(
            m, access.selected_ids(u, m, NAMES, ["NATION_4"]), ["MACHINERY", "BUILDING"]
        )
    )
    for part in ("users", "members", "links"):
        result[f"apply_access_rules_{part}"] = _after_access_rules(part)

    for name in ("add_roles", "keep_only_users", "apply_access_rules_links"):
        result[f"{name}_shuffled"] = _shuffled(result[name])
    for table in ("datavalue", "datavalueaudit", "dataelement", "users", "userrolemembers"):
        result[f"refresh_{table}"] = _refreshed_table(table)
    result["refresh_report"] = _refresh_report

    result["flat_users"] = lambda spark, sf_dir: flat_users(_nested_users(spark, sf_dir))
    result["document_users"] = _document_users
    result["role_links"] = lambda spark, sf_dir: role_links(_nested_users(spark, sf_dir))

    result["group_members"] = lambda spark, sf_dir: group_members(_nested_groups(spark, sf_dir))

    # Metadata.
    on_metadata = _on("metadata_target", "metadata_source")
    result["merge_metadata"] = on_metadata(merge_metadata)
    result["merge_summary"] = on_metadata(merge_summary)
    result["merge_metadata_shuffled"] = _shuffled(result["merge_metadata"])
    result["merge_files"] = on_metadata(_merged_files)
    result["merge_files_counts"] = on_metadata(_file_counts)
    result["merge_files_shuffled"] = _shuffled(result["merge_files"])

    # Expressions.
    result["redact_credentials"] = _on("connection_log")(
        lambda log: log.select("page_id", redact_credentials(F.col("line")).alias("line"))
    )
    result["url_segments"] = _on("pages")(
        lambda pages: pages.select("page_id", last_segment(F.col("url")).alias("segment"))
    )
    result["event_stamps"] = _on("events")(
        lambda events: events.select("event_id", stamp(F.col("ts")).alias("stamp"))
    )
    result["role_arrays"] = _order_arrays
    return result


# --- SQL ---------------------------------------------------------------------


def _list(uids: list[str]) -> str:
    return "(" + ", ".join(f"'{uid}'" for uid in uids) + ")"


def _programs(uids: list[str]) -> str:
    return f"SELECT programid FROM program WHERE uid IN {_list(uids)}"


def _stages(uids: list[str]) -> str:
    return (
        "programstageid IN (SELECT programstageid FROM programstage "
        f"WHERE programid IN ({_programs(uids)}))"
    )


def _members(uids: list[str]) -> str:
    return (
        "dataelementid IN (SELECT dataelementid FROM datasetelement WHERE datasetid IN "
        f"(SELECT datasetid FROM dataset WHERE uid IN {_list(uids)}))"
    )


def _named_elements(uids: list[str], within: list[str]) -> str:
    return (
        "dataelementid IN (SELECT dataelementid FROM dataelement "
        f"WHERE uid IN {_list(uids)} AND {_members(within)})"
    )


def _at(column: str, uids: list[str]) -> str:
    return (
        f"{column} IN (SELECT organisationunitid FROM organisationunit WHERE uid IN {_list(uids)})"
    )


def _below_units(uids: list[str]) -> str:
    return (
        "SELECT DISTINCT o.organisationunitid FROM organisationunit o JOIN organisationunit a "
        f"ON starts_with(o.path, a.path || '/') WHERE a.uid IN {_list(uids)}"
    )


def _below(column: str, uids: list[str]) -> str:
    return f"{column} IN ({_below_units(uids)})"


def _events(uids: list[str]) -> str:
    return (
        "programstageinstanceid IN (SELECT programstageinstanceid FROM programstageinstance "
        f"WHERE {_stages(uids)})"
    )


def _entities(uids: list[str]) -> str:
    return (
        "trackedentityinstanceid IN (SELECT trackedentityinstanceid FROM programinstance "
        f"WHERE programid IN ({_programs(uids)}))"
    )


def _keep(table: str, *conditions: str, columns: str = "*") -> str:
    removed = " OR ".join(f"coalesce({c}, false)" for c in conditions) or "false"
    with_views = fixtures.common_table_expressions(*_needed(table, *conditions))
    return f"{with_views}\nSELECT {columns} FROM {table} WHERE NOT ({removed})"


def _needed(*texts: str) -> list[str]:
    return [v for v in fixtures.VIEWS if any(v in text.split() or v == text for text in texts)]


def _has_keys(uids: list[str]) -> str:
    return f"list_has_any(json_keys(eventdatavalues), [{', '.join(repr(u) for u in uids)}])"


def _strip(condition: str, uids: list[str]) -> str:
    patch = "{" + ",".join(f'"{uid}":null' for uid in uids) + "}"
    return (
        f"* REPLACE (CASE WHEN {condition} AND {_has_keys(uids)} "
        f"THEN CAST(json_merge_patch(eventdatavalues, '{patch}') AS VARCHAR) "
        "ELSE eventdatavalues END AS eventdatavalues)"
    )


def _counts_sql(views: dict[str, str], emptied: tuple[str, ...] = ()) -> str:
    parts = [
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}"
        + (" WHERE false" if name in emptied else "")
        for name, view in views.items()
    ]
    with_views = fixtures.common_table_expressions(*views.values())
    return with_views + "\n" + "\nUNION ALL ".join(parts)


def _matched_sql(table: str, rules: list[tuple[int, str, str]]) -> str:
    parts = [
        f"SELECT CAST({rule} AS INT) AS rule, '{family}' AS family, count(*) AS matched_rows "
        f"FROM {table} WHERE {condition}"
        for rule, family, condition in rules
    ]
    conditions = [condition for _, _, condition in rules]
    with_views = fixtures.common_table_expressions(*_needed(table, *conditions))
    return with_views + "\n" + "\nUNION ALL ".join(parts)


def _access(text: str, steps: str = "") -> str:
    with_views = fixtures.common_table_expressions(*ACCESS_VIEWS)
    return f"{with_views}{steps}\n{text}"


def _chosen(
    names: list[str],
    groups: list[str],
    members: str = "usergroupmembers",
    users: str = "users",
) -> str:
    """Ids of users selected by name or group."""
    conditions = []
    if names:
        conditions.append(f"username IN {_list(names)}")
    if groups:
        conditions.append(
            f"id IN (SELECT user_id FROM {members} WHERE group_name IN {_list(groups)})"
        )
    return f"SELECT id FROM {users} WHERE {' OR '.join(conditions)}"


def _granted(links: str, chosen: str, roles: str) -> str:
    return (
        f"SELECT user_id, role_id FROM {links} UNION "
        f"SELECT s.id, r.id FROM ({chosen}) s JOIN ({roles}) r ON true"
    )


def table_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    ctes = fixtures.common_table_expressions

    sql["clone_selected"] = _counts_sql(
        {
            n: CLONE_SOURCE[n]
            for n in ("datavalue", "organisationunit", "Completeness_a", "public.sqlview")
        }
    )
    copied = {n: n for n in ("datavalue", "organisationunit")}
    protected = {"spatial_ref_sys": "spatial_ref_sys"}
    sql["clone_tables"] = _counts_sql(copied | protected)
    sql["clone_tables_organisationunit"] = (
        ctes("organisationunit") + " SELECT * FROM organisationunit"
    )
    sql["clone_replaced"] = _counts_sql(copied | {"spatial_ref_sys": "program"})
    sql["clone_verified"] = sql["clone_resumed"] = sql["clone_replaced"]
    sql["copy_digests"] = ctes("datavalue", "organisationunit") + " " + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{kind}' AS copy, count(*) AS row_count, "
        f"{str(kind == 'whole').lower()} AS same FROM {name}"
        for name in ("datavalue", "organisationunit")
        for kind in ("whole", "a row twice", "a value changed")
    )
    sql["snapshot_tables"] = _counts_sql(
        copied | protected | {"analytics_2024": CLONE_SOURCE["analytics_2024"]}
    )
    for name in DUMPED:
        sql[f"dump_{name}"] = f"{ctes(name)} SELECT * FROM {name}"
    database = {name: name for name in fixtures.DATABASE}
    sql["empty_data"] = _counts_sql(database, DATA_TABLES)
    sql["clear_dependents"] = _counts_sql(database, DEPENDENT_TABLES)
    sql["view_names"] = ctes("sqlview") + (
        " SELECT concat('_view_', replace(replace(lower(name), ' ', '_'), '_-_', '_')) AS name "
        "FROM sqlview WHERE type = 'VIEW'"
    )

    sql["program_stages"] = ctes("program", "programstage") + (
        f" SELECT programstageid FROM programstage WHERE {_stages(['click', 'error', 'TP2'])}"
    )
    sql["dataset_elements"] = ctes("dataset", "dataelement", "datasetelement") + (
        f" SELECT dataelementid FROM dataelement WHERE {_members(['Brand#2', 'Brand#4'])}"
    )
    hundred = [f"DE{n}" for n in range(100)]
    sql["elements_in_datasets"] = ctes("dataset", "dataelement", "datasetelement") + (
        " SELECT dataelementid FROM dataelement "
        f"WHERE {_named_elements(hundred, ['Brand#2', 'Brand#3'])}"
    )
    sql["org_unit_exact"] = ctes("organisationunit") + (
        " SELECT organisationunitid FROM organisationunit "
        f"WHERE uid IN {_list(['R1', 'N2', 'C8', 'S3'])}"
    )
    sql["org_unit_descendants"] = ctes("organisationunit") + " " + _below_units(["N2", "R3", "C1"])

    for suffix, table in (("", "datavalue"), ("_datavalueaudit", "datavalueaudit")):
        sql[f"prune_datasets_full{suffix}"] = _keep(table, _members(["Brand#1", "Brand#2"]))
    sql["prune_datasets_scoped"] = _keep(
        "datavalue",
        f"({_members(['Brand#1', 'Brand#2'])} AND {_members(['Brand#2'])} "
        f"AND {_below('sourceid', ['N2', 'R1'])})",
    )
    scope = ["Brand#4", "Brand#5"]
    sql["prune_datasets_scoped_elements"] = _keep(
        "datavalue",
        f"({_members(scope)} AND {_named_elements([f'DE{n}' for n in range(200)], scope)} "
        f"AND {_at('sourceid', ['S1', 'S2', 'S3', 'S4', 'S5', 'S6'])} "
        f"AND {_below('sourceid', ['R0', 'R1', 'R2'])})",
    )
    programs = ["click", "view"]
    sql["prune_events_full"] = _keep("programstageinstance", _stages(programs))
    for table in ("trackedentitydatavalueaudit", "programstageinstancecomments"):
        sql[f"prune_events_full_{table}"] = _keep(table, _events(programs))
    place = "organisationunitid"
    sql["prune_events_scoped"] = _keep(
        "programstageinstance",
        f"({_stages(['view', 'error'])} AND {_at(place, ['C8', 'C9', 'C46'])} "
        f"AND {_below(place, ['R0', 'R2', 'N1', 'N13'])})",
    )
    sql["prune_events_scoped_programs"] = _keep(
        "programstageinstance", f"({_stages(['signup'])} AND {_below(place, ['R0'])})"
    )
    with_events = ctes("programstageinstance", "programstage", "program", "organisationunit")
    condition = f"{_stages(['view', 'error'])} AND {_below(place, ['R0', 'R1', 'R2'])}"
    sql["strip_event_keys"] = (
        f"{with_events} SELECT {_strip(condition, ['de1', 'de2', 'k'])} FROM programstageinstance"
    )
    sql["strip_wide_documents"] = ctes("programstageinstance") + (
        ", entries AS (SELECT programstageid, '\"e' || programstageinstanceid || '\": {\"at\":[{\"unit\":' "
        "|| organisationunitid || '}]}' AS entry, 'e' || programstageinstanceid AS key FROM programstageinstance)"
        ", documents AS (SELECT programstageid, chr(10) || '{' || coalesce(string_agg(entry, ',' ORDER BY entry) "
        f"FILTER (WHERE key NOT IN {_list(WIDE_KEYS)}), '') || '}}' || chr(10) AS document "
        "FROM entries GROUP BY programstageid) SELECT programstageid, length(document) AS n_chars, "
        "md5(document) AS digest FROM documents"
    )
    tracker = ["TP1"]
    sql["prune_trackers_full_programstageinstance"] = _keep(
        "programstageinstance", _stages(tracker)
    )
    for table in ("programstageinstancecomments", "trackedentitydatavalueaudit"):
        sql[f"prune_trackers_full_{table}"] = _keep(table, _events(tracker))
    sql["prune_trackers_full_programinstance"] = _keep(
        "programinstance", f"(programid IN ({_programs(tracker)}))", _entities(tracker)
    )
    for table in TRACKER_TABLES[4:]:
        sql[f"prune_trackers_full_{table}"] = _keep(table, _entities(tracker))
    sql["prune_trackers_scoped"] = _keep(
        "programstageinstance",
        f"({_stages(['TP1', 'TP2'])} AND {_stages(['TP2', 'TP3'])} AND {_below(place, ['R1'])})",
    )
    condition = f"{_stages(['TP2', 'TP3'])} AND {_below(place, ['R1', 'R4'])}"
    sql["strip_tracker_keys"] = (
        f"{with_events} SELECT {_strip(condition, ['k', 'de3'])} FROM programstageinstance"
    )
    sql["prune_department_datavalue"] = _keep("datavalue", _members(["Brand#1"]))
    sql["prune_department_programstageinstance"] = _keep(
        "programstageinstance", _stages(["signup", "purchase"]), _stages(["TP1", "TP3"])
    )
    sql["prune_department_programinstance"] = _keep(
        "programinstance",
        f"(programid IN ({_programs(['TP1', 'TP3'])}))",
        _entities(["TP1", "TP3"]),
    )

    value_rules = [
        (
            0,
            "datasets",
            f"({_members(['Brand#2', 'Brand#5'])} AND {_members(['Brand#5', 'Brand#3'])} AND "
            f"{_at('sourceid', ['S1', 'S2', 'S3', 'S5', 'S8', 'S13'])} "
            f"AND {_below('sourceid', ['R0', 'R1', 'R3'])})",
        ),
        (4, "datasets", _members(["Brand#2", "Brand#5"])),
        (6, "datasets", "false"),
    ]
    replaced = _stages(["TP5", "TP3"])
    below = _below(place, ["N7", "N20"])
    event_rules = [
        (1, "events", f"({_stages(['signup', 'purchase'])} AND {below})"),
        (1, "trackers", f"({_stages(['TP1', 'TP3'])} AND {below})"),
        (3, "events", "false"),
        (4, "trackers", _stages(["TP4"])),
        (5, "events", f"({_stages(['error'])} AND {_at(place, ['C3', 'C11', 'C20'])})"),
    ]
    strip_rule = f"({replaced} AND {_has_keys(['k', 'de4'])})"
    sql["apply_rules_datavalue"] = _keep("datavalue", *[c for _, _, c in value_rules])
    sql["apply_rules_programstageinstance"] = _keep(
        "programstageinstance",
        *[c for _, _, c in event_rules],
        columns=_strip(replaced, ["k", "de4"]),
    )
    sql["apply_rules_programstageinstancecomments"] = _keep(
        "programstageinstancecomments", _events(["TP4"])
    )
    sql["apply_rules_programinstance"] = _keep(
        "programinstance", f"(programid IN ({_programs(['TP4'])}))", _entities(["TP4"])
    )
    for table in PRUNED_TABLES[4:]:
        sql[f"apply_rules_{table}"] = _keep(table, _entities(["TP4"]))
    sql["apply_rules_counts_datavalue"] = _matched_sql("datavalue", value_rules)
    sql["apply_rules_counts_programstageinstance"] = _matched_sql(
        "programstageinstance", [*event_rules, (2, "trackers", strip_rule)]
    )

    for name in (
        "apply_rules_datavalue",
        "apply_rules_programstageinstance",
        "prune_trackers_full_programinstance",
        "prune_trackers_full_programstageinstancecomments",
    ):
        sql[f"{name}_shuffled"] = sql[name]
    for name in BY_BITMAP:
        sql[f"{name}_bitmap"] = sql[name]
    sql["apply_rules_skewed"] = _keep("skewedvalue", *[c for _, _, c in value_rules])
    sql["apply_rules_skewed_shuffled"] = sql["apply_rules_skewed"]

    chosen = _chosen(NAMES, GROUPS)
    sql["users_by_username"] = _access(f"SELECT * FROM users WHERE username IN {_list(NAMES)}")
    sql["users_by_group"] = _access(f"SELECT * FROM users WHERE id IN ({_chosen([], GROUPS)})")
    sql["select_users"] = _access(f"SELECT * FROM users WHERE id IN ({chosen})")
    sql["activate_users"] = _access(
        "SELECT id, username, CASE WHEN id IN "
        f"({chosen}) THEN false ELSE disabled END AS disabled FROM users"
    )
    kept = f"id IN ({chosen}) OR username = '{OPERATOR_USER}'"
    sql["keep_only_users"] = _access(f"SELECT * FROM users WHERE {kept}")
    sql["removed_users"] = _access(f"SELECT * FROM users WHERE NOT ({kept})")
    named = f"SELECT id FROM userroles WHERE name IN {_list(NEW_ROLES)}"
    sql["add_roles"] = _access(_granted("userrolemembers", chosen, named))
    held = (
        "SELECT role_id AS id FROM {} WHERE user_id IN "
        f"(SELECT id FROM users WHERE username = '{TEMPLATE_USER}')"
    )
    sql["add_roles_from_template"] = _access(
        _granted("userrolemembers", chosen, held.format("userrolemembers"))
    )
    sql["remove_from_groups"] = _access(
        "SELECT * FROM usergroupmembers WHERE NOT (group_name IN ('MACHINERY', 'BUILDING') "
        f"AND user_id IN ({_chosen(NAMES, ['NATION_4'])}))"
    )
    steps = (
        f",\nlinks1 AS ({_granted('userrolemembers', _chosen([], GROUPS), named)})"
        f",\nlinks2 AS ({_granted('links1', _chosen([], ['NATION_5']), held.format('links1'))})"
        ",\nmembers1 AS (SELECT * FROM usergroupmembers WHERE NOT "
        "(group_name IN ('BUILDING', 'MACHINERY') AND user_id IN "
        f"({_chosen(['Customer#000000003'], ['NATION_4'])})))"
        f",\nremaining AS ({_chosen([OPERATOR_USER], ['BUILDING', 'FURNITURE'], 'members1')})"
    )
    sql["apply_access_rules_users"] = _access(
        "SELECT id, username, CASE WHEN id IN "
        f"({_chosen(['Customer#000000008'], ['FURNITURE'])}) THEN false ELSE disabled END "
        "AS disabled FROM users WHERE id IN (SELECT id FROM remaining)",
        steps,
    )
    sql["apply_access_rules_members"] = _access(
        "SELECT * FROM members1 WHERE user_id IN (SELECT id FROM remaining)", steps
    )
    sql["apply_access_rules_links"] = _access(
        "SELECT * FROM links2 WHERE user_id IN (SELECT id FROM remaining)", steps
    )

    for name in ("add_roles", "keep_only_users", "apply_access_rules_links"):
        sql[f"{name}_shuffled"] = sql[name]

    supply, far = _members(["Brand#2", "Brand#5"]), _below("sourceid", ["R0", "R1"])
    sql["refresh_datavalue"] = _keep("datavalue", f"({supply} AND {far})")
    sql["refresh_datavalueaudit"] = (
        ctes("datavalueaudit") + " SELECT * FROM datavalueaudit WHERE false"
    )
    sql["refresh_dataelement"] = ctes("dataelement", "imported_elements") + (
        " SELECT t.dataelementid, coalesce(t.uid, s.id) AS uid "
        "FROM dataelement t FULL OUTER JOIN imported_elements s ON t.uid = s.id"
    )
    people = ctes(*ACCESS_VIEWS, "imported_users") + (
        ",\npeople AS (SELECT coalesce(t.id, s.id) AS id, "
        "coalesce(s.username, t.username) AS username, "
        "coalesce(s.disabled, t.disabled) AS disabled "
        "FROM users t FULL OUTER JOIN imported_users s ON t.id = s.id)"
        ",\nremaining AS ("
        + _chosen(["AFRICA", OPERATOR_USER], ["BUILDING", "FURNITURE"], users="people")
        + ")"
    )
    active = _chosen(["AFRICA", "Customer#000000008"], ["FURNITURE"], users="people")
    sql["refresh_users"] = people + (
        f" SELECT id, username, CASE WHEN id IN ({active}) THEN false ELSE disabled END "
        "AS disabled FROM people WHERE id IN (SELECT id FROM remaining)"
    )
    building = _chosen([], ["BUILDING"], users="people")
    sql["refresh_userrolemembers"] = people + (
        f" SELECT * FROM ({_granted('userrolemembers', building, named)}) "
        "WHERE user_id IN (SELECT id FROM remaining)"
    )
    reported = [("rule_0_datasets_0", f"SELECT count(*) FROM datavalue WHERE {supply} AND {far}")]
    for table, target, imported, key in (
        ("users", "users", "imported_users", "id"),
        ("dataelement", "dataelement", "imported_elements", "uid"),
    ):
        known = f"id IN (SELECT {key} FROM {target})"
        for name, condition in (
            ("total", "true"),
            ("created", f"NOT {known}"),
            ("updated", known),
            ("deleted", "false"),
            ("ignored", "false"),
        ):
            reported.append(
                (f"people.json {table} {name}", f"SELECT count(*) FROM {imported} WHERE {condition}")
            )
    reported.append(("unmatched Unheard of", "SELECT CAST(1 AS BIGINT)"))
    leaving = _chosen(["AFRICA"], ["BUILDING", "FURNITURE"], users="people")
    for name, count in (
        ("1 activate selected", f"SELECT count(DISTINCT id) FROM ({active})"),
        ("2 addRoles selected", f"SELECT count(DISTINCT id) FROM ({building})"),
        ("2 addRoles roles", f"SELECT count(DISTINCT id) FROM ({named})"),
        ("3 deleteOthers selected", f"SELECT count(DISTINCT id) FROM ({leaving})"),
        (
            "3 deleteOthers deleted",
            "SELECT count(DISTINCT id) FROM people WHERE id NOT IN (SELECT id FROM remaining)",
        ),
    ):
        reported.append((f"entry {name}", count))
    given = ctes(*REFRESHED, "imported_users", "imported_elements")
    sql["refresh_report"] = given + people[people.index(",\npeople AS") :] + (
        " " + " UNION ALL ".join(f"SELECT '{name}' AS name, ({count}) AS n" for name, count in reported)
    )

    sql["flat_users"] = (
        "SELECT concat('U', c_custkey) AS id, "
        "CASE WHEN c_acctbal >= 0 THEN concat('c', c_custkey) ELSE c_name END AS username, "
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal < 1000 END AS disabled FROM customer"
    )
    sql["document_users"] = sql["flat_users"]
    sql["role_links"] = (
        "SELECT concat('U', c_custkey) AS user_id, c_mktsegment AS role_id FROM customer "
        "WHERE c_acctbal >= 0 UNION ALL "
        "SELECT concat('U', c_custkey), concat('NATION_', c_nationkey) FROM customer "
        "WHERE c_acctbal >= 0"
    )

    sql["group_members"] = (
        "SELECT c_name AS group_name, concat('U', c_custkey) AS user_id FROM customer UNION ALL "
        "SELECT c_name, concat('U', c_nationkey) FROM customer"
    )

    with_metadata = ctes("metadata_target", "metadata_source")
    sql["merge_metadata"] = with_metadata + (
        " SELECT coalesce(t.id, s.id) AS id, coalesce(s.name, t.name) AS name, "
        "coalesce(s.type, t.type) AS type, coalesce(s.size, t.size) AS size "
        "FROM metadata_target t FULL OUTER JOIN "
        "(SELECT * FROM metadata_source WHERE id IS NOT NULL) s ON t.id = s.id"
    )
    sql["merge_metadata_shuffled"] = sql["merge_metadata"]
    upsert = (
        "SELECT coalesce(t.id, s.id) AS id, coalesce(s.name, t.name) AS name, "
        "coalesce(s.type, t.type) AS type, coalesce(s.size, t.size) AS size "
        "FROM {} t FULL OUTER JOIN (SELECT * FROM {} WHERE id IS NOT NULL) s ON t.id = s.id"
    )
    files = (
        ",\nfile0 AS (SELECT * FROM metadata_source)"
        ",\nfile1 AS (SELECT id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS type, "
        "size + 1 AS size FROM metadata_source WHERE id % 2 = 0)"
        ",\nfile2 AS (SELECT id + 7 AS id, name, type, size FROM metadata_source)"
        f",\nafter0 AS ({upsert.format('metadata_target', 'file0')})"
        f",\nafter1 AS ({upsert.format('after0', 'file1')})"
    )
    sql["merge_files"] = with_metadata + files + " " + upsert.format("after1", "file2")
    sql["merge_files_shuffled"] = sql["merge_files"]
    sql["merge_files_counts"] = with_metadata + files + " " + " UNION ALL ".join(
        f"SELECT CAST({n} AS INT) AS file, count(*) AS total, count(*) FILTER (WHERE id IS NOT NULL "
        f"AND id NOT IN (SELECT id FROM {before} WHERE id IS NOT NULL)) AS created, "
        f"count(*) FILTER (WHERE id IN (SELECT id FROM {before} WHERE id IS NOT NULL)) AS updated, "
        f"CAST(0 AS BIGINT) AS deleted, count(*) FILTER (WHERE id IS NULL) AS ignored FROM file{n}"
        for n, before in enumerate(("metadata_target", "after0", "after1"))
    )
    sql["merge_summary"] = with_metadata + (
        " SELECT count(*) AS total, "
        "count(*) FILTER (WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM metadata_target)) "
        "AS created, "
        "count(*) FILTER (WHERE id IN (SELECT id FROM metadata_target)) AS updated, "
        "CAST(0 AS BIGINT) AS deleted, count(*) FILTER (WHERE id IS NULL) AS ignored "
        "FROM metadata_source"
    )

    sql["redact_credentials"] = ctes("connection_log") + (
        " SELECT page_id, regexp_replace(line, '://(.*?):(.*?)@', '://\\1:PASSWORD@', 'g') "
        "AS line FROM connection_log"
    )
    sql["url_segments"] = "SELECT page_id, split_part(url, '/', -1) AS segment FROM pages"
    sql["event_stamps"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M') AS stamp FROM events"
    )
    sql["role_arrays"] = (
        "SELECT o_orderkey, substr(o_orderpriority, 1, 1) || ',' || o_orderstatus "
        "|| CASE WHEN o_orderstatus <> 'F' THEN ',F' ELSE '' END "
        "|| CASE WHEN substr(o_orderpriority, 1, 1) <> '1' THEN ',1' ELSE '' END AS held, "
        "concat_ws(',', CASE WHEN substr(o_orderpriority, 1, 1) <> '1' "
        "THEN substr(o_orderpriority, 1, 1) END, "
        "CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END) AS remaining FROM orders"
    )
    return sql
