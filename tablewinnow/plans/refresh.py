"""One configuration file from end to end: select the tables to clone, apply the
rules and the access entries, and write the outcome as a new table set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from tablewinnow.plans.access_plan import (
    AccessState,
    apply_access_rules,
    load_entries,
    needed_tables,
    read_imports,
    skipped_entries,
)
from tablewinnow.plans.prune_plan import PrunePlan, apply_rules
from tablewinnow.plans.rules import Rule, load_config, load_rules
from tablewinnow.profile import ACCESS_TABLES, HEALTH_RECORDS, Profile
from tablewinnow.sources.tableset import TableSource, selected_names, write_tables
# Shapes of the access tables, for a source without them.
EMPTY = {
    "users": "id string, username string, disabled boolean",
    "members": "group_name string, user_id string",
    "roles": "id string, name string",
    "links": "user_id string, role_id string",
}


@dataclass(frozen=True)
class Outcome:
    folder: str
    unmatched: tuple[Rule, ...]
    matched_rows: Mapping[str, int]
    # Access entries that were not applied, and what each import did.
    skipped: tuple[Mapping | str, ...] = ()
    imports: tuple[tuple[str, str, Mapping[str, int]], ...] = ()
    # What each other access entry did: (its place in the list, action, counts).
    entries: tuple[tuple[int, str, Mapping[str, int]], ...] = ()


def _pruned(plan: PrunePlan) -> tuple[dict[str, DataFrame], list[Observation]]:
    """The pruned tables, and the counts that writing the fact tables will fill in."""
    tables, observations = plan.tables(), []
    for fact in (plan.values, plan.events):
        if fact.removals and fact.fact.table in plan.source:
            observation = Observation()
            tables[fact.fact.table] = plan.table(fact.fact.table, observation)
            observations.append(observation)
    return tables, observations


def refresh(
    spark: SparkSession,
    config: str,
    source: TableSource,
    folder: str,
    operator_user: str,
    import_folder: str | None = None,
    profile: Profile = HEALTH_RECORDS,
) -> Outcome:
    """Write to ``folder`` what the configuration makes of the source tables.

    The source is only read. Without a list of rules nothing is removed or emptied. Rows
    matched per removal are counted while the fact tables are written; a row hit by two
    removals counts for both. Import entries read their documents from ``import_folder``
    and merge each list of objects into the table it describes. A table that an entry
    needs and the source lacks is an error.
    """
    settings = load_config(spark, config)
    tables = {name: source.read(name) for name in selected_names(source.names())}
    outcome, unmatched, observations = dict(tables), [], []
    if "preprocess" in settings:
        departments, rules = load_rules(spark, config)
        plan, unmatched = apply_rules(tables, departments, rules, profile)
        outcome, observations = _pruned(plan)

    entries = load_entries(spark, config)
    imports, done = (), ()
    if entries:
        missing = sorted(needed_tables(entries) - set(outcome))
        if missing:
            raise ValueError(f"access entries need tables that the source lacks: {missing}")
        parts = {
            part: outcome.get(table, spark.createDataFrame([], EMPTY[part]))
            for part, table in ACCESS_TABLES.items()
        }
        others = {n: df for n, df in outcome.items() if n not in ACCESS_TABLES.values()}
        state = AccessState(**parts, metadata=others)
        sources = read_imports(spark, entries, import_folder) if import_folder else {}
        after = apply_access_rules(state, entries, operator_user, sources)
        changed = {
            table: getattr(after, part)
            for part, table in ACCESS_TABLES.items()
            if table in outcome or getattr(after, part) is not parts[part]
        }
        outcome = {**after.metadata, **changed}
        imports, done = after.imports, after.counts

    write_tables(outcome, folder)
    matched = {name: n for o in observations for name, n in o.get.items()}
    skipped = tuple(skipped_entries(entries))
    return Outcome(folder, tuple(unmatched), matched, skipped, imports, done)
