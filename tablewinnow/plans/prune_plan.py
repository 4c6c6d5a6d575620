"""All removals of a rule file as one plan per table.

Removal conditions read only metadata and keys that no rule changes, so rules
commute and every key set can be resolved from the input. The rules that bear
on a fact table are fused: the table is scanned once, whatever their number,
and rows are dropped or edited on the way. Inputs are never modified; a plan
yields the retained rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewinnow.functions.jsonkeys import any_of, stripped, top_keys
from tablewinnow.operators.empty import without_rows
from tablewinnow.operators.marks import (
    WORD_BITS,
    bit,
    element_marks,
    matched_words,
    names,
    place_marks,
    program_marks,
    stage_marks,
    word,
)
from tablewinnow.operators.matching import (
    KeySet,
    attach,
    drop_matching,
    keep_matching,
    key_set,
)
from tablewinnow.plans.rules import DATASETS, TRACKERS, Department, Removal, Rule, plan_removals
from tablewinnow.profile import DEPENDENT_TABLES, HEALTH_RECORDS, Fact, Profile
from tablewinnow.settings import concurrently

_MATCHED = "matched"
_PLACE = "_tw_place"
_OWN = "_tw_own_keys"
_KEYS = "_tw_keys"
_EDITED = "_tw_edited"


class FactPlan:
    """The removals that bear on one fact table."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        fact: Fact,
        removals: Sequence[Removal],
        profile: Profile,
    ):
        self.tables = tables
        self.fact = fact
        self.removals = list(removals)
        self.profile = profile

    @cached_property
    def _item_marks(self) -> KeySet:
        resolve = element_marks if self.fact is self.profile.values else stage_marks
        return KeySet(resolve(self.tables, self.removals, self.profile))

    @cached_property
    def _place_marks(self) -> KeySet | None:
        marks = place_marks(self.tables, self.removals, self.profile)
        if marks is None:
            return None
        return KeySet(marks.withColumnRenamed(self.profile.org_unit.key, _PLACE))

    def resolve(self) -> None:
        """Compute the marks; item and place marks do not depend on each other."""
        concurrently(lambda: self._item_marks, lambda: self._place_marks)

    @cached_property
    def marked(self) -> DataFrame:
        """The fact rows with the removals each is subject to."""
        self.resolve()
        n = len(self.removals)
        fact = self.tables[self.fact.table]
        rows = attach(fact, self._item_marks, self.fact.item)
        if self._place_marks is not None:
            # Where something happened only matters for rows that some removal
            # selects by item. The others have no place to look up, and if place
            # marks are too many to broadcast, they are not shuffled for them.
            place = F.col(self.fact.place)
            selected = F.col(names("item", n)[0]).isNotNull()
            rows = rows.withColumn(_PLACE, F.when(selected, place))
            rows = attach(rows, self._place_marks, _PLACE)
        found = matched_words(self.removals, self._place_marks is not None)
        matched = [m.alias(c) for m, c in zip(found, names(_MATCHED, n))]
        rows = rows.select(*fact.columns, *matched)
        return self._edited(rows) if self._stripping else rows

    @cached_property
    def _stripping(self) -> list[int]:
        return [i for i, r in enumerate(self.removals) if r.strips]

    def _edited(self, rows: DataFrame) -> DataFrame:
        """Documents some removal may edit, parsed once: their keys, and where a key goes, the
        new document. It is null where the text is no whole object, which is left alone."""
        document = F.col(self.fact.document)
        own = F.when(F.size(_KEYS) > 0, top_keys(document))
        edited = F.when(any_of(F.col(_OWN), F.col(_KEYS)), stripped(document, F.col(_KEYS)))
        return (
            rows.withColumn(_KEYS, self._stripped_keys())
            .withColumn(_OWN, own)
            .withColumn(_EDITED, edited)
        )

    def _has(self, index: int) -> Column:
        return bit(F.col(names(_MATCHED, len(self.removals))[index // WORD_BITS]), index)

    def _hit(self, index: int) -> Column:
        """Rows a removal acts on: those it deletes, or whose document it edits."""
        removal = self.removals[index]
        if not removal.strips:
            return self._has(index)
        keys = F.array(*[F.lit(key) for key in removal.elements])
        return self._has(index) & any_of(F.col(_OWN), keys) & F.col(_EDITED).isNotNull()

    def _deleted(self) -> Column:
        n = len(self.removals)
        deleting = [i for i, r in enumerate(self.removals) if not r.strips]
        conditions = [
            F.col(name).bitwiseAND(F.lit(word(deleting, w)).cast("long")) != 0
            for w, name in enumerate(names(_MATCHED, n))
            if word(deleting, w)
        ]
        return reduce(lambda a, b: a | b, conditions, F.lit(False))

    def _stripped_keys(self) -> Column:
        """The keys all matching removals take out of a row's document."""
        none = F.array().cast("array<string>")
        keys = [
            F.when(
                self._has(i), F.array(*[F.lit(key) for key in self.removals[i].elements])
            ).otherwise(none)
            for i in self._stripping
        ]
        return F.array_distinct(F.concat(*keys))

    def counts(self) -> list[Column]:
        """Rows each removal acts on. A row hit by two removals counts for both."""
        return [
            F.count_if(self._hit(i)).alias(self.label(i)) for i in range(len(self.removals))
        ]

    def label(self, index: int) -> str:
        """Name of a removal's count: its rule, its family and its place in the list."""
        return f"rule_{self.removals[index].rule}_{self.removals[index].family}_{index}"

    def retained(self, observation: Observation | None = None) -> DataFrame:
        """The rows that stay. An observation receives the counts in the same pass."""
        if not self.removals:
            return self.tables[self.fact.table]
        rows = self.marked
        if observation is not None:
            rows = rows.observe(observation, *self.counts())
        rows = rows.filter(~self._deleted())
        if self._stripping:
            document = self.fact.document
            rows = rows.withColumn(document, F.coalesce(F.col(_EDITED), F.col(document)))
        return rows.select(*self.tables[self.fact.table].columns)

    def rule_counts(self) -> DataFrame:
        """One row per removal: rule, family and the rows it acts on."""
        totals = self.marked.agg(*self.counts())
        entries = [
            F.struct(
                F.lit(r.rule).cast("int").alias("rule"),
                F.lit(r.family).alias("family"),
                F.col(self.label(i)).alias("matched_rows"),
            )
            for i, r in enumerate(self.removals)
        ]
        return totals.select(F.inline(F.array(*entries)))


class PrunePlan:
    """What a list of removals leaves of a table set.

    ``tables`` maps names to DataFrames; only those a table's plan needs are
    looked up. ``cleared`` names tables that are emptied first. Key sets are
    resolved when a table first needs them, from the input and once for all
    tables, so the outcome does not depend on what is written in between.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        removals: Sequence[Removal],
        profile: Profile = HEALTH_RECORDS,
        cleared: Sequence[str] = (),
    ):
        self.source = tables
        self.profile = profile
        self.cleared = frozenset(cleared)
        self.removals = list(removals)
        datasets = [r for r in self.removals if r.family == DATASETS]
        programs = [r for r in self.removals if r.family != DATASETS]
        self.values = FactPlan(tables, profile.values, datasets, profile)
        self.events = FactPlan(tables, profile.events, programs, profile)
        self.full_datasets = [r for r in datasets if r.full]
        self.full_programs = [r for r in programs if r.full]
        self.full_trackers = [r for r in self.full_programs if r.family == TRACKERS]

    @cached_property
    def removed_elements(self) -> KeySet:
        marks = element_marks(self.source, self.full_datasets, self.profile)
        return KeySet(marks.select(self.profile.element.key))

    @cached_property
    def removed_events(self) -> KeySet:
        """Keys of all events of the programs that are removed in full."""
        fact = self.profile.events
        stages = KeySet(stage_marks(self.source, self.full_programs, self.profile))
        events = keep_matching(self.source[fact.table], stages, fact.item)
        return KeySet(events.select(fact.key))

    @cached_property
    def removed_programs(self) -> KeySet:
        marks = program_marks(self.source, self.full_trackers, self.profile)
        key = F.col(self.profile.program.key)
        return KeySet(marks.select(key.alias(self.profile.enrolment.program)))

    @cached_property
    def removed_entities(self) -> KeySet:
        """Entities enrolled in a tracker program that is removed in full."""
        enrolment = self.profile.enrolment
        enrolled = keep_matching(
            self.source[enrolment.table], self.removed_programs, enrolment.program
        )
        return key_set(enrolled, enrolment.entity)

    def table(self, name: str, observation: Observation | None = None) -> DataFrame:
        """The retained rows of one table."""
        df = self.source[name]
        profile = self.profile
        if name in self.cleared:
            return without_rows(df)
        if name == profile.values.table:
            return self.values.retained(observation)
        if name == profile.events.table:
            return self.events.retained(observation)
        if name in profile.values.dependents and self.full_datasets:
            return drop_matching(df, self.removed_elements, profile.element.key)
        if name in profile.events.dependents and self.full_programs:
            return drop_matching(df, self.removed_events, profile.events.key)
        if self.full_trackers:
            enrolment = profile.enrolment
            if name == enrolment.table:
                others = drop_matching(df, self.removed_programs, enrolment.program)
                return drop_matching(others, self.removed_entities, enrolment.entity)
            if name in enrolment.entity_tables:
                return drop_matching(df, self.removed_entities, enrolment.entity)
        return df

    def resolve(self) -> None:
        """Compute the key sets the tables at hand need, side by side."""
        at_hand = set(self.source) - self.cleared
        enrolment = self.profile.enrolment
        jobs = [
            plan.resolve
            for plan in (self.values, self.events)
            if plan.removals and plan.fact.table in at_hand
        ]
        if self.full_datasets and at_hand & set(self.profile.values.dependents):
            jobs.append(lambda: self.removed_elements)
        if self.full_programs and at_hand & set(self.profile.events.dependents):
            jobs.append(lambda: self.removed_events)
        if self.full_trackers and at_hand & {enrolment.table, *enrolment.entity_tables}:
            jobs.append(lambda: self.removed_entities)
        concurrently(*jobs)

    def tables(self) -> dict[str, DataFrame]:
        self.resolve()
        return {name: self.table(name) for name in self.source}


def apply_rules(
    tables: Mapping[str, DataFrame],
    departments: Sequence[Department],
    rules: Sequence[Rule],
    profile: Profile = HEALTH_RECORDS,
) -> tuple[PrunePlan, list[Rule]]:
    """Plan a whole rule file: dependents are cleared first, then every removal
    applies. Also returns the rules whose department is unknown."""
    removals, unmatched = plan_removals(departments, rules)
    return PrunePlan(tables, removals, profile, cleared=DEPENDENT_TABLES), unmatched
