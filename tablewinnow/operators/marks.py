"""Rule marks: which rules a key is subject to, as bit masks.

Each removal gets one bit. A data element, program stage or org unit carries
the bits of all removals that select it, so any number of rules is checked
against a fact row with two lookups and one bitwise AND. Marks are built on
metadata tables only and hold one row per key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewinnow.functions.paths import proper_prefixes
from tablewinnow.operators.matching import KeySet, attach
from tablewinnow.plans.rules import Removal
from tablewinnow.profile import Profile

# Bits per long column; more removals take more columns.
WORD_BITS = 62
# Uids that are written into a plan; more are a table that is joined.
LITERAL_UIDS = 1000

_UID = "_tw_uid"


def words(count: int) -> int:
    return max(1, -(-count // WORD_BITS))


def word(indexes: Iterable[int], w: int) -> int:
    """Word ``w`` of the mask with the given bits."""
    return sum(1 << (i - w * WORD_BITS) for i in set(indexes) if i // WORD_BITS == w)


def names(prefix: str, count: int) -> list[str]:
    return [f"_tw_{prefix}{w}" for w in range(words(count))]


def lookup(uid: Column, bits: Mapping[str, set[int]], w: int) -> Column:
    """Word ``w`` of the mask a uid carries. Uids come from the rule file, so the
    mapping is written into the plan and needs no join."""
    by_value: dict[int, list[str]] = {}
    for name, indexes in bits.items():
        value = word(indexes, w)
        if value:
            by_value.setdefault(value, []).append(name)
    branches = F.lit(0).cast("long")
    if by_value:
        items = iter(by_value.items())
        value, uids = next(items)
        case = F.when(uid.isin(uids), F.lit(value).cast("long"))
        for value, uids in items:
            case = case.when(uid.isin(uids), F.lit(value).cast("long"))
        branches = case.otherwise(branches)
    return branches


def looked_up(
    df: DataFrame, column: str, bits: Mapping[str, set[int]], prefix: str, n: int
) -> DataFrame:
    """``df`` with the mask that the text in ``column`` carries, zero for others; a few texts are
    literals, many are a measured table."""
    if len(bits) > LITERAL_UIDS:
        rows = [(u, *(word(own, w) for w in range(words(n)))) for u, own in sorted(bits.items())]
        schema = ", ".join([f"{_UID} string", *(f"{c} long" for c in names(prefix, n))])
        marks = KeySet(df.sparkSession.createDataFrame(rows, schema))
        joined = attach(df.withColumn(_UID, F.col(column)), marks, _UID).drop(_UID)
        return joined.fillna(0, names(prefix, n))
    masks = [lookup(F.col(column), bits, w).alias(c) for w, c in enumerate(names(prefix, n))]
    return df.select("*", *[F.coalesce(m, F.lit(0).cast("long")).alias(c) for m, c in zip(masks, names(prefix, n))])


def any_of_both(left: str, right: str, n: int) -> Column:
    """Whether two masks have a bit in common; null is an empty mask."""
    shared = [
        F.coalesce(F.col(a).bitwiseAND(F.col(b)) != 0, F.lit(False))
        for a, b in zip(names(left, n), names(right, n))
    ]
    return reduce(lambda a, b: a | b, shared)


def any_among(prefix: str, indexes: Iterable[int], n: int) -> Column:
    """Whether a mask has one of the bits; null is an empty mask."""
    indexes = list(indexes)
    found = [
        F.coalesce(F.col(c).bitwiseAND(F.lit(word(indexes, w)).cast("long")) != 0, F.lit(False))
        for w, c in enumerate(names(prefix, n))
    ]
    return reduce(lambda a, b: a | b, found)


def _bits(lists: Iterable[tuple[int, Iterable[str]]]) -> dict[str, set[int]]:
    bits: dict[str, set[int]] = {}
    for index, uids in lists:
        for uid in uids:
            bits.setdefault(uid, set()).add(index)
    return bits


def _carried(
    df: DataFrame, key: Column, uid: Column, masks: Mapping[str, Mapping[str, set[int]]], n: int
) -> DataFrame:
    """``key`` and mask columns of the rows whose uid some rule mentions.

    A few uids are literals, which a scan can filter by. Many would make a plan that takes longer than
    the query; they are rows of uid and masks, measured like any key set."""
    mentioned = sorted({u for bits in masks.values() for u in bits})
    if len(mentioned) > LITERAL_UIDS:
        return _joined(df, key, uid, masks, mentioned, n)
    columns = [
        lookup(uid, bits, w).alias(name)
        for prefix, bits in masks.items()
        for w, name in enumerate(names(prefix, n))
    ]
    return df.filter(uid.isin(mentioned)).select(key, *columns)


def _joined(
    df: DataFrame,
    key: Column,
    uid: Column,
    masks: Mapping[str, Mapping[str, set[int]]],
    mentioned: Sequence[str],
    n: int,
) -> DataFrame:
    columns = [name for prefix in masks for name in names(prefix, n)]
    rows = [
        (u, *(word(bits.get(u, ()), w) for bits in masks.values() for w in range(words(n))))
        for u in mentioned
    ]
    schema = ", ".join([f"{_UID} string", *(f"{c} long" for c in columns)])
    marks = KeySet(df.sparkSession.createDataFrame(rows, schema))
    kept = df.select(key, uid.alias(_UID))
    return attach(kept, marks, _UID).dropna(subset=columns[:1]).drop(_UID)


def _merge(df: DataFrame, key: str, prefixes: Sequence[str], n: int) -> DataFrame:
    """One row per key, with the bits of all its rows."""
    return df.groupBy(key).agg(
        *[F.bit_or(name).alias(name) for prefix in prefixes for name in names(prefix, n)]
    )


def _satisfied(prefix: str, demanded: Iterable[int], n: int, w: int) -> Column:
    """Bits that are set in ``prefix`` or whose removal does not demand them."""
    demanded = set(demanded)
    free = word((i for i in range(n) if i not in demanded), w)
    carried = F.coalesce(F.col(names(prefix, n)[w]), F.lit(0).cast("long"))
    return carried.bitwiseOR(F.lit(free).cast("long"))


def _finish(df: DataFrame, key: str, out: str, masks: list[Column], n: int) -> DataFrame:
    columns = names(out, n)
    some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in columns])
    return df.select(key, *[m.alias(c) for m, c in zip(masks, columns)]).filter(some)


def element_marks(
    tables: Mapping[str, DataFrame], removals: Sequence[Removal], profile: Profile
) -> DataFrame:
    """Data element -> removals whose data sets and data elements select it.

    A value does not say which data set it was entered through, so membership of
    the element decides: in the department's data sets, and in the selected ones
    if there are any, and among the selected elements if there are any.
    """
    n = len(removals)
    dataset, element = profile.dataset, profile.element
    scope = [(i, r.scope) for i, r in enumerate(removals)]
    picked = [(i, r.selected) for i, r in enumerate(removals) if r.selected]
    named = [(i, r.elements) for i, r in enumerate(removals) if r.elements]

    datasets = _carried(
        tables[dataset.table],
        F.col(dataset.key),
        F.col(dataset.uid),
        {"scope": _bits(scope), "picked": _bits(picked)},
        n,
    )
    members = tables[profile.dataset_element].select(dataset.key, element.key)
    marks = _merge(members.join(datasets, dataset.key), element.key, ["scope", "picked"], n)
    if named:
        elements = _carried(
            tables[element.table],
            F.col(element.key),
            F.col(element.uid),
            {"named": _bits(named)},
            n,
        )
        marks = marks.join(_merge(elements, element.key, ["named"], n), element.key, "left")
    masks = []
    for w in range(words(n)):
        mask = F.col(names("scope", n)[w]).bitwiseAND(
            _satisfied("picked", [i for i, _ in picked], n, w)
        )
        if named:
            mask = mask.bitwiseAND(_satisfied("named", [i for i, _ in named], n, w))
        masks.append(mask)
    return _finish(marks, element.key, "item", masks, n)


def program_marks(
    tables: Mapping[str, DataFrame], removals: Sequence[Removal], profile: Profile
) -> DataFrame:
    """Program -> removals that concern it."""
    n = len(removals)
    program = profile.program
    carried = _carried(
        tables[program.table],
        F.col(program.key),
        F.col(program.uid),
        {"item": _bits((i, r.programs) for i, r in enumerate(removals))},
        n,
    )
    return _merge(carried, program.key, ["item"], n)


def stage_marks(
    tables: Mapping[str, DataFrame], removals: Sequence[Removal], profile: Profile
) -> DataFrame:
    """Program stage -> removals that concern its program."""
    stages = tables[profile.stage].select(profile.stage_key, profile.program.key)
    carried = stages.join(program_marks(tables, removals, profile), profile.program.key)
    return _merge(carried, profile.stage_key, ["item"], len(removals))


def place_marks(
    tables: Mapping[str, DataFrame], removals: Sequence[Removal], profile: Profile
) -> DataFrame | None:
    """Org unit -> removals that reach it; None when no removal names a place.

    Exact units and descendants given together are a conjunction.
    """
    n = len(removals)
    unit = profile.org_unit
    exact = [(i, r.units) for i, r in enumerate(removals) if r.units]
    below = [(i, r.units_below) for i, r in enumerate(removals) if r.units_below]
    if not exact and not below:
        return None
    units = tables[unit.table]
    nothing = [F.lit(0).cast("long").alias(c) for c in names("below", n)]
    reached = _carried(
        units, F.col(unit.key), F.col(unit.uid), {"exact": _bits(exact)}, n
    ).select("*", *nothing)
    if below:
        anchors = _merge(
            _carried(
                units, F.col(profile.path), F.col(unit.uid), {"below": _bits(below)}, n
            ).dropna(subset=[profile.path]),
            profile.path,
            ["below"],
            n,
        )
        levels = units.select(
            unit.key, F.explode(proper_prefixes(F.col(profile.path))).alias(profile.path)
        )
        nothing = [F.lit(0).cast("long").alias(c) for c in names("exact", n)]
        descendants = (
            attach(levels, KeySet(anchors), profile.path)
            .filter(F.col(names("below", n)[0]).isNotNull())
            .select(unit.key, *nothing, *names("below", n))
        )
        reached = reached.unionByName(descendants)
    marks = _merge(reached, unit.key, ["exact", "below"], n)
    placed = {i for i, _ in exact} | {i for i, _ in below}
    masks = [
        _satisfied("exact", [i for i, _ in exact], n, w)
        .bitwiseAND(_satisfied("below", [i for i, _ in below], n, w))
        .bitwiseAND(F.lit(word(placed, w)).cast("long"))
        for w in range(words(n))
    ]
    return _finish(marks, unit.key, "place", masks, n)


def matched_words(removals: Sequence[Removal], has_places: bool) -> list[Column]:
    """Per word, the removals a fact row with item and place marks is subject to."""
    n = len(removals)
    anywhere = [i for i, r in enumerate(removals) if not r.units and not r.units_below]
    result = []
    for w in range(words(n)):
        item = F.coalesce(F.col(names("item", n)[w]), F.lit(0).cast("long"))
        reach = F.lit(word(anywhere, w)).cast("long")
        if has_places:
            place = F.coalesce(F.col(names("place", n)[w]), F.lit(0).cast("long"))
            reach = place.bitwiseOR(reach)
        result.append(item.bitwiseAND(reach))
    return result


def bit(column: Column, index: int) -> Column:
    """Whether the bit of removal ``index`` is set in its word."""
    value = 1 << (index % WORD_BITS)
    return column.bitwiseAND(F.lit(value).cast("long")) != 0
