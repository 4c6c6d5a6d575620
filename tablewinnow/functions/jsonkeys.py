"""Editing JSON objects kept as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What JSON takes for blank.
_BLANKS = " \t\n\r"

# Brackets and commas by themselves; strings and all else between them as one token. Joined,
# tokens are the document again. The quantifiers are possessive: a string of any length is
# matched in a loop, not by recursion.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKENS = rf'(?s)[{{}}\[\],]|(?:[^{{}}\[\],"]++|{_STRING})++|"'
_FIRST_STRING = rf"(?s)\A[{_BLANKS}]*+({_STRING})"

# A value in brackets of at most so many levels, which is all of most documents.
_LEVELS_MATCHED = 16
_NESTED = "(?!)"
for _ in range(_LEVELS_MATCHED):
    _NESTED = rf'[{{\[](?:[^{{}}\[\]"]++|{_STRING}|{_NESTED})*+[}}\]]'
_VALUE = rf'(?:[^{{}}\[\],"]++|{_STRING}|{_NESTED})++'
_SHALLOW = rf"(?s){_VALUE}"

# Documents of more bytes are cut into pieces of so many entries, in which the unwanted ones are
# matched: an array of millions of entries takes several times the text. That needs keys without
# escapes.
_WIDE = 1 << 16
_PLAIN = rf'[{_BLANKS}]*+"[^"\\]*+"{_VALUE}'
_PIECE = rf"(?s)\G(?:{_PLAIN}(?:,|\z)){{1,4096}}+"

# Spark's trim of given characters notes the place of every character, eight bytes for each byte of
# the text. So it gets an end of so many characters.
_END = 1024

# Sums are run over blocks of so many, and over the blocks' sums in the same way: work grows with
# the number of tokens, not with its square. Four levels reach 64^4 tokens.
_BLOCK = 64
_LEVELS = 3


def top_keys(document: Column) -> Column:
    """The keys of the object at its top level; null for null, malformed or non-object text."""
    return F.json_object_keys(document)


def has_any_key(document: Column, keys: Column) -> Column:
    """True when the object has one of ``keys`` at its top level, whatever the
    value, JSON null included. False for null, malformed or non-object text."""
    return any_of(top_keys(document), keys)


def any_of(own: Column, keys: Column) -> Column:
    """Whether the keys of an object have one of ``keys`` among them."""
    return F.coalesce(F.arrays_overlap(own, keys), F.lit(False))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blanks(text: Column, end: Callable[..., Column], trim: Callable[..., Column]) -> Column:
    """How many blanks there are at an end of a text."""

    def count(part: Column) -> Column:
        bare = _let(trim(part, F.lit(_BLANKS)), F.length)
        return _let(bare, lambda n: F.when(n > 0, F.length(part) - n))

    return F.coalesce(_let(end(text, F.lit(_END)), count), count(text), F.length(text))


def _blanks_before(text: Column) -> Column:
    return _blanks(text, F.left, F.ltrim)


def _blanks_after(text: Column) -> Column:
    return _blanks(text, F.right, F.rtrim)


def _trimmed(text: Column) -> Column:
    """The text without blanks at its ends."""

    def between(before: Column) -> Column:
        return F.substring(text, before + 1, F.length(text) - before - _blanks_after(text))

    return _let(_blanks_before(text), between)


def _sums_of_block(values: Column) -> Column:
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("sums"))

    def add(now: Column, value: Column) -> Column:
        total = now["sum"] + value
        return F.struct(
            total.alias("sum"), F.concat(now["sums"], F.array(total)).alias("sums")
        )

    return F.aggregate(values, start, add, lambda last: last["sums"])


def running_sums(values: Column, levels: int = _LEVELS) -> Column:
    """For each number of an array the sum up to it, in time linear in its length."""
    if not levels:
        return _sums_of_block(values)

    def by_blocks(all_values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / _BLOCK).cast("int"))
        blocks = F.transform(
            numbers, lambda b: _sums_of_block(F.slice(all_values, b * _BLOCK + 1, F.lit(_BLOCK)))
        )
        return _let(blocks, shifted)

    def shifted(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.element_at(block, -1))
        return _let(
            running_sums(totals, levels - 1),
            lambda before: F.flatten(
                F.transform(
                    blocks,
                    lambda block, i: _let(
                        F.coalesce(F.get(before, i - 1), F.lit(0)),
                        lambda shift: F.transform(block, lambda s: s + shift),
                    ),
                )
            ),
        )

    return _let(
        values,
        lambda v: F.when(F.size(v) <= _BLOCK, _sums_of_block(v)).otherwise(by_blocks(v)),
    )


def _inner(document: Column) -> Column:
    """What stands between the braces at the ends of a document; null if there are none."""

    def inside(text: Column) -> Column:
        closed = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")) & (F.octet_length(text) > 1)
        return F.when(closed, F.substring(text, F.lit(2), F.length(text) - 2))

    return _let(_trimmed(document), inside)


def entries_of(document: Column) -> Column:
    """The top-level entries of a JSON object in order, each as it is written; null for text
    whose brackets do not make it one object. An entry ends at a comma outside nested objects
    and arrays.

    Entries of a few levels of brackets are matched at once. Where that does not give the whole
    text again, there are more levels, and commas are told apart by their depth."""

    def matched(inner: Column) -> Column:
        shallow = F.regexp_extract_all(inner, F.lit(_SHALLOW), F.lit(0))
        deep = _by_depth(F.concat(F.lit("{"), inner, F.lit("}")))
        return _let(shallow, lambda e: F.when(F.array_join(e, ",") == inner, e).otherwise(deep))

    return _let(_inner(document), matched)


def _by_depth(text: Column) -> Column:
    """The entries of an object of any depth."""

    def change(token: Column) -> Column:
        return F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)

    def cut(tokens: Column, depth: Column) -> Column:
        n = F.size(tokens)
        # One object: it opens first, and closes last and not before.
        whole = (
            (F.get(tokens, F.lit(0)) == "{")
            & (F.get(tokens, n - 1) == "}")
            & (F.get(depth, n - 1) == 0)
            & (F.array_min(F.slice(depth, 1, n - 1)) > 0)
        )
        commas = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (F.get(tokens, i) == ",") & (F.get(depth, i) == 1)
        )
        bounds = F.concat(F.array(F.lit(0)), commas, F.array(n - 1))
        return F.when(whole, _let(bounds, lambda at: between(tokens, at)))

    def between(tokens: Column, at: Column) -> Column:
        def entry(start: Column, number: Column) -> Column:
            own = F.slice(tokens, start + 2, F.get(at, number + 1) - start - 1)
            return F.array_join(own, "")

        return F.transform(F.slice(at, 1, F.size(at) - 1), entry)

    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    return _let(
        tokens,
        lambda t: _let(running_sums(F.transform(t, change)), lambda depth: cut(t, depth)),
    )


def without_keys(document: Column, keys: Column) -> Column:
    """The object without ``keys``, all other entries as they are written: numbers of any
    length, blanks, escapes and repeated keys included, and blanks around the object. Text that has
    none of the keys at its top level, and text that is no well-formed object, is returned byte for
    byte. Well-formed is what Spark's JSON reader takes: it knows limits, such as a depth of 1000."""
    return F.coalesce(
        F.when(has_any_key(document, keys), stripped(document, keys)), document
    )


def stripped(document: Column, keys: Column) -> Column:
    """As ``without_keys``, for documents that have one of the keys; null if they are no object."""
    wide = F.octet_length(document) > _WIDE

    def inside(inner: Column) -> Column:
        pieces = F.regexp_extract_all(inner, F.lit(_PIECE), F.lit(0))

        def matched(found: Column) -> Column:
            size = F.aggregate(found, F.lit(0), lambda n, piece: n + F.octet_length(piece))
            return F.when(size == F.octet_length(inner), _without_matched(found, keys))

        return F.coalesce(F.when(wide, _let(pieces, matched)), _without_entries(document, keys))

    before = F.left(document, _blanks_before(document))
    after = F.right(document, _blanks_after(document))
    kept = _let(_let(_inner(document), inside), _trimmed)
    return F.concat(before, F.lit("{"), kept, F.lit("}"), after)


def _without_entries(document: Column, keys: Column) -> Column:
    """The entries but those of ``keys``, joined; null if the document is no object."""
    kept = F.filter(
        entries_of(document),
        lambda e: ~F.coalesce(F.array_contains(keys, _key_of(e)), F.lit(False)),
    )
    return F.array_join(kept, ",")


def _without_matched(pieces: Column, keys: Column) -> Column:
    """As ``_without_entries``, of pieces whose entries have keys without escapes. No quote or
    backslash is in such a key, so no other key is looked for."""
    plain = F.filter(keys, lambda k: ~F.contains(k, F.lit('"')) & ~F.contains(k, F.lit("\\")))
    any_key = F.concat(F.array(F.lit("(?!)")), F.transform(plain, _quoted))
    unwanted = F.concat(F.lit(rf'(?![{_BLANKS}]*+"(?:'), F.array_join(any_key, "|"), F.lit(')")'))
    entry = F.lit(rf"{_PLAIN}(?:,|\z)")
    # Entries to keep are matched many at a time, others one at a time.
    pattern = F.concat(F.lit(r"(?s)\G(?:((?:"), unwanted, entry, F.lit(")++)|"), entry, F.lit(")"))
    kept = F.transform(pieces, lambda piece: F.regexp_replace(piece, pattern, F.lit("$1")))
    return _let(
        F.array_join(kept, ""),
        lambda k: F.when(F.endswith(k, F.lit(",")), F.left(k, F.length(k) - 1)).otherwise(k),
    )


def _quoted(key: Column) -> Column:
    """A pattern of the text itself, which has no backslash."""
    return F.concat(F.lit(r"\Q"), key, F.lit(r"\E"))


def _key_of(entry: Column) -> Column:
    """The key of an entry: the string it begins with, as text. Without a backslash it is what
    stands between the first two quotes."""
    plain = F.substring_index(F.substring_index(entry, '"', 2), '"', -1)
    key = F.regexp_extract(entry, _FIRST_STRING, 1)
    parsed = F.get(F.from_json(F.concat(F.lit("["), key, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(F.contains(plain, F.lit("\\")), parsed).otherwise(plain)
