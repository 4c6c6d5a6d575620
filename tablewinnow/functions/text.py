"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a credential looks like in a connection string, and what
# replaces it. (?d) makes "." stop at \n only.
CREDENTIAL = r"(?d)://(.*?):(.*?)@"
REDACTED = "://$1:PASSWORD@"

# Fixed value: minute-grained stamp used in snapshot names.
STAMP_FORMAT = "yyyy-MM-dd_HHmm"


def redact_credentials(line: Column) -> Column:
    """``://user:secret@`` becomes ``://user:PASSWORD@``, every time it occurs."""
    return F.regexp_replace(line, CREDENTIAL, REDACTED)


def view_name(name: Column) -> Column:
    """Name of the view generated for a stored SQL view; null for a null name."""
    underscored = F.replace(F.lower(name), F.lit(" "), F.lit("_"))
    return F.concat(F.lit("_view_"), F.replace(underscored, F.lit("_-_"), F.lit("_")))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)


def last_segment(text: Column, separator: str = "/") -> Column:
    return F.substring_index(text, separator, -1)
