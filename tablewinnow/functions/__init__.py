from tablewinnow.functions.arrays import array_minus, unique_by_field
from tablewinnow.functions.jsonkeys import has_any_key, without_keys
from tablewinnow.functions.paths import proper_prefixes
from tablewinnow.functions.text import last_segment, redact_credentials, stamp, view_name

__all__ = [
    "array_minus",
    "has_any_key",
    "last_segment",
    "proper_prefixes",
    "redact_credentials",
    "stamp",
    "unique_by_field",
    "view_name",
    "without_keys",
]
