"""Column functions: text parsing, keys and ids, labels and display."""

from voltmark.functions.display import display_number, has_value, labelled, safe_divide
from voltmark.functions.keys import ambiguous_ids, stable_id63, stable_uuid5, surrogate_key
from voltmark.functions.parse import parse, to_boolean, to_date, to_double, to_timestamp

__all__ = [
    "ambiguous_ids",
    "display_number",
    "has_value",
    "labelled",
    "parse",
    "safe_divide",
    "stable_id63",
    "stable_uuid5",
    "surrogate_key",
    "to_boolean",
    "to_date",
    "to_double",
    "to_timestamp",
]
