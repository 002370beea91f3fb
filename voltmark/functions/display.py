"""Labels, comparison with lists of values, safe ratios and number display."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(code: Column, labels: Mapping[str, str]) -> Column:
    """The label of a code, or the code itself where none is given."""
    if not labels:
        return code
    chain = None
    for value, text in labels.items():
        chain = F.when(code == value, text) if chain is None else chain.when(code == value, text)
    return chain.otherwise(code)


def has_value(column: Column, values: Sequence) -> Column:
    """Whether the column has one of the values; None among them asks for nulls."""
    present = [v for v in values if v is not None]
    return column.isin(present) | column.isNull() if len(present) < len(values) else column.isin(present)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null, not an error, when the denominator is zero or null."""
    return F.try_divide(numerator, denominator)


# Decimals shown by each number format a measure may carry.
FORMAT_DECIMALS = {"#,##0": 0, "#,##0.00": 2, "#,##0.000": 3}


def display_number(value: Column, number_format: str) -> Column:
    """The value as grouped text, e.g. ``1,234.50``. For presentation only."""
    if number_format not in FORMAT_DECIMALS:
        raise ValueError(f"unknown number format {number_format!r}; known: {', '.join(FORMAT_DECIMALS)}")
    return F.format_number(value, FORMAT_DECIMALS[number_format])
