"""Text to typed values. Text that does not parse becomes null and never fails
the job, whatever ``spark.sql.ansi.enabled`` says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(text: Column) -> Column:
    """``"NaN"`` is a number here, as it is for Spark's own cast."""
    return text.try_cast("double")


def to_timestamp(text: Column) -> Column:
    """Text without an offset is read in the session time zone. Text without a date is no timestamp:
    Spark would put the day of the run before it, and a later run would give another value."""
    return F.try_to_timestamp(F.regexp_extract(text, r"(?s)^\s*[+-]?\d{4,6}(-.*|\s*)$", 0))


def to_date(text: Column) -> Column:
    return F.try_to_date(text)


def to_boolean(text: Column) -> Column:
    """True for the text "true" in any case, null for null, false for anything else."""
    return F.lower(text) == F.lit("true")


_PARSERS = {
    T.DoubleType(): to_double,
    T.TimestampType(): to_timestamp,
    T.DateType(): to_date,
    T.BooleanType(): to_boolean,
    T.StringType(): lambda text: text,
}


def parse(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` as ``target``: values of that type pass through, others go by way of text."""
    if source == target:
        return column
    if target not in _PARSERS:
        raise TypeError(f"no parser for {target.simpleString()}")
    return _PARSERS[target](column.cast("string"))
