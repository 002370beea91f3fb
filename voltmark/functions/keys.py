"""Deterministic keys and ids, computed in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# RFC 4122 namespace for URLs, and the text between id parts.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
SEPARATOR = "::"


def surrogate_key(code: Column) -> Column:
    """32 hex digits of the MD5 of a business code; null stays null."""
    return F.md5(code)


def _joined(parts: tuple[Column, ...]) -> Column:
    """Parts joined with the separator; ``concat`` (not ``concat_ws``), so any null part gives null."""
    if not parts:
        raise ValueError("an id needs at least one part")
    texts = [p.cast("string") for p in parts]
    return reduce(lambda left, right: F.concat(left, F.lit(SEPARATOR), right), texts)


def stable_id63(*parts: Column) -> Column:
    """Positive 63-bit id: the leading 64 bits of the SHA-256, top bit cleared, never zero."""
    leading = F.conv(F.substring(F.sha2(_joined(parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    cleared = (leading % F.lit(str(2**63)).cast("decimal(20,0)")).cast("bigint")
    return F.when(cleared == 0, F.lit(1).cast("bigint")).otherwise(cleared)


def stable_uuid5(*parts: Column) -> Column:
    """RFC 4122 version 5 UUID of the parts in the URL namespace."""
    name = F.encode(_joined(parts), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), name))
    # The variant takes the two top bits of this digit: 8 + (digit mod 4), as text.
    position = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1
    variant = F.substring(F.lit("89ab"), position, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def ambiguous_ids(rows: DataFrame, parts: Sequence[str], make: Callable[..., Column] = stable_id63) -> DataFrame:
    """``id, first, second, cause`` for ids that rows with different ``parts`` share: the least and the greatest of their part
    lists, and whether it is the ``separator`` (``"a::b", "c"`` and ``"a", "b::c"`` are joined to one text) or the ``hash``.

    Rows with a null part have no id and are left out. Equal part lists are one, however many rows have them; they
    are combined before the shuffle, so a part list of many rows is one row for each task.
    """
    texts = [F.col(f"`{p}`").cast("string") for p in parts]
    lists = F.array(*texts)
    made = rows.select(make(*texts).alias("id"), lists.alias("parts"), _joined(tuple(texts)).alias("text")).filter("id IS NOT NULL")
    least, greatest = F.min("parts").alias("first"), F.max("parts").alias("second")
    shared = made.groupBy("id").agg(least, greatest, F.min("text").alias("low"), F.max("text").alias("high"))
    cause = F.when(F.col("low") == F.col("high"), "separator").otherwise("hash")
    return shared.filter("first <> second").select("id", "first", "second", cause.alias("cause"))
