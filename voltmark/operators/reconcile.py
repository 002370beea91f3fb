"""Two states of a table compared by checksums, level by level."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differing(left: DataFrame, right: DataFrame, levels: Sequence[Sequence[Column]], columns: Sequence[str]) -> DataFrame:
    """The groups of the last level in which two tables hold different rows: the columns of all levels, and ``left_rows`` and
    ``right_rows``, how many rows either has there.

    ``levels`` are lists of named columns (``F.col("site_id")``, ``F.trunc(...).alias("month")``), coarse ones first. Each side
    gives every group of the first level one checksum of the ``columns`` of its rows; only rows of groups that differ are read
    for the next level, and so on. No row meets another row: what is joined is one checksum for each group.

    A checksum is the number of rows and two sums of 32-bit parts of a 64-bit hash of each row, so it doesn't depend on the order of the
    rows, and rows that stand twice count twice (an exclusive or would lose them). Nulls are values like others, in
    groups too. Different rows with equal checksums are possible with a chance of about 2^-64 for a group.

    The groups of all levels but the last are collected, so those should be few: months, regions, partitions. As filters on such columns
    they reach the scan, and partitions without a difference are not read again.
    """
    if not levels:
        raise ValueError("reconciliation needs at least one level")
    known: list[Column] = []
    for k, level in enumerate(levels):
        known += level
        found = _apart(_checksums(left, known, columns), _checksums(right, known, columns))
        if k == len(levels) - 1:
            return found
        names = [f.name for f in found.schema if f.name not in ("left_rows", "right_rows")]
        groups = [tuple(r[n] for n in names) for r in found.collect()]
        left, right = (_within(side, known, groups) for side in (left, right))
    raise AssertionError


def _checksums(rows: DataFrame, groups: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    hashed = rows.select(*groups, F.xxhash64(*[_told_apart(rows, c) for c in columns]).alias("|hash"))
    names = [c for c in hashed.columns if c != "|hash"]
    # As decimals, since a group of 2^31 rows would overflow a long.
    low = F.sum(F.col("`|hash`").bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)")).alias("|low")
    high = F.sum(F.shiftright("`|hash`", 32).cast("decimal(20,0)")).alias("|high")
    return hashed.groupBy(*[F.col(f"`{n}`") for n in names]).agg(F.count(F.lit(1)).alias("|rows"), low, high)


def _told_apart(rows: DataFrame, name: str) -> Column:
    """A column for hashing: Spark's hash skips nulls, so that (null, 1) and (1, null) would be equal."""
    column = F.col(f"`{name}`")
    return F.struct(column.isNull().alias("null"), column.alias("value"))


def _apart(left: DataFrame, right: DataFrame) -> DataFrame:
    names = [c for c in left.columns if not c.startswith("|")]
    other = right.toDF(*[f"{c}!" for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(f"`{n}`").eqNullSafe(F.col(f"`{n}!`")) for n in names])
    both = left.join(other, same, "full_outer")
    equal = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{c}!`")) for c in ("|rows", "|low", "|high")])
    # A group that one side lacks has no count there.
    held = F.col("`|rows`").isNotNull()
    return both.filter(~equal).select(
        *[F.when(held, F.col(f"`{n}`")).otherwise(F.col(f"`{n}!`")).alias(n) for n in names],
        F.coalesce("`|rows`", F.lit(0)).alias("left_rows"),
        F.coalesce("`|rows!`", F.lit(0)).alias("right_rows"),
    )


def _within(rows: DataFrame, columns: Sequence[Column], groups: Sequence[tuple]) -> DataFrame:
    """Rows of the groups. One column is compared with a list of values, which Spark can use to leave out files."""
    if not groups:
        return rows.limit(0)
    if len(columns) == 1:
        values = [g[0] for g in groups if g[0] is not None]
        asked = columns[0].isin(values) if values else F.lit(False)
        return rows.filter(asked | columns[0].isNull() if len(values) < len(groups) else asked)
    keyed = [reduce(lambda a, b: a & b, [c.eqNullSafe(F.lit(v)) for c, v in zip(columns, g, strict=True)]) for g in groups]
    return rows.filter(reduce(lambda a, b: a | b, keyed))
