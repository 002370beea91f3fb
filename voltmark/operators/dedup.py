"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the highest ``latest`` values per key (nulls rank last).

    Ties are broken by all other columns in ascending order, so the survivor depends on the rows
    only, never on how they were partitioned. Rows equal in every column are interchangeable.

    Spark plans ``row_number() = 1`` as a group limit *before* the shuffle and another after it,
    so each map task sends at most one row per key: a key that holds a third of all rows costs the
    reducer one row per map task.
    """
    missing = [c for c in (*keys, *latest) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the frame: {missing}")
    order = [f"`{c}` DESC NULLS LAST" for c in latest]
    order += [f"`{c}` ASC NULLS FIRST" for c in df.columns if c not in keys and c not in latest]
    partition = ", ".join(f"`{c}`" for c in keys)
    # Frames of key columns only are ordered by the key, which is the same for all copies.
    rank = F.expr(f"row_number() OVER (PARTITION BY {partition} ORDER BY {', '.join(order) or partition})")
    return df.withColumn(_RANK, rank).filter(f"{_RANK} = 1").drop(_RANK)
