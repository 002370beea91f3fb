"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, key: str) -> DataFrame:
    """The ``k`` rows with the highest ``by``, equal ones in ``key`` order.

    Spark keeps the best ``k`` rows in each task and merges those; it does not sort the table.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(key).asc()).limit(k)
