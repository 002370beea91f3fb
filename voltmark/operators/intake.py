"""What conforming a table leaves out: rows by reason, and values that don't parse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "table_name string, what string, column_name string, rows bigint"


@dataclass
class _Watch:
    source: DataFrame
    rows: DataFrame
    counts: list[Column]
    seen: Observation


class Intake:
    """Counts taken while tables are conformed and written, in the same pass.

    Pass one to the builders (or to ``run_all``) and ask for :meth:`report` once their tables are written. For each table:
    ``read`` rows, rows ``dropped`` for want of a column (the first one missing, keys before others), and values that
    ``failed`` to parse and became null. What is neither dropped nor written was replaced by another row of its key.
    """

    def __init__(self):
        self._watches: dict[str, _Watch] = {}

    def watched(self, name: str, source: DataFrame, rows: DataFrame, needed: Sequence[str], parsed: Sequence[str]) -> DataFrame:
        """``rows`` (of ``source`` as parsed, with a flag ``failed|column`` for each of ``parsed``), counted as they pass."""
        reason = first_missing(needed)
        counts = [F.count(F.lit(1)).alias("read|")]
        counts += [F.count_if(reason == c).alias(f"dropped|{c}") for c in needed]
        counts += [F.count_if(F.col(f"`failed|{c}`")).alias(f"failed|{c}") for c in parsed]
        watch = _Watch(source, rows, counts, Observation())
        self._watches[name] = watch
        return rows.observe(watch.seen, *counts)

    def counts(self) -> dict[str, dict[str, int]]:
        """By table, the counts named ``read|``, ``dropped|column`` and ``failed|column``.

        Rows are counted before a shuffle, and a task that ran again after its output was lost has counted twice. That shows in
        the number of rows read, which Parquet knows from its footers; then, and only then, the counts are taken again.
        """
        found = {}
        for name, watch in self._watches.items():
            counts = watch.seen.get
            if counts["read|"] != watch.source.count():
                counts = watch.rows.agg(*watch.counts).first().asDict()
            found[name] = counts
        return found

    def report(self, spark: SparkSession) -> DataFrame:
        """``table_name, what, column_name, rows``: a row for each count of :meth:`counts`, zeros included."""
        rows = [(name, *key.split("|", 1), n) for name, counts in self.counts().items() for key, n in counts.items()]
        return spark.createDataFrame([(t, what, column or None, n) for t, what, column, n in rows], SCHEMA)


def first_missing(needed: Sequence[str]) -> Column:
    """The name of the first column that is null, or null."""
    return F.coalesce(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in needed])
