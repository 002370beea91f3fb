"""Session settings the library is written for."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution does the work that depends on the data: it coalesces small
# shuffle partitions, splits skewed ones on both sides of a join and in a
# rebalance before a partitioned write, and turns a sort-merge join into a
# broadcast join once a side's real size is known to be small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str = "voltmark", master: str | None = None, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; entries of ``settings`` win over them.

    On a cluster leave ``master`` out and set ``spark.sql.shuffle.partitions`` (or the adaptive
    initial partition number) for the data at hand: about one partition per 128 MB shuffled.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: Fixed value: bytes of files for a task that sorts what it reads. Typed rows take ten times their compressed size and more.
FINE_SCAN = 32 * 2**20
_SCAN = "spark.sql.files.maxPartitionBytes"


@contextmanager
def fine_scans(spark: SparkSession) -> Iterator[None]:
    """Jobs run in this block read at most ``FINE_SCAN`` bytes of files a task, or what the session allows if that is less.

    A deduplication sorts rows before their shuffle. Spark's 128 MB of files a task, which only large tables come to, are
    more than fits the memory of a task once they are rows, so the sorts spill; a quarter of it does fit.
    """
    before = spark.conf.get(_SCAN)
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", before.strip().lower()).groups()
    if int(number) * 1024 ** " kmgtp".index(unit or " ") <= FINE_SCAN:
        yield
        return
    spark.conf.set(_SCAN, FINE_SCAN)
    try:
        yield
    finally:
        spark.conf.set(_SCAN, before)
