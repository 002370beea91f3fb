"""Text rows to a typed table: parse, derive, drop rows without key, deduplicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltmark.functions import parse
from voltmark.operators.dedup import latest_per_key
from voltmark.operators.intake import Intake
from voltmark.registry import INGESTED_AT, table


def _parsed(source: DataFrame, name: str, keep: Sequence[str]) -> dict[str, tuple[Column, bool]]:
    """The columns ``source`` shares with table ``name``, parsed to its types, and whether there was something to parse."""
    wanted = {f.name: f.dataType for f in table(name).schema}
    given = {f.name: f.dataType for f in source.schema if f.name in wanted and f.name not in keep}
    return {
        c: (F.col(f"`{c}`"), False) if wanted[c] == t else (parse(F.col(f"`{c}`"), t, wanted[c]), True) for c, t in given.items()
    }


def typed(source: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``source`` shares with table ``name``, parsed to its types, and ``keep`` as they are."""
    return source.select(*[column.alias(c) for c, (column, _) in _parsed(source, name, keep).items()], *keep)


def conform(
    source: DataFrame,
    name: str,
    derive: Mapping[str, Column] | None = None,
    required: Sequence[str] = (),
    latest: Sequence[str] = (),
    intake: Intake | None = None,
) -> DataFrame:
    """``source`` as table ``name``: unique by its key, columns in table order.

    ``derive`` adds columns computed from the parsed ones. Rows with a null key or a null
    ``required`` column are dropped *before* deduplication, so a bad copy of a row never replaces
    a good one. Any other value that does not parse becomes null and its row stays. The survivor
    of a key is the last ingested row, where the source has ingestion times, and among those the one with
    the highest ``latest`` columns. ``intake`` counts what is dropped, while the result is computed.
    """
    spec = table(name)
    latest = [*([INGESTED_AT] if INGESTED_AT in source.columns else []), *latest]
    carried = [c for c in latest if c not in spec.columns]
    needed = list(dict.fromkeys((*spec.key, *required)))
    if intake:
        parsed = _parsed(source, name, carried)
        failed = {c: F.col(f"`{c}`").isNotNull() & column.isNull() for c, (column, tried) in parsed.items() if tried}
        rows = source.select(
            *[column.alias(c) for c, (column, _) in parsed.items()], *carried, *[x.alias(f"failed|{c}") for c, x in failed.items()]
        )
        rows = intake.watched(name, source, rows, needed, list(failed)).drop(*[f"failed|{c}" for c in failed])
    else:
        rows = typed(source, name, keep=carried)
    if derive:
        rows = rows.withColumns(dict(derive))
    present = " AND ".join(f"`{c}` IS NOT NULL" for c in needed)
    columns = [c for c in spec.columns if c in rows.columns]
    return latest_per_key(rows.filter(present), spec.key, latest).select(*columns)
