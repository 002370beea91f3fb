"""Raw extracts in landing form: business columns as text plus ingestion metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmark.registry import INGESTED_AT, SOURCE_FILE, table
from voltmark.sources.lake import Lake


def land(extract: DataFrame, name: str, source_file: str | Column) -> DataFrame:
    """``extract`` as raw table ``name``: every business column as text, stamped with time and source.

    ``source_file`` is a label, or a column such as ``F.col("_metadata.file_path")`` for frames
    read from files. Columns the table does not have are an error; ones it lacks are too.
    """
    spec = table(name)
    if spec.layer != "bronze":
        raise ValueError(f"{name} is a {spec.layer} table; only bronze tables take raw extracts")
    wanted = spec.business_columns
    unknown = sorted(set(extract.columns) - set(wanted))
    missing = [c for c in wanted if c not in extract.columns]
    if unknown or missing:
        raise ValueError(f"{name}: unknown columns {unknown}, missing columns {missing}")
    label = F.lit(source_file) if isinstance(source_file, str) else source_file
    return extract.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in wanted],
        F.current_timestamp().alias(INGESTED_AT),
        label.alias(SOURCE_FILE),
    )


def land_rows(spark: SparkSession, name: str, rows: Iterable[Sequence[str | None]], source_file: str) -> DataFrame:
    """Rows held in memory, values in the column order of the table, in landing form."""
    columns = table(name).business_columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return land(spark.createDataFrame(list(rows), schema), name, source_file)


def land_files(lake: Lake, name: str, files: DataFrame, columns: Mapping[str, Column] | None = None) -> int:
    """Append the rows of files that were not landed before to raw table ``name``; returns how many rows.

    ``files`` is a frame read from files, as ``spark.read.parquet(folder)`` gives it, and ``columns`` makes the business columns
    of its own (default: those of the same names). Rows are stamped as by :func:`land`, with the path of their file.

    A ledger beside the layers has the path and modification time of every file landed. A file that was written again
    counts as new. Ledger and rows arrive together: an entry names the part of the table that holds the rows, is written before it,
    and counts once that part is complete, so that a landing that was cut off is simply repeated. When the raw table
    is overwritten or truncated its entries lapse. Files without rows are looked at again each time.

    Only new files are read; for the others Spark looks at footers. One writer at a time.
    """
    spec = table(name)
    if spec.layer != "bronze":
        raise ValueError(f"{name} is a {spec.layer} table; only bronze tables take raw extracts")
    columns = columns or {c: F.col(f"`{c}`") for c in spec.business_columns}
    if set(columns) != set(spec.business_columns):
        raise ValueError(f"{name}: columns {sorted(set(columns) ^ set(spec.business_columns))} are missing or unknown")
    if not lake.exists(name):
        lake.create_tables("bronze")
    path, modified = F.col("_metadata.file_path"), F.unix_micros("_metadata.file_modification_time")
    version, _ = lake.position(name)
    found = files.select(path.alias("file_path"), modified.alias("modified")).distinct()
    if lake.exists("landed_files"):
        ledger = lake.read("landed_files").filter((F.col("table_name") == name) & (F.col("version") == version))
        ledger = ledger.filter(F.col("part").isin(lake.parts(name)))
        found = found.join(ledger.select("file_path", "modified").distinct(), ["file_path", "modified"], "left_anti")
    new = [(row.file_path, row.modified) for row in found.collect()]  # the driver has listed these files anyway
    if not new:
        return 0
    part = lake.next_part(name)
    entries = [(name, version, part, *entry) for entry in new]
    lake.append("landed_files", lake.spark.createDataFrame(entries, table("landed_files").schema).coalesce(1))
    rows = files.filter(path.isin([p for p, _ in new])).select(
        *[columns[c].cast("string").alias(c) for c in spec.business_columns],
        F.current_timestamp().alias(INGESTED_AT),
        path.alias(SOURCE_FILE),
        modified.alias("|modified"),
    )
    # A file that changed since is left for the next landing.
    seen = lake.spark.createDataFrame(new, "`|path` string, `|at` long")
    same = (F.col(SOURCE_FILE) == F.col("`|path`")) & (F.col("`|modified`") == F.col("`|at`"))
    return lake.append(name, rows.join(seen, same, "left_semi").drop("|modified"))
