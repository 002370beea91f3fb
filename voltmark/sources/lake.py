"""The tables of a lake, addressed by path: ``{root}/{layer}/{table}``."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from voltmark.registry import LAYERS, TABLES, Table, layer_tables, table


class Lake:
    """Reads and writes the registered tables under ``root``, any Hadoop path.

    ``fmt`` is ``"parquet"`` or ``"delta"``; Delta needs its package on the session.

    A Parquet table is a folder of numbered versions. An overwrite writes the next one beside the others; it counts
    from the moment Spark marks it as complete, so a failed or interrupted overwrite leaves the table as it was. The
    version before stays until the next overwrite, for readers that are under way. An append to a version is a numbered
    part in a folder of its own, which counts in the same way: all of its rows are read, or none. One writer at a time.

    ``buckets`` is the number of buckets of bucketed tables: about one per 128 MB of them, and the same for all sessions that
    open the lake, as files don't tell it.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", buckets: int = 32):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.buckets = buckets

    # -- addressing and reading ------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{table(name).layer}/{name}"

    def exists(self, name: str) -> bool:
        """Whether the table can be read."""
        if self.fmt == "parquet":
            return bool(self._versions(name, complete=True))
        fs, path = self._filesystem(self.path(name))
        return fs.exists(path)

    def location(self, name: str) -> str:
        """The folder of the table's version that counts now, without later appends; an error if there is none."""
        if self.fmt != "parquet":
            return self.path(name)
        complete = self._versions(name, complete=True)
        if not complete:
            raise FileNotFoundError(f"no complete table {name} at {self.path(name)}")
        return f"{self.path(name)}/{complete[-1]}"

    def read(self, name: str, after: int = -1) -> DataFrame:
        """A lazy scan. With the table's own schema for Parquet, so that empty tables read and
        columns declared after a file was written come back as null.

        ``after`` leaves out the parts up to that number, as given by :meth:`position`.
        """
        spec = table(name)
        if self.fmt != "parquet":
            if after >= 0:
                raise ValueError("parts of a table can be told apart in Parquet tables only")
            return self.spark.read.format(self.fmt).load(self.location(name))
        if spec.bucket_by:
            return self._bucketed(spec)
        whole, parts = self.location(name), self.parts(name)
        appended = [f"{self._appended(name, whole)}/part={n:08}" for n in parts if n > max(after, 0)]
        first = [whole] if after < 0 else []
        if not spec.partition_by or not appended:
            paths = first + appended
            return self._scan(spec, paths) if paths else self._empty(spec)
        # Partitioned folders with different roots can't be one scan.
        later = self._scan(spec, appended, self._appended(name, whole))
        return self._scan(spec, first).unionByName(later) if first else later

    def _scan(self, spec: Table, paths: list[str], root: str | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt).schema(spec.schema)
        if root:
            reader = reader.option("basePath", root)
        return reader.load(paths).select(*spec.columns)

    def _bucketed(self, spec: Table) -> DataFrame:
        """A bucketed table through the session's catalog, which is where Spark looks for buckets; registered
        anew in a session that doesn't know it."""
        path = self.location(spec.name)
        name = self._catalog_name(path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(spec.partition_by)}) "
                f"CLUSTERED BY ({spec.bucket_by}) SORTED BY ({spec.bucket_by}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return self.spark.read.table(name).select(*spec.columns)

    def _catalog_name(self, path: str) -> str:
        return f"voltmark_{hashlib.md5(path.encode()).hexdigest()}"

    def position(self, name: str) -> tuple[str, int]:
        """The version of a Parquet table that counts now, distinct from all before it, and its last complete part."""
        if self.fmt != "parquet":
            raise ValueError("only Parquet tables are written in numbered parts")
        fs, mark = self._filesystem(f"{self.location(name)}/_SUCCESS")
        written = fs.getFileStatus(mark).getModificationTime()
        return f"{mark.getParent().getName()}@{written}", self.parts(name)[-1]

    def next_part(self, name: str) -> int:
        """The number that the next append to a Parquet table gets. No other append ever had it, complete or not."""
        return max([0, *self._numbers(self._appended(name, self.location(name)))]) + 1

    def read_required(self, name: str) -> DataFrame:
        """As :meth:`read`, but an error when the table has no rows yet."""
        df = self.read(name)
        if df.isEmpty():
            raise ValueError(f"table {name} has no rows; build it first")
        return df

    def bind(self, *names: str, views: bool = False) -> dict[str, DataFrame]:
        """Tables by name (all silver ones by default), each a lazy scan; ``views`` also
        registers them as temporary views of the same names."""
        chosen = names or tuple(t.name for t in layer_tables("silver"))
        bound = {name: self.read(name) for name in chosen}
        if views:
            for name, df in bound.items():
                df.createOrReplaceTempView(name)
        return bound

    # -- writing ---------------------------------------------------------------

    def overwrite(self, name: str, df: DataFrame, gather: bool = True) -> int:
        """Replace the table by ``df`` and return the rows written.

        Rows of a partition value are gathered by a shuffle before they are written. Without ``gather`` each task writes
        the rows it has, which is as few files where ``df`` is a union of tables with one value each.
        """
        return self._write(table(name), df, "overwrite", gather)

    def append(self, name: str, df: DataFrame) -> int:
        """Add ``df`` to the table and return the rows written."""
        return self._write(table(name), df, "append")

    def replace_partitions(self, name: str, df: DataFrame, values: Iterable[date]) -> int:
        """Replace the partitions of these days by ``df``, whose rows all are of these days, and return the rows
        written. Files of other partitions are not touched; a day without rows has no partition afterwards.

        Each day is replaced at once, but the days one after another: an interrupted call must be repeated, and who was
        reading one of these days must read again.
        """
        spec, values = table(name), set(values)
        if self.fmt != "parquet" or len(spec.partition_by) != 1:
            raise ValueError(f"{name} is no Parquet table with one partition column")
        if self.parts(name) != [0]:
            raise ValueError(f"{name} has appended parts; overwrite it first")
        (column,) = spec.partition_by
        seen = Observation()
        counted = [F.count(F.lit(1)).alias("rows"), F.collect_set(column).alias("values")]
        rows = self._gathered(df, spec).observe(seen, *counted)
        writer = rows.write.format(self.fmt).mode("overwrite").partitionBy(column)
        writer.option("partitionOverwriteMode", "dynamic").save(self.location(name))
        filled = set(seen.get["values"])
        if not filled <= values:
            raise ValueError(f"{name}: rows of days that were not to be replaced: {sorted(filled - values)[:3]}")
        for value in values - filled:
            fs, path = self._filesystem(f"{self.location(name)}/{column}={value}")
            fs.delete(path, True)
        return seen.get["rows"]

    def _gathered(self, df: DataFrame, spec: Table) -> DataFrame:
        rows = _checked(df, spec)
        if spec.bucket_by:
            # One writer for a bucket of a partition value, unless it is a large one.
            keyed = rows.withColumn("|bucket", F.expr(f"pmod(hash(`{spec.bucket_by}`), {self.buckets})"))
            return keyed.hint("rebalance", *[F.col(f"`{c}`") for c in (*spec.partition_by, "|bucket")]).drop("|bucket")
        if spec.partition_by:
            # Puts the rows of a partition value together, so a task does not write a file for
            # every value. Unlike repartition, a rebalance lets adaptive execution split a value
            # that holds much of the table over several tasks.
            rows = rows.hint("rebalance", *[F.col(c) for c in spec.partition_by])
        return rows

    def _write(self, spec: Table, df: DataFrame, mode: str, gather: bool = True) -> int:
        # Counted while writing; a count() afterwards would run the whole plan again.
        seen = Observation()
        rows = self._gathered(df, spec) if gather else _checked(df, spec)
        self._save(spec, rows.observe(seen, F.count(F.lit(1)).alias("rows")), mode)
        return seen.get["rows"]

    def _save(self, spec: Table, rows: DataFrame, mode: str) -> None:
        if self.fmt != "parquet":
            self._writer(spec, rows, mode).save(self.path(spec.name))
            return
        before = self._versions(spec.name, complete=True)
        if mode == "append" and before:
            if spec.bucket_by:
                raise ValueError(f"{spec.name} is bucketed and can be overwritten only")
            folder = self._appended(spec.name, before[-1])
            self._writer(spec, rows, "errorifexists").save(f"{folder}/part={self.next_part(spec.name):08}")
            return
        taken = self._versions(spec.name, complete=False)
        new = f"v{int(taken[-1][1:]) + 1 if taken else 1:08}"
        path = f"{self.path(spec.name)}/{new}"
        writer = self._writer(spec, rows, "errorifexists")
        if spec.bucket_by:
            self._forget(path)  # a table that was removed may have had this path
            bucketed = writer.bucketBy(self.buckets, spec.bucket_by).sortBy(spec.bucket_by)
            bucketed.option("path", path).saveAsTable(self._catalog_name(path))
        else:
            writer.save(path)
        for version in set(taken) - set(before[-1:]):
            if spec.bucket_by:
                self._forget(f"{self.path(spec.name)}/{version}")
            for folder in (f"{self.path(spec.name)}/{version}", self._appended(spec.name, version)):
                fs, path = self._filesystem(folder)
                fs.delete(path, True)

    def _forget(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(path)}")

    def _appended(self, name: str, version: str) -> str:
        """The folder of the parts appended to a version."""
        return f"{self.path(name)}/a{version.rsplit('/', 1)[-1][1:]}"

    def _numbers(self, folder: str) -> list[int]:
        """The parts in a folder, complete or not."""
        fs, path = self._filesystem(folder)
        names = [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removeprefix("part=")) for n in names if n.startswith("part="))

    def parts(self, name: str) -> list[int]:
        """The complete parts of the version that counts: 0 for the version itself, then its appends."""
        # One listing, however many parts there are.
        fs, marks = self._filesystem(f"{self._appended(name, self.location(name))}/part=*/_SUCCESS")
        found = [x.getPath().getParent().getName() for x in fs.globStatus(marks) or ()]
        return [0, *sorted(int(n.removeprefix("part=")) for n in found)]

    def _versions(self, name: str, complete: bool) -> list[str]:
        """Version folders of a Parquet table in order; with ``complete`` those that Spark has marked as written."""
        fs, path = self._filesystem(self.path(name))
        if not fs.exists(path):
            return []
        found = sorted(x.getPath().getName() for x in fs.listStatus(path) if re.fullmatch(r"v\d{8,}", x.getPath().getName()))
        if not complete:
            return found
        marks = {v: self._filesystem(f"{self.path(name)}/{v}/_SUCCESS")[1] for v in found}
        return [v for v in found if fs.exists(marks[v])]

    def _writer(self, spec: Table, df: DataFrame, mode: str) -> DataFrameWriter:
        writer = df.write.format(self.fmt).mode(mode)
        if mode == "overwrite":
            # The whole table is replaced, whatever the session says about single partitions.
            writer = writer.option("partitionOverwriteMode", "static")
            if self.fmt == "delta":
                writer = writer.option("overwriteSchema", "true")
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
        return writer

    # -- table lifecycle -------------------------------------------------------

    def create_tables(self, *layers: str) -> list[str]:
        """Create the tables of the layers (default: all) without rows; existing rows stay.

        For Delta, an existing table takes on columns declared since. For Parquet nothing needs to
        be written for that, see :meth:`read`.
        """
        created = []
        for spec in self._tables_of(layers):
            if self.fmt == "parquet" and self.exists(spec.name):
                continue
            if self.fmt == "delta":
                self._writer(spec, self._empty(spec), "append").option("mergeSchema", "true").save(self.path(spec.name))
            else:
                self._save(spec, self._empty(spec), "append")
            created.append(spec.name)
        return created

    def truncate(self, tables: Iterable[str] | None = None) -> dict[str, str]:
        """Delete every row of the tables (default: all) and keep their schemas.

        Goes on past tables that are missing or fail, whatever the failure; returns ``"cleared"`` or why not, by table.
        """
        outcome = {}
        for name in tables if tables is not None else TABLES:
            spec = table(name)
            try:
                if not self.exists(name):
                    outcome[name] = "skipped: no such table"
                    continue
                if self.fmt == "delta":
                    self.spark.sql(f"DELETE FROM delta.`{self.path(name)}`")
                else:
                    self._save(spec, self._empty(spec), "overwrite")
                outcome[name] = "cleared"
            except Exception as error:  # storage and permission errors come in many types
                outcome[name] = f"skipped: {error}"
        return outcome

    def reset(self, *layers: str, confirm: bool = False) -> list[str]:
        """Remove the table folders of the layers (default: all). Needs ``confirm=True``.

        Touches the paths of registered tables only; anything else under the root stays.
        """
        if not confirm:
            raise ValueError("reset removes tables for good; pass confirm=True")
        removed = []
        for spec in self._tables_of(layers):
            fs, path = self._filesystem(self.path(spec.name))
            if fs.exists(path) and fs.delete(path, True):
                removed.append(spec.name)
        return removed

    # -- helpers ---------------------------------------------------------------

    def _tables_of(self, layers: tuple[str, ...]) -> list[Table]:
        return [spec for layer in layers or LAYERS for spec in layer_tables(layer)]

    def _empty(self, spec: Table) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema])

    def _filesystem(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path


def _checked(df: DataFrame, spec: Table) -> DataFrame:
    """``df`` with its columns in table order; other names or types are an error."""
    wanted = {f.name: f.dataType for f in spec.schema}
    given = {f.name: f.dataType for f in df.schema}
    if wanted != given or len(df.columns) != len(given):
        differences = [
            f"{c}: table {wanted[c].simpleString() if c in wanted else 'absent'}, "
            f"frame {given[c].simpleString() if c in given else 'absent'}"
            for c in dict.fromkeys([*wanted, *given])
            if wanted.get(c) != given.get(c)
        ]
        raise ValueError(f"{spec.name}: {'; '.join(differences)}")
    return df.select(*[F.col(f"`{c}`") for c in wanted])
