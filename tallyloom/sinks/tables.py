"""Stored Parquet tables: folders that a commit log names.

    base      a whole version of the table, with everything up to a batch
    batches   the rows each batch added, on top of the base

A write goes to a new folder and counts from its commit on, so readers never see a part of it. A batch that runs twice replaces
itself, also after it was folded into the base: every row keeps the number of its batch in `_batch`. Versions that were replaced stay
readable until `drop_superseded`.

Rows of a table with cluster columns are dealt to files by ranges of them (inside a month, if it is partitioned), and least and
greatest values of each file are stored beside the folder, under `_bounds`: `find` opens only files that can hold what is looked for.

While rows are written, their number and their newest time are observed, and the commit names both: `metrics` has them for each batch and
`size` for the whole table, so reports add numbers up instead of reading data. What is observed lies behind the last shuffle of a write,
where a task that runs again counts once.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.upsert import newest_per_key
from tallyloom.session import tidy
from tallyloom.sinks.log import Action, Contents, Log, delete
from tallyloom.sources.landing import as_path

BATCH, WRITE, BOUNDS = "_batch", "_write", "_bounds"


@dataclass(frozen=True)
class Written:
    """A folder, the number of its rows, and the newest time among them as text."""

    path: str
    rows: int
    newest: str | None


class Table:
    def __init__(
        self, spark: SparkSession, folder: str, schema: str, keys: Sequence[str] = (),
        newest_by: Sequence[str] = ("ingested_at",), partition: tuple[str, str] | None = None,
        cluster: Sequence[str] = (), log: Log | None = None, name: str = "table", one_value: bool = False,
    ):
        """`one_value` says that all rows of a batch have one value of the partition: they are written where they are."""
        self.spark, self.folder, self.schema, self.one_value = spark, folder, schema, one_value
        self.keys, self.newest_by = list(keys), list(newest_by)
        self.partition, self.cluster = partition, list(cluster)
        self.log, self.name = log if log is not None else Log(spark, folder), name
        self.as_of: int | None = None

    def at(self, version: int) -> Table:
        """The table as it was after a commit."""
        then = copy.copy(self)
        then.as_of = version
        return then

    @property
    def contents(self) -> Contents:
        return self.log.contents(self.name, self.as_of)

    def last_batch(self) -> int:
        found = self.contents
        return max([found.upto or 0, *found.batches])

    def columns(self) -> list[str]:
        return [field.split()[0] for field in _split_ddl(self.schema)]

    # -- writing ---------------------------------------------------------------------------------

    def _observed(self, rows: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
        """Rows, and their number and newest time as soon as they are written."""
        seen, time = Observation(), self.newest_by[0] if self.newest_by else None
        newest = F.max(time).cast("string") if time in self.columns() else F.lit(None).cast("string")
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest"), *more), seen

    def _write(self, df: DataFrame, label: str, batch: int) -> Written:
        """Writes rows to a new folder. Rows without the number of their batch get this one."""
        number = F.col(BATCH) if BATCH in df.columns else F.lit(batch).cast("long").alias(BATCH)
        rows = df.select(*self.columns(), number)
        if self.partition:
            name, value = self.partition
            rows = rows.withColumn(name, F.expr(value))
            if not self.cluster and not self.one_value:
                # Rebalancing splits a partition value that holds much of the data over several tasks
                # and gathers the small ones, so files come out near the advisory size.
                rows = rows.hint("rebalance", name)
        if self.cluster:
            # A partition value with much of the data has several ranges. Small ones are gathered.
            by = [*([self.partition[0]] if self.partition else []), *self.cluster]
            rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
        path = f"{WRITE}={label}-{batch}-{uuid.uuid4().hex}"
        rows, seen = self._observed(rows)
        writer = rows.write
        if self.partition:
            writer = writer.partitionBy(self.partition[0])
        with tidy(df.sparkSession):
            writer.parquet(f"{self.folder}/{path}")
        if self.cluster:
            ends = [f(x).alias(f"{name}_{x}") for x in self.cluster for name, f in (("low", F.min), ("high", F.max))]
            files = self._read([path]).groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends)
            with tidy(df.sparkSession):
                files.write.parquet(f"{self.folder}/{BOUNDS}/{path}")
        return Written(path, seen.get["rows"], seen.get["newest"])

    def _log(self, op: str, batch: int, written: Written) -> int:
        self.log.add(Action(self.name, op, batch, written.path, rows=written.rows, newest=written.newest))
        return written.rows

    def append(self, df: DataFrame, batch: int) -> int:
        """Adds a batch and returns the number of its rows; the same batch number again replaces what it added before."""
        return self._log("add", batch, self._write(df, "batch", batch))

    def replace(self, df: DataFrame, batch: int) -> int:
        """A new content for the whole table; returns the number of its rows."""
        return self._log("replace", batch, self._write(df, "base", batch))

    def compact(self, after: int = 1) -> None:
        """Folds the batches into the base, if there are `after` of them at least."""
        with self.log.transaction():
            if len(self.contents.batches) >= max(1, after):
                upto = self.last_batch()
                rows = self._current() if self.keys else self._rows()
                self._log("fold", upto, self._write(rows, "base", upto))

    def drop_superseded(self) -> int:
        """Deletes the folders that only earlier versions name. Call it when no reader
        of an older state is at work. Returns how many folders went."""
        old = self.log.paths(self.name) - self.log.contents(self.name).paths
        for path in old:
            delete(self.spark, f"{self.folder}/{path}")
            if self.cluster:
                delete(self.spark, f"{self.folder}/{BOUNDS}/{path}")
        return len(old)

    # -- reading ---------------------------------------------------------------------------------

    def metrics(self) -> DataFrame:
        """batch, rows, newest: what each batch brought, folded or not, from the log alone.

        newest is the greatest value, as text, of the first column that says which row of a key is newest. After a replacement of
        the table there is one line for it. Numbers are null where a batch was written before they were kept.
        """
        lines = [(batch, rows, newest) for batch, (rows, newest) in sorted(self.contents.brought.items())]
        return self.spark.createDataFrame(lines, "batch long, rows long, newest string")

    def size(self) -> int | None:
        """The number of rows of `current`, or of `read` if the table has no keys, if the log tells it; else None.

        Rows of batches on top of a base with keys have to be compared with it to be counted.
        """
        found = self.contents
        if not self.keys:
            known = [rows for rows, _ in found.brought.values()]
        elif not found.batches:
            known = list(found.sizes.values())
        else:
            return None
        return None if None in known else sum(known)

    def _stored_schema(self) -> str:
        month = f", {self.partition[0]} date" if self.partition else ""
        return f"{self.schema}, {BATCH} long{month}"

    def _read(self, folders: Sequence[str], files: Sequence[str] | None = None) -> DataFrame:
        # The folders are read as partitions of the table's, since each may have partitions of its own.
        reader = self.spark.read.schema(self._stored_schema()).option("basePath", self.folder)
        return reader.parquet(*([f"{self.folder}/{p}" for p in folders] if files is None else [as_path(f) for f in files]))

    def _scan(self, paths: Sequence[str]) -> DataFrame:
        return self._read(paths).drop(WRITE) if paths else self.spark.createDataFrame([], self._stored_schema())

    def _base(self) -> DataFrame:
        """The base without the batches that ran again since."""
        found = self.contents
        rows = self._scan([found.base] if found.base else [])
        again = [b for b in found.batches if b <= (found.upto or 0)]
        return rows.where(~F.col(BATCH).isin(again)) if again else rows

    def _batches(self, below: int | None = None) -> DataFrame:
        # One scan over all folders.
        return self._scan([p for b, p in sorted(self.contents.batches.items()) if below is None or b < below])

    def _rows(self, below: int | None = None) -> DataFrame:
        found = self.contents
        base = self._base() if below is None else self._base().where(F.col(BATCH) < below)
        if not found.batches:
            return base
        return self._batches(below) if found.base is None else base.unionByName(self._batches(below))

    def _current(self) -> DataFrame:
        found = self.contents
        if not found.batches:
            return self._base()
        recent = self._batches()
        if found.base is None:
            return newest_per_key(recent, self.keys, self.newest_by)
        touched = recent.select(*[F.col(k).alias(f"_key_{k}") for k in self.keys]).distinct()
        same_key = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in self.keys])
        base = self._scan([found.base])
        again = base.join(touched, same_key, "left_semi").unionByName(recent)
        untouched = base.join(touched, same_key, "left_anti")
        return untouched.unionByName(newest_per_key(again, self.keys, self.newest_by))

    def read_base(self) -> DataFrame:
        return self._base().drop(BATCH)

    def read_as_written(self) -> DataFrame:
        """The last whole version, with the columns it was written with."""
        base = self.contents.base
        if base is None:
            raise LookupError(f"{self.folder} has no whole version yet")
        return self.spark.read.parquet(f"{self.folder}/{base}").drop(BATCH)

    def read_batch(self, batch: int) -> DataFrame:
        return self._scan([self.contents.batches[batch]]).drop(BATCH)

    def read_batches(self, below: int | None = None) -> DataFrame:
        return self._batches(below).drop(BATCH)

    def read(self, below: int | None = None) -> DataFrame:
        """Every stored row, including older rows of a key; or those of batches below a number, folded or not."""
        return self._rows(below).drop(BATCH)

    def _files(self, folders: Sequence[str], column: str, low: object, high: object) -> list[str]:
        if not folders:
            return []
        found = self.spark.read.parquet(*[f"{self.folder}/{BOUNDS}/{p}" for p in folders])
        if low is not None:
            found = found.where(F.col(f"high_{column}") >= F.lit(low))
        if high is not None:
            found = found.where(F.col(f"low_{column}") <= F.lit(high))
        return [row["file"] for row in found.select("file").collect()]

    def files(self, column: str, low: object, high: object) -> list[str]:
        """The files that can hold rows whose cluster column lies between two values; None is no bound."""
        return self._files(sorted(self.contents.paths), column, low, high)

    def find(self, column: str, low: object, high: object) -> DataFrame:
        """Stored rows whose column lies between two values, both included; None is no bound, and null is never between.

        By a cluster column only files are opened whose range meets this one; their names pass
        through the driver, as with any read of files. By other columns all files are read.
        """
        wanted = F.col(column).isNotNull()
        if low is not None:
            wanted &= F.col(column) >= F.lit(low)
        if high is not None:
            wanted &= F.col(column) <= F.lit(high)
        if column not in self.cluster:
            return self.read().where(wanted)
        found = self.contents
        again = [b for b in found.batches if b <= (found.upto or 0)]
        rows = self.spark.createDataFrame([], self._stored_schema())
        for folders, replaced in (([found.base] if found.base else [], again), (sorted(found.batches.values()), [])):
            if files := self._files(folders, column, low, high):
                rows = rows.unionByName(self._read(folders, files).drop(WRITE).where(wanted & ~F.col(BATCH).isin(replaced)))
        return rows.drop(BATCH)

    def current(self) -> DataFrame:
        """The newest row of every key.

        The base has one row per key already. Only its rows whose key occurs in a later batch are
        compared again; when the batches are small Spark broadcasts their keys and the base is
        filtered without a shuffle.
        """
        return self._current().drop(BATCH)


def _split_ddl(schema: str) -> list[str]:
    """Top-level fields of a DDL text."""
    fields, depth, start = [], 0, 0
    for i, letter in enumerate(schema):
        depth += {"<": 1, ">": -1}.get(letter, 0)
        if letter == "," and depth == 0:
            fields.append(schema[start:i].strip())
            start = i + 1
    return [*fields, schema[start:].strip()]
