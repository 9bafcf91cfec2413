"""Keyed tables whose base lies in hash buckets: a merge rewrites the buckets it touches, and the base is never shuffled.

The base has one row per key, bucketed and sorted by `_key`, the table's keys as one text. Each bucket is a folder of its own, so the
commit log says for every bucket which version of it counts; a merge writes new folders for the buckets in which its keys lie and
leaves the others where they are. To read, the folders are put together as the partitions of a bucketed catalog table: Spark then
knows how the rows are dealt, and joins them with the few rows of the batches, which alone are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.upsert import newest_per_key
from tallyloom.session import tidy
from tallyloom.sinks.log import Action, Log
from tallyloom.sinks.tables import BATCH, Table, Written

KEY, BUCKET = "_key", "_bucket"


class BucketedTable(Table):
    def __init__(
        self, spark: SparkSession, folder: str, schema: str, keys: Sequence[str], newest_by: Sequence[str] = ("ingested_at",),
        buckets: int = 16, log: Log | None = None, name: str = "table",
    ):
        super().__init__(spark, folder, schema, keys=keys, newest_by=newest_by, log=log, name=name)
        self.buckets = buckets

    def _key(self) -> Column:
        """The keys as one text that differs where they do; null is a value like others."""
        parts = [F.coalesce(F.concat(F.lit("="), F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))),
                            F.lit("-")) for k in self.keys]
        return F.concat_ws("|", *parts)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key, with the key's bucket, which is the one Spark deals it to."""
        newest = newest_per_key(rows, self.keys, self.newest_by).withColumn(KEY, self._key())
        return newest.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(self.buckets)))

    # -- the base as a catalog table ---------------------------------------------------------------

    def _bucketed(self, wanted: Sequence[int] | None = None) -> DataFrame:
        """The base, or some buckets of it, with `_key`, `_bucket` and `_batch`."""
        folders = {b: p for b, p in self.contents.buckets.items() if wanted is None or b in wanted}
        name = f"tallyloom_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({self.schema}, {BATCH} long, {KEY} string, {BUCKET} int) USING parquet "
            f"PARTITIONED BY ({BUCKET}) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/none'"
        )
        if folders:
            parts = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{self.folder}/{p}'" for b, p in sorted(folders.items()))
            self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name)

    def _write_buckets(self, rows: DataFrame, batch: int) -> tuple[Written, dict[int, int]]:
        """What was written, and the number of rows of each bucket that has some."""
        path, name = f"base-{batch}-{uuid.uuid4().hex}", f"tallyloom_{uuid.uuid4().hex}"
        each = F.array(*(F.count(F.when(F.col(BUCKET) == b, 1)) for b in range(self.buckets))).alias("each")
        rows, seen = self._observed(rows.select(*self.columns(), BATCH, KEY, BUCKET), each)
        writer = rows.write.format("parquet").option("path", f"{self.folder}/{path}")
        with tidy(rows.sparkSession):
            writer.partitionBy(BUCKET).bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(name)
        # The files stay; the name is not needed to read them.
        self.spark.sql(f"DROP TABLE {name}")
        sizes = {b: n for b, n in enumerate(seen.get["each"]) if n}
        return Written(path, seen.get["rows"], seen.get["newest"]), sizes

    def _merges(self, batch: int, path: str, sizes: dict[int, int]) -> list[Action]:
        return [Action(self.name, "merge", batch, f"{path}/{BUCKET}={b}", b, n) for b, n in sorted(sizes.items())]

    def _merged(self, base: DataFrame, recent: DataFrame) -> DataFrame:
        """Base rows and newest rows of the batches, the newer one of each key. The order is that of `newest_per_key`."""
        by = [b for b in self.newest_by if b not in self.keys]
        others = [x for x in (*self.columns(), BATCH) if x not in (*self.keys, *by)]

        def row(df: DataFrame) -> DataFrame:
            return df.select(KEY, F.struct(F.struct(*by, *others).alias("by"), *self.keys, BUCKET).alias("row"))

        both = row(base).join(row(recent).withColumnRenamed("row", "new"), KEY, "full_outer")
        one = F.greatest("row", "new")
        return both.select(
            *[one[x].alias(x) if x in self.keys else one["by"][x].alias(x) for x in (*self.columns(), BATCH)], KEY, one[BUCKET].alias(BUCKET)
        )

    # -- what a table does -------------------------------------------------------------------------

    def compact(self, after: int = 1) -> list[int]:
        """Merges the batches into the buckets they touch; returns these."""
        with self.log.transaction():
            if len(self.contents.batches) < max(1, after):
                return []
            upto = self.last_batch()
            recent = self._keyed(self._batches())
            # At most as many numbers as there are buckets.
            touched = sorted(r[0] for r in recent.select(BUCKET).distinct().collect())
            if not touched:
                # The base stays as it is.
                self.log.add(Action(self.name, "fold", upto))
                return touched
            if self.contents.buckets.keys() & set(touched):
                # The join deals the rows to buckets, so writing needs no shuffle of its own.
                rows = self._merged(self._bucketed(touched), recent)
            else:
                # Nothing stored to compare them with: they are dealt to the same buckets without a join and its sort.
                rows = recent.repartition(self.buckets, KEY)
            written, sizes = self._write_buckets(rows, upto)
            self.log.add(*self._merges(upto, written.path, sizes))
            return touched

    def replace(self, df: DataFrame, batch: int) -> int:
        rows = self._keyed(df.select(*self.columns(), F.lit(batch).cast("long").alias(BATCH)))
        written, sizes = self._write_buckets(rows.repartition(self.buckets, KEY), batch)
        whole = Action(self.name, "replace", batch, rows=written.rows, newest=written.newest)
        self.log.add(whole, *self._merges(batch, written.path, sizes))
        return written.rows

    def _base(self) -> DataFrame:
        rows = self._bucketed().drop(KEY, BUCKET)
        again = [b for b in self.contents.batches if b <= (self.contents.upto or 0)]
        return rows.where(~F.col(BATCH).isin(again)) if again else rows

    def _rows(self, below: int | None = None) -> DataFrame:
        base = self._base() if below is None else self._base().where(F.col(BATCH) < below)
        return base.unionByName(self._batches(below)) if self.contents.batches else base

    def _current(self) -> DataFrame:
        found = self.contents
        if not found.batches:
            return self._bucketed().drop(KEY, BUCKET)
        recent = self._keyed(self._batches())
        if not found.buckets:
            return recent.drop(KEY, BUCKET)
        return self._merged(self._bucketed(), recent).drop(KEY, BUCKET)
