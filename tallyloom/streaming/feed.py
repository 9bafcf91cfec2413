"""Landed pages as a stream: each micro-batch is a few files, and memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sinks.tables import Table
from tallyloom.sources.pages import PAGE_FILE, list_or_envelope, unreadable


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(PAGE_FILE).option("maxFilesPerTrigger", files_per_batch).json(path)


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], changes: bool = False) -> list[dict]:
    """Handles everything that has landed so far, batch by batch, and returns the progress of each batch that had rows.

    A batch that is repeated after a failure gets the same number, so sinks can overwrite what it
    wrote the first time. `changes` is for streams with keyed state: each batch gets the keys it touched.
    """
    query = (
        stream.writeStream.foreachBatch(each)
        .outputMode("update" if changes else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"] > 0]


def append_pages(table: Table, shape: Callable[[DataFrame], DataFrame], aside: Table | None = None) -> Callable[[DataFrame, int], None]:
    """A sink that appends the records of each batch of pages to a table, and the pages that cannot be read to another.

    If both are in one log, they become visible together.
    """

    def each(pages: DataFrame, batch: int) -> None:
        with table.log.transaction():
            table.append(shape(list_or_envelope(pages)), batch + 1)
            if aside is not None:
                aside.append(unreadable(pages), batch + 1)

    return each


def append_rows(table: Table) -> Callable[[DataFrame, int], None]:
    """A sink that appends each batch as it is."""

    def each(rows: DataFrame, batch: int) -> None:
        table.append(rows, batch + 1)

    return each


def first_arrivals(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The first row of each key over a whole stream, in the batch in which it comes; drain it with `changes`.

    First is the row of the earliest batch, and inside a batch the least by `arrival`; ties are settled by the other columns. Null is a key
    like others. For each key the state store keeps its first row, however late a copy comes, and a batch looks up its own keys
    only: nothing that earlier batches have stored is read. A batch first reduces its rows to one per key inside each task, so a
    key with a third of all rows is no load. A batch that is repeated has the time of its first attempt, hence the same result.
    """
    others = [x for x in rows.columns if x not in keys and x not in arrival]
    # All rows of a batch have the batch's own time.
    timed = rows.withColumn("_seen_at", F.current_timestamp())
    first = F.min(F.struct("_seen_at", *arrival, *others)).alias("_first")
    found = timed.groupBy(*keys).agg(first).where(F.col("_first._seen_at") == F.current_timestamp())
    return found.select(*[F.col(x) if x in keys else F.col(f"_first.{x}") for x in rows.columns])
