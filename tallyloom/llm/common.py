"""What the operators share: guarded columns, Arrow maps, held-out folds and the size of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import session

# Rows handed to Python at once; texts differ in length by four orders of magnitude.
ARROW_ROWS = 1000
ARROW_BYTES = 32 << 20
WHITE = b" \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch and make sure that a shared folder is known."""
    session.apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    session.shared_folder(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text") -> DataFrame:
    """Only the id and the text, whatever further columns there are; a null text is an empty one."""
    text = F.coalesce(docs[text_name].cast("string"), F.lit(""))
    return docs.select(docs[id_name].cast("long").alias(id_name), text.alias(text_name))


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def map_arrow(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function of one batch to every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def text_bytes(docs: DataFrame, text_name: str = "text") -> int:
    """Bytes of all texts: one number, by which jobs choose how finely they divide their work."""
    found = docs.agg(F.sum(F.octet_length(docs[text_name]))).first()
    return int(found[0] or 0)


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int = 5, id_name: str = "doc_id"
) -> DataFrame:
    """Texts with their label, from the learning folds only, `rows` of them at most.

    The bound is a documented parameter of the classifiers. Rows are chosen by the hash of their id, so
    the choice does not follow the order of the table. Several labels of one id count as their smallest.
    """
    known = (
        labels.select(labels[id_name].cast("long").alias(id_name), labels[label].cast("int").alias("label"))
        .where(F.col(id_name).isNotNull() & F.col("label").isNotNull())
        .where(fold(F.col(id_name), folds) != 0)
        .groupBy(id_name)
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64(id_name), id_name)
        .limit(rows)
    )
    # The right side has `rows` lines of two numbers at most.
    return texts_of(docs).join(F.broadcast(known), id_name)
