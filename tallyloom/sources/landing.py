"""A folder in which the files of a source land: which of them are new, and their records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.pages import PAGE_FILE, page_contents

FILE = "file string, modified long, size long"
# What is known of a file that was read: the newest creation second in it, and the batch.
READ_FILE = f"{FILE}, newest long, batch long"


@dataclass(frozen=True)
class Landing:
    """JSON lines with pages (page, body); a file is complete when it shows up under its name.

    A file is known by path, time and size, so one that was written anew is a new file.
    """

    spark: SparkSession
    folder: str

    def files(self) -> DataFrame:
        """All files there are; their contents are not read."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.folder)
        # The form of the name that the rows of a file carry too.
        return found.select(F.col("_metadata.file_path").alias("file"), F.unix_millis("modificationTime").alias("modified"), F.col("length").alias("size"))

    def unread(self, known: DataFrame, batch: int, after: int) -> DataFrame:
        """Files no other batch has read, and those read by earlier batches that hold records created after a second.

        The result is fixed: files that land later are not in it. The names of these files pass
        through the driver, as with any read of files; those of the others do not.
        """
        earlier = (F.col("batch") < batch) & F.coalesce(F.col("newest") <= after, F.lit(True))
        settled = known.where(earlier | (F.col("batch") > batch))
        new = self.files().join(settled, ["file", "modified", "size"], "left_anti")
        return self.spark.createDataFrame(new.collect(), FILE)

    def contents(self, files: Sequence[str]) -> DataFrame:
        """(file, json_data, no_list) of the records in some files; a body that cannot be read is one row with `no_list`."""
        if not files:
            return self.spark.createDataFrame([], "file string, json_data string, no_list boolean")
        pages = self.spark.read.schema(PAGE_FILE).json([as_path(f) for f in files])
        return page_contents(pages.select("*", F.col("_metadata.file_path").alias("file")))


def as_path(file: str) -> str:
    """What to read a file by whose name is that of `_metadata.file_path`; letters of patterns stand for themselves."""
    return "".join(f"\\{letter}" if letter in "*?[]{}\\" else letter for letter in unquote(file))
