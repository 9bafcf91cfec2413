"""Landed pages of an API: a page is a JSON body, and its records are rows.

A body is `{"data": [...], "has_more": bool}`, `{"data": [...], "nextCursor": text}` or a bare list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.records import parse, with_parsed

PAGE_FILE = "page bigint, body string"
ENVELOPE = "data array<string>, has_more boolean, nextCursor string"


def _opened(pages: DataFrame) -> DataFrame:
    """page, body, and `read`: the records, has_more and nextCursor of the body, which is parsed once.

    The records are null if the body is neither a list nor an envelope with one.
    """
    bare = F.startswith(F.ltrim("body"), F.lit("["))
    # A list is read as the envelope it would be in.
    whole = F.when(bare, F.concat(F.lit('{"data":'), "body", F.lit("}"))).otherwise(F.col("body"))
    return with_parsed(pages, F.from_json(whole, ENVELOPE), "read")


def _records(opened: DataFrame) -> DataFrame:
    return opened.select("page", F.posexplode("read.data").alias("place", "json_data"))


def list_or_envelope(pages: DataFrame) -> DataFrame:
    """All records of all pages, whatever their form; bodies that cannot be read are in `unreadable`."""
    return _records(_opened(pages))


def unreadable(pages: DataFrame) -> DataFrame:
    """page, body and reason of the pages that give no records because they cannot be read."""
    return _opened(pages).where("read.data is null").select("page", "body", F.lit("no list of records").alias("reason"))


def page_contents(pages: DataFrame) -> DataFrame:
    """(file, json_data, no_list) of pages with a `file`: their records, and the body of a page that gives none because it cannot be read."""
    no_list = F.col("read.data").isNull()
    each = _opened(pages).withColumn("no_list", no_list).select(
        "file", "body", "no_list", F.explode(F.coalesce("read.data", F.array(F.lit(None).cast("string")))).alias("record")
    )
    return each.select("file", F.when(F.col("no_list"), F.col("body")).otherwise(F.col("record")).alias("json_data"), "no_list")


def envelopes(pages: DataFrame, follow: str = "has_more", stop: bool = False) -> DataFrame:
    """Records of all pages, in (page, place) order; bodies that cannot be read are in `unreadable`.

    With `stop`, only the pages a reader would reach who follows the pointers: reading ends before the first empty or
    malformed page and after the first page that does not point to a next one. `follow` says what the pointer is: has_more,
    nextCursor, or any integer text for 'a page shorter than this is the last'.
    """
    opened = _opened(pages)
    if not stop:
        return _records(opened)
    if follow == "has_more":
        more = F.coalesce(F.col("read.has_more"), F.lit(False))
    elif follow == "nextCursor":
        more = F.coalesce("read.nextCursor", F.lit("")) != ""
    else:
        more = F.size("read.data") >= int(follow)
    blank = F.coalesce(F.size("read.data"), F.lit(0)) < 1
    # Two numbers for the whole source, reduced in the tasks before they meet.
    ends = opened.agg(
        F.min(F.when(blank, F.col("page"))).alias("blank"), F.min(F.when(~more, F.col("page"))).alias("last"),
    ).select(F.struct(F.coalesce("blank", F.lit(2**62)).alias("blank"), F.coalesce("last", F.lit(2**62)).alias("last")))
    end = ends.scalar()
    return _records(opened.where((F.col("page") < end.getField("blank")) & (F.col("page") <= end.getField("last"))))


def as_records(rows: DataFrame, schema: str) -> DataFrame:
    """Parses json_data into columns."""
    return parse(rows, schema).select("r.*")
