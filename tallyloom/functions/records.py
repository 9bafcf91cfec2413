"""Parsing JSON text into a struct column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parsed(df: DataFrame, value: Column, into: str) -> DataFrame:
    """Adds a parsed value that is computed once per row.

    As a plain projection, a filter on a field of the struct would be pushed below the projection
    and parse the text again for every field it tests. A generator's output stays where it is, so
    the value goes through a one-element array.
    """
    return df.select("*", F.explode(F.array(value)).alias(into))


def parse(df: DataFrame, schema: str, into: str = "r", text: str = "json_data") -> DataFrame:
    return with_parsed(df, F.from_json(text, schema), into)
