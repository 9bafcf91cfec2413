"""From raw documents to packed training sequences: each stage works on all that the stage before it kept.

Every stage takes nulls, empty and very long texts, repeated rows, several texts of one id, an empty table and further columns. A
row is known by its id and its text, so no row goes because of another one's text. A null text is an empty one, whose quality the
classifier judges; without labels nothing is rejected. Rows without words are never near duplicates or contaminated. A document
whose text is wholly repeated stays, with an empty text, and is packed as the end mark alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyloom import session
from tallyloom.llm import common, decontaminate, jaccard_join, packing, quality_gbdt, queries, suffix_dedup


# Repeated byte strings of this length are taken out. Passages of over 50 words begin at some 250 bytes; strings that long which
# clean documents share by chance are rare, shorter ones less so.
PASSAGE = 250


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    common.prepare(spark)
    trees = quality_gbdt.fit(docs, common.table(spark, sf_dir, "labels"))
    return quality_gbdt.keep_good(docs, trees)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar ones."""
    common.prepare(spark)
    return jaccard_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long byte strings that occur more than once."""
    common.prepare(spark)
    return suffix_dedup.clean(docs, PASSAGE)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    common.prepare(spark)
    return decontaminate.drop_found(docs, common.table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    common.prepare(spark)
    return packing.pack(docs, queries.public_tokenizer())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_items),
    ("packing", sequences),
]

# Trees, a tokenizer and a suffix order stand in the way of SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between two stages the rows are a Parquet table in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    folder = session.scratch(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
