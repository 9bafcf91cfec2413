"""What is registered, and the pipeline as a whole."""

import corpus_pipeline
from tallyloom import session
from tallyloom.llm import common, queries
from tests.compare import compare, duck


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_oracles(spark, folder):
    connection = duck(folder)
    for name, sql in queries.ORACLE.items():
        assert compare(spark, connection, folder, name, queries.QUERIES[name], sql) is None


def test_pipeline_stages(spark, folder):
    docs = common.table(spark, folder, "documents")
    columns, before, place = docs.columns, docs, session.scratch(spark, "test-pipeline")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, folder).write.parquet(f"{place}/{k}")
        after = spark.read.parquet(f"{place}/{k}")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == columns, name
            assert 0 < after.count() <= before.count()
            assert after.select("doc_id").distinct().count() == after.count()
            before = after
    good = {r.doc_id for r in common.table(spark, folder, "labels").where("quality = 1").collect()}
    first = {r.doc_id for r in spark.read.parquet(f"{place}/0").select("doc_id").collect()}
    assert len(good & first) > 0.97 * len(good)
    # Every kept document is packed whole.
    whole = after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(whole) == before.count() and all(r["sum(length)"] == r["max(doc_tokens)"] for r in whole)


def test_pipeline_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "ids_crc32"} <= set(rows.columns) and rows.count() > 0


def test_pipeline_of_odd_rows(spark, folder, odd):
    clean = "This text is nobody's copy and names things that no other one names, such as a heron, a ladder and some old bread."
    near = "Of these two rows one is a copy of the other one, but for its last few words, which have been written anew in it, as here {}."
    more = [(20, near.format("and there")), (21, near.format("or so")), (21, clean), (None, near.format("and there")), (None, clean[:60])]
    rows = odd.unionByName(odd.sparkSession.createDataFrame([(*r, *odd.first()[2:]) for r in more], odd.schema))
    stages = dict(corpus_pipeline.STAGES)
    names, place = rows.columns, session.scratch(spark, "odd-pipeline")
    # The classifier may reject any of these; all others see them all.
    assert set(names) == set(stages.pop("quality classifier")(spark, rows, folder).columns)
    for k, (name, stage) in enumerate(stages.items()):
        stage(spark, rows, folder).write.parquet(f"{place}/{k}")
        after = spark.read.parquet(f"{place}/{k}")
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in rows.collect()}
            break
        assert after.columns == names
        kept = [(r.doc_id, r.text or "") for r in after.select("doc_id", "text").collect()]
        assert (21, clean) in kept and (None, clean[:60]) in kept and sum(i in (20, 21) for i, _ in kept) == 2
        assert sum(i is None and t.startswith("Of these") for i, t in kept) == 0
        rows = after


def test_pipeline_of_nothing(spark, folder):
    docs = common.table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
