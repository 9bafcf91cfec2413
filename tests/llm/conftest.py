import pytest

from tallyloom.llm import common


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    common.prepare(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names the operators use themselves."""

    def make(rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, block long, th long, found long, words string, "
            "node string, label int, `own` int, away int"
        )
        full = [(i, t, "en", "s", 0 if t is None else len(t), 1, 2, 3, "w", "n", 7, 9, 4) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="session")
def documents(spark, folder):
    return common.table(spark, folder, "documents")


@pytest.fixture(scope="session")
def raw(documents):
    """doc_id and bytes of the small table's documents."""
    return [(r.doc_id, (r.text or "").encode()) for r in documents.select("doc_id", "text").collect()]


LONG = "word " * 60_000 + "end"
# Null and empty texts, white space, a long text, repeated rows, one id with two texts, no id.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "one two three four five six seven."), (5, "one two three four five six seven."),
    (6, "one"), (6, "another text of this id, which is longer."), (None, "no id here at all, but some words."), (None, None), (7, "\0 zero é 漢字 \U0001f600"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])
