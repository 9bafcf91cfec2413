import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyloom import session  # noqa: E402
from tallyloom.sources.fixtures import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"}
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, folder):
    return Tables(spark, folder)


@pytest.fixture
def scratch(spark):
    return session.scratch(spark, "test")


@pytest.fixture
def records(spark):
    """Turns Python values into landed records."""
    import json

    def make(*values, **columns):
        rows = [(v if isinstance(v, str) else json.dumps(v), i) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "json_data string, place int")

    return make
