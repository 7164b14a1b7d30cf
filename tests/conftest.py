import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value_of(spark):
    """Value of a column expression over one row of strings."""
    from pyspark.sql import functions as F

    def evaluate(expression, text):
        row = spark.createDataFrame([(text,)], "v STRING").select(expression(F.col("v")))
        return row.first()[0]

    return evaluate
