import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loomset.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def unified(spark):
    """Build a unified table from (instruction, input, output) tuples, numbered from 0."""

    def build(*rows, partitions=None):
        data = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(data, "row_id bigint, instruction string, input string, output string")
        return df.repartition(partitions) if partitions else df

    return build


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
