import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    session = local_session(8, "tests", **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a Column rule over a list of values of one type."""

    def run(values, dtype, rule):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
        rows = df.select("i", rule("x").alias("y")).orderBy("i").collect()
        return [row.y for row in rows]

    return run
