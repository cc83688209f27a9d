import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *names):
        found = [tuple(r) for r in (df.select(*names) if names else df).collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (int, float)) else (True, "", v) for v in r))

    return collect


@pytest.fixture
def values(spark):
    """Result of a column function for each of some values."""

    def apply(function, texts, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
        found = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [tuple(r.y) if isinstance(r.y, tuple) else r.y for r in found]

    return apply
