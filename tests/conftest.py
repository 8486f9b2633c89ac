import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from freshet.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    spark = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(work / "checkpoints"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def one(spark):
    """Values of expressions on one row."""

    def run(**columns):
        return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()

    return run


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def run(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return run
