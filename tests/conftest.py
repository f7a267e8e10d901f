import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from pyspark.sql import SparkSession  # noqa: E402

from vitalgrid.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def rows():
    """Collect as sorted tuples, floats rounded."""

    def take(df, *cols):
        picked = df.select(*cols) if cols else df
        plain = lambda v: round(v, 6) if isinstance(v, float) else v
        return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))

    return take
