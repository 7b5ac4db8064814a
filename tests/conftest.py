import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4,2]")  # a failed task is tried once more
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getConf().get("spark.checkpoint.dir"):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "space")


SEVEN = "_1 string, _2 int, _3 boolean, _4 float, _5 double, _6 bigint, _7 tinyint"
ROWS1 = [
    ("plum", 7, False, -2.5, 1e300, 2**63 - 1, -128),
    (None, 8, None, None, -0.0, None, 127),
    ("", 9, True, 3.5, 6.25, -(2**63), None),
]
ROWS2 = ["oak", "elm", "ash", "oak", ""]
