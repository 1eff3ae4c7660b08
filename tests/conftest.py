import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    place = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(place / "warehouse"))
               .config("spark.checkpoint.dir", str(place / "shared")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
