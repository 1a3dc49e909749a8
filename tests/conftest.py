import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from linecross.session import configure  # noqa: E402


#: The folder that stands for a cluster's shared one.
CHECKPOINTS = tempfile.mkdtemp(prefix="linecross-tests-")


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.ui.enabled", "false").config("spark.checkpoint.dir", CHECKPOINTS).config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config(
        "spark.ui.showConsoleProgress", "false").getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()
