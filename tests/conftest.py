import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # A zone with clock changes: nothing may depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stagewatch-test-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def slices_of(spark):
    """Force the path for oversized groups by lowering the row limit."""
    def limit(rows: int) -> None:
        spark.conf.set("spark.stagewatch.sliceRows", str(rows))

    yield limit
    spark.conf.unset("spark.stagewatch.sliceRows")
