import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("rollcall-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "6g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["whole", "spread"])
def groups(request, monkeypatch):
    """Runs a test twice; 'spread' treats every group above two rows as hot."""
    from rollcall.functions import spread
    if request.param == "spread":
        monkeypatch.setattr(spread, "HOT_ROWS", 2)
        monkeypatch.setattr(spread, "CHUNK_BITS", 1)
    return request.param
