import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from duolect import ship_package


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("duolect-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    session.sparkContext.addPyFile(str(Path(__file__).with_name("doubles.py")))
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test, left in place afterwards."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
