import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Workers start elsewhere: like on a cluster, they cannot import the package.
    home = os.getcwd()
    os.chdir(tmp_path_factory.mktemp("elsewhere"))
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    os.chdir(home)
    yield session
    session.stop()
