import os
import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", os.path.join(work, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(work, "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
