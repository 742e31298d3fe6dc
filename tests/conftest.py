import os

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
