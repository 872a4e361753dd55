import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[*]").appName("lakeingest-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
