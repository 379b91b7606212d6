import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from tidemark.workspace import checkpoint_dir

    if checkpoint_dir(session) is None:  # set one only where the session names none
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    yield session


@pytest.fixture()
def run(spark):
    import __spark_entry__ as E

    return E.Run(spark, SF)


@pytest.fixture()
def run01(spark):
    import __spark_entry__ as E

    return E.Run(spark, SF01)


@pytest.fixture()
def derby_url():
    return f"jdbc:derby:memory:t_{uuid.uuid4().hex[:10]};create=true"


@pytest.fixture()
def local_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
