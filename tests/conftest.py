import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from placetime.session import local_session

    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def one(spark):
    """Value of one expression over one row of named values."""
    def evaluate(column, **values):
        frame = spark.range(1)
        for name, value in values.items():
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(value))
        return frame.select(column.alias("v")).first()["v"]
    return evaluate
