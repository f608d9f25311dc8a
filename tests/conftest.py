import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textmill import get_session

    s = get_session("local[*]", 8, app_name="textmill-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="textmill-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate a Column expression on one string value."""
    from pyspark.sql import functions as F

    def run(fn, value):
        df = spark.createDataFrame([(value,)], "v string")
        return df.select(fn(F.col("v")).alias("o")).first()["o"]

    return run


@pytest.fixture
def many(spark):
    """Evaluate a Column expression on a list of string values (order kept)."""
    from pyspark.sql import functions as F

    def run(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
