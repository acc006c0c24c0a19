import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chartloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, partitions=4, memory="4g")


@pytest.fixture
def rows(spark):
    """DataFrame from tuples and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def value(spark):
    """Value of a column expression built over one text column ``x``."""

    def evaluate(build, *texts):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[0] for r in df.orderBy("i").select(build(F.col("x")).alias("v")).collect()]

    return evaluate
