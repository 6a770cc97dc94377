import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lathe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def evaluate(spark):
    """Value of an expression function applied to literal texts."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        names = [f"v{i}" for i in range(len(values))]
        df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
        return df.select(fn(*[F.col(n) for n in names]).alias("out")).collect()[0]["out"]

    return run
