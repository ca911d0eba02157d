import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.default.parallelism", "3")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def two_blobs(spark):
    """Two separable classes of unequal size."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        y = 1 if i % 3 == 0 else 0
        x = rng.normal([4.0 * y, -3.0 * y], 1.0)
        rows.append((i, float(x[0]), float(x[1]), y))
    return spark.createDataFrame(rows, "key long, a double, b double, label int").repartition(3).cache()


@pytest.fixture(scope="session")
def three_blobs(spark):
    """Three classes with text labels, four columns; one class has three rows only."""
    rng = np.random.default_rng(2)
    centres = {"x": [0, 0, 0, 0], "y": [5, 5, 0, 0], "z": [0, 5, 5, 5]}
    rows = []
    for i in range(240):
        k = "z" if i < 3 else ("x", "y")[i % 2]
        v = rng.normal(centres[k], 0.8)
        rows.append((i, *[float(c) for c in v], k))
    return spark.createDataFrame(rows, "key long, a double, b double, c double, d double, label string").cache()


def rows_of(df, *order):
    """Rows as tuples, sorted."""
    return sorted(tuple(r) for r in (df.select(*order) if order else df).collect())


@pytest.fixture
def rows():
    return rows_of
