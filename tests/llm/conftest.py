import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.llm.stage import Scratch, ship

from awkward import CLASHING, DOCUMENTS, awkward_texts


@pytest.fixture(scope="session", autouse=True)
def shipped(spark: SparkSession):
    ship(spark)


@pytest.fixture
def scratch(spark):
    return lambda: Scratch(spark, "test")


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "r", "k", "n", "s", "w", "d", 1, 2, "x", "y") for i, t in awkward_texts()]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
