import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crmlake.session import builder  # noqa: E402
from crmlake.sources import landed as L  # noqa: E402

NOW = "2024-01-15 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = (builder("tests").master("local[4]").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def objects(spark):
    """Parsed objects of a type from Python payloads (dicts or raw text), in order."""

    def make(object_type, *payloads):
        rows = [(p if isinstance(p, str) else json.dumps(p), i) for i, p in enumerate(payloads)]
        return L.parse_objects(spark.createDataFrame(rows, "raw string, seq long"), object_type)

    return make


@pytest.fixture
def pages(spark):
    def make(*payloads):
        rows = [(json.dumps(p), "f", i) for i, p in enumerate(payloads)]
        return spark.createDataFrame(rows, "page string, file string, at long")

    return make
