from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from flowcubes.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = build_session("local[4]", shuffle_partitions=8, app_name="flowcubes-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
