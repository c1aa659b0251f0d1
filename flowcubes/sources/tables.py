"""Parquet tables of a data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table; ``name.parquet`` may be a file or a directory of parts."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))
