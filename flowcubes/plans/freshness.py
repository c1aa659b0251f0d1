"""Data vintage across the published tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def freshness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q23: the newest ``run_ts`` over all tables and the number of distinct
    vintages; anything but 1 means a partial refresh.

    Only ``run_ts`` is read from each table. A distinct-then-union keeps the
    stacked input at one row per (table, vintage)."""
    frames = [df.select("run_ts").distinct() for df in tables.values()]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    return stacked.agg(
        F.max("run_ts").alias("refreshed_at"),
        F.count_distinct("run_ts").alias("distinct_vintages"),
    )
