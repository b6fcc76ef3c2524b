"""Stored history from a relational database over JDBC (partitioned read).

The original store is a relational table keyed by ``(city,
event_timestamp)``. Spark reads it in parallel ranges of a numeric or time
column instead of LIMIT/OFFSET pages; the key filter and the column list are
pushed into the SQL Spark sends. Needs the database's JDBC driver on the
classpath; not exercised by the tests (no database runs here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import RAW_FEATURES


def read_history_jdbc(spark: SparkSession, url: str, table: str, *, city: str | None = None,
                      partition_column: str = "event_timestamp", lower_bound: str, upper_bound: str,
                      num_partitions: int, properties: dict | None = None) -> DataFrame:
    """``city, event_timestamp, aqi, <6 pollutants>`` read in ``num_partitions``
    parallel ranges of ``partition_column`` (bounds only split the ranges;
    rows outside them are still read)."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load().select("city", "event_timestamp", "aqi", *RAW_FEATURES)
    return df.where(F.col("city") == city) if city is not None else df
