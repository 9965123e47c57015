"""JDBC scans and writes (users dimension, event history, raw sink).

Partitioned reads split the scan over ``num_partitions`` range predicates on a
numeric column, so a large table is not pulled through one connection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs bounds and num_partitions")
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 5000, mode: str = "append") -> None:
    """Bulk append in batches of ``batch_size`` rows per round trip."""
    props = dict(properties or {})
    props["batchsize"] = str(batch_size)
    df.write.jdbc(url, table, mode=mode, properties=props)
