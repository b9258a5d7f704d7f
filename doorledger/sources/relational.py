"""Users and predictions: Parquet snapshots, or JDBC where a driver is on the class path."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, location: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(location)


def read_jdbc(spark: SparkSession, url: str, name: str, key: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """Parallel JDBC read, split on a numeric key."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", name)
            .option("partitionColumn", key).option("lowerBound", str(lower))
            .option("upperBound", str(upper)).option("numPartitions", str(partitions))
            .options(**options).load())


def write_snapshot(df: DataFrame, base: str) -> str:
    """Write a new version of a table next to the older ones and return its path.

    A table is never overwritten while a plan may still read it.
    """
    path = f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path
