"""JDBC source scans.

A plain ``dbtable`` read runs in one task; for large tables pass a numeric
``partition_column`` with bounds so Spark opens ``num_partitions`` parallel
range queries. Filters are applied as DataFrame predicates, which Spark
pushes into the generated SQL (``PushedFilters`` in the plan), instead of
splicing SQL text into a subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, *, user: str | None = None,
                    password: str | None = None, driver: str | None = None,
                    fetchsize: int = 10000, partition_column: str | None = None,
                    lower_bound: int | None = None, upper_bound: int | None = None,
                    num_partitions: int | None = None,
                    predicate: Column | None = None) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetchsize)))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                        .option("lowerBound", str(lower_bound))
                        .option("upperBound", str(upper_bound))
                        .option("numPartitions", str(num_partitions)))
    df = reader.load()
    return df.filter(predicate) if predicate is not None else df
