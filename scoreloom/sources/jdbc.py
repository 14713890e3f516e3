"""Reading a relational table, in parallel where a numeric column allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The whole table. Without a partition column one task reads it, which suits
    the ten-row ranking table; anything larger should be read in partitions."""
    given = [partition_column is not None, bounds is not None, partitions is not None]
    if any(given) and not all(given):
        raise ValueError("partition_column, bounds and partitions belong together")
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    low, high = bounds
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=properties or {},
    )
