"""Lifecycle of stored cell tables: create, exists, append, rewrite, drop.

Tables are ordinary Parquet tables of the session catalog. Cells are only ever
appended; a delete writes the remaining cells to a new table and swaps the names,
because a plan cannot overwrite the files it reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.cells import newest_versions
from scoreloom.schemas import CELL_ID, CELLS

DEFAULT_MAX_VERSIONS = 3


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(
    spark: SparkSession,
    name: str,
    families: list[str],
    max_versions: int = DEFAULT_MAX_VERSIONS,
) -> None:
    """Create the table unless it exists; families and versions become properties."""
    if not families:
        raise ValueError("a cell table needs at least one family")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CELLS.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet TBLPROPERTIES "
        f"('families' = '{','.join(families)}', 'max_versions' = '{max_versions}')"
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_property(spark: SparkSession, name: str, key: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('{key}')").first()["value"]


def by_key(cells: DataFrame) -> DataFrame:
    """Range-partition and sort cells by key, so that key predicates skip row groups.

    The whole cell address is in the range key: a row with very many cells or
    versions is spread over several partitions.
    """
    address = [*CELL_ID, "version"]
    return cells.repartitionByRange(*address).sortWithinPartitions(*address)


def append_cells(spark: SparkSession, name: str, cells: DataFrame) -> None:
    """Append cells; a cell of a family the table does not have fails the write."""
    families = table_property(spark, name, "families").split(",")
    known = F.col("family").isin(families)
    message = F.concat(F.lit(f"table {name} has no family "), F.col("family"))
    family = F.when(known, F.col("family")).otherwise(F.raise_error(message).cast("string"))
    checked = cells.select(*[f.name for f in CELLS.fields]).withColumn("family", family)
    by_key(checked).write.mode("append").insertInto(name)


def read_cells(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def rewrite_table(spark: SparkSession, name: str, cells: DataFrame) -> None:
    """Replace the content of the table by `cells`, which may be derived from it.

    The successor is complete before the old table goes; a job that dies between the
    two leaves the successor under its own name.
    """
    families = table_property(spark, name, "families").split(",")
    max_versions = int(table_property(spark, name, "max_versions"))
    successor = f"{name}_{uuid.uuid4().hex[:12]}"
    create_table(spark, successor, families, max_versions)
    append_cells(spark, successor, cells)
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {successor} RENAME TO {name}")


def trim_versions(spark: SparkSession, name: str) -> None:
    """Rewrite the table without versions older than its `max_versions` property."""
    k = int(table_property(spark, name, "max_versions"))
    kept = newest_versions(read_cells(spark, name), k).drop("age")
    rewrite_table(spark, name, kept)
