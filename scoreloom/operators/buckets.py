"""Cell tables bucketed and sorted by row key, read back without a shuffle.

The buckets are Spark's own (`bucketBy`), one sorted file each. Whatever groups or joins by
row key, or by a longer address that starts with it, finds its rows in place: current values,
versions, wide rows, row deletes and counts of rows plan no exchange of the stored cells. A
lookup by key reads one bucket.

One row may hold a large share of all cells, and its bucket is then one long task. So
`open_cells` compares the largest bucket with the mean, by the row counts of the files, and
beyond `MOST_SKEW` reads the same files without their bucketing: aggregates then shrink the row
in every task before a shuffle. So it does, too, once a bucket is larger than a file split
(`spark.sql.files.maxPartitionBytes`): with a fixed number of buckets, a task that reads a whole
bucket grows with the table. The choice changes plans, never results.
"""

from __future__ import annotations

import posixpath
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.schemas import CELL_ID, CELLS
from scoreloom.session import shared_dir

BUCKETS = 64
MOST_SKEW = 4.0


class BucketedCells(NamedTuple):
    name: str  #: table of the session catalog
    path: str  #: its folder
    buckets: int


def store_cells(
    cells: DataFrame, name: str | None = None, path: str | None = None, buckets: int = BUCKETS
) -> BucketedCells:
    """Write cells as a bucketed table; a new name and a work folder unless given."""
    spark = cells.sparkSession
    name = name or f"cells_{uuid.uuid4().hex}"
    path = path or posixpath.join(shared_dir(spark), name)
    # Dealt by the hash that buckets use, so that each bucket is one file.
    dealt = cells.select(*[f.name for f in CELLS.fields]).repartition(buckets, "row_key")
    writer = dealt.write.format("parquet").option("path", path)
    writer.bucketBy(buckets, "row_key").sortBy(*CELL_ID).saveAsTable(name)
    return BucketedCells(name, path, buckets)


def bucket_sizes(spark: SparkSession, stored: BucketedCells) -> DataFrame:
    """(file, n): cells of each bucket that has any; counts come from the file footers."""
    return spark.table(stored.name).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))


def skew(spark: SparkSession, stored: BucketedCells) -> float:
    """Cells of the largest bucket, as a multiple of the mean over all buckets."""
    most, total = bucket_sizes(spark, stored).agg(F.max("n"), F.sum("n")).first()
    return most * stored.buckets / total if total else 0.0


def largest_bucket_bytes(spark: SparkSession, stored: BucketedCells) -> int:
    """Bytes of the largest bucket file; sizes come from the file listing."""
    sizes = spark.table(stored.name).select("_metadata.file_name", "_metadata.file_size").distinct()
    return sizes.agg(F.max("file_size")).first()[0] or 0


def open_cells(spark: SparkSession, stored: BucketedCells, most_skew: float = MOST_SKEW) -> DataFrame:
    """The stored cells, by their buckets unless one of them is far larger than the others
    or than a file split."""
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    if skew(spark, stored) <= most_skew and largest_bucket_bytes(spark, stored) <= split:
        return spark.table(stored.name)
    return spark.read.parquet(stored.path)
