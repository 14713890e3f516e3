"""Keyed tables in key ranges: loads and deletes rewrite the ranges they touch, and no other.

A table is a Parquet folder partitioned by `key_range`. The ranges and their lowest keys are
chosen once, when the table is created, by Spark's range partitioning; they stand beside the
table. A load finds the range of each of its keys, reads those ranges (the partition filter
leaves out all others), merges and replaces them by a dynamic partition overwrite.

Rows move once: a table is dealt and written in one shuffle, and so is what a load rewrites. The
overwrite stages its files and moves them into place when all are written, so a lost job has
changed no range or is finished by running it again: an upsert or delete of the same rows twice
gives the same table. One writer at a time, as for any folder.

Keys compare as text, byte by byte. A key before the first range belongs to the first one.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from scoreloom.operators import cells as cell_operators
from scoreloom.operators import upsert as upserts
from scoreloom.session import work_path

RANGES = 200
RANGE = "key_range"
ROWS_PER_TASK = 500_000  # rows that one task cuts, sorts and writes at most
CODEC = "zstd"  # of the stored and staged rows


def _tasks(spark: SparkSession, rows: DataFrame, key: str, least: int) -> int:
    """Tasks for dealing `rows` by key: more as the rows grow, so that no task sorts a growing share."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(key).alias("keys")).first()
    return max(1, min(counted.keys, max(least, shuffle, -(-counted.n // ROWS_PER_TASK))))


def create(df: DataFrame, path: str, key: str = "row_key", ranges: int = RANGES, staged: bool = True) -> None:
    """Write a keyed frame as a table of at most `ranges` key ranges, each sorted by key.

    The rows are read for their number, for Spark's range cut and for the table. They are staged
    in between, so that they are computed once; `staged=False` is for rows that are only read and
    projected, which takes less than to write them twice.
    """
    spark = df.sparkSession
    df.limit(0).write.parquet(posixpath.join(path, "shape"))  # the columns, also of a table without rows
    rows = df
    if staged:
        place = work_path(spark, "range-rows")
        df.write.parquet(place, compression=CODEC)
        rows = spark.read.parquet(place)
    # The ranges are runs of Spark's finer key cuts, so that no task holds a whole range.
    count = _tasks(spark, rows, key, ranges)
    ranges = min(ranges, count)
    number = F.least(F.floor(F.spark_partition_id() * ranges / count), F.lit(ranges - 1)).cast("int")
    dealt = rows.repartitionByRange(count, key).withColumn(RANGE, number).sortWithinPartitions(RANGE, key)
    dealt.write.partitionBy(RANGE).parquet(posixpath.join(path, "rows"), compression=CODEC)
    # A file is sorted by key: its first row has its lowest key, and nothing needs to be sorted again.
    first = stored(spark, path).where(F.col("_metadata.row_index") == 0).select(RANGE, F.col(key).alias("low"))
    found = first.groupBy(RANGE).agg(F.min("low").alias("low")).collect()
    lows = [(r.low or "", r[RANGE], key) for r in found] or [("", 0, key)]
    lowest = spark.createDataFrame(lows, f"lowest string, {RANGE} int, key_column string")
    lowest.coalesce(1).write.parquet(posixpath.join(path, "ranges"))


def _bounds(spark: SparkSession, path: str) -> tuple[str, list[str], list[int]]:
    """Key column, lowest key and number of each range, in order; at most `ranges` rows."""
    found = sorted((r.lowest, r[RANGE], r.key_column) for r in spark.read.parquet(posixpath.join(path, "ranges")).collect())
    if not found:
        return "row_key", [""], [0]
    return found[0][2], [low for low, *_ in found], [number for _, number, _ in found]


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table with their range, the partition column."""
    shape = spark.read.parquet(posixpath.join(path, "shape")).schema
    return spark.read.schema(shape.add(RANGE, IntegerType())).parquet(posixpath.join(path, "rows"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table, without the range column."""
    return stored(spark, path).drop(RANGE)


def range_of(key: Column, lows: list[str], numbers: list[int]) -> Column:
    """The range that holds a key: the last one whose lowest key is not above it."""
    below = F.size(F.filter(F.lit(lows), lambda low: low <= key))
    return F.element_at(F.lit(numbers), F.greatest(below, F.lit(1)))


def _touched(spark: SparkSession, path: str, keys: DataFrame) -> dict[int, int]:
    """How many of these keys each range holds, for ranges that hold any (at most all ranges)."""
    key, lows, numbers = _bounds(spark, path)
    found = keys.select(range_of(F.col(key), lows, numbers).alias(RANGE)).groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
    return {r[RANGE]: r.n for r in found.collect()}


def touched(spark: SparkSession, path: str, keys: DataFrame) -> list[int]:
    """Numbers of the ranges that hold any of these keys (at most all ranges)."""
    return sorted(_touched(spark, path, keys))


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """The files of the table and the range of each."""
    found = stored(spark, path).inputFiles()
    return {f: int(f.rsplit(f"{RANGE}=", 1)[1].split("/", 1)[0]) for f in found}


def rewrite(
    spark: SparkSession, path: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> list[int]:
    """Replace the ranges of `keys` by `change` of their rows; returns these ranges.

    `change` gets the rows of these ranges only and may add rows with keys of `keys`.
    """
    key, lows, numbers = _bounds(spark, path)
    rows = posixpath.join(path, "rows")
    asked = _touched(spark, path, keys)
    ids = sorted(asked)
    if not ids:
        return ids
    found = stored(spark, path).where(F.col(RANGE).isin(ids))
    changed = change(found.drop(RANGE)).select(*[c for c in found.columns if c != RANGE])
    ranged = changed.withColumn(RANGE, range_of(F.col(key), lows, numbers))
    # Each range is cut at its own keys, into more tasks as it grows; a file is sorted by key.
    count = max(len(ids), -(-(found.count() + sum(asked.values())) // ROWS_PER_TASK))
    dealt = ranged.repartitionByRange(count, RANGE, key).sortWithinPartitions(RANGE, key)
    before = _files(spark, path)
    replacing = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replacing.partitionBy(RANGE).parquet(rows, compression=CODEC)
    # The overwrite leaves a range that lost all rows as it was: its old files are still there.
    left = {number for file, number in _files(spark, path).items() if file in before}
    nothing = spark.createDataFrame([], spark.read.parquet(posixpath.join(path, "shape")).schema)
    for number in sorted(left & set(ids)):
        nothing.write.mode("overwrite").parquet(posixpath.join(rows, f"{RANGE}={number}"))
    return ids


def upsert(
    spark: SparkSession, path: str, load: DataFrame, order_by: list[str], large_load: bool = False
) -> list[int]:
    """The rows of `load` replace or extend the stored ones; of equal keys the last wins."""
    key, *_ = _bounds(spark, path)
    staged = work_path(spark, "range-load")
    upserts.last_per_key(load, [key], order_by).write.parquet(staged)
    winners = spark.read.parquet(staged)
    return rewrite(
        spark, path, winners, lambda found: upserts.upsert(found, winners, [key], order_by, large_load)
    )


def delete_rows(spark: SparkSession, path: str, keys: DataFrame) -> list[int]:
    """Remove all rows of these keys."""
    key, *_ = _bounds(spark, path)
    gone = keys.select(key).distinct()
    return rewrite(spark, path, gone, lambda found: found.join(gone, key, "left_anti"))


def delete_cells(
    spark: SparkSession, path: str, targets: DataFrame, all_versions: bool = False
) -> list[int]:
    """Remove the newest version (or all) of the target cells of a table of cells."""
    return rewrite(
        spark, path, targets, lambda found: cell_operators.delete_cells(found, targets, all_versions)
    )
