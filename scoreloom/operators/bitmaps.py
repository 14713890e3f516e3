"""Exact distinct counts that add up: bitmaps of ids.

Ids fall into buckets of 32,768, and a bucket's ids are the bits of one 4 KB value. A day's
bitmaps are made by a map-side aggregate, so what is shuffled is one value per task and
bucket and never an id; days are merged by `or`. The number of distinct ids over any set of days
is the sum of set bits, with no return to the rows.

Ids are 64-bit integers, best dense ones; rows without an id are one unknown id, kept as
bucket NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def of_ids(df: DataFrame, column: str = "user_id") -> DataFrame:
    """(bucket, bits): the bitmap of a column; bucket NULL stands for rows without an id."""
    number = F.col(column).cast("bigint")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number))
    known = df.where(number.isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(bits.alias("bits"))
    unknown = df.where(number.isNull()).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    one_bit = F.lit(None).cast("bigint").alias("bucket"), F.unhex(F.rpad(F.lit("01"), 8192, "0")).alias("bits")
    return known.unionByName(unknown.select(*one_bit))


def merge(*bitmaps: DataFrame) -> DataFrame:
    """The union of several days' bitmaps."""
    together = reduce(DataFrame.unionByName, bitmaps)
    return together.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count(bitmaps: DataFrame, name: str = "user_count") -> DataFrame:
    """Number of distinct ids of merged bitmaps; an unknown id counts as one."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias(name))
