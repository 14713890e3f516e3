"""Lookups of stored ratings by user, item or any key part, without reading everything.

Row keys start with the user, so the ratings themselves, sorted by key, answer a key prefix.
All else asks a covering index: a copy of each rating under each value by which only the index
finds it, sorted by (value, kind). A lookup is one equality on `value`, which reaches the scan
and skips all row groups of other values; no join and no second read follow.

Kinds: `part` for each part of the key after the first (`second` tells whether the value
is the second one), `user` and `item` for the columns, where they are not what the key says:
a lookup asks a column only if no key matches, and a rating whose key starts with its user (or
has its item second) is itself such a match. Values are text. Both tables are
range tables (`ranges`), and `add` keeps both with each load: it takes the entries
of replaced ratings out and the new ones in, and rewrites only the ranges that these touch.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.keys import SEPARATOR
from scoreloom.operators import ranges
from scoreloom.operators.search import RATING_FIELDS, required
from scoreloom.operators.upsert import last_per_key
from scoreloom.session import work_path

PART, USER, ITEM = "part", "user", "item"


def entries(ratings: DataFrame) -> DataFrame:
    """(value, kind, second, entry) and the rating, for all by which a rating has to be found.

    `entry` is the key of the index: value, kind and row key, so that equal ones are one.
    """
    parts = F.split("row_key", SEPARATOR)
    later = F.array_distinct(F.slice(parts, F.lit(2), F.size(parts)))
    by_part = F.transform(
        later, lambda p: F.struct(p.alias("value"), F.lit(PART).alias("kind"), (p == F.get(parts, F.lit(1))).alias("second"))
    )
    user, item = F.col("user_id").cast("string"), F.col("item_id").cast("string")
    # `find_ratings_of_user` and `find_ratings_of_item` match such a rating by its key, ahead of its column.
    by_key = F.col("row_key").startswith(F.concat(user, F.lit(SEPARATOR))), F.get(parts, F.lit(1)).eqNullSafe(item)
    by_column = [
        F.struct(F.when(~named, value).alias("value"), F.lit(kind).alias("kind"), F.lit(False).alias("second"))
        for value, named, kind in zip((user, item), by_key, (USER, ITEM), strict=True)
    ]
    asked = ratings.select(F.inline(F.concat(by_part, F.array(*by_column))), *RATING_FIELDS)
    entry = F.concat_ws("\u0001", "value", "kind", "row_key")
    return asked.where(F.col("value").isNotNull()).withColumn("entry", entry)


def _paths(path: str) -> tuple[str, str]:
    return posixpath.join(path, "ratings"), posixpath.join(path, "entries")


def create(ratings: DataFrame, path: str, count: int = ranges.RANGES) -> None:
    """Store keyed ratings and their index. The index is made from the stored ratings."""
    rows, index = _paths(path)
    ranges.create(ratings.select(*RATING_FIELDS), rows, "row_key", count)
    ranges.create(entries(ranges.read(ratings.sparkSession, rows)), index, "entry", count, staged=False)


def add(spark: SparkSession, path: str, load: DataFrame, order_by: list[str]) -> None:
    """Upsert a load of ratings into both tables."""
    rows, index = _paths(path)
    staged = work_path(spark, "indexed-load")
    last_per_key(load, ["row_key"], order_by).select(*RATING_FIELDS).write.parquet(f"{staged}/new")
    new = spark.read.parquet(f"{staged}/new")
    ids = ranges.touched(spark, rows, new)
    stored = ranges.stored(spark, rows).where(F.col(ranges.RANGE).isin(ids))
    stored.join(new, "row_key", "left_semi").select(*RATING_FIELDS).write.parquet(f"{staged}/old")
    old = spark.read.parquet(f"{staged}/old")
    gone, come = entries(old), entries(new)
    # The index first: should the job end here, running it again finds the same old rows.
    ranges.rewrite(
        spark, index, gone.select("entry").unionByName(come.select("entry")),
        lambda found: found.join(gone.select("entry"), "entry", "left_anti").join(come.select("entry"), "entry", "left_anti").unionByName(come),
    )
    ranges.rewrite(spark, rows, new, lambda found: found.join(new, "row_key", "left_anti").unionByName(new))


def ratings_table(spark: SparkSession, path: str) -> DataFrame:
    return ranges.read(spark, _paths(path)[0])


def _entries(spark: SparkSession, path: str, value: str) -> DataFrame:
    return ranges.read(spark, _paths(path)[1]).where(F.col("value") == value)


def ratings_of_user(spark: SparkSession, path: str, user_id: str) -> DataFrame:
    """By key prefix, on the ratings themselves."""
    prefix = required(user_id, "user id") + SEPARATOR
    return ratings_table(spark, path).where(F.col("row_key").startswith(prefix))


def ratings_of_item(spark: SparkSession, path: str, item_id: str) -> DataFrame:
    """Ratings whose key names the item in its second part."""
    found = _entries(spark, path, required(item_id, "item id"))
    return found.where((F.col("kind") == PART) & F.col("second")).select(*RATING_FIELDS)


def ratings_mentioning(spark: SparkSession, path: str, part: str) -> DataFrame:
    """Ratings with this key part anywhere after the first."""
    return _entries(spark, path, required(part, "key part")).where(F.col("kind") == PART).select(*RATING_FIELDS)


def _first(found: DataFrame) -> DataFrame:
    """Rows of the smallest `rank` that occurs."""
    best = found.agg(F.min("rank").alias("best")).scalar()
    return found.where(F.col("rank") == best).select(*RATING_FIELDS)


def find_ratings_of_user(spark: SparkSession, path: str, user_id: str) -> DataFrame:
    """By key prefix; only if no key matches, by the user column."""
    by_key = ratings_of_user(spark, path, user_id).select(*RATING_FIELDS, F.lit(0).alias("rank"))
    by_column = _entries(spark, path, user_id).where(F.col("kind") == USER)
    return _first(by_key.unionByName(by_column.select(*RATING_FIELDS, F.lit(1).alias("rank"))))


def find_ratings_of_item(
    spark: SparkSession, path: str, item_id: str, by_pattern: bool = False
) -> DataFrame:
    """By the second key part, then by the item column; `by_pattern` asks any later key part first."""
    found = _entries(spark, path, required(item_id, "item id"))
    is_part, is_item = F.col("kind") == PART, F.col("kind") == ITEM
    first = is_part if by_pattern else is_part & F.col("second")
    ranked = found.where(first | is_item)
    rank = F.when(is_item, 1).otherwise(0)
    return _first(ranked.select(*RATING_FIELDS, rank.alias("rank")))
