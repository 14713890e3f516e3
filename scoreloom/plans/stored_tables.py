"""Registered queries on stored tables: bucketed cells, key ranges, indexes, bitmaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import bitmaps, buckets, cells, key_index, ranges, title_index
from scoreloom.plans import views
from scoreloom.plans.keyed_tables import CELL, VERSIONS
from scoreloom.plans.registry import query
from scoreloom.plans.searches import ITEM, ITEM_COLUMNS, KEYED, RATING_COLUMNS, USER, keyed_ratings
from scoreloom.plans.views import ITEMS, RATING_CELLS, RATINGS
from scoreloom.schemas import RATING_CELLS as RATING_ADDRESSES
from scoreloom.session import work_path

FILES = 8  # buckets and ranges of the tables below; a cluster takes more


# --- bucketed cells --------------------------------------------------------------------


def _stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.open_cells(spark, buckets.store_cells(views.rating_cells(spark, sf_dir), buckets=FILES))


@query(f"SELECT {CELL} FROM {VERSIONS} WHERE age = 1")
def stored_cells_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.latest(_stored_cells(spark, sf_dir))


@query(f"SELECT {CELL}, CAST(age AS INTEGER) AS age FROM {VERSIONS} WHERE age <= 3")
def stored_cell_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.newest_versions(_stored_cells(spark, sf_dir), 3)


@query(f"""
SELECT row_key, CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
  CAST(rating AS VARCHAR) AS rating, CAST(timestamp AS VARCHAR) AS timestamp FROM {KEYED}""")
def stored_rating_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings stored as bucketed cells and scanned back as rows."""
    as_cells = cells.to_cells(
        keyed_ratings(spark, sf_dir), F.col("row_key"), RATING_ADDRESSES, F.col("timestamp")
    )
    stored = buckets.store_cells(as_cells, buckets=FILES)
    return cells.wide(buckets.open_cells(spark, stored), RATING_ADDRESSES)


@query(f"""
SELECT {CELL} FROM {RATING_CELLS}
WHERE row_key NOT IN (SELECT row_key FROM {ITEMS} WHERE kind = 'ECONOMY')""")
def stored_delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = views.items(spark, sf_dir).where(F.col("kind") == "ECONOMY")
    return cells.delete_rows(_stored_cells(spark, sf_dir), gone)


# --- key ranges ------------------------------------------------------------------------

TAKEN = "row_key >= '5' AND row_key < '52'"  # the keys of a load: some ranges of the table


@query(f"""
SELECT {RATING_COLUMNS} FROM {KEYED} WHERE NOT ({TAKEN})
UNION ALL SELECT row_key, user_id, item_id, 0.5::DOUBLE, timestamp + 1 FROM {KEYED} WHERE {TAKEN}
UNION ALL SELECT row_key || '_new', user_id, item_id, 5.0::DOUBLE, timestamp FROM {KEYED} WHERE {TAKEN}""")
def upsert_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of some key ranges replaces old keys and adds new ones."""
    path = work_path(spark, "ranged-ratings")
    ranges.create(keyed_ratings(spark, sf_dir), path, ranges=FILES)
    rows = ranges.read(spark, path).where(TAKEN)
    changed = rows.withColumn("rating", F.lit(0.5)).withColumn("timestamp", F.col("timestamp") + 1)
    added = rows.withColumn("row_key", F.concat("row_key", F.lit("_new"))).withColumn("rating", F.lit(5.0))
    ranges.upsert(spark, path, changed.unionByName(added), ["timestamp"])
    return ranges.read(spark, path)


@query(f"""
SELECT {CELL} FROM {VERSIONS} WHERE NOT (row_key >= '2' AND row_key < '25' AND age = 1)
  AND NOT (row_key >= '7' AND row_key < '72')""")
def delete_in_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of some cells goes, and all cells of other rows."""
    path = work_path(spark, "ranged-cells")
    one_each = views.rating_cells(spark, sf_dir).groupBy("row_key", "family", "qualifier", "version").agg(
        F.min("value").alias("value")
    )
    ranges.create(one_each, path, ranges=FILES)
    address = ["row_key", "family", "qualifier"]
    ranges.delete_cells(spark, path, ranges.read(spark, path).where("row_key >= '2' AND row_key < '25'").select(*address))
    ranges.delete_rows(spark, path, ranges.read(spark, path).where("row_key >= '7' AND row_key < '72'").select("row_key"))
    return ranges.read(spark, path)


# --- lookups by index ------------------------------------------------------------------


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "indexed-ratings")
    key_index.create(keyed_ratings(spark, sf_dir), path, FILES)
    return path


@query(f"SELECT {RATING_COLUMNS} FROM {KEYED} WHERE starts_with(row_key, '{USER}_')")
def indexed_ratings_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_index.ratings_of_user(spark, _indexed(spark, sf_dir), USER)


@query(f"SELECT {RATING_COLUMNS} FROM {KEYED} WHERE split_part(row_key, '_', 2) = '{ITEM}'")
def indexed_ratings_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_index.ratings_of_item(spark, _indexed(spark, sf_dir), ITEM)


@query(f"""SELECT {RATING_COLUMNS} FROM {KEYED}
WHERE list_contains(string_split(row_key, '_')[2:], '{ITEM}')""")
def indexed_ratings_by_key_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_index.ratings_mentioning(spark, _indexed(spark, sf_dir), ITEM)


@query(f"SELECT {RATING_COLUMNS} FROM {KEYED} WHERE starts_with(row_key, '{USER}_')")
def indexed_fallback_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_index.find_ratings_of_user(spark, _indexed(spark, sf_dir), USER)


@query(f"""SELECT 'e' || user_id || '-' || item_id AS row_key, user_id, item_id, rating, timestamp
FROM {KEYED} WHERE user_id = {USER}""")
def indexed_fallback_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of another form: the user column has to answer."""
    path = work_path(spark, "indexed-ratings")
    odd_key = F.concat(F.lit("e"), "user_id", F.lit("-"), "item_id")
    key_index.create(keyed_ratings(spark, sf_dir).withColumn("row_key", odd_key), path, FILES)
    return key_index.find_ratings_of_user(spark, path, USER)


@query(f"""
SELECT CASE WHEN item_id = {ITEM} THEN 'x' || user_id ELSE row_key END AS row_key,
  user_id, item_id, rating, timestamp FROM {KEYED} WHERE item_id = {ITEM}""")
def indexed_fallback_of_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No key names the item, as its keys are of another form: the item column answers."""
    path = work_path(spark, "indexed-ratings")
    odd_key = F.when(F.col("item_id") == int(ITEM), F.concat(F.lit("x"), "user_id")).otherwise(F.col("row_key"))
    key_index.create(keyed_ratings(spark, sf_dir).withColumn("row_key", odd_key), path, FILES)
    return key_index.find_ratings_of_item(spark, path, ITEM, by_pattern=True)


@query(f"""SELECT {RATING_COLUMNS} FROM {KEYED} WHERE split_part(row_key, '_', 2) = '{ITEM}' AND user_id % 2 = 1
UNION ALL SELECT row_key, user_id, item_id, 1.0::DOUBLE, timestamp + 5 FROM {KEYED} WHERE item_id = {ITEM} AND user_id % 2 = 0""")
def indexed_lookup_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after a load that replaces half of the item's ratings."""
    path = _indexed(spark, sf_dir)
    again = key_index.ratings_table(spark, path).where((F.col("item_id") == int(ITEM)) & (F.col("user_id") % 2 == 0))
    load = again.withColumn("rating", F.lit(1.0)).withColumn("timestamp", F.col("timestamp") + 5)
    key_index.add(spark, path, load, ["timestamp"])
    return key_index.ratings_of_item(spark, path, ITEM)


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE contains(lower(title), 'ring')")
def indexed_title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "title-index")
    title_index.create(views.items(spark, sf_dir).drop("kind"), path, F.lower("title"), files=FILES)
    return title_index.search(spark, path, "ring")


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE contains(title, 'd ')")
def indexed_title_search_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword shorter than a gram, letter case included."""
    path = work_path(spark, "title-index")
    title_index.create(views.items(spark, sf_dir).drop("kind"), path, F.col("title"), files=FILES)
    return title_index.search(spark, path, "d ")


# --- distinct counts that add up ---------------------------------------------------------


@query(f"SELECT count(DISTINCT user_id) AS user_count FROM {RATINGS}")
def distinct_users_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bitmaps of the older ratings and bitmaps of the newer ones, merged."""
    path = work_path(spark, "user-bitmaps")
    rated = views.ratings(spark, sf_dir).select("user_id", "status")
    bitmaps.of_ids(rated.where("status = 'F'")).write.parquet(path)
    return bitmaps.count(bitmaps.merge(spark.read.parquet(path), bitmaps.of_ids(rated.where("status <> 'F'"))))
