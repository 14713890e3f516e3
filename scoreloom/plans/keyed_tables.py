"""Registered queries: cells, versions, upserts, deletes and file ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import cells, tables
from scoreloom.operators.upsert import last_per_key, upsert
from scoreloom.plans import views
from scoreloom.plans.registry import query
from scoreloom.plans.searches import KEYED, keyed_ratings
from scoreloom.plans.views import EVENTS, ITEM_RATINGS, ITEMS, RATING_CELLS, RATINGS
from scoreloom.schemas import ITEM_CELLS, RATING_CELLS as RATING_ADDRESSES
from scoreloom.sinks.writers import write_counted
from scoreloom.sources import csv_files
from scoreloom.session import work_path

# One value per version of a cell, and its rank from the newest.
VERSIONS = f"""(SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier
  ORDER BY version DESC) AS age FROM (SELECT row_key, family, qualifier, version,
  min(value) AS value FROM {RATING_CELLS} GROUP BY ALL))"""
CELL = "row_key, family, qualifier, version, value"
CELLS_PER_TASK = 2_000_000  # cells that one task of a wide scan sorts, at most


def _loads_sql() -> str:
    """Old rows are status F, the load is status O; the last row of the load wins."""
    last = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY status, row_key ORDER BY
      timestamp DESC, order_id DESC, line_no DESC, rating DESC) AS age FROM {RATINGS}) WHERE age = 1)"""
    columns = "row_key, rating, timestamp, order_id, line_no"
    return f"""
WITH last AS {last}
SELECT {columns} FROM last WHERE status = 'O'
UNION ALL SELECT {columns} FROM last WHERE status = 'F'
  AND row_key NOT IN (SELECT row_key FROM last WHERE status = 'O')"""


@query(_loads_sql())
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into one keyed table: first the F rows, then the O rows."""
    rated = views.ratings(spark, sf_dir).select(
        "row_key", "rating", "timestamp", "order_id", "line_no", "status"
    )
    order = ["timestamp", "order_id", "line_no"]
    old, new = (rated.where(F.col("status") == s).drop("status") for s in ("F", "O"))
    empty = rated.drop("status").limit(0)
    stored = upsert(empty, old, ["row_key"], order)
    return upsert(stored, new, ["row_key"], order, large_load=True)


@query(f"""
WITH last AS (SELECT row_key, max(timestamp) AS timestamp FROM {RATINGS} GROUP BY row_key)
SELECT row_key, CASE WHEN row_key IN (SELECT user_id || '_' || item_id FROM {EVENTS})
    THEN -1 ELSE timestamp END AS timestamp FROM last
UNION SELECT user_id || '_' || item_id, -1 FROM {EVENTS}""")
def upsert_small_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, which are few, replace or extend the ratings; all get the time -1."""
    rated = views.ratings(spark, sf_dir).select("row_key", "timestamp")
    stored = last_per_key(rated, ["row_key"], ["timestamp"])
    load = views.events(spark, sf_dir).select(
        F.concat_ws("_", "user_id", "item_id").alias("row_key"), F.lit(-1).cast("bigint").alias("timestamp")
    )
    return upsert(stored, load, ["row_key"], ["timestamp"])


@query(f"SELECT {CELL}, CAST(age AS INTEGER) AS age FROM {VERSIONS} WHERE age <= 3")
def cell_versions_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.newest_versions(views.rating_cells(spark, sf_dir), 3)


@query(f"""
SELECT row_key, family, qualifier, version, value FROM (SELECT *, row_number() OVER (
  PARTITION BY row_key, family, qualifier ORDER BY version) AS first FROM {VERSIONS} WHERE age <= 5)
WHERE first = 1""")
def cell_oldest_of_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.oldest_of_newest(views.rating_cells(spark, sf_dir), 5)


@query(f"SELECT {CELL} FROM {VERSIONS} WHERE age = 1")
def cells_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.latest(views.rating_cells(spark, sf_dir))


@query(f"""
SELECT row_key, CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
  CAST(rating AS VARCHAR) AS rating, CAST(timestamp AS VARCHAR) AS timestamp FROM {KEYED}""")
def rating_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings stored as cells of a catalog-free Parquet folder and scanned back as rows."""
    stored = work_path(spark, "rating-cells")
    as_cells = cells.to_cells(
        keyed_ratings(spark, sf_dir), F.col("row_key"), RATING_ADDRESSES, F.col("timestamp")
    )
    written = write_counted(tables.by_key(as_cells), stored)
    # The rows' values are text, so their aggregate sorts what a task holds: dealt by key into
    # tasks of at most CELLS_PER_TASK cells, not by file split, a task does not grow with the table.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-written // CELLS_PER_TASK))
    return cells.wide(spark.read.parquet(stored).repartition(tasks, "row_key"), RATING_ADDRESSES)


@query(f"SELECT row_key, title, genres FROM {ITEMS}")
def items_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.wide(views.item_cells(spark, sf_dir), ITEM_CELLS)


@query(f"""
SELECT row_key, 'info' AS family, qualifier, CAST(1 AS BIGINT) AS version, value FROM (
  SELECT row_key, 'title' AS qualifier, title AS value FROM {ITEMS}
  UNION ALL SELECT row_key, 'genres', genres FROM {ITEMS})
WHERE row_key IN (SELECT row_key FROM {ITEMS} ORDER BY row_key LIMIT 15)""")
def first_keys_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.first_keys_cells(views.item_cells(spark, sf_dir), 15)


@query(f"""
SELECT {CELL} FROM {RATING_CELLS}
WHERE row_key NOT IN (SELECT row_key FROM {ITEMS} WHERE kind = 'ECONOMY')""")
def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = views.items(spark, sf_dir).where(F.col("kind") == "ECONOMY")
    return cells.delete_rows(views.rating_cells(spark, sf_dir), gone)


def _economy_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.items(spark, sf_dir).where(F.col("kind") == "ECONOMY").select(
        "row_key", F.lit("rateinfo").alias("family"), F.lit("rating").alias("qualifier")
    )


# After the newest version is gone, the one before it is the current value.
@query(f"""
SELECT {CELL} FROM {VERSIONS}
WHERE age = CASE WHEN row_key IN (SELECT row_key FROM {ITEMS} WHERE kind = 'ECONOMY')
  THEN 2 ELSE 1 END""")
def delete_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = cells.delete_cells(
        views.rating_cells(spark, sf_dir), _economy_cells(spark, sf_dir)
    )
    return cells.latest(left)


@query(f"""
SELECT {CELL} FROM {RATING_CELLS}
WHERE row_key NOT IN (SELECT row_key FROM {ITEMS} WHERE kind = 'ECONOMY')""")
def delete_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.delete_cells(
        views.rating_cells(spark, sf_dir), _economy_cells(spark, sf_dir), all_versions=True
    )


@query(f"SELECT count(DISTINCT row_key) AS row_count FROM {RATING_CELLS}")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.count_rows(views.rating_cells(spark, sf_dir))


def _uneven_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ratings stored in five layouts, one per kind of event."""
    e = views.events(spark, sf_dir)
    user, item, rating, time = "user_id", "item_id", "rating", "timestamp"
    layouts = {
        "click": {user: ("info", "userId"), item: ("info", "movieId"),
                  rating: ("info", "rating"), time: ("info", "timestamp")},
        "view": {rating: ("data", "Score"), time: ("data", "TIME")},
        "purchase": {user: ("info", "userId"), item: ("info", "movieId"), rating: ("info", "score")},
        "error": {rating: ("info", "rating"), "no_time": ("info", "timestamp")},
        "signup": {"event_id": ("data", "score"), rating: ("alt", "rating"),
                   time: ("x", "timestamp"), user: ("zz", "userId")},
    }
    key = F.concat_ws("_", "user_id", "item_id", "event_id")
    e = e.withColumn("no_time", F.lit(""))
    parts = [
        cells.to_cells(e.where(F.col("kind") == kind), key, columns, F.lit(1))
        for kind, columns in layouts.items()
    ]
    uneven = parts[0]
    for part in parts[1:]:
        uneven = cells.put(uneven, part)
    return uneven


@query(f"""
SELECT user_id || '_' || item_id || '_' || event_id AS row_key,
  CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
  CAST(rating AS VARCHAR) AS rating,
  CAST(CASE WHEN kind IN ('purchase', 'error') THEN event_id ELSE timestamp END AS VARCHAR)
    AS timestamp FROM {EVENTS}""")
def schema_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.ratings_by_schema_on_read(_uneven_cells(spark, sf_dir))


# --- files ---------------------------------------------------------------------------


def _rating_file(spark: SparkSession, sf_dir: str, label: str) -> str:
    """All ratings as a CSV folder; returned items (flag R) lack their last field."""
    path = work_path(spark, label)
    complete = F.concat_ws(",", "user_id", "item_id", "rating", "timestamp")
    short = F.concat_ws(",", "user_id", "item_id", "rating")
    line = F.when(F.col("flag") == "R", short).otherwise(complete)
    header = "userId,movieId,rating,timestamp"
    # Every part file of a folder needs its own header, as Spark writes and reads it.
    views.ratings(spark, sf_dir).select(line.alias(header)).write.options(
        header=True, quote="", escapeQuotes=False
    ).csv(path)
    return path


@query(f"""
SELECT count(*) AS read_count, CAST(count(*) FILTER (WHERE flag = 'R') AS BIGINT) AS rejected_count,
  count(*) FILTER (WHERE flag <> 'R') - count(DISTINCT row_key) FILTER (WHERE flag <> 'R')
    AS duplicate_count,
  count(DISTINCT row_key) FILTER (WHERE flag <> 'R') AS stored_count, true AS complete
FROM {RATINGS}""")
def ingest_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rating file with short records is loaded into an empty table and accounted for."""
    load = csv_files.ingest_ratings(spark, _rating_file(spark, sf_dir, "ratings-csv"))
    stored = work_path(spark, "ratings")
    csv_files.load(load.accepted.drop("load_order").limit(0), load).write.parquet(stored)
    return csv_files.reconcile(load, spark.read.parquet(stored))


@query(f"SELECT CAST(row_key AS VARCHAR) AS row_key, title, genres FROM {ITEMS}")
def ingest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog through a quoted CSV file with padded fields."""
    path = work_path(spark, "items-csv")
    views.items(spark, sf_dir).select(
        F.col("item_id").alias("movieId"),
        F.concat(F.lit("  "), "title", F.lit("\t ")).alias("title"),
        "genres",
    ).write.options(
        header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return csv_files.ingest_items(spark, path).accepted.select("row_key", "title", "genres")


@query(f"SELECT item_id, avg(rating) AS avg_rating, count(*) AS n FROM {ITEM_RATINGS} GROUP BY item_id")
def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings through a typed CSV scan, aggregated per item."""
    path = work_path(spark, "typed-csv")
    views.ratings(spark, sf_dir).select(
        F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating", "timestamp"
    ).write.option("header", True).csv(path)
    read = csv_files.read_ratings(spark, path).withColumn("item_id", F.col("item_id").cast("bigint"))
    return read.groupBy("item_id").agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("n")
    )
