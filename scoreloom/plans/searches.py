"""Registered queries: lookups, searches and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.keys import key_part, rating_key
from scoreloom.functions.text import normalize_title
from scoreloom.operators import cells, search, summary
from scoreloom.operators.upsert import last_per_key
from scoreloom.plans import views
from scoreloom.plans.registry import query
from scoreloom.plans.summaries import _summary_sql
from scoreloom.plans.views import EVENTS, ITEM_RATINGS, ITEMS, RATINGS, two_decimals_sql
from scoreloom.session import work_path

ITEM, USER = "77", "42"
RATING_COLUMNS = "row_key, user_id, item_id, rating, timestamp"

# Ratings by key, the last one of each user and item.
KEYED = f"""(SELECT {RATING_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
  ORDER BY timestamp DESC, order_id DESC, line_no DESC, rating DESC) AS age FROM {RATINGS}) WHERE age = 1)"""
ITEM_COLUMNS = "row_key, item_id, title, genres"


def keyed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = views.ratings(spark, sf_dir).select(
        "user_id", "item_id", "rating", "timestamp", "order_id", "line_no"
    )
    # User and item make the key: it is added afterwards, so that it is not shuffled.
    last = last_per_key(rated, ["user_id", "item_id"], ["timestamp", "order_id", "line_no"])
    return last.withColumn("row_key", rating_key(F.col("user_id"), F.col("item_id"))).select(*search.RATING_FIELDS)


def stored_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed ratings as a written table, for searches that read them repeatedly."""
    path = work_path(spark, "keyed-ratings")
    keyed_ratings(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.items(spark, sf_dir).drop("kind")


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ratings(spark, sf_dir).select(*search.RATING_FIELDS)


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE row_key = '{ITEM}'")
def item_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.by_key(_items(spark, sf_dir), ITEM)


@query(f"""SELECT {ITEM_COLUMNS} FROM {ITEMS}
WHERE item_id IN (SELECT item_id FROM {EVENTS})""")
def items_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = views.events(spark, sf_dir).select(F.col("item_id").cast("string").alias("row_key"))
    return search.by_keys(_items(spark, sf_dir), keys)


@query(f"SELECT {RATING_COLUMNS} FROM {RATINGS} WHERE starts_with(row_key, '{USER}_')")
def ratings_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ratings_of_user(_ratings(spark, sf_dir), USER)


@query(f"SELECT {RATING_COLUMNS} FROM {RATINGS} WHERE split_part(row_key, '_', 2) = '{ITEM}'")
def ratings_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ratings_of_item(_ratings(spark, sf_dir), ITEM)


@query(f"""SELECT {RATING_COLUMNS} FROM {RATINGS}
WHERE list_contains(string_split(row_key, '_')[2:], '{ITEM}')""")
def ratings_by_key_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings(spark, sf_dir).where(search.key_mentions(ITEM))


@query(f"SELECT {RATING_COLUMNS} FROM {RATINGS} WHERE rating = 4.5")
def ratings_with_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.with_value(_ratings(spark, sf_dir), "rating", 4.5)


def _fallback_sql(source: str) -> str:
    return f"""
WITH ranked AS (SELECT *, CASE WHEN starts_with(row_key, '{USER}_') THEN 0
  WHEN CAST(user_id AS VARCHAR) = '{USER}' THEN 1 END AS match FROM {source})
SELECT {RATING_COLUMNS} FROM ranked WHERE match = (SELECT min(match) FROM ranked)"""


@query(_fallback_sql(RATINGS))
def fallback_lookup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.find_ratings_of_user(_ratings(spark, sf_dir), USER)


@query(_fallback_sql(f"(SELECT * REPLACE ('e' || user_id || '-' || item_id AS row_key) FROM {RATINGS})"))
def fallback_lookup_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that do not follow the usual form: the user column has to answer."""
    odd_key = F.concat(F.lit("e"), "user_id", F.lit("-"), "item_id")
    return search.find_ratings_of_user(
        _ratings(spark, sf_dir).withColumn("row_key", odd_key), USER
    )


@query(f"""
WITH ranked AS (SELECT *, CASE WHEN list_contains(string_split(row_key, '_')[2:], '{ITEM}') THEN 0
  WHEN CAST(item_id AS VARCHAR) = '{ITEM}' THEN 1
  WHEN split_part(row_key, '_', 2) = '{ITEM}' THEN 2 END AS match FROM {RATINGS})
SELECT {RATING_COLUMNS} FROM ranked WHERE match = (SELECT min(match) FROM ranked)""")
def fallback_lookup_of_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.find_ratings_of_item(_ratings(spark, sf_dir), ITEM, by_pattern=True)


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE contains(lower(title), 'ring')")
def title_search_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.title_search(_items(spark, sf_dir), "RiNg")


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE contains(title, 'red ')")
def title_search_cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.containing(_items(spark, sf_dir), "title", "red ")


@query(f"""
SELECT item_id, title, avg_rating FROM ({_summary_sql(ITEMS, ITEM_RATINGS)}) s
WHERE contains(title, 'ring') ORDER BY CAST(item_id AS VARCHAR) LIMIT 10""")
def title_search_cs_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = summary.item_summary(
        views.items(spark, sf_dir), views.item_ratings(spark, sf_dir)
    ).withColumn("row_key", F.col("item_id").cast("string"))
    return search.title_search_first(report, "ring").select("item_id", "title", "avg_rating")


@query(f"""
SELECT {ITEM_COLUMNS} FROM {ITEMS}
WHERE lower(trim(regexp_replace(title, '\\s+', ' ', 'g'))) = 'red widget'
ORDER BY row_key LIMIT 1""")
def title_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.title_exact(_items(spark, sf_dir), "  RED   Widget ")


@query(f"""
SELECT {ITEM_COLUMNS}, title = 'old ring' AS is_exact FROM {ITEMS}
WHERE contains(lower(title), 'old ring') OR contains(lower(title), 'cold ring')""")
def title_search_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.title_search_pinned(_items(spark, sf_dir), "OLD ring")


@query(f"""SELECT item_id, lower(trim(regexp_replace(title || '  ' || genres, '\\s+', ' ', 'g')))
AS normal FROM {ITEMS}""")
def titles_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t "), F.upper("title"), F.lit(" \n"), "genres", F.lit(" \t"))
    return _items(spark, sf_dir).select("item_id", normalize_title(padded).alias("normal"))


HITS = f"(SELECT * FROM {ITEMS} WHERE contains(lower(title), 'gizmo'))"
FIGURES = f"""(SELECT item_id, count(*) AS n,
  {two_decimals_sql('sum(rating)', 'count(*)')} AS mean FROM {KEYED} GROUP BY item_id)"""


@query(f"""
SELECT h.item_id, h.title, h.genres, coalesce(f.n, 0) AS rating_count,
  coalesce(f.mean, 'N/A') AS avg_rating
FROM {HITS} h LEFT JOIN {FIGURES} f ON f.item_id = h.item_id""")
def search_with_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_with_figures(
        _items(spark, sf_dir), keyed_ratings(spark, sf_dir), "Gizmo"
    )


@query(f"""
SELECT h.item_id, h.title, h.genres, k.row_key, k.user_id, k.rating, k.timestamp
FROM {HITS} h LEFT JOIN {KEYED} k ON k.item_id = h.item_id""")
def search_with_rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_with_rating_rows(
        _items(spark, sf_dir), stored_ratings(spark, sf_dir), "Gizmo"
    )


CHUNK_ROWS = 8


@query(f"""
WITH rated AS (SELECT h.item_id, h.title, h.genres, f.n, f.mean, k.row_key, k.rating, k.timestamp,
    CAST(('0x' || substr(md5(k.row_key), 1, 8))::BIGINT % CAST(ceil(f.n / {CHUNK_ROWS}) AS BIGINT)
      AS INTEGER) AS chunk
  FROM {HITS} h LEFT JOIN {FIGURES} f ON f.item_id = h.item_id
  LEFT JOIN {KEYED} k ON k.item_id = h.item_id)
SELECT item_id, title, genres, coalesce(n, 0) AS rating_count,
  coalesce(mean, 'N/A') AS avg_rating, coalesce(chunk, 0) AS chunk,
  coalesce(string_agg(row_key || ' ' || rating || ' ' || timestamp, ',' ORDER BY row_key), '')
    AS ratings
FROM rated GROUP BY item_id, title, genres, n, mean, chunk""")
def search_with_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested lists in small chunks, printed as text for the comparison."""
    nested = search.search_with_ratings(
        _items(spark, sf_dir), stored_ratings(spark, sf_dir), "Gizmo", chunk_rows=CHUNK_ROWS
    )
    line = F.transform(
        "ratings",
        lambda r: F.concat_ws(" ", r.row_key, r.rating.cast("string"), r.timestamp.cast("string")),
    )
    return nested.withColumn("ratings", F.array_join(line, ","))


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} WHERE row_key >= '100' AND row_key < '1003'")
def key_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.key_range(_items(spark, sf_dir), "100", "1003")


@query(f"SELECT {ITEM_COLUMNS} FROM {ITEMS} ORDER BY row_key LIMIT 20")
def first_n_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.first_rows(_items(spark, sf_dir), 20)


@query(f"""
SELECT row_key || '_' || timestamp AS row_key, CAST(user_id AS VARCHAR) AS user_part,
  CAST(item_id AS VARCHAR) AS item_part, CAST(timestamp AS VARCHAR) AS time_part FROM {RATINGS}""")
def key_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("_", "row_key", "timestamp")
    return _ratings(spark, sf_dir).select(
        key.alias("row_key"),
        key_part(key, 0).alias("user_part"),
        key_part(key, 1).alias("item_part"),
        key_part(key, 2).alias("time_part"),
    )
