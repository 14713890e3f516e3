"""Registered queries: aggregates over ratings and the item report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.numbers import decimals_text, stars
from scoreloom.functions.text import genre_list
from scoreloom.functions.times import epoch_seconds_text
from scoreloom.operators import summary
from scoreloom.operators.lookup import one_name_per_item, with_names
from scoreloom.operators.reports import read_summary, read_summary_of
from scoreloom.plans import views
from scoreloom.plans.registry import query
from scoreloom.plans.views import EVENTS, ITEM_RATINGS, ITEMS, RATINGS, STRAY_RATINGS, two_decimals_sql
from scoreloom.sinks.writers import summary_cells

WRITE_TIME = "2024-02-01 12:00:00"


def _summary_sql(items: str, ratings: str) -> str:
    return f"""
SELECT i.item_id, i.title, i.genres, coalesce(s.max_rating, 0.0) AS max_rating,
  coalesce(s.avg_rating, 0.0) AS avg_rating, coalesce(s.min_rating, 0.0) AS min_rating
FROM {items} i LEFT JOIN (
  SELECT item_id, round(max(rating), 3) AS max_rating, round(avg(rating), 3) AS avg_rating,
    round(min(rating), 3) AS min_rating
  FROM {ratings} GROUP BY item_id) s ON s.item_id = i.item_id"""


@query(_summary_sql(ITEMS, ITEM_RATINGS))
def item_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.item_summary(views.items(spark, sf_dir), views.item_ratings(spark, sf_dir))


@query(_summary_sql(ITEMS, EVENTS))
def item_summary_with_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.item_summary(views.items(spark, sf_dir), views.events(spark, sf_dir))


@query(f"""
SELECT i.item_id, i.title, i.genres, coalesce(s.n, 0) AS rating_user_count,
  coalesce(s.total, 0.0) AS sum_rating, coalesce(s.max_rating, 0.0) AS max_rating,
  coalesce(s.avg_rating, 0.0) AS avg_rating, coalesce(s.min_rating, 0.0) AS min_rating
FROM {ITEMS} i LEFT JOIN (
  SELECT item_id, count(user_id) AS n, round(sum(rating), 3) AS total,
    round(max(rating), 3) AS max_rating, round(avg(rating), 3) AS avg_rating,
    round(min(rating), 3) AS min_rating
  FROM {RATINGS} GROUP BY item_id) s ON s.item_id = i.item_id""")
def item_summary_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.item_summary(
        views.items(spark, sf_dir), views.ratings(spark, sf_dir), full=True
    )


@query(f"""
WITH s AS ({_summary_sql(ITEMS, ITEM_RATINGS)}),
cells AS (
  SELECT item_id, 'movieinfo' AS family, 'movieId' AS qualifier, CAST(item_id AS VARCHAR) AS value FROM s
  UNION ALL SELECT item_id, 'movieinfo', 'title', title FROM s
  UNION ALL SELECT item_id, 'movieinfo', 'genres', genres FROM s
  UNION ALL SELECT item_id, 'rateinfo', 'max_rating', CAST(max_rating AS VARCHAR) FROM s
  UNION ALL SELECT item_id, 'rateinfo', 'avg_rating', CAST(avg_rating AS VARCHAR) FROM s
  UNION ALL SELECT item_id, 'rateinfo', 'min_rating', CAST(min_rating AS VARCHAR) FROM s
  UNION ALL SELECT item_id, 'rateinfo', 'timestamp', '{WRITE_TIME}' FROM s)
SELECT CAST(item_id AS VARCHAR) AS row_key, family, qualifier,
  CAST(epoch_ms(TIMESTAMP '{WRITE_TIME}') AS BIGINT) AS version, value FROM cells""")
def item_summary_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_cells(item_summary(spark, sf_dir), F.lit(WRITE_TIME).cast("timestamp"))


def _stored_summary_sql(where: str) -> str:
    return f"""
SELECT CAST(item_id AS VARCHAR) AS row_key, CAST(item_id AS VARCHAR) AS item_id, title, genres,
  CAST(max_rating AS VARCHAR) AS max_rating, CAST(avg_rating AS VARCHAR) AS avg_rating,
  CAST(min_rating AS VARCHAR) AS min_rating, '{WRITE_TIME}' AS timestamp
FROM ({_summary_sql(ITEMS, ITEM_RATINGS)}) s WHERE {where}"""


@query(_stored_summary_sql("true"))
def summary_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_summary(item_summary_cells(spark, sf_dir))


@query(_stored_summary_sql("item_id = 77"))
def summary_of_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_summary_of(item_summary_cells(spark, sf_dir), "77")


@query(f"""
SELECT avg(coalesce(try_cast(CASE WHEN flag = 'R' THEN 'returned' ELSE CAST(rating AS VARCHAR) END
  AS DOUBLE), 0.0)) AS avg_rating FROM {ITEM_RATINGS}""")
def global_mean_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("flag") == "R", "returned").otherwise(F.col("rating").cast("string"))
    return summary.global_mean(
        views.item_ratings(spark, sf_dir).select(text.alias("rating"))
    )


@query(f"""
SELECT avg(CASE WHEN flag = 'N' OR flag = 'R' THEN 0.0 ELSE rating END) AS avg_rating
FROM {ITEM_RATINGS}""")
def global_mean_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with all fields, with a bad rating (R) and with too few fields (N)."""
    rated = views.item_ratings(spark, sf_dir)
    flag = F.col("flag")
    rating = F.when(flag == "R", "x").when(flag == "A", F.col("rating").cast("string"))
    line = F.concat_ws(",", F.col("shop_id"), F.col("item_id"), rating)
    return summary.mean_of_lines(rated.select(line.alias("value")))


@query(f"SELECT count(*) AS rating_count FROM {ITEM_RATINGS}")
def rating_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.rating_count(views.item_ratings(spark, sf_dir))


@query(f"SELECT count(DISTINCT user_id) AS user_count FROM {RATINGS}")
def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distinct_users(views.ratings(spark, sf_dir))


@query(f"""
SELECT i.n AS item_count, r.n AS rating_count,
  CASE WHEN i.n > 0 THEN r.n / i.n::DOUBLE ELSE 0.0 END AS avg_ratings_per_item
FROM (SELECT count(*) AS n FROM {ITEMS}) i, (SELECT count(*) AS n FROM {ITEM_RATINGS}) r""")
def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.catalog_stats(views.items(spark, sf_dir), views.item_ratings(spark, sf_dir))


def _by_rating_sql(where: str, having: str) -> str:
    return f"""
SELECT r.item_id, CASE WHEN i.item_id IS NULL THEN 'Unknown' ELSE title END AS title,
  CASE WHEN i.item_id IS NULL THEN 'Unknown' ELSE genres END AS genres,
  mean AS avg_rating, rating_count
FROM (SELECT item_id, {two_decimals_sql('sum(rating)', 'count(*)')} AS mean,
  count(*) AS rating_count FROM {STRAY_RATINGS} WHERE {where} GROUP BY item_id HAVING {having}) r
LEFT JOIN {ITEMS} i ON i.item_id = r.item_id"""


@query(_by_rating_sql("rating BETWEEN 2.0 AND 4.0", "true"))
def items_by_rating_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.items_by_rating(
        views.items(spark, sf_dir), views.stray_ratings(spark, sf_dir), 2.0, 4.0
    )


@query(_by_rating_sql("true", "avg(rating) BETWEEN 2.5 AND 3.0"))
def items_by_avg_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.items_by_rating(
        views.items(spark, sf_dir),
        views.stray_ratings(spark, sf_dir),
        2.5,
        3.0,
        on="average",
    )


@query(f"""
SELECT item_id, count(*) AS rating_count, round(avg(rating), 3) AS avg_rating
FROM {ITEM_RATINGS} GROUP BY item_id
ORDER BY rating_count DESC, avg_rating DESC, item_id LIMIT 25""")
def popular_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.popular_items(views.item_ratings(spark, sf_dir), 25)


@query(f"""
SELECT user_id, count(*) AS rating_count, round(avg(rating), 3) AS avg_rating,
  round(min(rating), 3) AS min_rating, round(max(rating), 3) AS max_rating
FROM {RATINGS} GROUP BY user_id""")
def user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.user_stats(views.ratings(spark, sf_dir))


@query(f"""
SELECT genre, count(*) AS item_count
FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM {ITEMS}) GROUP BY genre""")
def genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    genres = views.items(spark, sf_dir).select(F.explode(genre_list(F.col("genres"))).alias("genre"))
    return genres.groupBy("genre").agg(F.count(F.lit(1)).alias("item_count"))


@query(f"""
SELECT item_id, order_id, line_no, repeat('★', CAST(floor(rating) AS INTEGER)) AS stars,
  printf('%.1f', rating) AS rating_text,
  strftime(to_timestamp(timestamp) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS rated_at
FROM {ITEM_RATINGS}""")
def rating_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.col("rating")
    return views.item_ratings(spark, sf_dir).select(
        "item_id",
        "order_id",
        "line_no",
        stars(rating).alias("stars"),
        decimals_text(rating, 1).alias("rating_text"),
        epoch_seconds_text(F.col("timestamp")).alias("rated_at"),
    )


@query(f"""
SELECT e.event_id, coalesce(i.title, '未知') AS name
FROM {EVENTS} e LEFT JOIN {ITEMS} i ON i.item_id = e.item_id""")
def event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = one_name_per_item(views.items(spark, sf_dir))
    return with_names(views.events(spark, sf_dir), names).select("event_id", "name")
