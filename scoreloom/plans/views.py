"""The given star-schema tables seen as items, ratings and events.

Each view exists twice: as a DataFrame, and as a SQL expression for the oracle.

* items: parts, all of them. Facts of one kind (`error` events, and in `stray_ratings`
  returned line items) name the negated id, which the catalog does not know.
* ratings: every line item rates its part on the half-star scale 0.5 to 5.0; the
  rater is the customer of the order. Half stars are exact in binary, so sums and
  means do not depend on the order in which partitions are added up.
* events: every event rates the item in its JSON properties; item ids cover only
  part of the catalog, so the other items stay unrated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.keys import rating_key
from scoreloom.operators.cells import to_cells

STRAY_EVENT, STRAY_FLAG = "error", "R"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("row_key"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
        F.col("p_type").alias("kind"),
    )


def _half_stars(tenths_of_scale):
    return F.ceil(tenths_of_scale) * F.lit(0.5)


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings without their rater: one scan, no join."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        _half_stars(F.col("l_quantity") / 5).alias("rating"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("shop_id"),
    )


def stray_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`item_ratings`, some of them of items that are in no catalog."""
    item = F.when(F.col("flag") == STRAY_FLAG, -F.col("item_id")).otherwise(F.col("item_id"))
    return item_ratings(spark, sf_dir).withColumn("item_id", item)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    rated = item_ratings(spark, sf_dir).join(orders, "order_id")
    return rated.withColumn("row_key", rating_key(F.col("user_id"), F.col("item_id")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "events"))


def events_of(raw: DataFrame) -> DataFrame:
    """The events view over a batch or streaming frame of the raw table."""
    item = F.get_json_object("props", "$.k").try_cast("bigint")
    item = F.when(F.col("event_type") == STRAY_EVENT, -item).otherwise(item)
    return raw.select(
        "event_id",
        "user_id",
        item.alias("item_id"),
        F.least(_half_stars(F.col("value") / 10), F.lit(5.0)).alias("rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("kind"),
    )


def rating_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating as a version of its item's one rating cell."""
    rated = item_ratings(spark, sf_dir)
    return to_cells(
        rated, F.col("item_id"), {"rating": ("rateinfo", "rating")}, F.col("timestamp") * 1000
    )


def item_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as cells of the family `info`, all of version 1."""
    return to_cells(
        items(spark, sf_dir),
        F.col("row_key"),
        {"title": ("info", "title"), "genres": ("info", "genres")},
        F.lit(1),
    )


# --- the same views in SQL ------------------------------------------------------------

ITEMS = """(SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_partkey AS item_id, p_name AS title,
  p_type || '|' || p_brand AS genres, p_type AS kind FROM part)"""
ITEM_RATINGS = """(SELECT l_partkey AS item_id, ceil(l_quantity / 5) * 0.5::DOUBLE AS rating,
  CAST(epoch(l_shipdate) AS BIGINT) AS timestamp, l_returnflag AS flag, l_linestatus AS status,
  l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS shop_id FROM lineitem)"""
STRAY_RATINGS = f"""(SELECT * REPLACE (CASE WHEN flag = '{STRAY_FLAG}' THEN -item_id ELSE item_id END AS item_id)
  FROM {ITEM_RATINGS})"""
RATINGS = f"""(SELECT r.*, o_custkey AS user_id, o_custkey || '_' || item_id AS row_key
  FROM {ITEM_RATINGS} r JOIN orders ON order_id = o_orderkey)"""
EVENTS = f"""(SELECT event_id, user_id, CASE WHEN event_type = '{STRAY_EVENT}' THEN -1 ELSE 1 END
  * CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  least(ceil(value / 10) * 0.5::DOUBLE, 5.0::DOUBLE) AS rating,
  CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, ts AS event_time, event_type AS kind FROM events)"""
RATING_CELLS = f"""(SELECT CAST(item_id AS VARCHAR) AS row_key, 'rateinfo' AS family,
  'rating' AS qualifier, timestamp * 1000 AS version, CAST(rating AS VARCHAR) AS value
  FROM {ITEM_RATINGS})"""


def two_decimals_sql(total: str, n: str) -> str:
    """total/n with two decimals, halves up, in integer arithmetic.

    `total` is a sum of half stars. The detour over a rounded double would turn
    2.425, whose double is a little smaller, into 2.42.
    """
    hundredths = f"((100 * CAST(2 * ({total}) AS BIGINT) + {n}) // (2 * {n}))"
    return f"({hundredths} // 100) || '.' || lpad(CAST({hundredths} % 100 AS VARCHAR), 2, '0')"
