"""Schemas of the files, streams and tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: file, wire and table formats ------------------------------

ITEM_FILE_FIELDS = ["movieId", "title", "genres"]
RATING_FILE_FIELDS = ["userId", "movieId", "rating", "timestamp"]

ITEM_FILE_DDL = "movieId BIGINT, title STRING, genres STRING"
# Wider than the file on purpose: the column that is not there reads as NULL.
ITEM_FILE_WIDE_DDL = "movieId BIGINT, title STRING, genres STRING, timestamp BIGINT"
RATING_FILE_DDL = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
EVENT_JSON_DDL = (
    "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT, createTime STRING"
)

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNKNOWN_NAME = "未知"
UNKNOWN_FIELD = "Unknown"
NO_AVERAGE = "N/A"
NO_TIME = "—"

# Where columns live in the wide-column tables: alias -> (family, qualifier)
ITEM_CELLS = {"title": ("info", "title"), "genres": ("info", "genres")}
RATING_CELLS = {
    "user_id": ("info", "userId"),
    "item_id": ("info", "movieId"),
    "rating": ("info", "rating"),
    "timestamp": ("info", "timestamp"),
}
SUMMARY_CELLS = {
    "item_id": ("movieinfo", "movieId"),
    "title": ("movieinfo", "title"),
    "genres": ("movieinfo", "genres"),
    "max_rating": ("rateinfo", "max_rating"),
    "avg_rating": ("rateinfo", "avg_rating"),
    "min_rating": ("rateinfo", "min_rating"),
    "timestamp": ("rateinfo", "timestamp"),
}
RAW_EVENT_CELLS = {
    "user_id": ("rateinfo", "userId"),
    "item_id": ("rateinfo", "movieId"),
    "rating": ("rateinfo", "rating"),
    "timestamp": ("rateinfo", "timestamp"),
}
HOT_ITEM_CELLS = {
    "start_time": ("rateinfo", "startTime"),
    "end_time": ("rateinfo", "endTime"),
    "name": ("rateinfo", "name"),
    "count": ("rateinfo", "count"),
    "avg_rating": ("rateinfo", "avgRating"),
    "update_time": ("rateinfo", "updateTime"),
}

# --- in-memory frames ---------------------------------------------------------

# One row per stored value of a wide-column table. `version` orders the values
# of one (row_key, family, qualifier); the largest version is the current one.
CELLS = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
CELL_ID = ["row_key", "family", "qualifier"]

# The windowed ranking as it is stored by the stream and read back. Counts are 64-bit
# here and everywhere: an int overflows, and fails the job, at 2.1 billion ratings.
HOT_ITEMS = T.StructType(
    [
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("update_time", T.StringType()),
    ]
)
