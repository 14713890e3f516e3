"""Registered queries: events as JSON, windows, and the streams over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.cells import to_cells, wide
from scoreloom.operators.lookup import one_name_per_item
from scoreloom.operators.reports import read_hot_item_cells
from scoreloom.plans import views
from scoreloom.plans.registry import query
from scoreloom.plans.views import EVENTS, ITEMS
from scoreloom.schemas import CELLS, HOT_ITEM_CELLS, HOT_ITEMS, RAW_EVENT_CELLS
from scoreloom.session import work_path
from scoreloom.sinks import writers
from scoreloom.sources import events as event_sources
from scoreloom.streaming import hot_items as hot
from scoreloom.streaming import monitor, raw_events

ALL_NOW = {"availableNow": True}

# Copies of each event for every window it falls into, then one group per name.
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _windows_sql(starts: list[str], where: str = "true") -> str:
    copies = " UNION ALL ".join(f"SELECT *, {start} AS w FROM {EVENTS}" for start in starts)
    return f"""
SELECT {STAMP.format('w')} AS start_time, {STAMP.format("w + INTERVAL 10 MINUTE")} AS end_time,
  name, count(user_id) AS count, round(avg(rating), 3) AS avg_rating
FROM (SELECT e.*, coalesce(i.title, '未知') AS name FROM ({copies}) e
  LEFT JOIN {ITEMS} i ON i.item_id = e.item_id)
WHERE {where} GROUP BY w, name"""


TUMBLING = ["time_bucket(INTERVAL 10 MINUTE, event_time)"]
SLIDING = [
    "time_bucket(INTERVAL 5 MINUTE, event_time)",
    "time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE",
]
TOP = " ORDER BY start_time DESC, end_time DESC, count DESC, name LIMIT 10"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_name_per_item(views.items(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message; `createTime` is its time, the key its number + 2."""
    e = views.events(spark, sf_dir)
    return writers.rating_events(e, F.col("event_id") + 2, F.col("event_time"))


def _message_files(spark: SparkSession, sf_dir: str) -> str:
    folder = work_path(spark, "messages")
    writers.write_lines(_messages(spark, sf_dir), folder)
    return folder


@query(f"""
SELECT CAST(event_id + 2 AS VARCHAR) AS key, user_id, item_id, rating, timestamp,
  {STAMP.format('event_time')} AS create_time FROM {EVENTS}""")
def events_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, with each JSON field looked up by its wire name."""
    def field(name: str, kind: str) -> Column:
        return F.get_json_object("value", f"$.{name}").cast(kind)

    return _messages(spark, sf_dir).select(
        "key",
        field("userId", "bigint").alias("user_id"),
        field("movieId", "bigint").alias("item_id"),
        field("rating", "double").alias("rating"),
        field("timestamp", "bigint").alias("timestamp"),
        field("createTime", "string").alias("create_time"),
    )


@query(f"""
SELECT user_id, item_id, rating, timestamp,
  {STAMP.format('event_time')} AS create_time,
  {STAMP.format("date_trunc('second', event_time)")} AS event_time FROM {EVENTS}""")
def events_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = hot.parse_events(_messages(spark, sf_dir))
    return parsed.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


@query(_windows_sql(TUMBLING))
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot.window_counts(views.events(spark, sf_dir), _names(spark, sf_dir))


@query(_windows_sql(TUMBLING))
def window_counts_before_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot.window_counts(
        views.events(spark, sf_dir), _names(spark, sf_dir), count_before_lookup=True
    )


@query(_windows_sql(TUMBLING) + TOP)
def hot_items_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = hot.hot_items(views.events(spark, sf_dir), _names(spark, sf_dir))
    return top.drop("update_time")


@query(_windows_sql(SLIDING))
def sliding_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot.rating_trend(views.events(spark, sf_dir), _names(spark, sf_dir))


def _stream_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_sources.text_directory(spark, _message_files(spark, sf_dir))


def _stream_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(raw.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return views.events_of(stream)


def _stored_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = work_path(spark, "hot-items")
    hot.run_hot_items(
        hot.parse_events(_stream_of_messages(spark, sf_dir)),
        _names(spark, sf_dir),
        writers.parquet_snapshot(snapshot),
        work_path(spark, "hot-items-state"),
        ALL_NOW,
    ).awaitTermination()
    return writers.read_snapshot(spark, snapshot, HOT_ITEMS)


@query(_windows_sql(TUMBLING) + TOP)
def hot_items_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages in files, streamed into the ranking; its last snapshot."""
    return _stored_hot_items(spark, sf_dir).drop("update_time")


@query(f"""SELECT * FROM ({_windows_sql(TUMBLING)} {TOP})
ORDER BY start_time DESC, count DESC, name LIMIT 5""")
def hot_topn_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot.read_hot_items(_stored_hot_items(spark, sf_dir), 5).drop("update_time")


@query(_windows_sql(TUMBLING) + TOP)
def hot_topn_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows stored as cells of the ranking table, the newest ten read back."""
    counts = window_counts(spark, sf_dir)
    stored = to_cells(
        counts.withColumn("update_time", F.col("end_time")),
        F.concat_ws("_", "start_time", "name"),
        HOT_ITEM_CELLS,
        F.lit(1),
    )
    return hot.read_hot_items(read_hot_item_cells(stored)).drop("row_key", "update_time")


@query(_windows_sql(
    TUMBLING, f"w + INTERVAL 10 MINUTE <= (SELECT max(event_time) FROM {EVENTS}) - INTERVAL 10 MINUTE"
))
def windowed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that a watermark of ten minutes has closed, each written once."""
    path = work_path(spark, "windows")
    hot.run_window_counts(
        _stream_of_events(spark, sf_dir),
        _names(spark, sf_dir),
        path,
        work_path(spark, "windows-state"),
        trigger=ALL_NOW,
    ).awaitTermination()
    columns = [f for f in HOT_ITEMS.fields if f.name != "update_time"]
    return spark.read.schema(type(HOT_ITEMS)(columns)).parquet(path)


@query(f"SELECT CAST(count(*) AS BIGINT) AS row_count FROM {EVENTS}")
def micro_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per micro-batch of arriving files, added up: the split is not fixed."""
    counts = work_path(spark, "batch-counts")
    arrivals = event_sources.text_directory(
        spark, _message_files(spark, sf_dir), max_files_per_trigger=2
    )
    monitor.run_monitor(
        arrivals, counts, work_path(spark, "batch-counts-state"), ALL_NOW
    ).awaitTermination()
    return monitor.read_counts(spark, counts).agg(F.sum("row_count").alias("row_count"))


@query(f"""
SELECT CAST(item_id AS VARCHAR) AS row_key, CAST(user_id AS VARCHAR) AS user_id,
  CAST(item_id AS VARCHAR) AS item_id, CAST(rating AS VARCHAR) AS rating,
  CAST(timestamp * 1000 AS VARCHAR) AS timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_id DESC) AS age FROM {EVENTS})
WHERE age = 1""")
def raw_event_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event appended as cells of its item; the last event of each item.

    Each event counts as written at its own second, so that the result is fixed.
    """
    path = work_path(spark, "raw-events")
    raw_events.run_raw_events(
        _stream_of_events(spark, sf_dir),
        path,
        work_path(spark, "raw-events-state"),
        ALL_NOW,
        written_at=F.timestamp_seconds("timestamp"),
        version=F.col("event_id"),
    ).awaitTermination()
    return wide(spark.read.schema(CELLS).parquet(path), RAW_EVENT_CELLS)
