"""Windowed rating counts per item name and the ranking of the newest windows.

`parse_events`, `window_counts` and `newest_top` take batch and streaming frames
alike, so the batch result of a set of events is the reference for the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.functions.numbers import lenient_double, lenient_long
from scoreloom.functions.times import parse_time, time_text
from scoreloom.operators.lookup import with_names
from scoreloom.schemas import EVENT_JSON_DDL, UNKNOWN_NAME
from scoreloom.sinks.writers import BatchSink

WINDOW = "10 minutes"
SLIDE = "5 minutes"
TOP_N = 10
TRIGGER = "60 seconds"


def parse_events(messages: DataFrame) -> DataFrame:
    """Typed events from messages with a `value`; a bad field, or line, becomes NULL."""
    body = F.from_json(F.col("value").cast("string"), EVENT_JSON_DDL)
    return messages.select(body.alias("data")).select(
        F.col("data.userId").alias("user_id"),
        F.col("data.movieId").alias("item_id"),
        F.col("data.rating").alias("rating"),
        F.col("data.timestamp").alias("timestamp"),
        F.col("data.createTime").alias("create_time"),
        parse_time(F.col("data.createTime")).alias("event_time"),
    )


def window_counts(
    events: DataFrame,
    names: DataFrame,
    window: str = WINDOW,
    slide: str | None = None,
    default: str = UNKNOWN_NAME,
    salts: int = 1,
    count_before_lookup: bool = False,
) -> DataFrame:
    """Rating count and mean per window and *name*: items of one name count together.

    Tumbling windows unless `slide` is given. Events without a time are left out.
    The default joins names first, which is one shuffle when Spark broadcasts the
    catalog. `count_before_lookup` (batch only) first counts per window and item,
    so that a catalog too large to broadcast is joined to counts and not to events.
    """
    span = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    if count_before_lookup:
        if events.isStreaming:
            raise ValueError("count_before_lookup needs a batch frame")
        per_item = events.groupBy(span.alias("window"), "item_id").agg(
            F.count("user_id").alias("_n"),
            F.sum("rating").alias("_sum"),
            F.count("rating").alias("_rated"),
        )
        grouped = with_names(per_item, names, default, salts).groupBy("window", "name")
        count, mean = F.sum("_n"), F.try_divide(F.sum("_sum"), F.sum("_rated"))
    else:
        grouped = with_names(events, names, default, salts).groupBy(span.alias("window"), "name")
        count, mean = F.count("user_id"), F.avg("rating")
    return grouped.agg(
        count.alias("count"), F.round(mean, 3).cast("double").alias("avg_rating")
    ).select(
        time_text(F.col("window.start")).alias("start_time"),
        time_text(F.col("window.end")).alias("end_time"),
        "name",
        "count",
        "avg_rating",
    )


def newest_top(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n rows of the newest windows, largest count first; n is over all windows."""
    return counts.orderBy(
        F.desc("start_time"), F.desc("end_time"), F.desc("count"), "name"
    ).limit(n)


def hot_items(
    events: DataFrame, names: DataFrame, window: str = WINDOW, n: int = TOP_N, **options
) -> DataFrame:
    counts = window_counts(events, names, window, **options)
    stamped = counts.withColumn("update_time", time_text(F.current_timestamp()))
    return newest_top(stamped, n)


def rating_trend(
    events: DataFrame, names: DataFrame, window: str = WINDOW, slide: str = SLIDE, **options
) -> DataFrame:
    """Counts and means over sliding windows."""
    return window_counts(events, names, window, slide, **options)


def run_hot_items(
    events: DataFrame,
    names: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    window: str = WINDOW,
    n: int = TOP_N,
    **options,
) -> StreamingQuery:
    """Start the ranking; after each trigger `sink` gets the current n rows.

    Complete mode keeps every window in the state store: an event may be as late
    as it likes. `run_window_counts` bounds the state instead. Every micro-batch
    joins `names` anew; `one_name_per_item(items).persist()` saves the repeated scan
    of a large catalog and lets Spark see its true size.
    """
    return (
        hot_items(events, names, window, n, **options)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .foreachBatch(sink)
        .start()
    )


def run_window_counts(
    events: DataFrame,
    names: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = WINDOW,
    trigger: dict | None = None,
    window: str = WINDOW,
    slide: str | None = None,
    **options,
) -> StreamingQuery:
    """Append each window to `path` once the watermark has passed its end.

    State holds open windows only. Events later than `delay` are dropped, and the
    last windows stay unwritten until newer events arrive.
    """
    on_time = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    counts = window_counts(
        on_time.withWatermark("event_time", delay), names, window, slide, **options
    )
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def read_hot_items(stored: DataFrame, n: int = TOP_N) -> DataFrame:
    """The stored ranking as text or typed columns, newest window first.

    A count or mean that is missing or not a number reads as zero.
    """
    return (
        stored.withColumn("count", lenient_long(F.col("count").cast("string")))
        .withColumn("avg_rating", lenient_double(F.col("avg_rating").cast("string")))
        .orderBy(F.desc_nulls_last("start_time"), F.desc("count"), "name")
        .limit(n)
    )
