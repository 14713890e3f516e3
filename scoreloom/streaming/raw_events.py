"""Appending every rating event to a cell table keyed by item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.operators.cells import to_cells
from scoreloom.schemas import RAW_EVENT_CELLS

TRIGGER = "100 milliseconds"


def event_cells(
    events: DataFrame, written_at: Column | None = None, version: Column | None = None
) -> DataFrame:
    """Four cells per event under its item id; through `latest` the last event wins.

    The `timestamp` cell is the write time in epoch milliseconds (default: now). The
    version, which decides what is last, is the event time in milliseconds unless
    another column is given; an event without a time is older than all others.
    """
    moment = F.current_timestamp() if written_at is None else written_at
    order = F.unix_millis(F.col("event_time").cast("timestamp")) if version is None else version
    stamped = events.where(F.col("item_id").isNotNull()).select(
        "user_id",
        "item_id",
        "rating",
        F.unix_millis(moment.cast("timestamp")).alias("timestamp"),
        order.alias("version"),
    )
    return to_cells(stamped, F.col("item_id"), RAW_EVENT_CELLS, F.col("version"))


def run_raw_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    written_at: Column | None = None,
    version: Column | None = None,
) -> StreamingQuery:
    """Append event cells to a Parquet folder, each event exactly once."""
    return (
        event_cells(events, written_at, version)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )
