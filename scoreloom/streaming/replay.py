"""Replaying a rating file as a stream of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.sinks.writers import rating_events
from scoreloom.sources.csv_files import rating_lines


def file_messages(spark: SparkSession, path: str, sent_at: Column | None = None) -> DataFrame:
    """Messages of a rating file, keyed by line number; the header is line 1."""
    return rating_events(rating_lines(spark, path), F.col("line_number"), sent_at)
