"""The complete jobs: files into tables, tables into reports, messages into a ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.functions.numbers import lenient_double
from scoreloom.operators import summary, tables
from scoreloom.operators.cells import to_cells, wide
from scoreloom.operators.lookup import one_name_per_item
from scoreloom.operators.upsert import last_per_key
from scoreloom.schemas import ITEM_CELLS, RATING_CELLS
from scoreloom.session import work_path
from scoreloom.sinks.writers import BatchSink, summary_cells, write_counted
from scoreloom.sources import csv_files
from scoreloom.streaming import hot_items

ITEM_FAMILIES = ["info"]
SUMMARY_FAMILIES = ["movieinfo", "rateinfo"]


def _load_table(
    spark: SparkSession,
    load: csv_files.Ingest,
    columns: dict[str, tuple[str, str]],
    table: str,
    loaded_at: Column,
) -> DataFrame:
    tables.create_table(spark, table, ITEM_FAMILIES)
    # All rows of a load share one version, so repeated keys are settled before.
    last = last_per_key(load.accepted, ["row_key"], ["load_order"])
    version = F.unix_millis(loaded_at.cast("timestamp"))
    tables.append_cells(spark, table, to_cells(last, F.col("row_key"), columns, version))
    stored = tables.read_cells(spark, table).select("row_key").distinct()
    return csv_files.reconcile(load, stored)


def load_items(
    spark: SparkSession, path: str, table: str, loaded_at: Column | None = None
) -> DataFrame:
    """Add an item file to a cell table; returns the reconciliation."""
    moment = F.current_timestamp() if loaded_at is None else loaded_at
    return _load_table(spark, csv_files.ingest_items(spark, path), ITEM_CELLS, table, moment)


def load_ratings(
    spark: SparkSession, path: str, table: str, loaded_at: Column | None = None
) -> DataFrame:
    """Add a rating file to a cell table; returns the reconciliation."""
    moment = F.current_timestamp() if loaded_at is None else loaded_at
    return _load_table(spark, csv_files.ingest_ratings(spark, path), RATING_CELLS, table, moment)


def stored_items(spark: SparkSession, table: str) -> DataFrame:
    """Current items of a cell table: row_key, item_id, title, genres."""
    found = wide(tables.read_cells(spark, table), ITEM_CELLS)
    return found.withColumn("item_id", F.col("row_key"))


def stored_ratings(spark: SparkSession, table: str) -> DataFrame:
    """Current ratings of a cell table, all fields as text."""
    return wide(tables.read_cells(spark, table), RATING_CELLS)


def stored_statistics(spark: SparkSession, item_table: str, rating_table: str) -> DataFrame:
    """One row: catalog counts, mean rating and number of raters of two cell tables."""
    items = tables.read_cells(spark, item_table).select("row_key").distinct()
    ratings = stored_ratings(spark, rating_table)
    one = F.count(F.lit(1))
    figures = ratings.agg(
        one.alias("rating_count"),
        F.avg(lenient_double(F.col("rating"))).alias("avg_rating"),
        F.count_distinct(F.coalesce("user_id", F.lit("null"))).alias("user_count"),
    )
    counted = items.agg(one.alias("item_count"))
    rows = figures.unionByName(counted, allowMissingColumns=True)
    return rows.agg(
        *[F.max(c).alias(c) for c in ("item_count", "rating_count", "avg_rating", "user_count")]
    )


def publish_item_summary(
    spark: SparkSession,
    items_path: str,
    ratings_path: str,
    table: str,
    written_at: Column | None = None,
) -> int:
    """Summarize the ratings of two files per item, append the result to a cell table,
    and return the number of items. The summary is computed once and staged, since
    writing by key samples its input first."""
    report = summary.item_summary(
        csv_files.read_items(spark, items_path), csv_files.read_ratings(spark, ratings_path)
    )
    staged = work_path(spark, "item-summary")
    count = write_counted(report, staged)
    tables.create_table(spark, table, SUMMARY_FAMILIES)
    stored = summary_cells(spark.read.parquet(staged), written_at)
    tables.append_cells(spark, table, stored)
    return count


def rank_messages(
    messages: DataFrame,
    items: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Rank the items of a message stream (Kafka or files) and keep `sink` up to date."""
    return hot_items.run_hot_items(
        hot_items.parse_events(messages), one_name_per_item(items), sink, checkpoint, trigger,
        **options,
    )
