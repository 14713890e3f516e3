"""Sinks for batch frames and for the micro-batches of a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.functions.times import time_text
from scoreloom.operators.cells import to_cells
from scoreloom.schemas import SUMMARY_CELLS

ROWS_PER_FLUSH = 1000

BatchSink = Callable[[DataFrame, int], None]


def summary_cells(summary: DataFrame, written_at: Column | None = None) -> DataFrame:
    """An item summary as cells of two families, each row stamped with the write time."""
    moment = F.current_timestamp() if written_at is None else written_at
    stamped = summary.withColumn("timestamp", time_text(moment))
    return to_cells(stamped, F.col("item_id"), SUMMARY_CELLS, F.unix_millis(moment.cast("timestamp")))


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write Parquet and return the number of rows written, without a second job."""
    written = Observation("written")
    df.observe(written, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return written.get["n"]


def rating_events(ratings: DataFrame, key: Column, sent_at: Column | None = None) -> DataFrame:
    """Ratings as messages: `key` text and a JSON `value` with the time of sending."""
    moment = F.current_timestamp() if sent_at is None else sent_at
    body = F.struct(
        F.col("user_id").alias("userId"),
        F.col("item_id").alias("movieId"),
        F.col("rating").alias("rating"),
        F.col("timestamp").alias("timestamp"),
        time_text(moment).alias("createTime"),
    )
    return ratings.select(key.cast("string").alias("key"), F.to_json(body).alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send messages; needs Spark's Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    messages.write.format("kafka").options(**options).save()


def write_lines(messages: DataFrame, directory: str) -> None:
    """Append the message values as lines of new files, for `text_directory` to read."""
    messages.select("value").write.mode("append").text(directory)


def put_in_batches(
    df: DataFrame, put: Callable[[list[Row]], None], rows_per_flush: int = ROWS_PER_FLUSH
) -> None:
    """Hand the rows to an external store, each partition in lists of bounded length.

    `put` runs in the executors and may see rows again when a task is retried, so
    it should be an upsert. It is not called for an empty partition.
    """
    def send(rows: Iterator[Row]) -> None:
        while batch := list(islice(rows, rows_per_flush)):
            put(batch)

    df.foreachPartition(send)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, path: str) -> list:
    """The finished batches of a snapshot, oldest first."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    found = _file_system(spark, Path(path)).globStatus(Path(f"{path}/batch=*/_SUCCESS"))
    return sorted((x.getPath().getParent() for x in found or []), key=lambda p: p.getName())


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest committed batch of a snapshot; no rows before the first."""
    found = _committed(spark, path)
    return spark.read.schema(schema).parquet(found[-1].toString()) if found else spark.createDataFrame([], schema)


# --- micro-batch sinks -----------------------------------------------------------


def parquet_snapshot(path: str) -> BatchSink:
    """Each micro-batch replaces the snapshot at `path`, read by `read_snapshot`.

    A batch goes to a folder of its own; readers take the newest that was committed, so
    a batch that fails leaves the one before in place. The two newest are kept.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
        for old in _committed(batch.sparkSession, path)[:-2]:
            _file_system(batch.sparkSession, old).delete(old, True)

    return replace


def jdbc_snapshot(url: str, table: str, properties: dict[str, str] | None = None) -> BatchSink:
    """Each micro-batch replaces the relational table."""
    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").jdbc(url, table, properties=properties or {})

    return replace
