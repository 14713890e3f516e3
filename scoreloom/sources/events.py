"""Event sources: Kafka topics and directories that receive files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom import schemas


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_events(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of a topic; needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def text_directory(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the lines of new files in a directory, in the column `value`."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def rating_directory(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of new rating files without header, typed."""
    reader = spark.readStream.schema(schemas.RATING_FILE_DDL)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(path)
    return raw.withColumnsRenamed({"userId": "user_id", "movieId": "item_id"})
