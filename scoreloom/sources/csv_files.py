"""CSV scans and the bulk ingest of item and rating files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom import schemas
from scoreloom.functions.keys import rating_key
from scoreloom.functions.text import trim_field
from scoreloom.operators.upsert import upsert
from scoreloom.session import work_path

_REJECTED = "_corrupt_record"


def _reader(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("sep", ",")
        .option("encoding", "utf-8")
        .option("quote", '"')
        .option("escape", '"')
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Rating file with its declared types: user_id, item_id, rating, timestamp."""
    raw = _reader(spark).schema(schemas.RATING_FILE_DDL).csv(path)
    return raw.withColumnsRenamed({"userId": "user_id", "movieId": "item_id"})


def read_items(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Item file: item_id, title, genres. `infer` costs one more pass over the file."""
    reader = _reader(spark)
    reader = reader.option("inferSchema", True) if infer else reader.schema(schemas.ITEM_FILE_DDL)
    return reader.csv(path).withColumnRenamed("movieId", "item_id")


def load_order() -> Column:
    """Sorts records as they stand in their file."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("load_order")


def read_item_names(spark: SparkSession, path: str) -> DataFrame:
    """(item_id, title, load_order) through a schema wider than the file."""
    wide = _reader(spark).schema(schemas.ITEM_FILE_WIDE_DDL).csv(path)
    return wide.select(F.col("movieId").alias("item_id"), "title", load_order())


@dataclass(frozen=True)
class Ingest:
    """The records of one file: keyed rows with `load_order`, `short` and `record`."""

    records: DataFrame

    @property
    def accepted(self) -> DataFrame:
        return self.records.where(~F.col("short")).drop("short", "record")

    @property
    def rejected(self) -> DataFrame:
        """The text of the records that have too few fields."""
        return self.records.where("short").select("record")


# A quoted field, whose separators do not count.
_QUOTED = r'(^|,)"(?:[^"]|"")*"'


def _fields(spark: SparkSession, path: str, names: list[str], multi_line: bool) -> DataFrame:
    """All fields as trimmed text plus `record`, `short` and `load_order`.

    A record whose number of fields differs from the schema's is reported as corrupt
    with its text, whose fields are counted: only a record with too few is short.
    """
    ddl = ", ".join(f"{name} STRING" for name in [*names, _REJECTED])
    raw = (
        _reader(spark)
        .schema(ddl)
        .option("columnNameOfCorruptRecord", _REJECTED)
        # A pruned parse skips fields and would not notice that a record is short.
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    counted = F.size(F.split(F.regexp_replace(_REJECTED, _QUOTED, "$1"), ","))
    # A short record lacks the last field. Spark wants one column of the record to be read.
    short = F.col(_REJECTED).isNotNull() & F.col(names[-1]).isNull() & (counted < len(names))
    return raw.select(
        *[trim_field(F.coalesce(name, F.lit(""))).alias(name) for name in names],
        F.col(_REJECTED).alias("record"),
        short.alias("short"),
        load_order(),
    )


def _keyed(fields: DataFrame, columns: dict[str, Column]) -> Ingest:
    renamed = [c.alias(name) for name, c in columns.items()]
    return Ingest(fields.select(*renamed, "load_order", "short", "record"))


def ingest_items(spark: SparkSession, path: str, multi_line: bool = False) -> Ingest:
    """`multi_line` accepts line breaks inside quotes; each file is then read by one task."""
    item = F.col("movieId")
    return _keyed(
        _fields(spark, path, schemas.ITEM_FILE_FIELDS, multi_line),
        {"row_key": item, "item_id": item, "title": F.col("title"), "genres": F.col("genres")},
    )


def ingest_ratings(spark: SparkSession, path: str, multi_line: bool = False) -> Ingest:
    """`multi_line` accepts line breaks inside quotes; each file is then read by one task."""
    user, item = F.col("userId"), F.col("movieId")
    return _keyed(
        _fields(spark, path, schemas.RATING_FILE_FIELDS, multi_line),
        {
            "row_key": rating_key(user, item),
            "user_id": user,
            "item_id": item,
            "rating": F.col("rating"),
            "timestamp": F.col("timestamp"),
        },
    )


def load(stored: DataFrame, ingest: Ingest) -> DataFrame:
    """The stored keyed table after the load; later records of the file win."""
    return upsert(stored, ingest.accepted, ["row_key"], ["load_order"])


def reconcile(ingest: Ingest, stored: DataFrame) -> DataFrame:
    """One row: records read, rejected and repeated, rows stored, and whether all arrived.

    The load is complete when every accepted key is in `stored`; rows that were
    stored before do not count as a difference.
    """
    one = F.count(F.lit(1))
    none = F.max(F.lit(0).cast("bigint"))
    # The rows of the file and of the table are each counted in one pass.
    file = ingest.records.agg(
        one.alias("read_count"),
        F.count(F.when(F.col("short"), 1)).alias("rejected_count"),
        F.count_distinct(F.when(~F.col("short"), F.col("row_key"))).alias("key_count"),
        none.alias("stored_count"),
        none.alias("found_count"),
    )
    loaded = ingest.accepted.select("row_key").distinct().withColumn("_loaded", F.lit(True))
    table = stored.select("row_key").join(loaded, "row_key", "left").agg(
        none.alias("read_count"),
        none.alias("rejected_count"),
        none.alias("key_count"),
        one.alias("stored_count"),
        F.count("_loaded").alias("found_count"),
    )
    sums = file.unionByName(table).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in file.columns]
    )
    return sums.select(
        "read_count",
        "rejected_count",
        (F.col("read_count") - F.col("rejected_count") - F.col("key_count")).alias(
            "duplicate_count"
        ),
        "stored_count",
        (F.col("found_count") == F.col("key_count")).alias("complete"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the 1-based `line_number` of each line in its file.

    The lines are staged once with their position inside their file block. Block
    sizes then give each block's offset, so no line is sorted or moved to number it.
    """
    staged = work_path(spark, "lines")
    spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).write.parquet(staged)
    lines = spark.read.parquet(staged)
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("size"), F.min("row").alias("first_row")
    )
    # One row per block (a block is up to spark.sql.files.maxPartitionBytes long).
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    offsets = blocks.select("file", "block", "first_row", offset.alias("offset"))
    number = F.col("offset") + F.col("row") - F.col("first_row") + 1
    return lines.join(offsets, ["file", "block"]).select(
        "file", number.alias("line_number"), "value"
    )


def rating_lines(spark: SparkSession, path: str) -> DataFrame:
    """Typed ratings of unquoted lines, header skipped, with their `line_number`."""
    parts = F.split("value", ",")
    return read_lines(spark, path).where(F.col("line_number") > 1).select(
        "line_number",
        F.get(parts, F.lit(0)).try_cast("bigint").alias("user_id"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("item_id"),
        F.get(parts, F.lit(2)).try_cast("double").alias("rating"),
        F.get(parts, F.lit(3)).try_cast("bigint").alias("timestamp"),
    )
