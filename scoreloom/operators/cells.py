"""Wide-column tables as DataFrames of cells.

A cell is `(row_key, family, qualifier, version, value)`. Writing adds cells; the
newest version of a cell is its current value. Of two cells with the same version
the smaller value counts, in every operator alike. All operators take and return
DataFrames, so a mutation is a new frame that the caller stores where it likes.

Where an aggregate meets a semi-join, the aggregate is written first: it shrinks a
cell with very many versions before any shuffle, and Spark itself moves the
semi-join below it whenever the key list is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.functions.keys import key_part, key_parts
from scoreloom.schemas import CELL_ID, CELLS, RATING_CELLS

BROADCAST_KEYS = 10_000


def _newest_first() -> Column:
    """Sorts the newest version of a cell first and equal versions by value."""
    return F.struct((-F.col("version")).alias("age"), F.col("value").alias("value"))


def to_cells(
    df: DataFrame, row_key: Column, columns: dict[str, tuple[str, str]], version: Column
) -> DataFrame:
    """Turn each row of a typed frame into one text cell per non-NULL column.

    A row without a version gets version 0, the oldest.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                F.col(column).cast("string").alias("value"),
            )
            for column, (family, qualifier) in columns.items()
        ]
    )
    keyed = df.select(
        row_key.cast("string").alias("row_key"),
        F.coalesce(version.cast("bigint"), F.lit(0)).alias("version"),
        F.inline(cells),
    )
    return keyed.where(F.col("value").isNotNull()).select(*CELL_ID, "version", "value")


def one_cell(
    spark: SparkSession, row_key: str, family: str, qualifier: str, value: str, version: int
) -> DataFrame:
    return spark.createDataFrame([(row_key, family, qualifier, version, value)], CELLS)


def put(cells: DataFrame, new_cells: DataFrame) -> DataFrame:
    """Add cells; a value with a newer version becomes the current one."""
    return cells.unionByName(new_cells)


def latest(cells: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The current value of every cell, or of the cells of the given row keys."""
    newest = cells.groupBy(*CELL_ID).agg(F.min(_newest_first()).alias("_newest"))
    if keys is not None:
        newest = newest.join(keys.select("row_key").distinct(), "row_key", "left_semi")
    return newest.select(
        *CELL_ID, (-F.col("_newest.age")).alias("version"), F.col("_newest.value").alias("value")
    )


def newest_versions(cells: DataFrame, k: int = 3) -> DataFrame:
    """Up to k versions of every cell, `age` 1 being the newest.

    The `dense_rank() <= k` filter runs before the only shuffle as well (a window group
    limit), so a cell that holds most of the table sends k versions per partition.
    Copies of one version then collapse on the same partitioning.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    by_age = Window.partitionBy(*CELL_ID).orderBy(F.desc("version"))
    newest = cells.withColumn("age", F.dense_rank().over(by_age)).where(F.col("age") <= k)
    kept = newest.groupBy(*CELL_ID, "version", "age").agg(F.min("value").alias("value"))
    return kept.select(*CELL_ID, "version", "value", "age")


def oldest_of_newest(cells: DataFrame, k: int = 5) -> DataFrame:
    """The oldest among the k newest versions of every cell."""
    kept = newest_versions(cells, k)
    return kept.groupBy(*CELL_ID).agg(
        F.min("version").alias("version"), F.min_by("value", "version").alias("value")
    )


def wide(cells: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Current values as one row per key, in a single aggregation.

    `columns` maps output names to (family, qualifier). A row that has none of
    them still appears, with NULLs.
    """
    def current(family: str, qualifier: str) -> Column:
        mine = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        return F.min_by("value", F.when(mine, _newest_first()))

    return cells.groupBy("row_key").agg(
        *[current(f, q).alias(name) for name, (f, q) in columns.items()]
    )


def get_row(cells: DataFrame, row_key: str) -> DataFrame:
    """Current cells of one row; no rows when the key does not exist."""
    return latest(cells.where(F.col("row_key") == row_key))


def get_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Current cells of many rows, keys given as a frame with `row_key`."""
    return latest(cells, keys)


def key_range(df: DataFrame, start: str, stop: str) -> DataFrame:
    """Rows with start <= row_key < stop, keys compared as text."""
    return df.where((F.col("row_key") >= start) & (F.col("row_key") < stop))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of a one-row-per-key frame in key order ('10' before '9')."""
    return df.orderBy("row_key").limit(n)


def first_keys_cells(cells: DataFrame, n: int) -> DataFrame:
    """Current cells of the first n keys; only those keys' cells are aggregated.

    The key list has n rows by construction, so a short one is broadcast by hint.
    """
    keys = cells.select("row_key").distinct().orderBy("row_key").limit(n)
    if n <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return latest(cells.join(keys, "row_key", "left_semi"))


def count_rows(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count_distinct("row_key").alias("row_count"))


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """All cells except those of the given row keys."""
    return cells.join(keys.select("row_key").distinct(), "row_key", "left_anti")


def delete_cells(
    cells: DataFrame, targets: DataFrame, all_versions: bool = False
) -> DataFrame:
    """Remove the newest version of the target cells, so that an older one resurfaces.

    `targets` has row_key, family and qualifier. With `all_versions` the target
    cells disappear altogether.
    """
    wanted = targets.select(*CELL_ID).distinct()
    if all_versions:
        return cells.join(wanted, CELL_ID, "left_anti")
    newest = (
        cells.groupBy(*CELL_ID)
        .agg(F.max("version").alias("version"))
        .join(wanted, CELL_ID, "left_semi")
    )
    return cells.join(newest, [*CELL_ID, "version"], "left_anti")


def ratings_by_schema_on_read(cells: DataFrame, family: str = "info") -> DataFrame:
    """Rating rows from cells whose families and qualifiers are not uniform.

    Each field is read from its own cell in `family`. If that is absent, the first
    alias in (family, qualifier) order is used: the exact qualifier in any family,
    `score` for the rating or `time` for the timestamp in any letter case. User,
    item and time may finally come from the row key; the rating never does.
    """
    lower = F.lower("qualifier")
    aliases = {
        "user_id": F.col("qualifier") == RATING_CELLS["user_id"][1],
        "item_id": F.col("qualifier") == RATING_CELLS["item_id"][1],
        "rating": (F.col("qualifier") == RATING_CELLS["rating"][1]) | (lower == "score"),
        "timestamp": (F.col("qualifier") == RATING_CELLS["timestamp"][1]) | (lower == "time"),
    }

    def exact(field: str) -> Column:
        return (F.col("family") == family) & (F.col("qualifier") == RATING_CELLS[field][1])

    def first_choice(field: str) -> Column:
        preference = F.struct(
            (~exact(field)).alias("other"), "family", "qualifier", _newest_first().alias("cell")
        )
        return F.min(F.when(aliases[field], preference)).alias(field)

    chosen = cells.groupBy("row_key").agg(*[first_choice(field) for field in aliases])
    complete = F.lit(True)
    for field in aliases:
        complete = complete & (F.col(f"{field}.other") == F.lit(False))
    rows = chosen.select(
        "row_key",
        *[F.col(f"{field}.cell.value").alias(field) for field in aliases],
        F.coalesce(complete, F.lit(False)).alias("_complete"),
    )
    key = F.col("row_key")
    has_item_part = F.size(key_parts(key)) >= 2
    no_time = F.col("timestamp").isNull() | (~F.col("_complete") & (F.col("timestamp") == ""))
    return rows.select(
        "row_key",
        F.coalesce("user_id", F.when(has_item_part, key_part(key, 0))).alias("user_id"),
        F.coalesce("item_id", key_part(key, 1)).alias("item_id"),
        "rating",
        F.when(no_time, F.coalesce(key_part(key, 2), "timestamp"))
        .otherwise(F.col("timestamp"))
        .alias("timestamp"),
    )
