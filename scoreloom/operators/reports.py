"""Reading stored item summaries and rankings back from their cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.times import either_time_text
from scoreloom.operators.cells import wide
from scoreloom.schemas import HOT_ITEM_CELLS, SUMMARY_CELLS


def read_summary(cells: DataFrame) -> DataFrame:
    """Stored item summaries, one row per item, all fields as text.

    The write time may be stored as epoch milliseconds or as formatted text.
    """
    stored = wide(cells, SUMMARY_CELLS)
    return stored.withColumn("timestamp", either_time_text(F.col("timestamp")))


def read_summary_of(cells: DataFrame, row_key: str) -> DataFrame:
    """The stored summary of one item; no rows when there is none."""
    return read_summary(cells.where(F.col("row_key") == row_key))


def read_hot_item_cells(cells: DataFrame) -> DataFrame:
    """The six columns of a stored ranking as text, other cells left unread."""
    wanted = F.lit(False)
    for family, qualifier in HOT_ITEM_CELLS.values():
        wanted = wanted | ((F.col("family") == family) & (F.col("qualifier") == qualifier))
    return wide(cells.where(wanted), HOT_ITEM_CELLS)
