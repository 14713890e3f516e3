"""Parsing and printing of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(c: Column, default: float = 0.0) -> Column:
    """The number in a text field; missing or malformed text counts as `default`."""
    return F.coalesce(c.try_cast("double"), F.lit(default))


def lenient_long(c: Column, default: int = 0) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))


def decimals_text(c: Column, places: int) -> Column:
    """Fixed-point text, halves rounded away from zero; NULL stays NULL."""
    return F.when(c.isNotNull(), F.format_string(f"%.{places}f", c))


def stars(rating: Column) -> Column:
    """One star per full point."""
    return F.repeat(F.lit("★"), F.floor(rating).cast("int"))
