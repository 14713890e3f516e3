"""Column functions over titles, genres and raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# fixed value: the characters that count as blank at the ends of a field
BLANKS = "".join(chr(code) for code in range(0x21))


def trim_field(c: Column) -> Column:
    """Strip spaces and control characters (U+0000 to U+0020) from both ends."""
    return F.trim(c, F.lit(BLANKS))


def normalize_title(c: Column) -> Column:
    """Runs of white space become one space; ends trimmed; lower case; NULL -> ''."""
    one_space = F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")
    return F.lower(trim_field(one_space))


def contains_ignoring_case(c: Column, keyword: str) -> Column:
    return F.lower(c).contains(F.lower(F.lit(keyword)))


def quoted(literal: str) -> str:
    """`literal` as a regular expression that matches exactly itself."""
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def genre_list(c: Column) -> Column:
    return F.split(c, r"\|")


def release_year(title: Column) -> Column:
    """The year of a title that ends in `(YYYY)`, else NULL."""
    return F.regexp_extract(title, r"\((\d{4})\)\s*$", 1).try_cast("int")
