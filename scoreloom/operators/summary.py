"""Aggregates over ratings: per item, per user and over the whole catalog.

`ratings` has `user_id, item_id, rating` (and `row_key` where noted), `items` has
`item_id, title, genres`. Every aggregate is a partial/final pair, so hot items
and users are reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numbers import decimals_text, lenient_double
from scoreloom.operators.lookup import with_item_fields

LOWEST_RATING, HIGHEST_RATING = 0.0, 5.0


def _rounded(c: Column) -> Column:
    return F.round(c, 3).cast("double")


def item_stats(ratings: DataFrame, full: bool = True) -> DataFrame:
    """Largest, mean and smallest rating per item; `full` adds rater count and sum."""
    extra = [
        F.count("user_id").alias("rating_user_count"),
        _rounded(F.sum("rating")).alias("sum_rating"),
    ]
    return ratings.groupBy("item_id").agg(
        *(extra if full else []),
        _rounded(F.max("rating")).alias("max_rating"),
        _rounded(F.avg("rating")).alias("avg_rating"),
        _rounded(F.min("rating")).alias("min_rating"),
    )


def item_summary(items: DataFrame, ratings: DataFrame, full: bool = False) -> DataFrame:
    """Every catalog item with its rating figures; an unrated item gets zeros."""
    joined = items.select("item_id", "title", "genres").join(
        item_stats(ratings, full), "item_id", "left"
    )
    for name in ("max_rating", "avg_rating", "min_rating"):
        joined = joined.withColumn(name, F.coalesce(name, F.lit(0.0)))
    if full:
        joined = joined.withColumn(
            "rating_user_count", F.coalesce("rating_user_count", F.lit(0))
        ).withColumn("sum_rating", F.coalesce("sum_rating", F.lit(0.0)))
    return joined


def global_mean(ratings: DataFrame, column: str = "rating") -> DataFrame:
    """Mean over all rows; a missing or malformed rating counts as 0.0, not as absent."""
    return ratings.agg(F.avg(lenient_double(F.col(column))).alias("avg_rating"))


def mean_of_lines(lines: DataFrame, column: str = "value", separator: str = ",") -> DataFrame:
    """`global_mean` over `user,item,rating,time` text lines; short lines count as 0.0."""
    third = F.get(F.split(F.col(column), separator), F.lit(2))
    return global_mean(lines.select(third.alias("rating")))


def rating_count(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.count(F.lit(1)).alias("rating_count"))


def distinct_users(ratings: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of different raters; rows without a user count as one rater."""
    user = F.col("user_id")
    known = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    unknown = F.coalesce(F.max(user.isNull().cast("bigint")), F.lit(0))
    return ratings.agg((known + unknown).alias("user_count"))


def catalog_stats(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Item count, rating count and ratings per item (0 for an empty catalog)."""
    one = F.count(F.lit(1))
    none = F.lit(0).cast("bigint")
    counts = items.agg(one.alias("item_count"), none.alias("rating_count")).unionByName(
        ratings.agg(none.alias("item_count"), one.alias("rating_count"))
    )
    totals = counts.agg(
        F.sum("item_count").alias("item_count"), F.sum("rating_count").alias("rating_count")
    )
    per_item = F.when(
        F.col("item_count") > 0, F.col("rating_count") / F.col("item_count")
    ).otherwise(0.0)
    return totals.withColumn("avg_ratings_per_item", per_item)


def items_by_rating(
    items: DataFrame,
    ratings: DataFrame,
    low: float | None = LOWEST_RATING,
    high: float | None = HIGHEST_RATING,
    on: str = "rating",
) -> DataFrame:
    """Items with ratings in the closed range [low, high], their mean and count.

    `on="rating"` keeps the single ratings that are in range and averages those;
    `on="average"` keeps the items whose mean over all ratings is in range.
    Ratings that are not numbers are left out.
    """
    if low is None or high is None:
        raise ValueError("both ends of the rating range are required")
    if low > high:
        raise ValueError("the low end of the rating range exceeds the high end")
    if on not in ("rating", "average"):
        raise ValueError(f"on must be 'rating' or 'average', not {on!r}")
    rated = ratings.select("item_id", F.col("rating").try_cast("double").alias("rating"))
    rated = rated.where(F.col("rating").isNotNull() & ~F.isnan("rating"))
    if on == "rating":
        rated = rated.where(F.col("rating").between(low, high))
    means = rated.groupBy("item_id").agg(
        F.avg("rating").alias("_mean"), F.count(F.lit(1)).alias("rating_count")
    )
    if on == "average":
        means = means.where(F.col("_mean").between(low, high))
    return with_item_fields(means, items).select(
        "item_id",
        "title",
        "genres",
        decimals_text(F.col("_mean"), 2).alias("avg_rating"),
        "rating_count",
    )


def popular_items(ratings: DataFrame, n: int = 10) -> DataFrame:
    """The n items with the most ratings; mean rating, then id, break ties."""
    counts = ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("rating_count"), _rounded(F.avg("rating")).alias("avg_rating")
    )
    return counts.orderBy(F.desc("rating_count"), F.desc("avg_rating"), "item_id").limit(n)


def user_stats(ratings: DataFrame) -> DataFrame:
    """Each rater's number of ratings with mean, smallest and largest."""
    return ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rating_count"),
        _rounded(F.avg("rating")).alias("avg_rating"),
        _rounded(F.min("rating")).alias("min_rating"),
        _rounded(F.max("rating")).alias("max_rating"),
    )
