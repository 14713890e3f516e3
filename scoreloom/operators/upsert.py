"""Last-write-wins on typed, keyed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(
    df: DataFrame, keys: list[str], order_by: list[str], keep: list[str] | None = None
) -> DataFrame:
    """One row per key: the one with the largest `order_by` columns.

    Remaining columns break ties, so the result does not depend on partition
    order. It is an aggregate with a map-side part: a key that holds most of the
    rows shrinks to one row per partition before the shuffle.
    """
    if keep is None:
        keep = [c for c in df.columns if c not in keys and c not in order_by]
        kept_order = order_by
    else:
        kept_order = []
    ranked = F.struct(
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)],
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
    )
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    fields = {c: F.col(f"_best.o{i}").alias(c) for i, c in enumerate(kept_order)}
    fields |= {c: F.col(f"_best.k{i}").alias(c) for i, c in enumerate(keep)}
    return best.select(*keys, *[fields[c] for c in df.columns if c in fields])


def upsert(
    stored: DataFrame,
    load: DataFrame,
    keys: list[str],
    order_by: list[str],
    large_load: bool = False,
) -> DataFrame:
    """`stored` with the rows of `load` added; a loaded key replaces the stored row.

    Within one load the last row per key (by `order_by`) wins. By default `stored` is
    only anti-joined: when the load's keys are small enough for Spark to broadcast,
    the stored table is not shuffled at all, at the price of reading the load twice.
    With `large_load`, a load of about the size of the table, one full join reads
    each side once.
    """
    winners = last_per_key(load, keys, order_by).select(*stored.columns)
    if not large_load:
        kept = stored.join(winners.select(*keys), keys, "left_anti")
        return kept.unionByName(winners)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*df.columns).alias(name))

    both = packed(stored, "_old").join(packed(winners, "_new"), keys, "full")
    return both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")
