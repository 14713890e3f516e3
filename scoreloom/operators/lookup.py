"""Enrichment joins between facts and the item catalog.

None of these joins carries a broadcast hint. Spark compares the catalog's size
with `spark.sql.autoBroadcastJoinThreshold` (and, under adaptive execution, its
real size at run time) and broadcasts it only below that limit; a larger catalog
is joined by sort-merge, where adaptive execution splits hot item ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.upsert import last_per_key
from scoreloom.schemas import UNKNOWN_FIELD, UNKNOWN_NAME


def one_name_per_item(items: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """(item_id, name) with unique ids; of repeated ids the last in `order_by` stays.

    Without it, the last in the file stays, if the items carry their `load_order`.
    """
    if order_by is None and "load_order" in items.columns:
        order_by = ["load_order"]
    named = items.where(F.col("item_id").isNotNull())
    names = last_per_key(named, ["item_id"], order_by or [], keep=["title"])
    return names.withColumnRenamed("title", "name")


def with_names(
    facts: DataFrame,
    names: DataFrame,
    default: str = UNKNOWN_NAME,
    salts: int = 1,
) -> DataFrame:
    """Add `name` to every fact; an id that is NULL or not listed gets `default`.

    `names` must have unique ids (see `one_name_per_item`). Works on batch and
    streaming facts. `salts` > 1 spreads each id over that many join keys; it is
    meant for streams, where adaptive execution cannot split a hot id and the
    catalog is too large to broadcast. The key is a hash of the whole fact, which a
    retried task computes again alike.
    """
    keys = ["item_id"]
    # A listed item may have a NULL title, which is not the same as a missing item.
    listed = names.select("item_id", "name", F.lit(True).alias("_listed"))
    if salts > 1:
        keys.append("_salt")
        facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
        every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        listed = listed.withColumn("_salt", F.explode(every_salt))
    joined = facts.join(listed, keys, "left")
    name = F.when(F.col("_listed"), F.col("name")).otherwise(F.lit(default))
    return joined.withColumn("name", name).drop("_listed", "_salt")


def with_item_fields(
    facts: DataFrame, items: DataFrame, default: str = UNKNOWN_FIELD
) -> DataFrame:
    """Add `title` and `genres`; only a *missing item* gets `default`, a NULL title stays."""
    catalog = items.select("item_id", "title", "genres", F.lit(True).alias("_listed"))
    joined = facts.join(catalog, "item_id", "left")
    for field in ("title", "genres"):
        joined = joined.withColumn(
            field, F.when(F.col("_listed"), F.col(field)).otherwise(F.lit(default))
        )
    return joined.drop("_listed")
