"""Connected components of links between numbered rows, as joins and grouped minima.

Alternates the large-star and small-star steps of Kiveris et al. ("Connected Components
in MapReduce and Beyond", 2014) until the links are stars around each component's
smallest member. Minima are pre-aggregated before the shuffle, and a hub's links stand on
the side of a join that adaptive execution can split. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Hangs neighbours of u on the smallest among u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    kept = links.where("v > u" if larger else "v < u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least if not larger else None
    out = kept if own is None else kept.unionByName(own.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def smallest_member(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of `links` (a, b) but the smallest of each component."""
    path = work_path(links.sparkSession, "components")
    down = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    down, state = packed.staged(down, f"{path}/0"), None
    for i in range(1, rounds + 1):
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger=True)
        # What hangs on u after the small step: u's smaller neighbours and u itself.
        down = packed.staged(_star(large, larger=False), f"{path}/{i}")
        new = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return down.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = new
    raise RuntimeError(f"links did not settle in {rounds} rounds")
