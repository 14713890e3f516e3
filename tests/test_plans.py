"""The physical plans that matter at scale."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.operators import cells, search, summary, tables
from scoreloom.operators.lookup import one_name_per_item
from scoreloom.plans import views
from scoreloom.session import work_path
from scoreloom.streaming import hot_items
from tests.conftest import plan_of


@contextlib.contextmanager
def no_broadcast(spark):
    """Plan as if every table were too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Queries that run a stream or write files while they are built.
EAGER = {"hot_items_stream", "hot_topn_readback", "windowed_append", "micro_batch_counts",
         "raw_event_latest", "ingest_reconciliation", "ingest_items", "typed_csv_scan",
         "rating_table_scan", "search_with_ratings", "search_with_rating_rows"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - EAGER))
def test_no_cross_join_no_python_and_no_single_task_window(spark, sf_dir, name):
    with no_broadcast(spark):
        plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    # The only single-partition exchanges are those of one-row aggregates.
    lines = plan.splitlines()
    for above, line in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate(keys=[]" in above or "Aggregate(key=[]" in above


# Hinted broadcasts of the text operators: fingerprints that over a thousandth of all rows share
# (fewer than a thousand), and one row for each range of a sort.
BOUNDED = {"op12_simhash_near_dedup", "op13_importance_resampling"}


def test_no_broadcast_of_anything_that_can_grow(spark, sf_dir):
    """With automatic broadcasts off, the hinted broadcasts are the n-key list and bounded ones."""
    hinted = set()
    with no_broadcast(spark):
        for name in set(entry.queries()) - EAGER:
            if "BroadcastExchange" in plan_of(entry.queries()[name](spark, sf_dir)):
                hinted.add(name)
    assert hinted - BOUNDED == {"first_keys_cells"}


def test_item_summary_reads_two_columns_and_shuffles_once_per_side(spark, sf_dir):
    with no_broadcast(spark):
        plan = plan_of(entry.queries()["item_summary"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_avg" in plan


def test_window_counts_join_small_names_without_shuffling_events(spark, sf_dir):
    plan = plan_of(entry.queries()["window_counts"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan
    # One for the names, one for the windows.
    assert plan.count("Exchange hashpartitioning") == 2


def test_large_names_are_joined_to_counts(spark, sf_dir):
    with no_broadcast(spark):
        plan = plan_of(hot_items.window_counts(
            views.events(spark, sf_dir),
            one_name_per_item(views.items(spark, sf_dir)),
            count_before_lookup=True,
        ))
    join_input = plan[plan.index("SortMergeJoin"):]
    assert "partial_count(user_id" in join_input


def test_versions_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry.queries()["cell_versions_k"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_top_k_needs_no_global_sort(spark, sf_dir):
    for name in ("popular_items", "hot_items_batch", "first_n_by_key", "title_exact"):
        plan = plan_of(entry.queries()[name](spark, sf_dir))
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_chunks_of_one_item_are_spread(spark, sf_dir):
    """Between the join by item and the nesting there is a shuffle by item and chunk."""
    items, ratings = views.items(spark, sf_dir), views.ratings(spark, sf_dir)
    with no_broadcast(spark):
        plan = plan_of(search.search_with_ratings(items, ratings, "ring"))
    nesting = plan.index("collect_list")
    join = plan.index("SortMergeJoin", nesting)
    assert re.search(r"Exchange hashpartitioning\(item_id#\d+L?, chunk", plan[nesting:join])


def test_ratings_of_hits_are_counted_before_the_shuffle(spark, sf_dir):
    items, ratings = views.items(spark, sf_dir), views.item_ratings(spark, sf_dir)
    with no_broadcast(spark):
        plan = plan_of(search.search_with_figures(items, ratings, "ring"))
    semi = plan.index("LeftSemi")
    assert "partial_count" in plan[semi:]
    small = plan_of(search.search_with_figures(items, ratings, "ring"))
    counting = small.index("partial_count")
    assert "LeftSemi" in small[counting:]


def test_key_lists_reach_below_the_aggregate_when_small(spark, sf_dir):
    keys = views.items(spark, sf_dir)
    plan = plan_of(cells.get_rows(views.rating_cells(spark, sf_dir), keys))
    aggregate = plan.index("partial_min")
    assert "LeftSemi" in plan[aggregate:]


def test_key_predicates_reach_the_stored_table(spark, sf_dir):
    path = work_path(spark, "stored")
    tables.by_key(views.rating_cells(spark, sf_dir)).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "EqualTo(row_key,77)" in plan_of(cells.get_row(stored, "77"))
    assert "StringStartsWith(row_key,7_)" in plan_of(search.ratings_of_user(stored, "7"))
    assert "StringContains(value,4)" in plan_of(search.containing(stored, "value", "4"))
    ranged = plan_of(cells.key_range(stored, "10", "20"))
    assert "GreaterThanOrEqual(row_key,10)" in ranged and "LessThan(row_key,20)" in ranged
    wide = plan_of(cells.wide(stored.where(F.col("row_key") == "77"), {"r": ("rateinfo", "rating")}))
    assert "EqualTo(row_key,77)" in wide


def test_range_filters_on_ratings_reach_the_scan(spark, sf_dir):
    path = work_path(spark, "typed")
    views.item_ratings(spark, sf_dir).write.parquet(path)
    plan = plan_of(summary.items_by_rating(
        views.items(spark, sf_dir), spark.read.parquet(path), 2.0, 4.0
    ))
    assert "GreaterThanOrEqual(rating,2.0)" in plan and "LessThanOrEqual(rating,4.0)" in plan
    assert "ReadSchema: struct<item_id:bigint,rating:double>" in plan


def test_a_stored_table_is_sorted_by_key(spark, sf_dir):
    path = work_path(spark, "sorted")
    source = views.rating_cells(spark, sf_dir)
    tables.by_key(source).write.parquet(path)
    stored = spark.read.parquet(path)
    spans = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("row_key").alias("low"), F.max("row_key").alias("high")
    ).orderBy("low", "high").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))
    assert stored.count() == source.count()
