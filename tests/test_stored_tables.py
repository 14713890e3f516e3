"""Bucketed cells, key ranges, lookup and title indexes, and bitmaps."""

from __future__ import annotations

import os
import posixpath
import random
import re

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import bitmaps, buckets, cells, key_index, ranges, search, summary, title_index
from scoreloom.operators.upsert import upsert
from scoreloom.plans import stored_tables, views
from scoreloom.schemas import CELLS
from scoreloom.session import work_path
from tests.conftest import plan_of, rows
from tests.test_plans import no_broadcast

RATINGS = "row_key string, user_id string, item_id string, rating double, timestamp long"


def exchanges(df) -> int:
    """Shuffles of the plan before any of it runs."""
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan_of(df)))


def files(path: str) -> dict[str, float]:
    """Data files under a folder and their times."""
    found = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def some_cells(spark, n=3000, hot=0):
    rng = random.Random(n)
    made = [(f"r{rng.randrange(400)}", "info", rng.choice(["a", "b"]), rng.randrange(50), f"v{rng.randrange(9)}") for _ in range(n)]
    made += [("hot", "info", "a", i, f"v{i}") for i in range(hot)]
    return spark.createDataFrame(made, CELLS)


# --- bucketed cells ------------------------------------------------------------------


def test_bucketed_cells_need_no_shuffle(spark):
    plain = some_cells(spark)
    stored = buckets.open_cells(spark, buckets.store_cells(plain, buckets=8))
    gone = spark.createDataFrame([("r1",), ("r2",), (None,)], "row_key string")
    pairs = [
        (cells.latest(stored), cells.latest(plain)),
        (cells.newest_versions(stored, 2), cells.newest_versions(plain, 2)),
        (cells.wide(stored, {"a": ("info", "a")}), cells.wide(plain, {"a": ("info", "a")})),
    ]
    with no_broadcast(spark):
        for mine, _ in pairs:
            assert exchanges(mine) == 0
        left = cells.delete_rows(stored, gone)
        assert exchanges(left) == exchanges(gone.distinct())  # the keys only
        assert exchanges(cells.count_rows(stored)) == 1  # one partial count a task
    for mine, theirs in [*pairs, (left, cells.delete_rows(plain, gone))]:
        assert sorted(rows(mine)) == sorted(rows(theirs.select(*mine.columns)))


def test_a_bucketed_lookup_reads_one_bucket(spark):
    stored = buckets.store_cells(some_cells(spark), buckets=8)
    found = cells.get_row(spark.table(stored.name), "r7")
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(found)
    assert found.count() == 2


def test_a_hot_row_is_read_without_its_bucket(spark):
    plain = some_cells(spark, hot=20_000)
    stored = buckets.store_cells(plain, buckets=8)
    assert buckets.skew(spark, stored) > 5
    opened = cells.latest(buckets.open_cells(spark, stored))
    assert exchanges(opened) == 1 and "partial_min" in plan_of(opened)
    assert sorted(rows(opened)) == sorted(rows(cells.latest(plain).select(*opened.columns)))


def test_empty_bucketed_table(spark):
    stored = buckets.store_cells(some_cells(spark).limit(0), buckets=4)
    assert buckets.skew(spark, stored) == 0 and cells.latest(buckets.open_cells(spark, stored)).count() == 0


# --- key ranges ------------------------------------------------------------------------


def test_a_load_leaves_other_ranges_unchanged(spark):
    path = work_path(spark, "ranges")
    df = spark.range(1000).select(F.format_string("k%04d", "id").alias("row_key"), F.col("id").alias("n"), F.lit(1).alias("t"))
    ranges.create(df, path, ranges=10)
    before = files(path)
    load = df.where("n BETWEEN 500 AND 509").withColumn("t", F.lit(2))  # one per cent of the keys
    ids = ranges.upsert(spark, path, load, ["t"])
    after = files(path)
    assert 1 <= len(ids) <= 2
    gone = [f for f in before if f not in after]
    assert gone and all(any(f"{ranges.RANGE}={i}/" in f for i in ids) for f in gone)
    assert all(after[f] == before[f] for f in before if f in after) and len(before) - len(gone) >= 8
    assert sorted(rows(ranges.read(spark, path))) == sorted(rows(upsert(df, load, ["row_key"], ["t"])))


def test_random_loads_and_deletes(spark):
    rng, path = random.Random(3), work_path(spark, "ranges")
    want = {f"{rng.randrange(10**6)}é"[:k]: 0 for k in (2, 3, 5, 7) for _ in range(80)}
    ranges.create(spark.createDataFrame(list(want.items()), "row_key string, n long"), path, ranges=6)
    for turn in (1, 2):
        load = {rng.choice([*want, f"{rng.randrange(10**4)}", "", "~~"]): turn for _ in range(30)}
        ranges.upsert(spark, path, spark.createDataFrame(list(load.items()), "row_key string, n long"), ["n"], turn == 2)
        want |= load
        gone = rng.sample(sorted(want), 20) + ["not there"]
        ranges.delete_rows(spark, path, spark.createDataFrame([(k,) for k in gone], "row_key string"))
        want = {k: n for k, n in want.items() if k not in gone}
        assert sorted(rows(ranges.read(spark, path).select("row_key", "n"))) == sorted(want.items())


def test_emptied_ranges_and_empty_tables(spark):
    path = work_path(spark, "ranges")
    df = spark.range(100).select(F.format_string("k%02d", "id").alias("row_key"), "id")
    ranges.create(df, path, ranges=4)
    ranges.delete_rows(spark, path, df.where("id < 60"))
    assert sorted(rows(ranges.read(spark, path))) == sorted(rows(df.where("id >= 60")))
    ranges.upsert(spark, path, df.where("id = 3"), ["id"])
    assert ranges.read(spark, path).count() == 41
    assert ranges.upsert(spark, path, df.limit(0), ["id"]) == []
    empty = work_path(spark, "ranges")
    ranges.create(df.limit(0), empty, ranges=4)
    ranges.upsert(spark, empty, df.where("id < 5"), ["id"])
    assert sorted(rows(ranges.read(spark, empty))) == sorted(rows(df.where("id < 5")))


def test_deletes_of_cells_equal_the_plain_ones(spark):
    plain = some_cells(spark)
    path = work_path(spark, "ranges")
    ranges.create(plain, path, ranges=5)
    targets = spark.createDataFrame([(f"r{i}", "info", q) for i in range(20, 60) for q in "ab"], "row_key string, family string, qualifier string")
    for every in (False, True):
        want = cells.delete_cells(ranges.read(spark, path), targets, every)
        want = sorted(rows(want.select(*[f.name for f in CELLS.fields])))
        ranges.delete_cells(spark, path, targets, every)
        assert sorted(rows(ranges.read(spark, path).select(*[f.name for f in CELLS.fields]))) == want


# --- lookups -----------------------------------------------------------------------------


def some_ratings(spark, turn=0):
    rng = random.Random(turn)
    made = {}
    for _ in range(400):
        user, item, time = rng.randrange(30), rng.randrange(40), rng.randrange(40)
        key = rng.choice([f"{user}_{item}", f"{user}_{item}_{time}", f"e{user}-{item}", f"{user}"])
        made[key] = (key, None if rng.random() < 0.1 else f"{user}", f"{item}", float(turn), turn)
    return spark.createDataFrame(list(made.values()), RATINGS)


def answers(spark, path, table, texts):
    """Indexed answers beside those of a scan of the same ratings."""
    for text in texts:
        yield key_index.ratings_of_user(spark, path, text), search.ratings_of_user(table, text)
        yield key_index.ratings_of_item(spark, path, text), search.ratings_of_item(table, text)
        yield key_index.ratings_mentioning(spark, path, text), table.where(search.key_mentions(text))
        yield key_index.find_ratings_of_user(spark, path, text), search.find_ratings_of_user(table, text)
        for pattern in (False, True):
            yield (
                key_index.find_ratings_of_item(spark, path, text, pattern),
                search.find_ratings_of_item(table, text, pattern),
            )


def test_indexed_lookups_equal_scans_before_and_after_loads(spark):
    path, table = work_path(spark, "index"), some_ratings(spark)
    key_index.create(table, path, 4)
    for mine, theirs in answers(spark, path, table, ["7"]):
        assert sorted(rows(mine), key=str) == sorted(rows(theirs.select(*mine.columns)), key=str)
    key_index.add(spark, path, some_ratings(spark, 1), ["timestamp"])
    table = upsert(table, some_ratings(spark, 1), ["row_key"], ["timestamp"])
    for mine, theirs in answers(spark, path, table, ["7", "e3", "none"]):
        assert sorted(rows(mine), key=str) == sorted(rows(theirs.select(*mine.columns)), key=str)
    with pytest.raises(ValueError):
        key_index.ratings_of_item(spark, path, " ")


def test_every_scan_of_a_lookup_has_an_equality_or_a_prefix(spark):
    path = work_path(spark, "index")
    key_index.create(some_ratings(spark), path, 4)
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    lookups = [
        key_index.ratings_of_user(spark, path, "7"), key_index.ratings_of_item(spark, path, "7"),
        key_index.ratings_mentioning(spark, path, "7"), key_index.find_ratings_of_user(spark, path, "7"),
        key_index.find_ratings_of_item(spark, path, "7"), key_index.find_ratings_of_item(spark, path, "7", True),
    ]
    for found in lookups:
        pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(found))
        assert pushed and all("EqualTo(value,7)" in p or "StringStartsWith(row_key,7_)" in p for p in pushed)
        assert "Join" not in plan_of(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


# --- title index ---------------------------------------------------------------------------

TITLES = ["Red Ring", "ring", "RING ring", "a", "", None, "ab", "Äpfel über Ähren", "%_\\", "x" * 5000, "spring  ring", "ri ng", "Ring", "字母表"]


@pytest.mark.parametrize("lower", [True, False])
def test_title_index_equals_a_scan(spark, lower):
    items = spark.createDataFrame([(f"{i}", t, i) for i, t in enumerate(TITLES)], "row_key string, title string, n int")
    text = F.lower("title") if lower else F.col("title")
    path = work_path(spark, "titles")
    title_index.create(items, path, text, files=3)
    for keyword in ["ring", "Ring", "r", "g r", "Ähr", "%_", "\\", "x" * 100, "字母表", "ringr", "n\u0001"]:
        found = title_index.search(spark, path, keyword)
        assert sorted(rows(found), key=str) == sorted(rows(items.where(text.contains(keyword))), key=str)
    with pytest.raises(ValueError):
        title_index.search(spark, path, "")


def test_title_search_reads_the_keyword_s_postings(spark):
    items = spark.createDataFrame([(f"{i}", t) for i, t in enumerate(TITLES)], "row_key string, title string")
    path = work_path(spark, "titles")
    title_index.create(items, path, F.col("title"), files=3)
    assert "PushedFilters: [In(gram, [ing,rin])]" in plan_of(title_index.candidates(spark, path, "ring"))
    assert "StringStartsWith(gram,ri)" in plan_of(title_index.candidates(spark, path, "ri"))


# --- bitmaps -----------------------------------------------------------------------------


def test_bitmaps_add_up_to_distinct_users(spark):
    days = [
        spark.createDataFrame([(u,) for u in users], "user_id long")
        for users in ([1, 2, 2, 32768, 32769], [], [2, -5, None, 2**62, None], [None, 0, 10**7])
    ]
    maps = [bitmaps.of_ids(d) for d in days]
    for upto in range(1, 5):
        everything = days[0]
        for d in days[1:upto]:
            everything = everything.unionByName(d)
        assert rows(bitmaps.count(bitmaps.merge(*maps[:upto]))) == rows(summary.distinct_users(everything))


def test_bitmaps_shuffle_no_ids(spark, sf_dir):
    plan = plan_of(bitmaps.of_ids(views.ratings(spark, sf_dir).select("user_id")))
    ahead = [line for line in plan.splitlines() if "bitmap" in line.lower() and "partial" in line]
    assert ahead, "bitmaps are made before the shuffle"


@pytest.mark.parametrize("name", ["stored_cells_current", "stored_cell_versions", "stored_rating_scan"])
def test_registered_scans_of_stored_cells_plan_no_exchange(spark, sf_dir, name):
    with no_broadcast(spark):
        assert exchanges(getattr(stored_tables, name)(spark, sf_dir)) == 0


def test_a_range_is_written_by_several_tasks(spark):
    """Creating a table cuts each range at its own keys: no task holds a whole range."""
    df = spark.range(4000).select(F.format_string("k%05d", "id").alias("row_key"), "id")
    path = work_path(spark, "wide-ranges")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges.create(df, path, ranges=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = [f for f in files(posixpath.join(path, "rows"))]
    numbers = {int(re.search(rf"{ranges.RANGE}=(\d+)", f).group(1)) for f in written}
    assert numbers == {0, 1}
    assert len(written) > len(numbers)
    assert sorted(rows(ranges.read(spark, path))) == sorted(rows(df))
    key, lows, _ = ranges._bounds(spark, path)
    assert key == "row_key" and lows[0] == "k00000" and len(lows) == 2


def test_an_empty_table_keeps_its_key_and_rewritten_files_stay_sorted(spark):
    """The ranges name their key column also without rows; a rewrite keeps each file in key order."""
    df = spark.range(300).select(F.format_string("k%03d", (F.col("id") * 7) % 300).alias("code"), "id")
    empty = work_path(spark, "ranges")
    ranges.create(df.limit(0), empty, key="code", ranges=3)
    assert ranges._bounds(spark, empty)[0] == "code"
    ranges.upsert(spark, empty, df.where("id < 5"), ["id"])
    assert sorted(rows(ranges.read(spark, empty))) == sorted(rows(df.where("id < 5")))
    path = work_path(spark, "ranges")
    ranges.create(df, path, key="code", ranges=3)
    key, lows, _ = ranges._bounds(spark, path)
    lowest = ranges.stored(spark, path).groupBy(ranges.RANGE).agg(F.min("code")).orderBy(ranges.RANGE)
    assert key == "code" and lows == [r[1] for r in lowest.collect()]
    ranges.upsert(spark, path, df.where("id % 2 = 0").withColumn("id", F.col("id") + 1000), ["id"])
    stored = ranges.stored(spark, path).withColumn("file", F.input_file_name())
    for part in stored.groupBy("file").agg(F.collect_list("code").alias("codes")).collect():
        assert part.codes == sorted(part.codes)
    want = upsert(df, df.where("id % 2 = 0").withColumn("id", F.col("id") + 1000), ["code"], ["id"])
    assert sorted(rows(ranges.read(spark, path))) == sorted(rows(want))


def test_buckets_larger_than_a_split_are_read_split(spark):
    """With a fixed number of buckets, no task reads a whole bucket once buckets outgrow a split."""
    plain = some_cells(spark)
    stored = buckets.store_cells(plain, buckets=2)
    assert buckets.skew(spark, stored) <= buckets.MOST_SKEW
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        assert buckets.largest_bucket_bytes(spark, stored) > 256
        opened = cells.latest(buckets.open_cells(spark, stored))
        assert exchanges(opened) == 1
        assert sorted(rows(opened)) == sorted(rows(cells.latest(plain).select(*opened.columns)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rating_table_scan_aggregates_after_dealing_by_key(spark, sf_dir):
    """The wide rows are aggregated after the cells are dealt by key, not within file splits."""
    from scoreloom.plans import keyed_tables

    plan = plan_of(keyed_tables.rating_table_scan(spark, sf_dir))
    scan = plan.rindex("FileScan")
    deal = max(plan.rfind("Exchange hashpartitioning(row_key"), plan.rfind("Exchange SinglePartition"))
    aggregates = [m.start() for m in re.finditer(r"(Sort|Hash|ObjectHash)Aggregate", plan)]
    assert 0 <= deal < scan and all(a < deal for a in aggregates)


def test_range_tasks_grow_with_the_rows(spark, monkeypatch):
    """With coalescing on, the rows are still dealt into one task per ROWS_PER_TASK rows at least."""
    monkeypatch.setattr(ranges, "ROWS_PER_TASK", 100, raising=False)
    df = spark.range(4000).select(F.format_string("k%05d", "id").alias("row_key"), "id")
    path = work_path(spark, "growing-ranges")
    ranges.create(df, path, ranges=2)
    written = files(posixpath.join(path, "rows"))
    assert len(written) >= 4000 // 100
    assert sorted(rows(ranges.read(spark, path))) == sorted(rows(df))
    stored = ranges.stored(spark, path).withColumn("file", F.input_file_name())
    for part in stored.groupBy("file").agg(F.collect_list("row_key").alias("keys")).collect():
        assert part.keys == sorted(part.keys)


def plain_ratings(spark, n=600):
    """Ratings whose keys name their user and their item."""
    user, item = (F.col("id") % 40).cast("string"), F.floor(F.col("id") / 40).cast("string")
    return spark.range(n).select(
        F.concat(user, F.lit("_"), item).alias("row_key"), user.alias("user_id"), item.alias("item_id"),
        F.lit(1.0).alias("rating"), F.col("id").alias("timestamp"),
    )


def test_the_index_holds_what_the_key_does_not_answer(spark):
    """One entry for a key that names user and item; the columns only where the key says something else."""
    table = plain_ratings(spark)
    assert key_index.entries(table).count() == table.count()
    odd = [
        ("1_2", "1", "2", 1.0, 1),  # named by the key
        ("1_2_3", "1", "3", 1.0, 1),  # the item is a later part, not the second
        ("12_2", "1", "2", 1.0, 1),  # the key starts with another user
        ("1", "1", "2", 1.0, 1),  # no second part
        ("e1-2", "1", "2", 1.0, 1),
        ("1_", "1", None, 1.0, 1),
        ("9_2", None, "2", 1.0, 1),
        ("a_b_2", "a_b", "b", 1.0, 1),  # a user with the separator
        (None, "1", "2", 1.0, 1),
    ]
    table = spark.createDataFrame(odd, RATINGS)
    kinds = sorted(rows(key_index.entries(table).where("kind <> 'part'").select("row_key", "kind")))
    assert kinds == sorted([
        ("1_2_3", "item"), ("12_2", "user"), ("1", "user"), ("1", "item"), ("e1-2", "user"), ("e1-2", "item"),
    ])
    path, table = work_path(spark, "index"), table.where("row_key IS NOT NULL")
    key_index.create(table, path, 4)
    for mine, theirs in answers(spark, path, table, ["1", "2", "3", "12", "a_b", "b", "9"]):
        assert sorted(rows(mine), key=str) == sorted(rows(theirs.select(*mine.columns)), key=str)


def test_a_load_of_one_item_rewrites_the_ranges_of_its_entries(spark):
    path, table = work_path(spark, "index"), plain_ratings(spark, 4000)
    key_index.create(table, path, 8)
    before = files(posixpath.join(path, "entries", "rows"))
    assert len({f.split(f"{ranges.RANGE}=")[1].split("/")[0] for f in before}) == 8
    load = table.where("item_id = '7'").withColumn("rating", F.lit(5.0))
    key_index.add(spark, path, load, ["timestamp"])
    after = files(posixpath.join(path, "entries", "rows"))
    assert len({f.split(f"{ranges.RANGE}=")[1].split("/")[0] for f in before if f not in after}) <= 2
    found = key_index.ratings_of_item(spark, path, "7")
    assert sorted(rows(found)) == sorted(rows(load.select(*found.columns)))


def test_rows_are_staged_at_most_once(spark, monkeypatch):
    """A table is written from one staged copy, its index from the stored ratings; a load rewrites in one write."""
    staged = []
    for module in (ranges, key_index):
        monkeypatch.setattr(module, "work_path", lambda s, label: staged.append(label) or work_path(s, label))
    path, table = work_path(spark, "index"), plain_ratings(spark)
    key_index.create(table, path, 4)
    assert staged == ["range-rows"]
    key_index.add(spark, path, table.where("user_id = '3'").withColumn("rating", F.lit(5.0)), ["timestamp"])
    assert staged == ["range-rows", "indexed-load"]
    assert key_index.ratings_table(spark, path).where("rating = 5").count() == table.where("user_id = '3'").count()


def test_few_and_null_keys_still_make_ranges(spark):
    df = spark.range(400).select(F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 5)).alias("row_key"), "id")
    path = work_path(spark, "few-keys")
    ranges.create(df, path, ranges=3)
    _, lows, numbers = ranges._bounds(spark, path)
    assert len(lows) == 3 and lows == sorted(lows) and len(set(numbers)) == 3
    assert sorted(rows(ranges.read(spark, path)), key=str) == sorted(rows(df), key=str)
    ids = ranges.delete_rows(spark, path, spark.createDataFrame([("k4",)], "row_key string"))
    assert len(ids) == 1
    assert sorted(rows(ranges.read(spark, path)), key=str) == sorted(rows(df.where("row_key IS NULL OR row_key <> 'k4'")), key=str)
    only = work_path(spark, "null-keys")
    ranges.create(df.where("row_key IS NULL"), only, ranges=3)
    ranges.upsert(spark, only, df.where("id = 1"), ["id"])
    assert sorted(rows(ranges.read(spark, only)), key=str) == sorted(rows(df.where("row_key IS NULL OR id = 1")), key=str)


def test_keyed_ratings_shuffle_no_key(spark, sf_dir):
    """The key is made of user and item after they are grouped."""
    from scoreloom.plans.searches import keyed_ratings

    with no_broadcast(spark):
        plan = plan_of(keyed_ratings(spark, sf_dir))
    assert "Exchange hashpartitioning(user_id" in plan and "Exchange hashpartitioning(row_key" not in plan
