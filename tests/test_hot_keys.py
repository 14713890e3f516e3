"""Brute-force comparison on random rows of which a third share one key."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from scoreloom.operators import cells, search, summary
from scoreloom.operators.lookup import one_name_per_item
from scoreloom.operators.upsert import upsert
from scoreloom.schemas import CELLS
from scoreloom.streaming import hot_items
from tests.conftest import rows

HOT = "7"


@pytest.fixture(scope="module")
def cell_data():
    rng = random.Random(1)
    data = []
    for _ in range(6000):
        key = HOT if rng.random() < 1 / 3 else str(rng.randrange(300))
        data.append((key, rng.choice("fg"), rng.choice("pq"), rng.randrange(1, 40), str(rng.randrange(99))))
    # A group of exact copies as well.
    return data + [(HOT, "f", "p", 39, "5")] * 2000


@pytest.fixture(scope="module")
def table(spark, cell_data):
    return spark.createDataFrame(cell_data, CELLS).repartition(16).persist()


@pytest.fixture(scope="module")
def by_cell(cell_data):
    """cell -> its versions, newest first, each with its smallest value."""
    values = defaultdict(dict)
    for *cell, version, value in cell_data:
        known = values[tuple(cell)]
        known[version] = min(value, known.get(version, value))
    return {cell: sorted(v.items(), reverse=True) for cell, v in values.items()}


def test_current_and_versions(table, by_cell):
    current = {tuple(r[:3]): (r[3], r[4]) for r in rows(cells.latest(table))}
    assert current == {cell: v[0] for cell, v in by_cell.items()}
    kept = defaultdict(list)
    for *cell, version, value, age in sorted(rows(cells.newest_versions(table, 5)), key=lambda r: r[5]):
        kept[tuple(cell)].append((version, value))
    assert kept == {cell: v[:5] for cell, v in by_cell.items()}
    oldest = {tuple(r[:3]): (r[3], r[4]) for r in rows(cells.oldest_of_newest(table, 5))}
    assert oldest == {cell: v[:5][-1] for cell, v in by_cell.items()}


def test_deletes(spark, table, by_cell):
    targets = [c for c in by_cell if c[1] == "f" and int(c[0]) % 2]
    frame = spark.createDataFrame([(*c, None, None) for c in targets * 2], CELLS)
    left = {tuple(r[:3]): (r[3], r[4]) for r in rows(cells.latest(cells.delete_cells(table, frame)))}
    want = {c: v[1 if c in targets else 0:] for c, v in by_cell.items()}
    assert left == {c: v[0] for c, v in want.items() if v}
    keys = spark.createDataFrame([(HOT,), (HOT,), ("8",)], "row_key string")
    remaining = cells.delete_rows(table, keys)
    assert remaining.count() == table.where("row_key not in ('7', '8')").count()
    assert rows(cells.count_rows(remaining)) == [(len({c[0] for c in by_cell} - {HOT, "8"}),)]


def test_wide(table, by_cell):
    got = {r[0]: r[1:] for r in rows(cells.wide(table, {"a": ("f", "p"), "b": ("g", "q")}))}

    def current(key, family, qualifier):
        versions = by_cell.get((key, family, qualifier))
        return versions[0][1] if versions else None

    keys = {c[0] for c in by_cell}
    assert got == {k: (current(k, "f", "p"), current(k, "g", "q")) for k in keys}


def test_upsert(spark):
    rng = random.Random(2)
    stored = {f"k{i}": 0 for i in range(500)}
    load = [(f"k{7 if rng.random() < 1 / 3 else rng.randrange(800)}", n + 1) for n in range(5000)]
    old = spark.createDataFrame(list(stored.items()), "k string, n int")
    new = spark.createDataFrame(load, "k string, n int").repartition(16)
    for large_load in (False, True):
        got = rows(upsert(old, new, ["k"], ["n"], large_load))
        assert dict(got) == {**stored, **dict(load)} and len(got) == len(dict(got))


@pytest.fixture(scope="module")
def rating_data():
    rng = random.Random(3)
    return [
        (f"{user}_{item}", str(user), item, str(rng.randrange(1, 11) / 2), "1")
        for user in range(6000)
        for item in [HOT if user % 3 == 0 else str(rng.randrange(50))]
    ]


def test_searches(spark, rating_data):
    items = spark.createDataFrame(
        [(str(i), str(i), f"title {i % 10}", "g") for i in range(60)],
        "row_key string, item_id string, title string, genres string",
    )
    ratings = spark.createDataFrame(rating_data, search.RATING_FIELDS).repartition(16)
    groups = defaultdict(list)
    for row in rating_data:
        groups[row[2]].append(row)
    hits = [str(i) for i in range(60) if i % 10 == 7]
    nested = defaultdict(list)
    for r in search.search_with_ratings(items, ratings, "title 7", chunk_rows=50).collect():
        assert r["rating_count"] == len(groups[r["item_id"]])
        assert len(r["ratings"]) < 120
        nested[r["item_id"]] += [tuple(x) for x in r["ratings"]]
    assert {k: sorted(v) for k, v in nested.items()} == {k: sorted(groups[k]) for k in hits}
    flat = search.search_with_rating_rows(items, ratings, "title 7").collect()
    assert len(flat) == sum(max(1, len(groups[k])) for k in hits)


def test_windows(spark, rating_data):
    events = spark.createDataFrame(
        [(u, i, float(r), f"2025-12-08 {int(u) // 600:02d}:{int(u) // 10 % 60:02d}:00")
         for _, u, i, r, _ in rating_data],
        "user_id string, item_id string, rating double, t string",
    ).selectExpr("*", "cast(t as timestamp) as event_time").repartition(16)
    items = spark.createDataFrame(
        [(str(i), f"name {i % 5}") for i in range(0, 50, 2)] + [(HOT, "hot")],
        "item_id string, title string",
    )
    names = dict(rows(one_name_per_item(items)))
    want = defaultdict(list)
    for _, u, i, r, _ in rating_data:
        minute = int(u) // 10
        start = f"2025-12-08 {minute // 60:02d}:{minute % 60 // 10}0:00"
        want[start, names.get(i, "未知")].append(float(r))
    for options in ({}, {"salts": 5}, {"count_before_lookup": True}):
        counts = hot_items.window_counts(events, one_name_per_item(items), **options)
        got = {(r["start_time"], r["name"]): (r["count"], r["avg_rating"]) for r in counts.collect()}
        assert set(got) == set(want)
        for group, ratings in want.items():
            assert got[group][0] == len(ratings)
            assert got[group][1] == pytest.approx(sum(ratings) / len(ratings), abs=0.00051)


def test_summary(spark, rating_data):
    ratings = spark.createDataFrame(rating_data, search.RATING_FIELDS).repartition(16)
    groups = defaultdict(list)
    for row in rating_data:
        groups[row[2]].append(float(row[3]))
    typed = ratings.withColumn("rating", ratings.rating.cast("double"))
    for r in summary.item_stats(typed).collect():
        mine = groups[r["item_id"]]
        assert r["rating_user_count"] == len(mine)
        assert (r["max_rating"], r["min_rating"]) == (max(mine), min(mine))
        assert r["sum_rating"] == sum(mine)
