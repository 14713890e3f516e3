from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import cells, tables
from scoreloom.operators.upsert import last_per_key, upsert
from scoreloom.schemas import CELLS, ITEM_CELLS
from tests.conftest import rows


def frame(spark, *data):
    return spark.createDataFrame(list(data), CELLS)


@pytest.fixture(scope="module")
def versions(spark):
    """Six versions of one cell, one of them written twice, and a second cell."""
    data = [("r", "f", "q", v, f"v{v}") for v in range(1, 7)]
    return frame(spark, *data, ("r", "f", "q", 3, "a copy"), ("s", "f", "q", 1, "only"))


def test_latest(versions):
    assert sorted(rows(cells.latest(versions))) == [
        ("r", "f", "q", 6, "v6"), ("s", "f", "q", 1, "only")
    ]


def test_newest_versions(versions):
    got = sorted(rows(cells.newest_versions(versions, 4)))
    assert [(r[3], r[4], r[5]) for r in got if r[0] == "r"] == [
        (3, "a copy", 4), (4, "v4", 3), (5, "v5", 2), (6, "v6", 1)
    ]
    with pytest.raises(ValueError):
        cells.newest_versions(versions, 0)


def test_oldest_of_newest(versions):
    assert sorted(rows(cells.oldest_of_newest(versions, 5))) == [
        ("r", "f", "q", 2, "v2"), ("s", "f", "q", 1, "only")
    ]


def test_deleting_the_newest_version_lets_the_older_one_resurface(spark, versions):
    target = frame(spark, ("r", "f", "q", None, None), ("gone", "f", "q", None, None))
    left = cells.delete_cells(versions, target)
    assert sorted(r[4] for r in rows(cells.latest(left))) == ["only", "v5"]
    none = cells.delete_cells(versions, target, all_versions=True)
    assert rows(none) == [("s", "f", "q", 1, "only")]


def test_wide_keeps_rows_without_the_columns(spark):
    data = frame(
        spark,
        ("1", "info", "title", 1, "old"), ("1", "info", "title", 2, "new"),
        ("1", "info", "genres", 1, "A|B"), ("2", "other", "title", 1, "elsewhere"),
    )
    assert sorted(rows(cells.wide(data, ITEM_CELLS))) == [("1", "new", "A|B"), ("2", None, None)]


def test_to_cells_skips_nulls(spark):
    df = spark.createDataFrame([(1, "t", None)], "item_id int, title string, genres string")
    assert rows(cells.to_cells(df, F.col("item_id"), ITEM_CELLS, F.lit(5))) == [
        ("1", "info", "title", 5, "t")
    ]


def test_rows_in_key_order(spark):
    data = frame(spark, *[(k, "f", "q", 1, k) for k in ("1", "2", "9", "10", "100")])
    table = cells.wide(data, {"v": ("f", "q")})
    assert [r[0] for r in rows(cells.first_rows(table, 4))] == ["1", "10", "100", "2"]
    assert sorted(r[0] for r in rows(cells.first_keys_cells(data, 3))) == ["1", "10", "100"]
    assert sorted(r[0] for r in rows(cells.key_range(table, "10", "2"))) == ["10", "100"]


def test_get_rows(spark, versions):
    assert rows(cells.get_row(versions, "s")) == [("s", "f", "q", 1, "only")]
    assert rows(cells.get_row(versions, "none")) == []
    keys = spark.createDataFrame([("r",), ("r",)], "row_key string")
    assert rows(cells.get_rows(versions, keys)) == [("r", "f", "q", 6, "v6")]


def test_schema_on_read(spark):
    data = frame(
        spark,
        # complete, with an empty time that therefore stays empty
        ("1_2_9", "info", "userId", 1, "1"), ("1_2_9", "info", "movieId", 1, "2"),
        ("1_2_9", "info", "rating", 1, "4.0"), ("1_2_9", "info", "timestamp", 1, ""),
        # aliases, the first in (family, qualifier) order, the newest version of it
        ("3_4", "b", "SCORE", 1, "1.0"), ("3_4", "a", "score", 1, "2.0"),
        ("3_4", "a", "score", 2, "2.5"), ("3_4", "z", "Time", 1, "77"),
        # the own cell goes before an alias of an earlier family
        ("5_6", "a", "rating", 1, "1.0"), ("5_6", "info", "rating", 1, "5.0"),
        # an empty time of an incomplete row comes from the key
        ("7_8_55", "info", "timestamp", 1, ""),
        # nothing in the key
        ("plain", "info", "rating", 1, "3.0"), ("plain_", "info", "rating", 1, "3.5"),
    )
    got = {r[0]: r[1:] for r in rows(cells.ratings_by_schema_on_read(data))}
    assert got == {
        "1_2_9": ("1", "2", "4.0", ""),
        "3_4": ("3", "4", "2.5", "77"),
        "5_6": ("5", "6", "5.0", None),
        "7_8_55": ("7", "8", None, "55"),
        "plain": (None, None, "3.0", None),
        "plain_": (None, None, "3.5", None),
    }


def test_upsert(spark):
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 1, "kept")], "k string, n int, v string")
    load = spark.createDataFrame(
        [("a", 1, "first"), ("a", 2, "last"), ("c", 1, "x"), ("c", 1, "y")],
        "k string, n int, v string",
    )
    for large_load in (False, True):
        got = sorted(rows(upsert(stored, load, ["k"], ["n"], large_load)))
        assert got == [("a", 2, "last"), ("b", 1, "kept"), ("c", 1, "y")]
    assert sorted(rows(last_per_key(load, ["k"], ["n"]))) == [("a", 2, "last"), ("c", 1, "y")]


# --- stored tables ----------------------------------------------------------------


def put(spark, name, row_key, version, **values):
    data = [(row_key, "info", q, version, v) for q, v in values.items()]
    tables.append_cells(spark, name, frame(spark, *data))


def current(spark, name, row_key):
    found = cells.get_row(tables.read_cells(spark, name), row_key)
    return {r["qualifier"]: r["value"] for r in found.collect()}


def test_life_of_a_table(spark):
    name = "demo_items"
    assert not tables.table_exists(spark, name)
    tables.create_table(spark, name, ["info"])
    tables.create_table(spark, name, ["info"])
    assert tables.table_exists(spark, name)
    assert tables.table_property(spark, name, "max_versions") == "3"

    put(spark, name, "1", 1, title="Toy Story (1995)", genres="Adventure|Animation")
    for key, title in [("2", "Jumanji (1995)"), ("3", "Grumpier Old Men (1995)"), ("4", "x")]:
        put(spark, name, key, 1, title=title, genres="Comedy")
    tables.append_cells(spark, name, frame(spark))
    stored = tables.read_cells(spark, name)
    assert rows(cells.count_rows(stored)) == [(4,)]
    assert current(spark, name, "2")["title"] == "Jumanji (1995)"
    assert current(spark, name, "999") == {}
    assert len(rows(cells.first_rows(cells.wide(stored, ITEM_CELLS), 100))) == 4

    genres_of_1 = frame(spark, ("1", "info", "genres", None, None))
    tables.rewrite_table(spark, name, cells.delete_cells(stored, genres_of_1))
    assert current(spark, name, "1") == {"title": "Toy Story (1995)"}
    put(spark, name, "1", 2, genres="Adventure")
    assert current(spark, name, "1")["genres"] == "Adventure"

    key_4 = spark.createDataFrame([("4",)], "row_key string")
    tables.rewrite_table(spark, name, cells.delete_rows(tables.read_cells(spark, name), key_4))
    assert rows(cells.count_rows(tables.read_cells(spark, name))) == [(3,)]
    assert current(spark, name, "4") == {}

    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not tables.table_exists(spark, name)


def test_put_get_delete_column_delete_row(spark):
    name, key = "demo_delete", "999999"
    tables.create_table(spark, name, ["info"])
    put(spark, name, key, 1, title="T", genres="G")
    assert current(spark, name, key) == {"title": "T", "genres": "G"}
    column = frame(spark, (key, "info", "genres", None, None))
    tables.rewrite_table(spark, name, cells.delete_cells(tables.read_cells(spark, name), column))
    assert current(spark, name, key) == {"title": "T"}
    gone = spark.createDataFrame([(key,)], "row_key string")
    tables.rewrite_table(spark, name, cells.delete_rows(tables.read_cells(spark, name), gone))
    assert current(spark, name, key) == {}
    tables.drop_table(spark, name)


def test_old_versions_are_trimmed(spark):
    name = "demo_versions"
    tables.create_table(spark, name, ["info"], max_versions=2)
    for version in range(1, 5):
        put(spark, name, "1", version, title=f"t{version}")
    tables.trim_versions(spark, name)
    assert sorted(r["value"] for r in tables.read_cells(spark, name).collect()) == ["t3", "t4"]
    assert tables.table_property(spark, name, "max_versions") == "2"
    tables.drop_table(spark, name)


def test_an_unknown_family_fails_the_write(spark):
    name = "demo_families"
    tables.create_table(spark, name, ["info"])
    with pytest.raises(Exception, match="has no family other"):
        tables.append_cells(spark, name, frame(spark, ("1", "other", "q", 1, "v")))
    assert tables.read_cells(spark, name).count() == 0
    tables.drop_table(spark, name)
    with pytest.raises(ValueError):
        tables.create_table(spark, name, [])
