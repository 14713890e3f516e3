from __future__ import annotations

import pytest

from scoreloom.operators.lookup import one_name_per_item
from scoreloom.session import work_path
from scoreloom.sources import csv_files
from scoreloom.streaming.replay import file_messages
from pyspark.sql import functions as F
from tests.conftest import rows

ITEMS = '''movieId,title,genres
1,Toy Story (1995),Adventure|Animation
2,"American President, The (1995)",Comedy
3,"The ""Quoted"" One",\t Drama 
4,Short record
 5 ,  Padded  ,
6,Long record,Drama,extra
2,Last one wins,Drama
'''

RATINGS = """userId,movieId,rating,timestamp
1,1,4.0,964982703
1,3,x,964981247
2,1,5.0
1,1,2.5,964990000
"""


@pytest.fixture()
def items_file(tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(ITEMS)
    return str(path)


@pytest.fixture()
def ratings_file(tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text(RATINGS)
    return str(path)


def test_typed_scans(spark, tmp_path):
    (tmp_path / "m.csv").write_text("movieId,title,genres\n1,Über,Drama\n")
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,4.5,9\n")
    for infer in (False, True):
        assert rows(csv_files.read_items(spark, str(tmp_path / "m.csv"), infer)) == [
            (1, "Über", "Drama")
        ]
    ratings = csv_files.read_ratings(spark, str(tmp_path / "r.csv"))
    assert rows(ratings) == [(1, 2, 4.5, 9)]
    assert [t for _, t in ratings.dtypes] == ["bigint", "bigint", "double", "bigint"]


def test_schema_wider_than_the_file(spark, tmp_path):
    (tmp_path / "m.csv").write_text("movieId,title,genres\n1,A,Drama\n")
    assert rows(csv_files.read_item_names(spark, str(tmp_path / "m.csv")).drop("load_order")) == [(1, "A")]


def test_ingest_items(spark, items_file):
    load = csv_files.ingest_items(spark, items_file)
    assert rows(load.accepted.drop("load_order")) == [
        ("1", "1", "Toy Story (1995)", "Adventure|Animation"),
        ("2", "2", "American President, The (1995)", "Comedy"),
        ("3", "3", 'The "Quoted" One', "Drama"),
        ("5", "5", "Padded", ""),
        ("6", "6", "Long record", "Drama"),
        ("2", "2", "Last one wins", "Drama"),
    ]
    assert rows(load.rejected) == [("4,Short record",)]


def test_counting_accepted_rows_does_not_lose_the_short_record(spark, items_file):
    load = csv_files.ingest_items(spark, items_file)
    assert load.accepted.count() == 6
    assert load.rejected.count() == 1


def test_load_and_reconcile(spark, ratings_file):
    load = csv_files.ingest_ratings(spark, ratings_file)
    columns = ["row_key", "user_id", "item_id", "rating", "timestamp"]
    stored = spark.createDataFrame(
        [("1_3", "1", "3", "1.0", "1"), ("9_9", "9", "9", "2.0", "2")], columns
    )
    after = csv_files.load(stored, load)
    assert sorted(rows(after)) == [
        ("1_1", "1", "1", "2.5", "964990000"),
        ("1_3", "1", "3", "x", "964981247"),
        ("9_9", "9", "9", "2.0", "2"),
    ]
    assert csv_files.reconcile(load, after).first().asDict() == {
        "read_count": 4,
        "rejected_count": 1,
        "duplicate_count": 1,
        "stored_count": 3,
        "complete": True,
    }
    assert csv_files.reconcile(load, stored).first()["complete"] is False


def test_reconcile_of_an_empty_file(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("userId,movieId,rating,timestamp\n")
    load = csv_files.ingest_ratings(spark, str(tmp_path / "empty.csv"))
    report = csv_files.reconcile(load, load.accepted).first()
    assert tuple(report) == (0, 0, 0, 0, True)


def test_lines_are_numbered_across_file_blocks(spark, tmp_path):
    path = tmp_path / "many.csv"
    lines = ["userId,movieId,rating,timestamp"]
    lines += [f"{i},{i % 7},{(i % 10 + 1) / 2},{i}" for i in range(20_000)]
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        numbered = csv_files.rating_lines(spark, str(path))
        assert numbered.where("line_number <> user_id + 2").count() == 0
        assert numbered.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_replay_messages(spark, ratings_file):
    sent = F.lit("2025-12-08 12:33:16").cast("timestamp")
    got = rows(file_messages(spark, ratings_file, sent).orderBy("key"))
    assert got[0] == (
        "2",
        '{"userId":1,"movieId":1,"rating":4.0,"timestamp":964982703,'
        '"createTime":"2025-12-08 12:33:16"}',
    )
    assert [key for key, _ in got] == ["2", "3", "4", "5"]


def write(spark, lines: str) -> str:
    path = work_path(spark, "csv")
    spark.createDataFrame([(lines.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return path


def test_longer_records_with_an_empty_required_field_stay(spark):
    text = 'userId,movieId,rating,timestamp\n1,2,3.0,,extra\n1,3,4.0\n3000000000,"4,5",1.0,7,a,b\n'
    ingest = csv_files.ingest_ratings(spark, write(spark, text))
    assert sorted(r.user_id for r in ingest.accepted.collect()) == ["1", "3000000000"]
    assert [r.record for r in ingest.rejected.collect()] == ["1,3,4.0"]


def test_line_breaks_inside_quotes_are_a_choice(spark):
    path = write(spark, 'movieId,title,genres\n1,"Two\nlines",x\n2,One,y\n')
    kept = csv_files.ingest_items(spark, path, multi_line=True).accepted
    assert sorted((r.item_id, r.title) for r in kept.collect()) == [("1", "Two\nlines"), ("2", "One")]


def test_ids_beyond_32_bits_are_read(spark):
    path = write(spark, "userId,movieId,rating,timestamp\n3000000000,4000000000,3.5,5\n")
    for frame in (csv_files.read_ratings(spark, path), csv_files.rating_lines(spark, path)):
        assert [(r.user_id, r.item_id) for r in frame.collect()] == [(3000000000, 4000000000)]


def test_the_last_name_of_a_repeated_id_wins(spark):
    path = write(spark, "movieId,title,genres\n1,Zeta,x\n1,Alpha,x\n")
    assert [r.name for r in one_name_per_item(csv_files.read_item_names(spark, path)).collect()] == ["Alpha"]
